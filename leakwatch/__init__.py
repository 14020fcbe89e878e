"""leakwatch: find data leaving a network over web traffic, as Spark jobs."""

__version__ = "0.1.0"
