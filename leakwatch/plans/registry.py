"""Named queries over the test tables, each with its check where SQL can state one."""

from pyspark.sql import functions as F

QUERIES = {}
CHECKS = {}


def query(name, check=None):
    """Register a function (spark, sf_dir) -> DataFrame under a name."""

    def keep(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return keep


def rounded(frame, digits=6):
    """Doubles rounded, so that the order of summation does not show."""
    cells = []
    for name, kind in frame.dtypes:
        c = F.col(f"`{name}`")
        # Adding zero turns -0.0 into 0.0.
        cells.append((F.round(c, digits) + F.lit(0.0)).alias(name) if kind == "double" else c)
    return frame.select(*cells)


def sql(*views_and_body):
    """WITH view definitions, then the body."""
    *ctes, body = views_and_body
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
