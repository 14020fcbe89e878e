"""One place to save and load detectors of any kind, and one rule set for their decisions.

A saved model is a folder: a line of JSON that names its kind and features, and what the kind needs
(an MLlib pipeline, a node table, or nothing more). Loading dispatches on the kind.
"""

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.operators import iforest, models, spread

# Kinds whose scores fall for stranger rows; the scores of all others are chances of the positive class.
ANOMALY_KINDS = {"isolation_forest"}


@dataclass
class Saved:
    """A detector ready to score: its kind, features, optional threshold and window length, and its parts."""

    kind: str
    names: list
    threshold: float | None = None
    window_seconds: float | None = None
    parts: Any = None
    notes: dict = field(default_factory=dict)

    def fits(self, columns, window_seconds=None):
        """Whether a frame has all features, and its windows the length the model was trained on."""
        right = window_seconds is None or self.window_seconds is None or float(self.window_seconds) == float(window_seconds)
        return right and set(self.names) <= set(columns)

    def score(self, rows, window_seconds=None, name="model_score"):
        """Rows with the model's raw score; null for all if the model does not fit them."""
        if not self.fits(rows.columns, window_seconds):
            return rows.withColumn(name, F.lit(None).cast("double"))
        return _SCORERS[self.kind](rows, self, name)

    def predict(self, rows, threshold=None, window_seconds=None, name="model_score"):
        """Score and `prediction`. Anomaly scores are flagged below the threshold, which is their median where none is
        given; chances are flagged strictly above it, 0.5 where none is given. A window model keeps its own rule: at its stored
        threshold or above. Without a score there is no prediction."""
        scored = self.score(rows, window_seconds, name)
        c = F.col(name)
        if self.kind in ANOMALY_KINDS:
            if threshold is None:
                middle = spread.exact_quantiles(scored.select(name), [], name, {"m": 0.5}).scalar()
                scored = scored.withColumn("_middle", middle)
            flagged = c < (F.col("_middle") if threshold is None else F.lit(float(threshold)))
        elif threshold is None and self.kind == "runtime_window":
            flagged = models.raw_score_prediction(c, self.threshold) == 1
        else:
            flagged = c > F.lit(0.5 if threshold is None else float(threshold))
        return scored.withColumn("prediction", F.when(c.isNotNull(), flagged.cast("int"))).drop("_middle")


def _linear(rows, saved, name):
    """Logistic chance of a weighted sum."""
    total = F.lit(float(saved.parts["intercept"]))
    for n, w in zip(saved.names, saved.parts["weights"]):
        total = total + C.finite(F.col(f"`{n}`")) * F.lit(float(w))
    return rows.withColumn(name, 1.0 / (1.0 + F.exp(-total)))


def _nodes(rows, saved, name):
    """Decision value of a forest: lower is stranger."""
    nodes, take = saved.parts
    scored = iforest.score(rows, nodes, saved.names, take, name)
    return scored.withColumn(name, iforest.decision(name))


_SCORERS = {
    "linear": _linear,
    "isolation_forest": _nodes,
    "pipeline": lambda rows, saved, name: models.score(rows, saved.parts, saved.names, name),
    "runtime_window": lambda rows, saved, name: models.score(rows, saved.parts, saved.names, name),
}


def save(saved, path, spark):
    """Write a model; a folder that is there is replaced."""
    if saved.kind not in _SCORERS:
        raise ValueError(f"unknown kind of model: {saved.kind}")
    meta = {
        "model_type": saved.kind, "feature_names": list(saved.names), "threshold": saved.threshold,
        "window_size": saved.window_seconds, "notes": saved.notes,
    }
    if saved.kind == "linear":
        meta["parts"] = {"weights": list(map(float, saved.parts["weights"])), "intercept": float(saved.parts["intercept"])}
    elif saved.kind == "isolation_forest":
        nodes, take = saved.parts
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta["sample_size"] = int(take)
    else:
        saved.parts.write().overwrite().save(f"{path}/model")
    line = spark.createDataFrame([(json.dumps(meta),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark, path):
    """The model saved at a path, whatever its kind."""
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    kind = meta["model_type"]
    if kind not in _SCORERS:
        raise ValueError(f"unknown kind of model: {kind}")
    if kind == "linear":
        parts = meta["parts"]
    elif kind == "isolation_forest":
        parts = spark.read.schema(iforest.NODE).parquet(f"{path}/nodes"), meta["sample_size"]
    else:
        parts = PipelineModel.load(f"{path}/model")
    return Saved(kind, meta["feature_names"], meta["threshold"], meta["window_size"], parts, meta.get("notes") or {})
