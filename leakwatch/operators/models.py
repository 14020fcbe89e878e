"""Learned detectors on MLlib, their scoring rules, and saved models."""

import json

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import prep, spread

LABEL, WEIGHT, FEATURES = "label", "weight", "features"


def _usable(rows, names):
    """Features as finite doubles, so that no row is lost in the assembler."""
    return rows.withColumns({f"f{i}": C.finite(F.col(f"`{n}`")) for i, n in enumerate(names)})


def _assembler(names):
    return VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol=FEATURES)


def _fit(rows, names, estimator, weights=None, weighted=True):
    frame = _usable(rows, names)
    if weighted:
        frame = prep.with_class_weight(frame, LABEL, weights)
        estimator = estimator.setWeightCol(WEIGHT)
    estimator = estimator.setLabelCol(LABEL).setFeaturesCol(FEATURES)
    return Pipeline(stages=[_assembler(names), estimator]).fit(frame)


def fit_forest(rows, names=None, seed=fixed.SEED, **options):
    """Random forest on window features with balanced class weights."""
    forest = RandomForestClassifier(seed=seed, **{**fixed.FOREST, **options})
    return _fit(rows, names or fixed.RUNTIME_FEATURES, forest)


def fit_dense(rows, names, layers=None, iterations=60, seed=fixed.SEED):
    """Dense network; it takes no weights, so balance the rows beforehand."""
    sizes = [len(names), *(layers or fixed.DENSE_LAYERS), 2]
    net = MultilayerPerceptronClassifier(layers=sizes, maxIter=iterations, seed=seed)
    return _fit(rows, names, net, weighted=False)


def fit_logistic(rows, names, weights=None, iterations=50):
    return _fit(rows, names, LogisticRegression(maxIter=iterations), weights)


def fit_boosted(rows, names, weights=None, seed=fixed.SEED, **options):
    return _fit(rows, names, GBTClassifier(seed=seed, **options), weights)


def score(rows, model, names, name="score"):
    """Probability of the positive class for every row."""
    scored = model.transform(_usable(rows, names))
    added = [f"f{i}" for i in range(len(names))] + [FEATURES, "rawPrediction", "probability", "prediction"]
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(*added)


def score_foreign(rows, predict, names, name="score"):
    """Scores of a model from elsewhere; `predict` maps a matrix to a vector.

    It runs over Arrow batches; the function is shipped to the tasks.
    """

    @F.pandas_udf("double")
    def scored(cells: pd.Series) -> pd.Series:
        return pd.Series(np.asarray(predict(np.array(cells.tolist())), dtype=float))

    return rows.withColumn(name, scored(F.array(*[C.finite(F.col(f"`{n}`")) for n in names])))


# --- decisions --------------------------------------------------------------------


def raw_score_prediction(c, threshold=None):
    """A stored threshold decides; without one a score in 0..1 counts as probability
    and any other as a distance whose negative side is anomalous."""
    if threshold is not None:
        return (c >= threshold).cast("int")
    probability = c.between(0.0, 1.0)
    return F.when(probability, (c >= 0.5).cast("int")).otherwise((c < 0.0).cast("int"))


def median_prediction(scores, by=("model",)):
    """Scores below the model's median are flagged."""
    medians = spread.exact_quantiles(scores, by, "score", {"median_score": 0.5})
    joined = scores.join(medians, list(by)) if by else scores.withColumn("median_score", medians.scalar())
    return joined.withColumn("prediction", (F.col("score") < F.col("median_score")).cast("int"))


def flip_sign(c):
    """Distance score to anomaly score and its decision."""
    return (-c).alias("anomaly_score"), ((-c) > 0).cast("int").alias("prediction")


# --- saved models -------------------------------------------------------------------


def save(model, path, names, threshold, window_seconds, training_rows, metrics=None, kind="runtime_window"):
    """Model directory with its metadata row beside it."""
    model.write().overwrite().save(f"{path}/model")
    meta = {
        "model_type": kind,
        "feature_names": list(names),
        "threshold": float(threshold),
        "window_size": float(window_seconds),
        "training_rows": {k: int(v) for k, v in training_rows.items()},
        "metrics": metrics or {},
    }
    line = SparkSession.active().createDataFrame([(json.dumps(meta),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark, path):
    """The model and its metadata."""
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    return PipelineModel.load(f"{path}/model"), meta


def compatible(meta, columns, window_seconds=None):
    """Whether the frame has every feature and the window length of the model."""
    fits = set(meta["feature_names"]) <= set(columns)
    if window_seconds is not None:
        fits = fits and float(meta["window_size"]) == float(window_seconds)
    return fits


def predict_windows(windows, model, meta, window_seconds=None):
    """model_score and prediction by the stored threshold. A model that does not fit
    gives nulls, and the other detectors go on without it."""
    names = meta["feature_names"]
    if not compatible(meta, windows.columns, window_seconds):
        return windows.withColumns(
            {"model_score": F.lit(None).cast("double"), "prediction": F.lit(None).cast("int")}
        )
    scored = score(windows, model, names, "model_score")
    return scored.withColumn("prediction", raw_score_prediction(F.col("model_score"), meta["threshold"]))
