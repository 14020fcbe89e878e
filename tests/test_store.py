import pytest
from pyspark.sql import functions as F

from leakwatch.functions import fixed
from leakwatch.operators import iforest, models, store
from leakwatch.plans import model_queries
from leakwatch.session import fresh_dir


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, 90.0).otherwise(2.0).alias("b"),
        (F.col("id") % 3 == 0).cast("int").alias("label"))


def again(spark, saved):
    path = fresh_dir(spark, "model")
    store.save(saved, path, spark)
    return store.load(spark, path)


def scores(frame):
    return [tuple(r) for r in frame.select("id", "model_score").orderBy("id").collect()]


def test_every_kind_comes_back_and_scores_the_same(spark, rows):
    logistic = models.fit_logistic(rows, ["a", "b"])
    nodes, take = iforest.fit(rows, ["a", "b"], trees=10)
    for saved in (
        store.Saved("pipeline", ["a", "b"], parts=logistic),
        store.Saved("runtime_window", ["a", "b"], fixed.FOREST_THRESHOLD, 60.0, logistic, {"rows": 300}),
        store.Saved("isolation_forest", ["a", "b"], parts=(nodes.cache(), take)),
        store.Saved("linear", ["b"], parts={"weights": [1.0], "intercept": -3.0}),
    ):
        loaded = again(spark, saved)
        assert (loaded.kind, loaded.names, loaded.threshold, loaded.notes) == (saved.kind, saved.names, saved.threshold, saved.notes)
        assert scores(loaded.score(rows)) == scores(saved.score(rows))


def test_decisions_follow_the_kind(spark, rows):
    exact = rows.withColumn("b", F.lit(0.0))
    linear = store.Saved("linear", ["b"], parts={"weights": [1.0], "intercept": 0.0})
    assert exact.count() == linear.predict(exact).filter("prediction = 0").count()  # 0.5 is not above 0.5
    window = store.Saved("runtime_window", ["a", "b"], 0.0, 60.0, models.fit_logistic(rows, ["a", "b"]))
    assert window.predict(rows).filter("prediction = 1").count() == 300  # at the threshold or above
    nodes, take = iforest.fit(rows, ["a", "b"], trees=10)
    forest = store.Saved("isolation_forest", ["a", "b"], parts=(nodes.cache(), take))
    flagged = forest.predict(rows).agg(F.sum("prediction"), F.count(F.lit(1))).first()
    assert 0 < flagged[0] <= flagged[1] / 2
    assert forest.predict(rows, threshold=-9).agg(F.sum("prediction")).first()[0] == 0


def test_a_model_that_does_not_fit_gives_nulls(spark, rows):
    saved = store.Saved("linear", ["b"], window_seconds=60, parts={"weights": [1.0], "intercept": 0.0})
    for out in (saved.predict(rows.drop("b")), saved.predict(rows, window_seconds=10)):
        assert out.filter("model_score is null and prediction is null").count() == 300
    assert saved.predict(rows, window_seconds=60).filter("prediction is null").count() == 0


def test_unknown_kinds_are_refused(spark):
    with pytest.raises(ValueError):
        store.save(store.Saved("other", []), fresh_dir(spark, "model"), spark)


def test_queries_reach_both_decisions(spark, sf):
    for kind, rule in [(r["kind"], r["n"]) for r in model_queries.predict_binary(spark, sf).groupBy("kind", "rule").agg(F.countDistinct("prediction").alias("n")).collect()]:
        assert rule == 2, kind
    fits = model_queries.model_fit_check(spark, sf).filter("model = 'fits'")
    assert fits.select("prediction").distinct().count() == 2
