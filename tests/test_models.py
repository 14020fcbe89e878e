import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import NORMAL, window_frame
from leakwatch.functions import fixed
from leakwatch.operators import iforest, models, oversample
from leakwatch.plans import detection
from leakwatch.session import fresh_dir


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    normal = [(i, *map(float, rng.normal(0, 1, 2)), 0) for i in range(600)]
    odd = [(1000 + i, *map(float, rng.normal(8, 0.5, 2)), 1) for i in range(12)]
    return spark.createDataFrame(normal + odd, "id bigint, a double, b double, label int").cache()


def test_forest_separates_planted_points(spark, cloud):
    nodes, take = iforest.fit(cloud.filter("label = 0"), ["a", "b"], trees=60)
    scored = iforest.score(cloud, nodes, ["a", "b"], take)
    means = {r["label"]: r["s"] for r in scored.groupBy("label").agg(F.avg("anomaly_score").alias("s")).collect()}
    assert 0 < means[0] < means[1] <= 1 and means[1] > 0.6
    assert scored.count() == cloud.count()
    path = fresh_dir(spark, "forest")
    iforest.save(nodes, take, ["a", "b"], path)
    again, size, names = iforest.load(spark, path)
    same = iforest.score(cloud, again, names, size)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, scored.collect()))


@pytest.mark.parametrize("rows,trees,want", [(612, 3, 3), (612, 40, 40), (100, 5, 5)])
def test_samples_are_drawn_without_replacement(spark, cloud, rows, trees, want):
    samples, take = iforest.draw_samples(cloud.limit(rows), ["a"], trees, 256, "id", 1)
    sizes = samples.groupBy("tree").agg(F.count("id").alias("n"), F.count_distinct("id").alias("d")).collect()
    assert len(sizes) == want and {(r["n"], r["d"]) for r in sizes} == {(take, take)}


def test_interpolation_reaches_the_ratio(spark, cloud):
    out = oversample.interpolate_minority(cloud, ["a", "b"], 0.1)
    made = out.filter("synthetic")
    assert out.filter("label = 1").count() == 60 and made.count() == 48
    box = made.agg(F.min("a"), F.max("a")).first()
    real = cloud.filter("label = 1").agg(F.min("a"), F.max("a")).first()
    assert real[0] <= box[0] and box[1] <= real[1]


def test_too_few_minority_rows_are_left_alone(spark, cloud):
    few = cloud.filter("id < 1005")
    assert oversample.interpolate_minority(few, ["a", "b"]).count() == few.count()


def test_interpolation_makes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def label(i):
        seen.add(1)
        return int(i % 20 == 0)

    rows = spark.range(400).selectExpr("id", "double(id % 7) AS a", "double(id % 11) AS b").withColumn("label", label("id"))
    out = oversample.interpolate_minority(rows, ["a", "b"], 0.2)
    assert out.groupBy("label").count().orderBy("label").collect() == [(0, 380), (1, 76)]
    assert seen.value == 400


def test_jitter_reaches_the_target_and_stays_positive(spark, cloud):
    few = cloud.limit(7)
    out = oversample.jitter(few, ["a", "b"], 50)
    assert out.count() == 50 and out.filter("copy > 0").agg(F.min("a")).first()[0] >= 0
    assert oversample.jitter(few, ["a", "b"], 5).count() == 7


def test_saved_model_scores_the_same_and_is_checked(spark):
    changes = [{"upload_download_ratio": 300.0 if i % 3 == 0 else 0.5, "burst_count": 90 if i % 3 == 0 else 2} for i in range(60)]
    frame = window_frame(spark, changes).withColumn("label", (F.col("burst_count") > 50).cast("int"))
    model = models.fit_forest(frame, numTrees=10)
    path = fresh_dir(spark, "model")
    models.save(model, path, fixed.RUNTIME_FEATURES, fixed.FOREST_THRESHOLD, 60, {"normal": 40, "attack": 20})
    loaded, meta = models.load(spark, path)
    scored = models.predict_windows(frame, loaded, meta, 60)
    assert scored.filter("prediction = label").count() == 60
    assert meta["training_rows"] == {"normal": 40, "attack": 20} and meta["threshold"] == 0.8
    # Another window length, or a missing feature, leaves the model out.
    for other in (models.predict_windows(frame, loaded, meta, 10), models.predict_windows(frame.drop("burst_count"), loaded, meta)):
        assert other.filter("model_score IS NOT NULL OR prediction IS NOT NULL").count() == 0
    whole = detection.score_windows(frame.drop("label"), loaded, meta, online=False)
    assert whole.filter("array_contains(triggers, 'OFFLINE_MODEL')").count() == 20


def test_foreign_model(spark):
    frame = window_frame(spark, [{"burst_ratio": 0.9}, {}])
    out = models.score_foreign(frame, lambda x: x[:, 0] * 2, ["burst_ratio"]).orderBy("window_start").collect()
    assert [r["score"] for r in out] == [1.8, 2 * NORMAL["burst_ratio"]]


def test_boosted_and_logistic_learn_the_cloud(spark, cloud):
    for model in (models.fit_logistic(cloud, ["a", "b"]), models.fit_boosted(cloud, ["a", "b"], maxIter=3)):
        scored = models.score(cloud, model, ["a", "b"])
        assert scored.filter("(score >= 0.5) = (label = 1)").count() > 600
