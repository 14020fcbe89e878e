import random

import pytest
from pyspark.sql import functions as F

from leakwatch.functions import schemas
from leakwatch.operators import evaluate, iforest, models


def frame(spark, rows):
    return spark.createDataFrame([("m", i, y, float(s), "test") for i, (y, s) in enumerate(rows)], schemas.SCORE)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(int(rng.random() < 0.2), rng.randrange(40) / 40) for _ in range(600)]


def test_area_equals_all_pairs(spark, rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    got = evaluate.roc_auc(frame(spark, rows)).first()["auc"]
    assert got == pytest.approx(wins / len(pos) / len(neg))


def test_one_class_has_area_one_half(spark):
    assert evaluate.roc_auc(frame(spark, [(0, 0.1), (0, 0.9)])).first()["auc"] == 0.5


def test_curve_counts_equal_direct_counts(spark, rows):
    for r in evaluate.curve(frame(spark, rows)).collect():
        t = r["threshold"]
        assert r["tp"] == sum(y and s >= t for y, s in rows)
        assert r["fp"] == sum(not y and s >= t for y, s in rows)
        assert r["tn"] == sum(not y and s < t for y, s in rows)
        assert r["fn"] == sum(y and s < t for y, s in rows)


def test_nothing_flagged_gives_null_rates(spark):
    row = evaluate.classification_metrics(frame(spark, [(1, 0.2), (0, 0.1)]), 0.5).first()
    assert row["precision"] is None and row["tn"] == 1 and row["fn"] == 1


def test_optimal_threshold_prefers_recall_then_the_higher_cut(spark):
    data = frame(spark, [(1, 0.9), (1, 0.8), (0, 0.7), (0, 0.6), (1, 0.5), (0, 0.4)])
    best = evaluate.optimal_threshold(evaluate.threshold_scan(data), max_fpr=0.34).first()
    assert (best["threshold"], best["fpr_met"], best["recall_met"]) == (0.8, True, False)


def test_no_allowed_threshold_takes_the_lowest_fpr(spark):
    data = frame(spark, [(0, 0.9), (1, 0.8), (0, 0.7)])
    best = evaluate.optimal_threshold(evaluate.threshold_scan(data), max_fpr=0.1).first()
    assert (best["threshold"], best["fpr_met"]) == (0.9, False)


def test_no_scanned_threshold_falls_back(spark):
    data = frame(spark, [(0, 5.0), (1, 7.0)])
    scan = evaluate.threshold_scan(data)
    assert scan.count() == 0
    assert evaluate.threshold_or_default(data, evaluate.optimal_threshold(scan)).first()["threshold"] == 0.5


def test_threshold_is_only_changed_for_more_recall(spark):
    same = evaluate.improve_threshold(frame(spark, [(1, 0.9), (0, 0.1)])).first()
    assert same["threshold"] == 0.5 and not same["improved"]
    more = evaluate.improve_threshold(frame(spark, [(1, 0.9), (1, 0.3), (0, 0.1)])).first()
    assert more["threshold"] == 0.3 and more["improved"]


def test_raw_score_rule(spark):
    data = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (1.0,), (-0.1,), (1.5,)], "s double")
    got = [r[0] for r in data.select(models.raw_score_prediction(F.col("s"))).collect()]
    assert got == [0, 0, 1, 1, 1, 0]


def test_median_flags_the_lower_half(spark):
    out = models.median_prediction(frame(spark, [(0, s) for s in (1, 2, 3, 4)])).orderBy("score").collect()
    assert [r["prediction"] for r in out] == [1, 1, 0, 0] and out[0]["median_score"] == 2.5


def test_ties_go_to_the_supervised_model(spark):
    both = spark.createDataFrame([("anomaly", 0.5, 0.1), ("supervised", 0.5, 0.1)], "model string, auc double, fpr double")
    table = both.withColumns({n: F.lit(0.0) for n in ("f1", "precision", "recall")})
    assert {r["winner"] for r in evaluate.metric_winner(table, "anomaly", "supervised").collect()} == {"supervised"}


def test_cutoff_leaves_the_share_above(spark):
    data = frame(spark, [(0, s) for s in range(101)])
    assert iforest.contamination_cutoff(data, 0.05, "score").first()["cutoff"] == pytest.approx(95.0)
