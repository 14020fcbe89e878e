import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import NORMAL, window_frame
from leakwatch.functions import fixed
from leakwatch.operators import baseline, rules
from leakwatch.operators.moments import NAMES, Baselines, rounds


def vector(**changes):
    return np.array([{**NORMAL, **changes}[n] for n in NAMES], dtype=float)


def learned(values, name="request_count"):
    b = Baselines(1)
    for v in values:
        b.step([0], vector(**{name: v})[None, :], 0.5, 10**9)
    return b, NAMES.index(name)


def z_of(b, i, **changes):
    """Absolute z-score of one feature, from what a step returns."""
    *_, n, mean, std = b.step([0], vector(**changes)[None, :], 0.5, 0)
    return abs(vector(**changes)[i] - mean[0, i]) / std[0, i] if std[0, i] >= fixed.STD_FLOOR else 0.0


@pytest.mark.parametrize("values,mean,variance", [
    ([5.0], 5.0, 0.0), ([0.0, 10.0], 5.0, 25.0), ([2.0, 4.0, 4.0, 4.0, 5.0], 3.8, 0.96),
])
def test_running_mean_and_variance(values, mean, variance):
    b, i = learned(values)
    assert b.mean[0, i] == pytest.approx(mean)
    assert b.m2[0, i] / b.n[0] == pytest.approx(variance)


def test_moments_by_group(spark):
    rows = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 3.0)], "k string, v double")
    out = {r["k"]: r for r in baseline.running_moments(rows, ["k"], "v").collect()}
    assert (out["a"]["mean"], out["a"]["variance"], out["a"]["std"]) == (5.0, 25.0, 5.0)
    assert out["b"]["variance"] == 0.0


def test_merge_moments(spark):
    rows = spark.createDataFrame([(p, float(v)) for p, vs in enumerate([(1, 2, 3), (7, 8, 9)]) for v in vs], "p int, v double")
    parts = baseline.moments(rows.withColumn("k", F.lit("x")), ["k", "p"], "v")
    merged = baseline.merge_moments(parts, ["k"]).first()
    assert merged["n"] == 6 and merged["mean"] == pytest.approx(5.0)
    assert merged["m2"] / 6 == pytest.approx(np.var([1, 2, 3, 7, 8, 9]))


def test_merge_keeps_precision_far_from_zero(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(3e9, 1.0, 2000)
    rows = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "p int, v double")
    merged = baseline.merge_moments(baseline.moments(rows, ["p"], "v"), []).first()
    assert merged["mean"] == pytest.approx(values.mean(), rel=1e-12)
    assert merged["m2"] == pytest.approx(((values - values.mean()) ** 2).sum(), rel=1e-4)


def test_merge_ignores_empty_parts(spark):
    parts = spark.createDataFrame([("x", 0, None, None), ("x", 2, 5.0, 50.0)], "k string, n bigint, mean double, m2 double")
    assert tuple(baseline.merge_moments(parts, ["k"]).first()) == ("x", 2, 5.0, 50.0)


def test_z_scores_normal_and_deviating():
    b, i = learned([10 + k % 5 for k in range(20)])
    assert z_of(b, i, request_count=12) < 2.0
    assert z_of(b, i, request_count=100) > 10.0


def test_few_rows_and_constant_features_score_zero(spark):
    b, i = learned([10])
    assert z_of(b, i, request_count=99) == 0.0
    out = results(window_frame(spark, [{"request_count": 10}] * 3 + [{"request_count": 1000}]), warmup=3)
    assert out[3]["online_score"] == 0.0 and "request_count=const (std≈0)" in out[3]["reason_codes"]
    out = results(window_frame(spark, [{}] * 2), warmup=1)
    assert "request_count=N/A (baseline n=1)" in out[1]["reason_codes"]


def test_scores_of_normal_and_extreme_windows():
    def score(**changes):
        b = Baselines(1)
        for k in range(10):
            b.step([0], vector(request_count=10 + k % 5, upload_download_ratio=0.5 + k % 3 * 0.1)[None, :], 0.5, 10**9)
        return b.step([0], vector(**changes)[None, :], 0.5, 10)[1][0]

    low, high = score(request_count=12, upload_download_ratio=0.6), score(request_count=20, upload_download_ratio=500.0)
    assert 0.0 <= low < 0.5 < high <= 1.0


def test_sources_advance_together_as_they_would_alone():
    rng = np.random.default_rng(5)
    series = rng.normal(size=(40, 6, len(NAMES))) * rng.choice([1, 8], size=(40, 6, 1), p=[0.9, 0.1])
    both = Baselines(6)
    together = [both.step(np.arange(6), x, 0.5, 10) for x in series]
    for source in range(6):
        alone = Baselines(1)
        for k in range(40):
            one = alone.step([0], series[k, source][None, :], 0.5, 10)
            assert all((a[0] == t[source]).all() for a, t in zip(one, together[k]))
    assert sum(t[2].sum() for t in together) > 5  # some were flagged


def test_rounds_keep_the_order_of_repeats():
    at = np.array([3, 1, 3, 3, 1, 0])
    assert [at[r].tolist() for r in rounds(at)] == [[3, 1, 0], [3, 1], [3]]
    assert [r.tolist() for r in rounds(at)] == [[0, 1, 5], [2, 4], [3]] and rounds(np.zeros(0, int)) == []


def test_many_sources_with_gaps_and_repeated_starts(spark):
    """Sources of one task, windows of equal start, and Arrow batches that cut through a step."""
    frame = window_frame(spark, [{"request_count": 10 + k % 7, "src_ip": "x"} for k in range(30)])
    frame = frame.unionByName(frame.filter("window_start % 180 = 0"))
    wide = frame.crossJoin(spark.range(25).select(F.concat(F.lit("s"), F.col("id")).alias("_s"))).withColumn("src_ip", F.col("_s")).drop("_s")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
        many = baseline.monitor(wide, warmup=5).groupBy("src_ip").agg(
            F.sort_array(F.collect_list(F.struct("window_start", "baseline_count", "online_score"))).alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    one = [(r["window_start"], r["baseline_count"], r["online_score"]) for r in
           baseline.monitor(frame, warmup=5).orderBy("window_start", "baseline_count").collect()]
    assert len(many) == 25 and all([tuple(v) for v in r["v"]] == one for r in many)


def results(frame, **options):
    return baseline.monitor(frame, **options).orderBy("src_ip", "window_start").collect()


def test_disabled(spark):
    row = results(window_frame(spark, [{}]), enabled=False)[0]
    assert (row["online_score"], row["online_prediction"], row["baseline_count"]) == (0.0, 0, 0)
    assert row["reason_codes"] == ["online_monitor_disabled"]


def test_warmup_then_scoring(spark):
    out = results(window_frame(spark, [{"request_count": 10 + k} for k in range(11)]))
    assert [r["reason_codes"] for r in out[:10]] == [[f"warmup_{k + 1}/10"] for k in range(10)]
    assert all(r["online_prediction"] == 0 for r in out[:10])
    assert not any("warmup" in c for c in out[10]["reason_codes"])


def test_normal_window_enters_the_baseline(spark):
    out = results(window_frame(spark, [{"request_count": 10 + k} for k in range(3)] + [{"request_count": 11}]), warmup=3)
    assert out[3]["online_prediction"] == 0 and out[3]["baseline_count"] == 4


def test_flagged_window_does_not(spark):
    past = [{"request_count": 10 + k, "upload_download_ratio": 0.5 + k * 0.1} for k in range(3)]
    out = results(window_frame(spark, past + [{"upload_download_ratio": 500.0}]), warmup=3, threshold=0.3)
    assert out[3]["online_prediction"] == 1 and out[3]["baseline_count"] == 3


def test_extreme_deviation(spark):
    past = [{"request_count": 10 + k % 3, "upload_download_ratio": 0.5 + k % 3 * 0.1} for k in range(5)]
    row = results(window_frame(spark, past + [{"upload_download_ratio": 500.0, "request_count": 20}]), warmup=5)[-1]
    assert row["online_prediction"] == 1 and row["online_score"] > 0.5
    assert any(c.startswith("HIGH_Z: upload_download_ratio") for c in row["reason_codes"])


def test_sources_are_independent(spark):
    mixed = []
    for k in range(5):
        mixed += [{"src_ip": "10.0.0.1", "request_count": 10 + k}, {"src_ip": "10.0.0.2", "request_count": 50 + k}]
    mixed += [{"src_ip": "10.0.0.1", "request_count": 12, "upload_download_ratio": 500.0}, {"src_ip": "10.0.0.2", "request_count": 52}]
    out = results(window_frame(spark, mixed), warmup=5)
    last = {r["src_ip"]: r for r in out}
    # The ratio never varied, so it adds nothing however far it is off.
    assert last["10.0.0.2"]["online_prediction"] == 0 and last["10.0.0.2"]["baseline_count"] == 6
    means = {r["src_ip"]: r["mean"] for r in baseline.profile(window_frame(spark, mixed[:10])).filter("feature = 'request_count'").collect()}
    assert means == {"10.0.0.1": 12.0, "10.0.0.2": 52.0}


def test_stats_and_reset(spark):
    windows = window_frame(spark, [{}, {"src_ip": "10.0.0.2"}])
    stats = baseline.monitor_stats(baseline.monitor(windows)).first()
    assert (stats["windows_processed"], stats["baselines_created"]) == (2, 2)
    left = baseline.source_stats(baseline.monitor(baseline.without_sources(windows, ["10.0.0.1"])))
    assert [r["src_ip"] for r in left.collect()] == ["10.0.0.2"]
    assert baseline.monitor_stats(baseline.monitor(baseline.without_sources(windows))).first()["baselines_created"] == 0


def test_reset_clears_the_past_and_goes_on(spark):
    changes = [{"total_bytes": 1000.0 + i} for i in range(30)] + [{"src_ip": "10.0.0.2"} for _ in range(5)]
    windows = window_frame(spark, changes)
    resets = spark.createDataFrame([("10.0.0.1", 60.0 * 20), (None, 60.0 * 32)], "src_ip string, at double")
    out = baseline.monitor(baseline.with_resets(windows, resets)).orderBy("window_start").collect()
    assert len(out) == 35 and [r["epoch"] for r in out] == [0] * 20 + [1] * 10 + [0] * 2 + [1] * 3
    fresh = baseline.monitor(window_frame(spark, changes).filter("src_ip = '10.0.0.1' and window_start >= 1200"))
    again = [r["online_score"] for r in fresh.orderBy("window_start").collect()]
    assert [r["online_score"] for r in out[20:30]] == again
    assert out[20]["baseline_count"] < out[19]["baseline_count"]


def test_nulls_count_as_zero(spark):
    frame = window_frame(spark, [{} for _ in range(3)]).withColumn("request_rate", F.lit(None).cast("double"))
    assert len(results(frame, warmup=2)) == 3


def test_rule_score(spark):
    frame = window_frame(spark, [{}, {"upload_download_ratio": 200.0, "burst_count": 100, "total_bytes": 200_000}])
    scores = [r["rule_score"] for r in rules.rule_score(frame).orderBy("window_start").collect()]
    assert scores[0] < 0.5 < scores[1]


def test_rule_needs_ratio_and_bytes(spark):
    frame = window_frame(spark, [{"upload_download_ratio": 200.0}, {"total_bytes": 200_000}, {"inter_request_time_std": 0.01, "request_count": 4}])
    assert [r["rule_score"] for r in rules.rule_score(frame).collect()] == [0.0, 0.0, 0.0]


def fused(spark, **extra):
    frame = window_frame(spark, [{"upload_download_ratio": 200.0, "burst_count": 100, "total_bytes": 200_000, "unusual_port_ratio": 0.9}])
    whole = ["request_count", "total_bytes", "total_fwd_bytes", "total_bwd_bytes", "burst_count", "unique_destinations"]
    frame = frame.withColumns({n: F.col(n).cast("bigint") for n in whole})
    return rules.fuse(rules.rule_score(frame).withColumns(extra))


def test_alert_text_without_online_fields(spark):
    text = rules.alert_text(fused(spark)).first()["alert_text"]
    assert "Burst score:   0.800" in text and "[BURST_RULE] Burst exfil score" in text
    assert "Online score" not in text and "Model score" not in text and "Prediction" not in text


def test_alert_text_with_online_fields(spark):
    text = rules.alert_text(fused(
        spark, online_score=F.lit(0.75), online_prediction=F.lit(1), baseline_count=F.lit(12).cast("bigint"),
        reason_codes=F.array(*[F.lit(f"reason {i}") for i in range(7)]),
    )).first()["alert_text"]
    assert "Online score:  0.750  (ANOMALY)" in text and "Baseline n:   12" in text
    assert "reason 4" in text and "reason 5" not in text


def test_compact_text_has_three_reasons(spark):
    text = rules.compact_text(fused(
        spark, online_score=F.lit(0.75), online_prediction=F.lit(1), reason_codes=F.array(*[F.lit(f"reason {i}") for i in range(7)]),
    )).first()["message"]
    assert "reason 2" in text and "reason 3" not in text and text.endswith("Payload content was not included.")


def test_model_trigger_without_rule_is_medium(spark):
    frame = window_frame(spark, [{}])
    row = rules.fuse(rules.rule_score(frame).withColumn("prediction", F.lit(1))).first()
    assert row["triggers"] == ["OFFLINE_MODEL"] and row["severity"] == "MEDIUM" and row["alert"]
    quiet = rules.fuse(rules.rule_score(frame)).first()
    assert quiet["triggers"] == [] and quiet["severity"] == "INFO" and not quiet["alert"]


def test_weights_cover_the_features():
    assert set(fixed.BASELINE_WEIGHTS) == set(fixed.RUNTIME_FEATURES)
    assert sum(fixed.BASELINE_WEIGHTS.values()) == pytest.approx(13.5)
