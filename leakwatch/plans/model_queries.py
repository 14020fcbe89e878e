"""Queries over saved models and other written results."""

from pyspark.sql import functions as F

from leakwatch.operators import baseline, iforest, prep, rules, store, windows
from leakwatch.plans.flow_queries import FLOWS, LABELLED, SPLIT, _ranked, flow_rows, split_rows
from leakwatch.plans.packet_queries import (
    DEFAULT_SCORED, MONITOR_SELECT, WF, monitor_ctes, monitor_output, packets, recursive, scored_windows,
)
from leakwatch.plans.registry import query, rounded, sql
from leakwatch.session import fresh_dir

FEATURES = ["fwd_packets", "fwd_bytes", "duration_us"]
WEIGHTS, INTERCEPT = [0.1, 0.0004, -0.000000001], -2.5
# A small forest as node rows: tree, node, feature, cut, left, right, depth.
NODES = [
    (0, 0, 1, 4000.0, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 7.5), (0, 2, 0, 20.0, 3, 4, 0.0),
    (0, 3, -1, 0.0, -1, -1, 4.25), (0, 4, -1, 0.0, -1, -1, 2.0),
    (1, 0, 2, 30_000_000.0, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 6.0), (1, 2, 1, 9000.0, 3, 4, 0.0),
    (1, 3, -1, 0.0, -1, -1, 5.0), (1, 4, -1, 0.0, -1, -1, 3.0),
]
SAMPLE = 256


def stored(spark, kind):
    """A model of a kind, written and loaded again."""
    path = fresh_dir(spark, f"model-{kind}")
    parts = {"weights": WEIGHTS, "intercept": INTERCEPT}
    if kind == "isolation_forest":
        parts = spark.createDataFrame(NODES, iforest.NODE), SAMPLE
    store.save(store.Saved(kind, FEATURES, parts=parts), path, spark)
    return store.load(spark, path)


_POINT = "points AS (SELECT flow_id, CAST(fwd_packets AS DOUBLE) AS fwd_packets, CAST(fwd_bytes AS DOUBLE) AS fwd_bytes, CAST(duration_us AS DOUBLE) AS duration_us FROM flows)"
_LINEAR = "linear AS (SELECT flow_id, 1 / (1 + exp(-(" + f"{INTERCEPT}e0" + "".join(
    f" + {n} * {w:.10f}::DOUBLE" for n, w in zip(FEATURES, WEIGHTS)) + "))) AS model_score FROM points)"
_WALK = [
    "nodes(tree, node, feature, cut, l, r, depth) AS (VALUES " + ", ".join(
        f"({t}, {n}, {f}, {c}::DOUBLE, {a}, {b}, {d}::DOUBLE)" for t, n, f, c, a, b, d in NODES) + ")",
    """walk AS (
  SELECT flow_id, [fwd_packets, fwd_bytes, duration_us] AS x, tree, node FROM points, nodes WHERE node = 0
  UNION ALL
  SELECT w.flow_id, x, w.tree, CASE WHEN x[n.feature + 1] < n.cut THEN n.l ELSE n.r END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature >= 0)""",
    f"""forest AS (SELECT flow_id, 0.5e0 - pow(2, -avg(depth) / {iforest.expected_depth(SAMPLE)!r}::DOUBLE) AS model_score
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature < 0 GROUP BY flow_id)""",
]


@query("batch_scores", recursive(FLOWS, _POINT, _LINEAR, *_WALK, """
SELECT 'linear' AS kind, flow_id, round(model_score, 6) AS model_score FROM linear
UNION ALL SELECT 'isolation_forest', flow_id, round(model_score, 6) FROM forest"""))
def batch_scores(spark, sf):
    """All flows scored with saved models of two kinds; the forest is a table of nodes, walked as such by the check."""
    rows = flow_rows(spark, sf)
    parts = [
        stored(spark, kind).score(rows).select(F.lit(kind).alias("kind"), "flow_id", "model_score")
        for kind in ("linear", "isolation_forest")
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query("predict_binary", recursive(FLOWS, _POINT, _LINEAR, *_WALK, """
SELECT 'linear' AS kind, 'default' AS rule, flow_id, CASE WHEN model_score > 0.5e0 THEN 1 ELSE 0 END AS prediction FROM linear
UNION ALL SELECT 'linear', 'given', flow_id, CASE WHEN model_score > 0.25e0 THEN 1 ELSE 0 END FROM linear
UNION ALL SELECT 'isolation_forest', 'default', flow_id, CASE WHEN model_score < (SELECT median(model_score) FROM forest) THEN 1 ELSE 0 END FROM forest
UNION ALL SELECT 'isolation_forest', 'given', flow_id, CASE WHEN model_score < -0.2e0 THEN 1 ELSE 0 END FROM forest"""))
def predict_binary(spark, sf):
    """Decisions of saved models by the rule of their kind: median, given threshold, strictly above."""
    rows = flow_rows(spark, sf)
    out = None
    for kind, given in (("linear", 0.25), ("isolation_forest", -0.2)):
        model = stored(spark, kind)
        for rule, threshold in (("default", None), ("given", given)):
            part = model.predict(rows, threshold).select(
                F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), "flow_id", "prediction")
            out = part if out is None else out.unionByName(part)
    return out


@query("model_fit_check", sql(*WF, DEFAULT_SCORED, """
SELECT model, src_ip, window_start,
       CASE WHEN model = 'fits' THEN CASE WHEN s.upload_download_ratio > 1.2 THEN 1 ELSE 0 END END AS prediction,
       array_to_string(list_filter([CASE WHEN rule_score > 0.7 THEN 'BURST_RULE' END,
         CASE WHEN model = 'fits' AND s.upload_download_ratio > 1.2 THEN 'OFFLINE_MODEL' END], lambda t: t IS NOT NULL), '+') AS triggers
FROM scored s, (SELECT unnest(['fits', 'other features', 'other window']) AS model) m"""))
def model_fit_check(spark, sf):
    """A model that does not fit gives no score and no decision, and the rule goes on without it."""
    rows = scored_windows(spark, sf)
    ratio, out = ["upload_download_ratio"], None
    for name, features, seconds in (("fits", ratio, 60), ("other features", ratio + ["entropy"], 60), ("other window", ratio, 10)):
        path = fresh_dir(spark, "model-window")
        parts = {"weights": [1.0] * len(features), "intercept": -1.2}
        store.save(store.Saved("linear", features, window_seconds=seconds, parts=parts), path, spark)
        part = rules.fuse(store.load(spark, path).predict(rows, window_seconds=60))
        part = part.select(F.lit(name).alias("model"), "src_ip", "window_start", "prediction", F.array_join("triggers", "+").alias("triggers"))
        out = part if out is None else out.unionByName(part)
    return out


@query("split_sink", sql(FLOWS, LABELLED, _ranked(), SPLIT, "SELECT flow_id, exfil_label, split FROM split_rows"))
def split_sink(spark, sf):
    """Splits written by partition, read back."""
    path = fresh_dir(spark, "splits")
    prep.save_splits(split_rows(spark, sf), path, FEATURES)
    return spark.read.parquet(f"{path}/rows").select("flow_id", "exfil_label", "split")


_EPOCHS = """epoch_wf AS (
  SELECT * REPLACE (src_ip || '#' || (CASE WHEN src_ip = '10.0.0.1' AND window_start >= low + 900 THEN 1 ELSE 0 END
                                      + CASE WHEN window_start >= low + 1500 THEN 1 ELSE 0 END) AS src_ip)
  FROM wf, (SELECT min(window_start) AS low FROM wf) t)"""


@query("monitor_resets", recursive(*WF, _EPOCHS, *[c.replace("FROM wf)", "FROM epoch_wf)") for c in monitor_ctes(5)],
                                   MONITOR_SELECT.replace("SELECT src_ip", "SELECT split_part(src_ip, '#', 1) AS src_ip")))
def monitor_resets(spark, sf):
    """One source is reset, later all are; each starts its warm-up again."""
    rows = windows.window_features(packets(spark, sf))
    low = rows.agg(F.min("window_start")).first()[0]
    resets = spark.createDataFrame([("10.0.0.1", low + 900.0), (None, low + 1500.0)], "src_ip string, at double")
    return monitor_output(baseline.monitor(baseline.with_resets(rows, resets), warmup=5))
