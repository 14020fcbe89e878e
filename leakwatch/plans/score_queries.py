"""Queries over score tables and learned models."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import evaluate, iforest, labels, models, oversample, prep, rules, windows
from leakwatch.plans.flow_queries import FLOWS, LABELLED, NUMERIC, PROXY, labelled
from leakwatch.plans.packet_queries import packets
from leakwatch.plans.registry import query, rounded, sql
from leakwatch.session import cut_lineage, staged
from leakwatch.sources import views

SCORES = views.duck("scores")
_P, _R = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
_CELLS = {
    "precision": _P,
    "recall": _R,
    "f1": f"coalesce(2 * {_P} * {_R} / nullif({_P} + {_R}, 0), 0)",
    "fpr": "coalesce(fp / nullif(fp + tn, 0), 0)",
}
RATES = ", ".join(f"round({c}, 6) AS {n}" for n, c in _CELLS.items())
RAW_RATES = ", ".join(f"{c} AS {n}" for n, c in _CELLS.items())


def counts_sql(threshold, rows="scores", by="model"):
    return f"""counts AS (
  SELECT {by}, count(*) FILTER (score >= {threshold} AND label = 1) AS tp, count(*) FILTER (score >= {threshold} AND label = 0) AS fp,
         count(*) FILTER (score < {threshold} AND label = 0) AS tn, count(*) FILTER (score < {threshold} AND label = 1) AS fn
  FROM {rows} GROUP BY {by})"""


CURVE = """curve AS (
  SELECT model, score AS threshold, pos, neg,
         CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
         CAST(sum(neg) OVER (PARTITION BY model) - sum(neg) OVER w AS BIGINT) AS tn,
         CAST(sum(pos) OVER (PARTITION BY model) - sum(pos) OVER w AS BIGINT) AS fn
  FROM (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
        FROM {rows} GROUP BY model, score) t
  WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
SCAN = f"""scan AS (SELECT model, threshold, tp, fp, tn, fn, {RAW_RATES} FROM curve WHERE threshold BETWEEN 0.001 AND 0.999)"""
SCANNED = [SCORES, CURVE.replace("{rows}", "scores"), SCAN]
POINT = "threshold, tp, fp, tn, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(fpr, 6) AS fpr"


def score_rows(spark, sf):
    return views.load(spark, sf, "scores")


def only(rows, model):
    return rows.filter(F.col("model") == model)


@query("confusion_matrix", sql(SCORES, counts_sql(0.5), "SELECT * FROM counts"))
def confusion_matrix(spark, sf):
    return evaluate.confusion(score_rows(spark, sf))


@query("classification_metrics", sql(SCORES, counts_sql(0.96), f"""
SELECT model, tp, fp, tn, fn,
  CASE WHEN tp + fp > 0 THEN precision END AS precision, CASE WHEN tp + fp > 0 THEN recall END AS recall,
  CASE WHEN tp + fp > 0 THEN f1 END AS f1, CASE WHEN tp + fp > 0 THEN fpr END AS fpr
FROM (SELECT model, tp, fp, tn, fn, {RATES} FROM counts) t"""))
def classification_metrics(spark, sf):
    return rounded(evaluate.classification_metrics(score_rows(spark, sf), 0.96))


@query("roc_auc", sql(SCORES, CURVE.replace("{rows}", "scores"), """
SELECT model, round(sum(pos * (tn + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM curve GROUP BY model"""))
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(score_rows(spark, sf)))


@query("roc_curve", sql(SCORES, CURVE.replace("{rows}", "scores"), """
SELECT model, threshold, round(fp / (fp + tn), 6) AS fpr, round(tp / (tp + fn), 6) AS tpr FROM curve"""))
def roc_curve(spark, sf):
    return rounded(evaluate.roc_curve(score_rows(spark, sf)))


@query("threshold_scan", sql(*SCANNED, f"SELECT model, {POINT} FROM scan"))
def threshold_scan(spark, sf):
    return rounded(evaluate.threshold_scan(score_rows(spark, sf)).drop("position"))


@query("threshold_samples", sql(*SCANNED, f"""
SELECT model, {POINT} FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY threshold DESC) AS rn FROM scan) t
WHERE rn % 20 = 1"""))
def threshold_samples(spark, sf):
    return rounded(evaluate.every_nth(evaluate.threshold_scan(score_rows(spark, sf))).drop("position"))


@query("optimal_threshold", sql(*SCANNED, f"""
SELECT model, {POINT}, fpr <= 0.05 AS fpr_met, recall >= 0.85 AS recall_met FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY fpr <= 0.05 DESC,
    CASE WHEN fpr <= 0.05 THEN -recall ELSE fpr END, threshold DESC) AS rn FROM scan) t WHERE rn = 1"""))
def optimal_threshold(spark, sf):
    return rounded(evaluate.optimal_threshold(evaluate.threshold_scan(score_rows(spark, sf))))


@query("optimal_threshold_relaxed", sql(*SCANNED, f"""
SELECT model, {POINT}, false AS fpr_met, recall >= 0.85 AS recall_met FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY fpr, threshold DESC) AS rn FROM scan WHERE threshold <= 0.2) t WHERE rn = 1"""))
def optimal_threshold_relaxed(spark, sf):
    """No threshold meets the limit, so the one with the lowest FPR is taken."""
    scan = evaluate.threshold_scan(score_rows(spark, sf), limits=(0.001, 0.2))
    return rounded(evaluate.optimal_threshold(scan, max_fpr=0.0))


@query("threshold_default", sql(*SCANNED, """
SELECT model, coalesce((SELECT max(threshold) FROM scan s WHERE s.model = m.model AND s.threshold > 0.95
    AND s.fpr = (SELECT min(fpr) FROM scan x WHERE x.model = m.model AND x.threshold > 0.95)), 0.5) AS threshold
FROM (SELECT DISTINCT model FROM scores) m"""))
def threshold_default(spark, sf):
    """Models without a score in the scanned range fall back to 0.5."""
    rows = score_rows(spark, sf)
    scan = evaluate.threshold_scan(rows, limits=(0.9501, 0.999))
    return evaluate.threshold_or_default(rows, evaluate.optimal_threshold(scan, max_fpr=-1.0))


@query("threshold_improve_only", sql(*SCANNED, counts_sql(0.5), f"""
SELECT model, {POINT}, improved FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY improved DESC, recall DESC, threshold DESC) AS rn FROM (
    SELECT s.model, threshold, s.tp, s.fp, s.tn, s.fn, precision, recall, f1, fpr, true AS improved
    FROM scan s JOIN counts c ON s.model = c.model
    WHERE fpr <= 0.05 AND threshold BETWEEN 0.01 AND 0.99 AND recall > c.tp / (c.tp + c.fn)
    UNION ALL
    SELECT model, 0.5e0, tp, fp, tn, fn, {RAW_RATES}, false FROM counts) u) t WHERE rn = 1"""))
def threshold_improve_only(spark, sf):
    return rounded(evaluate.improve_threshold(score_rows(spark, sf)))


@query("youden_threshold", sql(*SCANNED, """
SELECT model, threshold, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM (
  SELECT model, threshold, tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr,
         row_number() OVER (PARTITION BY model ORDER BY round(tp / (tp + fn) - fp / (fp + tn), 12) DESC, threshold DESC) AS rn
  FROM curve) t WHERE rn = 1"""))
def youden_threshold(spark, sf):
    return rounded(evaluate.youden_threshold(evaluate.roc_curve(score_rows(spark, sf))))


@query("val_threshold_on_test", sql(SCORES, "val_rows AS (SELECT * FROM scores WHERE split = 'val')",
       CURVE.replace("{rows}", "val_rows"), """
chosen AS (SELECT model, threshold FROM (
  SELECT model, threshold, row_number() OVER (PARTITION BY model ORDER BY tp / (tp + fn) DESC, threshold DESC) AS rn
  FROM curve WHERE fp / (fp + tn) <= 0.05) t WHERE rn = 1)""",
       """test_rows AS (SELECT s.*, c.threshold FROM scores s JOIN chosen c USING (model) WHERE split = 'test')""",
       counts_sql("threshold", "test_rows", "model, threshold"),
       f"SELECT model, threshold, tp, fp, tn, fn, {RATES} FROM counts"))
def val_threshold_on_test(spark, sf):
    return rounded(evaluate.validation_threshold_on_test(score_rows(spark, sf)))


_KEYS = ", ".join(f"({k}e0)" for k in fixed.KEY_THRESHOLDS)


@query("key_threshold_table", sql(*SCANNED, f"""
SELECT model, key, {POINT}, fpr <= 0.05 AND recall >= 0.85 AS meets_targets FROM (
  SELECT s.*, k.key, row_number() OVER (PARTITION BY model, k.key ORDER BY threshold) AS rn
  FROM scan s JOIN (VALUES {_KEYS}) k(key) ON round(abs(threshold - k.key), 9) < 0.02) t WHERE rn = 1"""))
def key_threshold_table(spark, sf):
    return rounded(evaluate.key_thresholds(evaluate.threshold_scan(score_rows(spark, sf))))


@query("threshold_sensitivity", sql(FLOWS, LABELLED, PROXY, f"""
SELECT threshold, tp, fp, tn, fn, {RATES} FROM (
  SELECT t.threshold, count(*) FILTER (proxy_score >= threshold AND exfil_label = 1) AS tp,
         count(*) FILTER (proxy_score >= threshold AND exfil_label = 0) AS fp,
         count(*) FILTER (proxy_score < threshold AND exfil_label = 0) AS tn,
         count(*) FILTER (proxy_score < threshold AND exfil_label = 1) AS fn
  FROM proxied, (VALUES (0.3e0), (0.4e0), (0.5e0), (0.6e0), (0.7e0), (0.8e0), (0.9e0)) t(threshold) GROUP BY t.threshold) c"""))
def threshold_sensitivity(spark, sf):
    rows = rules.flow_proxy_score(labelled(spark, sf))
    return rounded(evaluate.threshold_sensitivity(rows, "proxy_score", "exfil_label"))


COMPARED = [SCORES, CURVE.replace("{rows}", "scores"), counts_sql(0.5), f"""compared AS (
  SELECT c.model, tp, fp, tn, fn, {RAW_RATES}, auc,
         CASE WHEN starts_with(c.model, 'anomaly') THEN 'anomaly' ELSE 'supervised' END AS kind
  FROM counts c JOIN (SELECT model, sum(pos * (tn + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM curve GROUP BY model) a
  ON a.model = c.model)"""]


def comparison(spark, sf):
    return evaluate.model_comparison(score_rows(spark, sf))


@query("model_comparison", sql(*COMPARED, """
SELECT model, kind, tp, fp, tn, fn, round(auc, 6) AS auc, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(fpr, 6) AS fpr FROM compared ORDER BY auc DESC"""))
def model_comparison(spark, sf):
    return rounded(comparison(spark, sf)).orderBy(F.desc("auc"), "model")


@query("metric_winner", sql(*COMPARED, " UNION ALL ".join(f"""
SELECT '{m}' AS metric, round(a.{m}, 6) AS anomaly_value, round(s.{m}, 6) AS supervised_value,
       CASE WHEN a.{m} {'<' if m == 'fpr' else '>'} s.{m} THEN 'anomaly' ELSE 'supervised' END AS winner
FROM compared a, compared s WHERE a.model = 'anomaly' AND s.model = 'supervised'"""
    for m in ("auc", "f1", "precision", "recall", "fpr"))))
def metric_winner(spark, sf):
    return rounded(evaluate.metric_winner(comparison(spark, sf), "anomaly", "supervised"))


@query("auc_gap_verdict", sql(*COMPARED, """
SELECT round(gap, 6) AS auc_gap, CASE WHEN gap > 0.10 THEN 'supervised clearly better' WHEN gap > 0.02
  THEN 'supervised somewhat better' ELSE 'equivalent, consider an ensemble' END AS verdict
FROM (SELECT (SELECT auc FROM compared WHERE model = 'supervised') - (SELECT auc FROM compared WHERE model = 'anomaly') AS gap) t"""))
def auc_gap_verdict(spark, sf):
    return rounded(evaluate.auc_verdict(comparison(spark, sf), "anomaly", "supervised"))


@query("best_per_family", sql(*COMPARED, """
SELECT kind, arg_max(model, auc) AS best_model, round(max(auc), 6) AS best_auc, round(avg(auc), 6) AS avg_auc,
       round(avg(f1), 6) AS avg_f1, round(avg(fpr), 6) AS avg_fpr FROM compared GROUP BY kind"""))
def best_per_family(spark, sf):
    return rounded(evaluate.best_per_family(comparison(spark, sf)))


@query("per_class_report", sql(SCORES, counts_sql(0.5), """
classes AS (
  SELECT model, '1' AS class, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r, tp + fn AS support, tp + fp + tn + fn AS n, tp + tn AS hits FROM counts
  UNION ALL
  SELECT model, '0', tn / nullif(tn + fn, 0), tn / nullif(tn + fp, 0), tn + fp, tp + fp + tn + fn, tp + tn FROM counts)""", """
scored AS (SELECT model, class, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f, support, n, hits FROM classes)""", """
SELECT model, class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scored
UNION ALL SELECT DISTINCT model, 'accuracy', round(hits / n, 6), round(hits / n, 6), round(hits / n, 6), n FROM scored
UNION ALL SELECT model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), any_value(n) FROM scored GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), any_value(n) FROM scored GROUP BY model"""))
def per_class_report(spark, sf):
    return rounded(evaluate.per_class_report(score_rows(spark, sf)))


@query("score_stats", sql(SCORES, """
SELECT model, min(score) AS min_score, max(score) AS max_score, round(avg(score), 6) AS mean_score, count(*) AS n
FROM scores GROUP BY model"""))
def score_stats(spark, sf):
    return rounded(evaluate.score_stats(score_rows(spark, sf)))


@query("run_comparison", sql(SCORES, """
pairs AS (SELECT o.label, o.score >= 0.5 AS was, n.score >= 0.5 AS now FROM scores o JOIN scores n ON o.id = n.id
          WHERE o.model = 'supervised_old' AND n.model = 'supervised')""", " UNION ALL ".join(f"""
SELECT '{run}' AS run, tp, fp, tn, fn, changed, {RATES} FROM (
  SELECT count(*) FILTER ({c} AND label = 1) AS tp, count(*) FILTER ({c} AND label = 0) AS fp,
         count(*) FILTER (NOT {c} AND label = 0) AS tn, count(*) FILTER (NOT {c} AND label = 1) AS fn,
         count(*) FILTER (was <> now) AS changed FROM pairs) t""" for run, c in (("old", "was"), ("new", "now")))))
def run_comparison(spark, sf):
    rows = score_rows(spark, sf)
    return rounded(evaluate.run_comparison(only(rows, "supervised_old"), only(rows, "supervised")))


# --- decisions on raw scores -----------------------------------------------------------------


@query("contamination_cutoff", sql(SCORES, """
SELECT model, round(quantile_cont(score, 0.95), 6) AS cutoff FROM scores WHERE label = 0 GROUP BY model"""))
def contamination_cutoff(spark, sf):
    normal = labels.normal_only(score_rows(spark, sf))
    return rounded(iforest.contamination_cutoff(normal, name="score", by=["model"]))


@query("contamination_cutoff_observed", sql(SCORES, """
placed AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS place, count(*) OVER () AS n
           FROM scores WHERE model = 'anomaly' AND label = 0)""", """
spot AS (SELECT (1 - (SELECT greatest(avg(label), 1e-4) FROM scores WHERE model = 'anomaly')) * (max(n) - 1) AS pos_at FROM placed)""", """
SELECT round(lo + (hi - lo) * (pos_at - floor(pos_at)), 6) AS cutoff FROM (
  SELECT pos_at, (SELECT score FROM placed WHERE place = floor(pos_at)) AS lo, (SELECT score FROM placed WHERE place = ceil(pos_at)) AS hi FROM spot) t"""))
def contamination_cutoff_observed(spark, sf):
    """The observed positive rate as contamination."""
    rows = only(score_rows(spark, sf), "anomaly")
    rate = rows.agg(F.avg("label")).first()[0]
    return rounded(iforest.contamination_cutoff(labels.normal_only(rows), max(rate, 1e-4), "score"))


@query("prediction_rule", sql(SCORES, """
SELECT model, id, CASE WHEN raw BETWEEN 0 AND 1 THEN CASE WHEN raw >= 0.5 THEN 1 ELSE 0 END
                       ELSE CASE WHEN raw < 0 THEN 1 ELSE 0 END END AS prediction,
       CASE WHEN raw >= 0.8 THEN 1 ELSE 0 END AS stored_prediction
FROM (SELECT *, score * 1.5e0 - 0.2e0 AS raw FROM scores) t"""))
def prediction_rule(spark, sf):
    raw = F.col("score") * 1.5 - 0.2
    return score_rows(spark, sf).select(
        "model", "id",
        models.raw_score_prediction(raw).alias("prediction"),
        models.raw_score_prediction(raw, fixed.FOREST_THRESHOLD).alias("stored_prediction"),
    )


@query("median_threshold", sql(SCORES, """
SELECT s.model, id, median_score, CASE WHEN score < median_score THEN 1 ELSE 0 END AS prediction
FROM scores s JOIN (SELECT model, round(median(score), 6) AS median_score FROM scores GROUP BY model) m ON m.model = s.model"""))
def median_threshold(spark, sf):
    return rounded(models.median_prediction(score_rows(spark, sf)).select("model", "id", "median_score", "prediction"))


@query("anomaly_sign_flip", sql(SCORES, """
SELECT id, round(-(0.5e0 - score), 6) + 0e0 AS anomaly_score, CASE WHEN -(0.5e0 - score) > 0 THEN 1 ELSE 0 END AS prediction
FROM scores WHERE model = 'anomaly'"""))
def anomaly_sign_flip(spark, sf):
    rows = only(score_rows(spark, sf), "anomaly")
    return rounded(rows.select("id", *models.flip_sign(iforest.decision("score"))))


# --- learned models (no SQL states their scores) -----------------------------------------------


@query("isolation_forest_scores")
def isolation_forest_scores(spark, sf):
    """Trained on normal flows, scored on all; flagged above the contamination cutoff."""
    rows = labelled(spark, sf).withColumn("label", F.col("exfil_label"))
    names = ["fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes", "duration_us", "psh_count"]
    nodes, take = iforest.fit(labels.normal_only(rows), names, "flow_id")
    scored = iforest.score(rows, cut_lineage(nodes), names, take)
    # The cutoff reads the scores several times; they are computed once.
    scored = cut_lineage(scored.select("flow_id", "label", "anomaly_score"))
    cutoff = iforest.contamination_cutoff(labels.normal_only(scored)).scalar()
    return scored.withColumn("prediction", (F.col("anomaly_score") > cutoff).cast("int"))


@query("window_forest_scores")
def window_forest_scores(spark, sf):
    """Random forest on labelled windows, trained on three quarters and scored on all."""
    source = views.load(spark, sf, "packets")
    rows = windows.window_features(packets(spark, sf))
    attacked = source.filter("attack").select(
        "src_ip", (F.col("ts_us") - F.pmod("ts_us", F.lit(60_000_000))).alias("bucket_us")
    ).distinct().select("src_ip", (F.col("bucket_us") / 1e6).alias("window_start"), F.lit(1).alias("hit"))
    named = rows.join(attacked, ["src_ip", "window_start"], "left").withColumn("label", F.coalesce("hit", F.lit(0)))
    keyed = named.withColumn("id", F.xxhash64("src_ip", "window_start"))
    split = staged(prep.stratified_split(keyed, shares={"train": 0.75, "test": 0.25}), "split-windows")
    model = models.fit_forest(split.filter("split = 'train'"))
    scored = models.score(split, model, fixed.RUNTIME_FEATURES, "model_score")
    decided = models.raw_score_prediction(F.col("model_score"), fixed.FOREST_THRESHOLD)
    return scored.select("src_ip", "window_start", "label", "split", "model_score", decided.alias("prediction"))


@query("mlp_scores")
def mlp_scores(spark, sf):
    """Dense network on scaled flows, subsampled, then oversampled."""
    rows = labels.clean_columns(labelled(spark, sf), NUMERIC).withColumn("label", F.col("exfil_label"))
    split = prep.stratified_split(rows.select("flow_id", "label", *NUMERIC), "flow_id")
    scaler = prep.fit_scaler(split.filter("split = 'train'"), NUMERIC)
    scaled = staged(prep.standardize(split, NUMERIC, scaler), "scaled-flows")
    sample = prep.subsample_realistic(scaled.filter("split = 'train'"), id_col="flow_id")
    train = oversample.interpolate_minority(sample, NUMERIC, 0.3, "flow_id")
    model = models.fit_dense(cut_lineage(train), NUMERIC)
    return models.score(scaled, model, NUMERIC).select("flow_id", "label", "split", "score")


@query("logistic_scores")
def logistic_scores(spark, sf):
    """Logistic regression with balanced class weights."""
    rows = labels.clean_columns(labelled(spark, sf), NUMERIC).withColumn("label", F.col("exfil_label"))
    model = models.fit_logistic(rows, NUMERIC)
    return models.score(rows, model, NUMERIC).select("flow_id", "label", "score")


@query("boosted_scores")
def boosted_scores(spark, sf):
    """Gradient-boosted trees with fixed 1:10 class weights."""
    rows = labels.clean_columns(labelled(spark, sf), NUMERIC).withColumn("label", F.col("exfil_label"))
    model = models.fit_boosted(rows, NUMERIC, weights={0: 1.0, 1: 10.0})
    return models.score(rows, model, NUMERIC).select("flow_id", "label", "score")


def soundness(scored, score, extra=()):
    """One row per split (where there is one): rows, positives, scores all in 0..1, area above one half."""
    named = scored.select(*extra, "label", F.col(score).alias("score"), F.lit("m").alias("model"))
    held = staged(named, "sound-scores")
    by = ["model", *extra]
    sizes = held.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == 1).alias("positives"),
        (F.count_if(F.col("score").between(0.0, 1.0)) == F.count(F.lit(1))).alias("in_range"),
    )
    return sizes.join(evaluate.roc_auc(held, by), by).select(
        *extra, "n", "positives", "in_range", (F.col("auc") > 0.5).alias("better_than_chance")
    )


_SOUND_FLOWS = sql(FLOWS, LABELLED, """
SELECT count(*) AS n, count(*) FILTER (exfil_label = 1) AS positives, true AS in_range, true AS better_than_chance FROM labelled""")


@query("isolation_forest_sound", _SOUND_FLOWS)
def isolation_forest_sound(spark, sf):
    return soundness(isolation_forest_scores(spark, sf), "anomaly_score")


@query("logistic_sound", _SOUND_FLOWS)
def logistic_sound(spark, sf):
    return soundness(logistic_scores(spark, sf), "score")


@query("boosted_sound", _SOUND_FLOWS)
def boosted_sound(spark, sf):
    return soundness(boosted_scores(spark, sf), "score")


_H = C.mix_sql("flow_id", fixed.SEED)


@query("mlp_sound", sql(FLOWS, LABELLED, f"""
SELECT split, count(*) AS n, count(*) FILTER (exfil_label = 1) AS positives, true AS in_range, true AS better_than_chance
FROM (SELECT exfil_label, CASE WHEN r <= floor(n * {list(fixed.SPLIT_SHARES.values())[0]}e0 + 0.5e0) THEN '{list(fixed.SPLIT_SHARES)[0]}'
                        WHEN r <= floor(n * {round(sum(list(fixed.SPLIT_SHARES.values())[:2]), 9)}e0 + 0.5e0) THEN '{list(fixed.SPLIT_SHARES)[1]}'
                        ELSE '{list(fixed.SPLIT_SHARES)[2]}' END AS split
      FROM (SELECT exfil_label, row_number() OVER (PARTITION BY exfil_label ORDER BY {_H}, flow_id) AS r,
                   count(*) OVER (PARTITION BY exfil_label) AS n FROM labelled))
GROUP BY split"""))
def mlp_sound(spark, sf):
    return soundness(mlp_scores(spark, sf), "score", ["split"])
