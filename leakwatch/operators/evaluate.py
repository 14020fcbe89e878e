"""Evaluation of scores: counts, curves, thresholds and comparisons.

Scores are first reduced to one row per distinct score, so curves cost one
aggregation and a running sum over distinct scores, whatever the row count.
"""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import spread

MODEL = ["model"]


def with_rates(counts):
    """Precision, recall, F1 and false positive rate from tp, fp, tn, fn."""
    precision = C.safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = C.safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    both = counts.withColumns({"precision": precision, "recall": recall})
    return both.withColumns(
        {
            "f1": C.safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
            "fpr": C.safe_div(F.col("fp"), F.col("fp") + F.col("tn")),
        }
    )


def confusion(scores, threshold=0.5, by=MODEL):
    """Counts with a score at or above the threshold taken as positive."""
    flagged, real = F.col("score") >= threshold, F.col("label") == 1
    return scores.groupBy(*by).agg(
        F.count_if(flagged & real).alias("tp"),
        F.count_if(flagged & ~real).alias("fp"),
        F.count_if(~flagged & ~real).alias("tn"),
        F.count_if(~flagged & real).alias("fn"),
    )


def classification_metrics(scores, threshold=0.5, by=MODEL):
    """Counts and rates; the rates are null where nothing was flagged."""
    rated = with_rates(confusion(scores, threshold, by))
    some = (F.col("tp") + F.col("fp")) > 0
    return rated.withColumns(
        {n: F.when(some, F.col(n)) for n in ("precision", "recall", "f1", "fpr")}
    )


def curve(scores, by=MODEL, limits=fixed.SCAN_RANGE, **tuning):
    """tp, fp, tn, fn at every distinct score, taken as threshold (>=).

    `position` counts the distinct scores inside the limits from the highest down.
    """
    pos = F.count_if(F.col("label") == 1)
    neg = F.count_if(F.col("label") == 0)
    inside = F.max(F.col("score").between(*limits).cast("int"))
    running = spread.running_totals(
        scores, by, "score", {"pos": pos, "neg": neg, "inside": inside}, descending=True, **tuning
    )
    return running.select(
        *by,
        F.col("score").alias("threshold"),
        F.col("pos"),
        F.col("neg"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        (F.col("total_neg") - F.col("cum_neg")).alias("tn"),
        (F.col("total_pos") - F.col("cum_pos")).alias("fn"),
        F.col("cum_inside").alias("position"),
    )


def roc_curve(scores, by=MODEL, **tuning):
    rated = with_rates(curve(scores, by, **tuning))
    return rated.select(*by, "threshold", "fpr", F.col("recall").alias("tpr"))


def auc_of_curve(points, by=MODEL):
    """Exact area with ties (Mann-Whitney): a positive beats the negatives below it
    and half of those at its own score. One class only gives 0.5."""
    wins = F.sum(F.col("pos").cast("double") * (F.col("tn") + F.col("neg") / 2))
    p, n = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    area = F.when((p > 0) & (n > 0), wins / (F.when(p > 0, p) * F.when(n > 0, n)))
    return points.groupBy(*by).agg(F.coalesce(area, F.lit(0.5)).alias("auc"))


def roc_auc(scores, by=MODEL, **tuning):
    return auc_of_curve(curve(scores, by, **tuning), by)


def threshold_scan(scores, by=MODEL, limits=fixed.SCAN_RANGE, **tuning):
    """All metrics at every distinct threshold inside the limits."""
    points = curve(scores, by, limits, **tuning)
    return with_rates(points.filter(F.col("threshold").between(*limits))).select(
        *by, "threshold", "tp", "fp", "tn", "fn", "precision", "recall", "f1", "fpr", "position"
    )


def every_nth(scan, n=20):
    """The 1st, (n+1)th, ... scanned threshold of each model, highest first."""
    return scan.filter(F.pmod(F.col("position"), F.lit(n)) == 1 % n)


_POINT = ["threshold", "tp", "fp", "tn", "fn", "precision", "recall", "f1", "fpr"]


def optimal_threshold(scan, by=MODEL, max_fpr=fixed.MAX_FPR, target_recall=fixed.TARGET_RECALL):
    """Within the FPR limit the highest recall, at the highest threshold that has it;
    else the lowest FPR. The recall target is reported, not enforced."""
    point = F.struct(*_POINT)
    allowed = F.col("fpr") <= max_fpr
    best = F.max_by(F.when(allowed, point), F.when(allowed, F.struct("recall", "threshold")))
    lowest = F.min_by(point, F.struct(F.col("fpr"), -F.col("threshold")))
    chosen = scan.groupBy(*by).agg(F.coalesce(best, lowest).alias("p"))
    return chosen.select(*by, "p.*").withColumns(
        {
            "fpr_met": F.col("fpr") <= max_fpr,
            "recall_met": F.col("recall") >= target_recall,
        }
    )


def threshold_or_default(scores, optimal, by=MODEL, default=0.5):
    """One threshold per model; models without any usable threshold get the default."""
    models = scores.select(*by).distinct()
    return models.join(optimal.select(*by, "threshold"), list(by), "left").withColumn(
        "threshold", F.coalesce("threshold", F.lit(default))
    )


def improve_threshold(scores, by=MODEL, max_fpr=fixed.MAX_FPR, start=0.5, **tuning):
    """Keep the default threshold unless one within the FPR limit has more recall."""
    current = with_rates(confusion(scores, start, by)).withColumn("threshold", F.lit(start))
    current = current.select(*by, F.struct(*_POINT).alias("now"))
    scan = threshold_scan(scores, by, fixed.IMPROVE_RANGE, **tuning)
    better = scan.join(current, list(by)).filter(
        (F.col("fpr") <= max_fpr) & (F.col("recall") > F.col("now.recall"))
    )
    best = better.groupBy(*by).agg(
        F.max_by(F.struct(*_POINT), F.struct("recall", "threshold")).alias("best")
    )
    return (
        current.join(best, list(by), "left")
        .withColumn("improved", F.col("best").isNotNull())
        .withColumn("p", F.coalesce("best", "now"))
        .select(*by, "p.*", "improved")
    )


def youden_threshold(points, by=MODEL):
    """Threshold with the largest tpr - fpr (the highest such threshold)."""
    gain = F.round(F.col("tpr") - F.col("fpr"), 12)
    best = F.max_by(F.struct("threshold", "tpr", "fpr"), F.struct(gain, F.col("threshold")))
    return points.groupBy(*by).agg(best.alias("p")).select(*by, "p.*")


def validation_threshold(scores, by=MODEL, max_fpr=fixed.MAX_FPR, **tuning):
    """Chosen on the validation rows: highest recall within the FPR limit, else Youden."""
    points = roc_curve(scores.filter(F.col("split") == "val"), by, **tuning)
    allowed = F.col("fpr") <= max_fpr
    within = F.max_by(F.when(allowed, F.col("threshold")), F.when(allowed, F.struct("tpr", "threshold")))
    gain = F.round(F.col("tpr") - F.col("fpr"), 12)
    youden = F.max_by(F.col("threshold"), F.struct(gain, F.col("threshold")))
    return points.groupBy(*by).agg(F.coalesce(within, youden).alias("threshold"))


def validation_threshold_on_test(scores, by=MODEL, max_fpr=fixed.MAX_FPR, **tuning):
    """Metrics on the test rows at the threshold chosen on the validation rows."""
    chosen = validation_threshold(scores, by, max_fpr, **tuning)
    scan_counts = (
        scores.filter(F.col("split") == "test")
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    )
    scan_counts = scan_counts.join(chosen, list(by))
    above = F.col("score") >= F.col("threshold")
    counts = scan_counts.groupBy(*by, "threshold").agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(~above, F.col("pos")).otherwise(0)).alias("fn"),
    )
    return with_rates(counts)


def key_thresholds(scan, by=MODEL, keys=None, within=0.02):
    """For each key value the lowest scanned threshold closer than `within`.

    A scanned threshold names the keys it serves, so no range join is needed.
    """
    keys = F.array(*[F.lit(k) for k in keys or fixed.KEY_THRESHOLDS])
    near = F.filter(keys, lambda k: F.round(F.abs(F.col("threshold") - k), 9) < within)
    served = scan.withColumn("key", F.explode(near))
    first = F.min_by(F.struct(*_POINT), "threshold")
    return (
        served.groupBy(*by, "key").agg(first.alias("p")).select(*by, "key", "p.*")
        .withColumn(
            "meets_targets",
            (F.col("fpr") <= fixed.MAX_FPR) & (F.col("recall") >= fixed.TARGET_RECALL),
        )
    )


def threshold_sensitivity(rows, score="score", label="label", thresholds=None):
    """Metrics at fixed thresholds, all counted in one pass."""
    s, real = F.round(F.col(score), 9), F.col(label) == 1
    cells = []
    for t in thresholds or fixed.SENSITIVITY_THRESHOLDS:
        flagged = s >= t
        cells.append(
            F.struct(
                F.lit(t).alias("threshold"),
                F.count_if(flagged & real).alias("tp"),
                F.count_if(flagged & ~real).alias("fp"),
                F.count_if(~flagged & ~real).alias("tn"),
                F.count_if(~flagged & real).alias("fn"),
            )
        )
    return with_rates(rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))


def family(model="model"):
    return F.when(F.col(model).startswith("anomaly"), F.lit("anomaly")).otherwise(F.lit("supervised"))


def model_comparison(scores, threshold=0.5, **tuning):
    """One row per model: kind, area and metrics."""
    areas = roc_auc(scores, **tuning)
    rated = with_rates(confusion(scores, threshold))
    return rated.join(areas, "model").withColumn("kind", family())


def metric_winner(comparison, anomaly, supervised, extra=()):
    """Which of two models is better by metric; lower is better for FPR and cost, and
    a tie goes to the supervised one."""
    names = ["auc", "f1", "precision", "recall", "fpr", *extra]
    lower = {"fpr", "us_per_row"}
    values = {
        n: [F.max(F.when(F.col("model") == m, F.col(n))) for m in (anomaly, supervised)]
        for n in names
    }
    cells = [
        F.struct(F.lit(n).alias("metric"), a.alias("anomaly_value"), s.alias("supervised_value"),
                 F.lit(n in lower).alias("lower"))
        for n, (a, s) in values.items()
    ]
    table = comparison.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    a, s = F.col("anomaly_value"), F.col("supervised_value")
    wins = F.when(F.col("lower"), a < s).otherwise(a > s)
    return table.select(
        "metric", "anomaly_value", "supervised_value",
        F.when(wins, F.lit("anomaly")).otherwise(F.lit("supervised")).alias("winner"),
    )


def auc_verdict(comparison, anomaly, supervised):
    """Short verdict by the area gap between the two."""
    area = [F.max(F.when(F.col("model") == m, F.col("auc"))) for m in (supervised, anomaly)]
    gap = F.col("auc_gap")
    verdict = (
        F.when(gap > 0.10, F.lit("supervised clearly better"))
        .when(gap > 0.02, F.lit("supervised somewhat better"))
        .otherwise(F.lit("equivalent, consider an ensemble"))
    )
    return comparison.agg((area[0] - area[1]).alias("auc_gap")).withColumn("verdict", verdict)


def best_per_family(comparison):
    """Best model of each kind by area, and averages of the kind."""
    return comparison.groupBy("kind").agg(
        F.max_by("model", F.struct(F.col("auc"), F.col("model"))).alias("best_model"),
        F.max("auc").alias("best_auc"),
        F.avg("auc").alias("avg_auc"),
        F.avg("f1").alias("avg_f1"),
        F.avg("fpr").alias("avg_fpr"),
    )


def per_class_report(scores, threshold=0.5):
    """Precision, recall, F1 and support of both classes, accuracy and averages."""
    c = confusion(scores, threshold)
    tp, fp, tn, fn = (F.col(n) for n in ("tp", "fp", "tn", "fn"))

    def row(name, hit, false_hit, missed):
        p, r = C.safe_div(hit, hit + false_hit), C.safe_div(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            C.safe_div(2 * p * r, p + r).alias("f1"), (hit + missed).alias("support"),
        )

    both = c.withColumn("one", row("1", tp, fp, fn)).withColumn("zero", row("0", tn, fn, fp))
    n = tp + fp + tn + fn

    def average(name, weight_one, weight_zero):
        def mix(m):
            return C.safe_div(
                F.col(f"one.{m}") * weight_one + F.col(f"zero.{m}") * weight_zero,
                weight_one + weight_zero,
            ).alias(m)

        return F.struct(F.lit(name).alias("class"), mix("precision"), mix("recall"), mix("f1"),
                        n.alias("support"))

    accuracy = C.safe_div(tp + tn, n)
    overall = F.struct(F.lit("accuracy").alias("class"), accuracy.alias("precision"),
                       accuracy.alias("recall"), accuracy.alias("f1"), n.alias("support"))
    rows = F.array(
        F.col("zero"), F.col("one"), overall,
        average("macro avg", F.lit(1), F.lit(1)),
        average("weighted avg", F.col("one.support"), F.col("zero.support")),
    )
    return both.select("model", F.inline(rows))


def score_stats(scores, by=MODEL):
    return scores.groupBy(*by).agg(
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.avg("score").alias("mean_score"),
        F.count(F.lit(1)).alias("n"),
    )


def run_comparison(old, new, threshold=0.5):
    """Metrics of two runs over the rows both have scored, and the changed decisions."""
    pairs = old.select("id", "label", F.col("score").alias("old")).join(
        new.select("id", F.col("score").alias("new")), "id"
    )
    was, now = F.col("old") >= threshold, F.col("new") >= threshold
    real = F.col("label") == 1

    def cells(run, flagged):
        return F.struct(
            F.lit(run).alias("run"),
            F.count_if(flagged & real).alias("tp"),
            F.count_if(flagged & ~real).alias("fp"),
            F.count_if(~flagged & ~real).alias("tn"),
            F.count_if(~flagged & real).alias("fn"),
            F.count_if(was != now).alias("changed"),
        )

    both = pairs.agg(F.array(cells("old", was), cells("new", now)).alias("cells"))
    return with_rates(both.select(F.inline("cells")))
