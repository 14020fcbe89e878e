"""From flow files to trained and evaluated models, in batch."""

from pyspark.sql import functions as F

from leakwatch.functions import fixed
from leakwatch.operators import evaluate, iforest, labels, models, oversample, prep
from leakwatch.session import cut_lineage, staged


def prepare(flows, id_col):
    """Labelled, cleaned, split and scaled rows, and the feature names.

    The scaler is fitted on the train rows only. The split rows are written
    because every later step starts from them.
    """
    labelled = labels.assign_labels(flows)
    cleaned, names = labels.clean_features(labelled, keep=(id_col,))
    rows = cleaned.withColumnRenamed("exfil_label", "label").withColumnRenamed(id_col, "id")
    split = staged(prep.stratified_split(rows), "split-flows")
    scaler = prep.fit_scaler(split.filter(F.col("split") == "train"), names)
    return prep.standardize(split, names, scaler), names


def supervised_scores(rows, names, target=100_000, iterations=60):
    """Subsample, oversample and train the dense classifier; score all rows."""
    train = rows.filter(F.col("split") == "train")
    sample = prep.subsample_realistic(train, target)
    balanced = cut_lineage(oversample.interpolate_minority(sample, names))
    model = models.fit_dense(balanced, names, iterations=iterations)
    scored = models.score(rows, model, names)
    return scored.select(F.lit("supervised").alias("model"), "id", "label", "score", "split"), model


def anomaly_scores(rows, names, trees=fixed.ISOLATION_TREES):
    """Isolation forest on the normal train rows; score all rows."""
    train = labels.normal_only(rows.filter(F.col("split") == "train"))
    nodes, take = iforest.fit(train, names, trees=trees)
    nodes = cut_lineage(nodes)
    scored = iforest.score(rows, nodes, names, take, "score")
    return scored.select(F.lit("anomaly").alias("model"), "id", "label", "score", "split"), (nodes, take)


def report(scores):
    """Comparison on the test rows at thresholds chosen on the validation rows."""
    tuned = evaluate.validation_threshold_on_test(scores)
    areas = evaluate.roc_auc(scores.filter(F.col("split") == "test"))
    return tuned.join(areas, "model").withColumn("kind", evaluate.family())


def write_report(rows, scan, path, every=20):
    """The report, each model's optimal threshold and every n-th scanned threshold, as JSON."""
    rows.write.mode("overwrite").json(f"{path}/report")
    evaluate.optimal_threshold(scan).write.mode("overwrite").json(f"{path}/optimal")
    evaluate.every_nth(scan, every).write.mode("overwrite").json(f"{path}/threshold_samples")


def write_dataset_summary(split_rows, names, path):
    """Rows and positives by split and in total, with the feature list, as JSON."""
    summary = prep.split_summary(split_rows).withColumns(
        {"n_features": F.lit(len(names)), "feature_names": F.array(*[F.lit(n) for n in names])}
    )
    summary.write.mode("overwrite").json(path)


def window_training_rows(window_rows, attack_sources_windows, target=None):
    """Window rows with a label: 1 where the (source, window start) is a known attack."""
    known = attack_sources_windows.select("src_ip", "window_start").distinct().withColumn("hit", F.lit(1))
    labelled = window_rows.join(known, ["src_ip", "window_start"], "left")
    labelled = labelled.withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")
    keyed = labelled.withColumn("id", F.xxhash64("src_ip", "window_start"))
    if target is None:
        return keyed
    return oversample.jitter(keyed, fixed.RUNTIME_FEATURES, target)
