"""Splits, scaling, subsampling and class weights."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import spread


def stratified_split(rows, id_col="id", label="label", shares=None, seed=fixed.SEED):
    """Adds `split`: each class is cut at exact shares of its size, in hashed order.

    The cuts are found first; rows are then assigned where they lie, without a shuffle.
    """
    shares = shares or fixed.SPLIT_SHARES
    names = list(shares)
    number = C.mix(id_col, seed)
    ranks, reached = {}, 0.0
    for name in names[:-1]:
        reached += shares[name]
        ranks[name] = lambda n, share=round(reached, 9): F.floor(n * F.lit(share) + F.lit(0.5))
    cuts = spread.hash_cuts(rows, [label], number, C.MIX_DOMAIN, id_col, ranks)
    choice = F.lit(names[-1])
    for (value,), at in cuts.items():
        own = F.lit(names[-1])
        for name in reversed(names[:-1]):
            own = F.when(spread.within_cut(number, id_col, at[name]), F.lit(name)).otherwise(own)
        choice = F.when(F.col(label).eqNullSafe(F.lit(value)), own).otherwise(choice)
    return rows.withColumn("split", choice)


def class_subsample(rows, quotas, id_col="id", label="label", seed=fixed.SEED):
    """At most `quotas[class]` rows of each class, drawn without replacement, by a filter on the hash."""
    number = C.mix(id_col, seed)
    limit = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    cuts = spread.hash_cuts(
        rows.filter(F.col(label).isin(list(quotas))), [label], number, C.MIX_DOMAIN, id_col,
        {"quota": lambda n: F.element_at(limit, F.col(label))},
    )
    kept = F.lit(False)
    for (value,), at in cuts.items():
        kept = kept | ((F.col(label) == value) & spread.within_cut(number, id_col, at["quota"]))
    return rows.filter(kept)


def _class_sizes(rows, label):
    sizes = rows.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    return sizes["pos"], sizes["neg"]


def ratio_quotas(n_pos, target=200_000):
    """Up to a tenth positives, the rest negatives."""
    pos = min(n_pos, int(target * 0.1))
    return {1: pos, 0: target - pos}


def realistic_quotas(n_pos, n_neg, target=100_000):
    """Two percent positives, each side capped by what there is."""
    pos = int(target * 0.02)
    return {1: min(pos, n_pos), 0: min(target - pos, n_neg)}


def subsample_ratio(rows, target=200_000, **names):
    n_pos, _ = _class_sizes(rows, names.get("label", "label"))
    return class_subsample(rows, ratio_quotas(n_pos, target), **names)


def subsample_realistic(rows, target=100_000, **names):
    n_pos, n_neg = _class_sizes(rows, names.get("label", "label"))
    return class_subsample(rows, realistic_quotas(n_pos, n_neg, target), **names)


def uniform_subsample(rows, size=50_000, id_col="id", seed=fixed.SEED):
    """Exactly `size` rows (all if fewer), drawn without replacement, by a filter on the hash."""
    number = C.mix(id_col, seed)
    cuts = spread.hash_cuts(rows, [], number, C.MIX_DOMAIN, id_col, {"size": lambda n: F.lit(size)})
    return rows.filter(spread.within_cut(number, id_col, cuts[()]["size"])) if cuts else rows


def fit_scaler(rows, names):
    """One row of population means and deviations; a constant column scales by 1."""
    cells = []
    for n in names:
        x = F.col(f"`{n}`").cast("double")
        std = F.stddev_pop(x)
        cells.append(
            F.struct(
                F.avg(x).alias("mean"),
                F.when(std > 0, std).otherwise(F.lit(1.0)).alias("std"),
            ).alias(n)
        )
    return rows.agg(F.struct(*cells).alias("scaler"))


def standardize(rows, names, scaler):
    """(value - mean) / deviation; the fitted row enters as a scalar subquery."""
    s = scaler.scalar()
    scaled = {n: (F.col(f"`{n}`").cast("double") - s[n]["mean"]) / s[n]["std"] for n in names}
    return rows.withColumns(scaled)


def save_scaler(scaler, path):
    """The fitted row, one column per feature."""
    scaler.select("scaler.*").write.mode("overwrite").parquet(path)


def load_scaler(spark, path):
    held = spark.read.parquet(path)
    return held.select(F.struct(*[F.col(f"`{n}`") for n in held.columns]).alias("scaler"))


def class_weights(rows, label="label"):
    """Balanced weight of each class: total / (2 * class size)."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    total = F.count(F.lit(1))
    cells = F.array(
        F.struct(F.lit(0).alias(label), neg.alias("n"), C.safe_div(total, 2 * neg).alias("weight")),
        F.struct(F.lit(1).alias(label), pos.alias("n"), C.safe_div(total, 2 * pos).alias("weight")),
    )
    return rows.agg(cells.alias("cells")).select(F.inline("cells"))


def with_class_weight(rows, label="label", fixed_weights=None):
    """A `weight` column, balanced or from fixed weights by class."""
    if fixed_weights:
        weight = F.when(F.col(label) == 1, F.lit(float(fixed_weights[1]))).otherwise(
            F.lit(float(fixed_weights[0]))
        )
        return rows.withColumn("weight", weight)
    n_pos, n_neg = _class_sizes(rows, label)
    total = n_pos + n_neg
    balanced = {1: total / (2 * n_pos) if n_pos else 0.0, 0: total / (2 * n_neg) if n_neg else 0.0}
    return with_class_weight(rows, label, balanced)


def split_summary(rows, label="label"):
    """Rows, positives and share by split, with a total row."""
    n, pos = F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0)).cast("bigint")
    return rows.rollup("split").agg(
        n.alias("n_rows"), pos.alias("n_positive"), C.safe_div(pos, n).alias("positive_rate")
    ).withColumn("split", F.coalesce("split", F.lit("total")))


def save_splits(rows, path, feature_names):
    """Rows partitioned by split, and the feature list as JSON beside them."""
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    spark = rows.sparkSession
    spark.createDataFrame([(list(feature_names),)], "feature_names array<string>").write.mode(
        "overwrite"
    ).json(f"{path}/features")
