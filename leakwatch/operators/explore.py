"""Exploratory statistics of flow tables."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.session import staged

# Deviations below this share of the mean are rounding: the column counts as constant.
ROUNDING = 1e-14


def label_rollup(flows, file="source_file", label="label"):
    """Rows by file and label, by file, and in total ('*' stands for all)."""
    name = F.trim(F.col(label))
    return (
        flows.select(F.col(file).alias("file"), name.alias("label"))
        .rollup("file", "label")
        .agg(F.count(F.lit(1)).alias("flows"), F.grouping_id().alias("level"))
        .withColumns({c: F.coalesce(c, F.lit("*")) for c in ("file", "label")})
    )


def class_mean_ratio(flows, names, label="exfil_label", only_different=False):
    """Mean of each feature by class and their ratio, in one pass."""
    cells = []
    for n in names:
        x = C.finite(F.col(f"`{n}`"))
        normal = F.avg(F.when(F.col(label) == 0, x))
        exfil = F.avg(F.when(F.col(label) == 1, x))
        cells.append(
            F.struct(F.lit(n).alias("feature"), normal.alias("normal_mean"), exfil.alias("exfil_mean"))
        )
    table = flows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    table = table.withColumn("ratio", C.safe_div(F.col("exfil_mean"), F.col("normal_mean")))
    if only_different:
        return table.filter((F.col("ratio") > 2) | (F.col("ratio") < 0.5))
    return table


def port_share(flows, port="dst_port", label="exfil_label", k=3):
    """The k most used ports of each class and their share of the class.

    After the aggregation there is at most one row per port number and class.
    """
    counts = flows.groupBy(label, port).agg(F.count(F.lit(1)).alias("flows"))
    group = Window.partitionBy(label)
    place = F.row_number().over(group.orderBy(F.desc("flows"), port))
    shared = counts.withColumn("share", F.col("flows") / F.sum("flows").over(group))
    return shared.withColumn("place", place).filter(F.col("place") <= k)


def class_histogram(flows, value, low, high, bins=80, label="exfil_label"):
    """Density histogram of a clipped value by class; empty bins are left out."""
    width = (high - low) / bins
    x = C.clip(C.finite(F.col(f"`{value}`")), float(low), float(high))
    place = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counts = flows.select(label, place.alias("bin")).groupBy(label, "bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(label))
    return counts.withColumns(
        {
            "bin_start": F.lit(float(low)) + F.col("bin") * width,
            "density": F.col("n") / (total * F.lit(width)),
        }
    )


def comoments(values, width):
    """n, means and the upper triangle of the summed products of deviations, for the rows of each task.

    `values` has one array column `x`. Batches are merged as they come, each around its own mean, so large
    means do not cancel; one row per task is left.
    """
    rows, columns = np.triu_indices(width)

    def run(batches):
        n, mean, sums = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not len(x):
                continue
            own = x.mean(axis=0)
            centred = x - own
            # The mean of large values is itself rounded; what is left of it is taken off once more.
            rest = centred.mean(axis=0)
            own, centred = own + rest, centred - rest
            gap, total = own - mean, n + len(x)
            sums += centred.T @ centred + np.outer(gap, gap) * (n * len(x) / total)
            mean, n = mean + gap * (len(x) / total), total
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([mean.tolist()]), pa.array([sums[rows, columns].tolist()])], ["n", "mean", "sums"]
        )

    return values.mapInArrow(run, "n bigint, mean array<double>, sums array<double>").filter("n > 0")


def correlation_matrix(flows, names):
    """Pearson correlation of every pair of columns, over all rows, in one scan.

    Tasks leave their moments and co-moments; those few rows are written, and moved to the common mean
    by the distance of their means. A constant column has no correlation (null).
    """
    x = F.array(*[C.finite(F.col(f"`{n}`")) for n in names])
    parts = staged(comoments(flows.select(x.alias("x")), len(names)), "co-moments")
    means = parts.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"), F.sum("n").alias("n")
    )
    common = means.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda v: v["m"])).scalar()
    places = [(a, b) for a in range(len(names)) for b in range(a, len(names))]
    pair = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in places])
    moved = (
        parts.withColumn("_common", common)
        .withColumn("off", F.zip_with("mean", "_common", lambda own, m: own - m))
        .select("n", "off", F.inline(F.arrays_zip(pair.alias("p"), F.col("sums").alias("s"))))
        .select("p.a", "p.b", (F.col("s") + F.col("n") * F.col("off")[F.col("p.a")] * F.col("off")[F.col("p.b")]).alias("s"))
        .groupBy("a", "b").agg(F.sum("s").alias("s"))
    )
    noise = F.col("n") * F.pow(F.col("m") * ROUNDING, F.lit(2.0))
    own = moved.filter("a = b").join(F.broadcast(means), F.col("a") == F.col("i"))
    own = own.select("a", F.when(F.col("s") > noise, F.col("s")).otherwise(F.lit(0.0)).alias("s"))
    sides = [own.select(F.col("a").alias(k), F.col("s").alias(f"s{k}")) for k in ("a", "b")]
    label = F.array(*[F.lit(n) for n in names])
    scale = F.sqrt("sa") * F.sqrt("sb")
    # Both sides have one row per column of the table.
    joined = moved.filter("a < b").join(F.broadcast(sides[0]), "a").join(F.broadcast(sides[1]), "b")
    return joined.select(
        label[F.col("a")].alias("feature_a"), label[F.col("b")].alias("feature_b"), F.when(scale > 0, F.col("s") / scale).alias("r")
    )


def high_correlations(matrix, limit=0.95):
    """Pairs above the limit, strongest first."""
    return matrix.filter(F.abs(F.col("r")) > limit).orderBy(F.desc(F.abs(F.col("r"))), "feature_a", "feature_b")
