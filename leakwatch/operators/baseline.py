"""Adaptive per-source baseline over window rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators.moments import NAMES, Baselines, rounds

RESULT = T.StructType(
    [
        T.StructField("online_score", T.DoubleType()),
        T.StructField("online_prediction", T.IntegerType()),
        T.StructField("reason_codes", T.ArrayType(T.StringType())),
        T.StructField("baseline_count", T.LongType()),
    ]
)


# What a step of the baseline leaves for the reasons.
STEP = T.StructType(
    [
        T.StructField("_warm", T.BooleanType()),
        T.StructField("_score", T.DoubleType()),
        T.StructField("_flagged", T.BooleanType()),
        T.StructField("_after", T.LongType()),
        T.StructField("_before", T.LongType()),
        T.StructField("_mean", T.ArrayType(T.DoubleType())),
        T.StructField("_std", T.ArrayType(T.DoubleType())),
    ]
)
# Sources of a task are taken in this many groups, one after the other, which bounds its state.
SOURCE_GROUPS = 64


def feature_array(columns):
    """The features in their order; absent columns and nulls are 0."""
    return F.array(
        *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in columns else F.lit(0.0) for n in NAMES]
    )


def _reasons(warmup):
    """Reason codes of a window from its features and the baseline before it."""
    cells = F.arrays_zip(
        F.array(*[F.lit(n) for n in NAMES]).alias("name"), F.col("_x").alias("x"), F.col("_mean").alias("mean"),
        F.col("_std").alias("std"), F.array(*[F.lit(i) for i in range(len(NAMES))]).alias("place"),
    )
    varies = lambda c: (F.col("_before") >= 2) & (c["std"] >= fixed.STD_FLOOR)
    z = lambda c: F.when(varies(c), F.abs(c["x"] - c["mean"]) / c["std"]).otherwise(F.lit(0.0))
    scored = F.transform(cells, lambda c: F.struct(
        c["name"].alias("name"), c["x"].alias("x"), c["mean"].alias("mean"), c["std"].alias("std"),
        (-z(c)).alias("minus_z"), c["place"].alias("place"),
    ))

    def note(c):
        text = F.concat(
            c["name"], F.when(c["x"] > c["mean"], F.lit("↑")).otherwise(F.lit("↓")), F.lit(" "), C.fixed_text(c["x"], 2),
            F.lit(" (baseline μ="), C.fixed_text(c["mean"], 2), F.lit(" σ="), C.fixed_text(c["std"], 2),
            F.lit(", z="), C.fixed_text(-c["minus_z"], 1), F.lit(")"),
        )
        return (
            F.when(F.col("_before") < 2, F.concat(c["name"], F.lit("=N/A (baseline n="), F.col("_before").cast("string"), F.lit(")")))
            .when(c["std"] < fixed.STD_FLOOR, F.concat(c["name"], F.lit("=const (std≈0)")))
            .when(-c["minus_z"] > fixed.Z_THRESHOLD, text)
        )

    notes = F.filter(F.transform(scored, note), lambda t: t.isNotNull())
    order = F.array_sort(F.transform(scored, lambda c: F.struct(c["minus_z"].alias("minus_z"), c["place"].alias("place"), c["name"].alias("name"))))
    high = F.filter(F.slice(order, 1, 3), lambda c: -c["minus_z"] > fixed.Z_THRESHOLD)
    codes = F.transform(high, lambda c: F.concat(F.lit("HIGH_Z: "), c["name"], F.lit("="), C.fixed_text(-c["minus_z"], 1), F.lit("σ")))
    last = F.when(F.col("_flagged"), codes).otherwise(F.array(F.lit("within_baseline")))
    warming = F.array(F.concat(F.lit("warmup_"), F.col("_after").cast("string"), F.lit(f"/{warmup}")))
    return F.when(F.col("_warm"), F.concat(notes, last)).otherwise(warming)


def explained(stepped, columns, warmup):
    """The given columns and the result of the monitor, from what the steps returned."""
    return stepped.withColumn("_x", feature_array(columns)).select(
        *[F.col(f"`{c}`") for c in columns],
        C.round_exact(F.col("_score"), 4).alias("online_score"),
        F.col("_flagged").cast("int").alias("online_prediction"),
        _reasons(warmup).alias("reason_codes"),
        F.col("_after").alias("baseline_count"),
    )


def step_arrays(parts):
    """Results of steps as Arrow arrays in the order of STEP."""
    warm, score, flagged, after, before, mean, std = parts
    width = pa.array(np.arange(0, len(NAMES) * (len(score) + 1), len(NAMES), dtype=np.int32))
    return [
        pa.array(warm), pa.array(score), pa.array(flagged), pa.array(after), pa.array(before),
        *[pa.ListArray.from_arrays(width, pa.array(np.ascontiguousarray(v).reshape(-1))) for v in (mean, std)],
    ]


def _lock_step(threshold, warmup):
    """mapInArrow function over rows sorted by group of sources, then time: all sources of a group take their
    next window in one vector step."""

    def score(batches):
        group, known, state = None, {}, Baselines()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(NAMES))
            groups, times = batch.column("_group").to_numpy(), batch.column("window_start").to_numpy(zero_copy_only=False)
            keys = batch.column("src_ip").to_pylist()
            if "epoch" in batch.schema.names:
                keys = list(zip(keys, batch.column("epoch").to_pylist()))
            changed = np.concatenate(([True], (np.diff(groups) != 0) | (np.diff(times) != 0)))
            starts = np.flatnonzero(changed).tolist()
            out = [np.empty(n, t) for t in (bool, float, bool, np.int64, np.int64)]
            out += [np.empty((n, len(NAMES))) for _ in range(2)]
            for low, high in zip(starts, [*starts[1:], n]):
                if groups[low] != group:
                    group, known, state = groups[low], {}, Baselines()
                at = np.array([known.setdefault(k, len(known)) for k in keys[low:high]])
                if len(known) > len(state.n):
                    state.grow(len(known))
                for rows in rounds(at):
                    for whole, part in zip(out, state.step(at[rows], x[low + rows], threshold, warmup)):
                        whole[low + rows] = part
            yield pa.RecordBatch.from_arrays([*batch.columns, *step_arrays(out)], [*batch.schema.names, *STEP.names])

    return score


def monitor(windows, threshold=fixed.ONLINE_THRESHOLD, warmup=fixed.WARMUP_WINDOWS, enabled=True):
    """Score each window against its source's own past.

    A flagged window does not enter the baseline, so every step depends on the
    decision before it and no window frame can express it. Sources are spread over tasks; a task
    takes a part of its sources at a time, in order of time, and moves all of them on by one window
    in a vector step. A source has one row per window however many packets it sent, so packet skew
    does not reach here. With a column `epoch` (see `with_resets`) a source starts afresh in each epoch.
    """
    if not enabled:
        return windows.withColumns(
            {
                "online_score": F.lit(0.0),
                "online_prediction": F.lit(0),
                "reason_codes": F.array(F.lit("online_monitor_disabled")),
                "baseline_count": F.lit(0).cast("bigint"),
            }
        )
    columns = windows.columns
    group = F.pmod(F.xxhash64("src_ip"), F.lit(SOURCE_GROUPS)).cast("int")
    ordered = (
        windows.withColumns({"_x": feature_array(columns), "_group": group})
        .repartition("src_ip").sortWithinPartitions("_group", "window_start", "src_ip")
    )
    stepped = ordered.mapInArrow(_lock_step(threshold, warmup), T.StructType(ordered.schema.fields + STEP.fields))
    return explained(stepped, columns, warmup)


def monitor_stats(monitored):
    """Windows processed, anomalies found and baselines held, over all sources."""
    return monitored.agg(
        F.count(F.lit(1)).alias("windows_processed"),
        F.coalesce(F.sum("online_prediction"), F.lit(0)).alias("anomalies_detected"),
        F.count_distinct("src_ip").alias("baselines_created"),
    )


def source_stats(monitored):
    """The same counters by source, with the baseline size after the last window."""
    return monitored.groupBy("src_ip").agg(
        F.count(F.lit(1)).alias("windows_processed"),
        F.sum("online_prediction").alias("anomalies_detected"),
        F.max("baseline_count").alias("baseline_count"),
    )


def with_resets(windows, resets):
    """Adds `epoch`: how many resets of its source a window has seen, for `monitor`.

    resets: (src_ip, at in seconds); a null source resets all. A window that starts at a
    reset or later belongs to the new epoch and is scored against that epoch's past only.
    """
    times = F.sort_array(F.collect_list("at"))
    own = resets.filter(F.col("src_ip").isNotNull()).groupBy("src_ip").agg(times.alias("_own"))
    every = resets.filter(F.col("src_ip").isNull()).agg(times.alias("_every")).scalar()
    joined = windows.join(own, "src_ip", "left").withColumn("_every", every)

    def passed(c):
        return F.coalesce(F.size(F.filter(c, lambda t: t <= F.col("window_start"))), F.lit(0))

    mine = F.when(F.col("_own").isNull(), F.lit(0)).otherwise(passed(F.col("_own")))
    return joined.withColumn("epoch", mine + passed(F.col("_every"))).drop("_own", "_every")


def without_sources(windows, sources=None):
    """Windows of the given sources (all if None) left out."""
    if sources is None:
        return windows.limit(0)
    return windows.filter(~F.col("src_ip").isin(*sources))


# --- parts of the baseline that do not depend on earlier decisions -----------------


def moments(windows, by, feature):
    """Count, mean and summed squared deviation by group: partial aggregates."""
    x = F.col(feature).cast("double")
    return windows.groupBy(*by).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        (F.coalesce(F.var_pop(x), F.lit(0.0)) * F.count(x)).alias("m2"),
    )


def running_moments(windows, by, feature):
    """Mean, variance and deviation of a feature; variance is 0 below two rows."""
    part = moments(windows, by, feature)
    variance = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("m2") / F.col("n"))
    return part.select(
        *by, "n", "mean", variance.alias("variance"), F.sqrt(variance).alias("std")
    )


def merge_moments(parts, by):
    """Combine partial (n, mean, m2) rows into one row per group.

    The common mean comes first; parts are then moved to it by their distance, so large
    means do not cancel. A group has few parts; their means are combined before the join.
    """
    some = parts.filter(F.col("n") > 0).select(*by, "n", "mean", "m2", F.lit(1).alias("_one"))
    keys = [*by, "_one"]
    near = some.join(some.groupBy(*keys).agg(F.min("mean").alias("_anchor")), keys)
    off = F.col("mean") - F.col("_anchor")
    n = F.sum("n")
    shift = F.sum(F.col("n") * off) / n
    moved = F.sum(F.col("m2") + F.col("n") * off * off) - n * shift * shift
    return near.groupBy(*by).agg(
        n.alias("n"), (F.first("_anchor") + shift).alias("mean"), F.greatest(moved, F.lit(0.0)).alias("m2")
    )


def warmup_gate(windows, warmup=fixed.WARMUP_WINDOWS):
    """Position of each window in its source's history, and whether it only warms up."""
    order = Window.partitionBy("src_ip").orderBy("window_start")
    return windows.withColumn("position", F.row_number().over(order)).withColumn(
        "warming_up", F.col("position") <= warmup
    )


def expanding_z(windows, names=None):
    """Absolute z-score against all earlier windows of the source (no selection)."""
    past = Window.partitionBy("src_ip").orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)
    n = F.count(F.lit(1)).over(past)
    added = {}
    for name in names or NAMES:
        x = C.finite(F.col(name))
        mean, std = F.avg(x).over(past), F.stddev_pop(x).over(past)
        usable = (n >= 2) & (std >= fixed.STD_FLOOR)
        added[f"z_{name}"] = F.when(usable, F.abs(x - mean) / std).otherwise(F.lit(0.0))
    return windows.withColumns(added)


def weighted_score(z_frame, names=None, z_limits=None):
    """Weighted mean of capped z-scores in units of their limits, at most 1."""
    names, limits = names or NAMES, z_limits or {}
    parts = [
        F.lit(fixed.BASELINE_WEIGHTS.get(n, 0.5))
        * F.least(F.col(f"z_{n}"), F.lit(fixed.Z_CAP))
        / F.lit(float(limits.get(n, fixed.Z_THRESHOLD)))
        for n in names
    ]
    weight = sum(fixed.BASELINE_WEIGHTS.get(n, 0.5) for n in names)
    if weight < fixed.STD_FLOOR:
        return z_frame.withColumn("anomaly_score", F.lit(0.0))
    return z_frame.withColumn("anomaly_score", F.least(C.total(parts) / F.lit(weight), F.lit(1.0)))


def top_deviations(z_frame, k=3, names=None):
    """The k largest z-scores above the threshold, as HIGH_Z codes."""
    names = names or NAMES
    # Sorting structs descending: earlier features win ties through -position.
    cells = F.array(
        *[
            F.struct(F.col(f"z_{n}").alias("z"), F.lit(-i).alias("place"), F.lit(n).alias("name"))
            for i, n in enumerate(names)
        ]
    )
    # Rounded, so that a deviation of exactly the threshold is not decided by noise.
    high = F.filter(cells, lambda c: F.round(c["z"], 9) > fixed.Z_THRESHOLD)
    top = F.slice(F.sort_array(high, asc=False), 1, k)
    codes = F.transform(
        top, lambda c: F.format_string("HIGH_Z: %s=%.1fσ", c["name"], c["z"])
    )
    return z_frame.withColumn("top_deviations", codes)


def profile(windows, names=None):
    """Long table (source, feature, n, mean, variance): one pass, then unpivot."""
    names = names or NAMES
    cells = []
    for name in names:
        x = C.finite(F.col(name))
        cells += [F.avg(x).alias(f"mean_{name}"), F.var_pop(x).alias(f"var_{name}")]
    wide = windows.groupBy("src_ip").agg(F.count(F.lit(1)).alias("n"), *cells)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                F.col(f"mean_{n}").alias("mean"),
                F.col(f"var_{n}").alias("variance"),
            )
            for n in names
        ]
    )
    return wide.select("src_ip", "n", F.inline(rows))
