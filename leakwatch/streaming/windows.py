"""Window features on a stream of packets.

Two chained event-time aggregations. The first closes short slices of a source
and reduces their packets to a summary; the second merges the few summaries of a
window. Packets are held only while their slice is open, and a busy source is
spread over tasks by slice.
"""

from pyspark.sql import functions as F

from leakwatch.functions import fixed
from leakwatch.operators import windows as batch


def _pairs(rows):
    """Neighbouring elements of a sorted array, as (earlier, later)."""
    last = F.greatest(F.size(rows) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(rows, F.lit(1), last).alias("a"), F.slice(rows, F.lit(2), last).alias("b")
    )


def _gap_summary(gaps):
    """The gap measures of an array of (gap_us, led) structs."""
    lengths = F.transform(gaps, lambda g: g["gap_us"])
    return {
        "gap_min": F.array_min(lengths),
        "gap_max": F.array_max(lengths),
        "fwd_gaps": F.size(F.filter(gaps, lambda g: g["led"])).cast("bigint"),
        "fwd_bursts": F.size(
            F.filter(gaps, lambda g: g["led"] & (g["gap_us"] < fixed.BURST_GAP_US))
        ).cast("bigint"),
    }


def _around(values, center):
    """Summed squared distance of an array of numbers from a value."""
    return F.aggregate(values, F.lit(0.0), lambda total, g: total + F.pow(g - center, F.lit(2.0)))


def window_features(
    packets,
    seconds=fixed.WINDOW_SECONDS,
    slice_seconds=1,
    late="30 seconds",
    start="bucket",
    min_packets=fixed.MIN_PACKETS,
):
    """Features of each source and window, emitted once the watermark has passed it.

    Windows are those of event time, so what happens does not depend on when it
    arrives; rows later than `late` are dropped and counted by the query.
    """
    if seconds % slice_seconds:
        raise ValueError("slices must divide the window")
    timed = batch.with_direction(packets).withColumn("event_time", F.timestamp_micros("ts_us"))
    unordered = batch._unordered()
    slices = (
        timed.withWatermark("event_time", late)
        .groupBy(F.window("event_time", f"{slice_seconds} seconds").alias("slice"), "src_ip")
        .agg(
            *[c.alias(n) for n, c in unordered.items()],
            F.array_sort(F.collect_list(F.struct("ts_us", "packet_id", "is_fwd"))).alias("seen"),
            F.collect_set("dst_ip").alias("destinations"),
        )
    )
    gaps = F.transform(
        _pairs(F.col("seen")),
        lambda p: F.struct(
            (p["b"]["ts_us"] - p["a"]["ts_us"]).alias("gap_us"), p["a"]["is_fwd"].alias("led")
        ),
    )
    summary = _gap_summary(gaps)
    lengths = F.transform(gaps, lambda g: g["gap_us"])
    count = F.size("seen") - 1
    mean = (F.col("last_us") - F.col("first_us")) / F.greatest(count, F.lit(1))
    edge = F.struct(
        "first_us",
        "last_us",
        F.element_at("seen", -1)["is_fwd"].alias("tail_fwd"),
        count.alias("gap_n"),
        mean.alias("gap_mean"),
        _around(lengths, mean).alias("gap_m2"),
    )
    closed = slices.select(
        F.window_time("slice").alias("slice_time"),
        "src_ip",
        *unordered,
        *[c.alias(n) for n, c in summary.items()],
        edge.alias("edge"),
        "destinations",
    )
    merged = closed.groupBy(F.window("slice_time", f"{seconds} seconds").alias("window"), "src_ip").agg(
        *[batch._merge(n).alias(n) for n in [*unordered, *summary]],
        F.array_sort(F.collect_list("edge")).alias("edges"),
        F.size(F.array_distinct(F.flatten(F.collect_list("destinations")))).cast("bigint").alias("destinations"),
    )
    between = F.transform(
        _pairs(F.col("edges")),
        lambda p: F.struct((p["b"]["first_us"] - p["a"]["last_us"]).alias("gap_us"), p["a"]["tail_fwd"].alias("led")),
    )
    seams = _gap_summary(between)
    center = (F.col("last_us") - F.col("first_us")) / F.greatest(F.col("n") - 1, F.lit(1))
    inside = F.aggregate(
        "edges",
        F.lit(0.0),
        lambda total, e: total + e["gap_m2"] + e["gap_n"] * F.pow(e["gap_mean"] - center, F.lit(2.0)),
    )
    stitched = merged.withColumns(
        {
            "bucket_us": F.unix_micros("window.start"),
            "gap_m2": inside + _around(F.transform(between, lambda g: g["gap_us"]), center),
            "gap_min": F.least(F.col("gap_min"), seams["gap_min"]),
            "gap_max": F.greatest(F.col("gap_max"), seams["gap_max"]),
            "fwd_gaps": F.col("fwd_gaps") + seams["fwd_gaps"],
            "fwd_bursts": F.col("fwd_bursts") + seams["fwd_bursts"],
        }
    )
    return batch.finish(stitched, seconds, start, min_packets)
