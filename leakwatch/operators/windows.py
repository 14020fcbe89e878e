"""Per-source tumbling windows and their features.

Packets are grouped by source and event-time bucket. Most measures are plain
mergeable aggregates; the gaps between consecutive packets need an order. Every
bucket is cut into short slices of time, so that a busy source is ordered by
many tasks, and the slice summaries are stitched.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed

KEYS = ["src_ip", "bucket_us"]
SLICES = 12  # of a window


def with_bucket(packets, seconds=fixed.WINDOW_SECONDS):
    size = int(seconds * 1_000_000)
    return packets.withColumn("bucket_us", F.expr(f"ts_us - pmod(ts_us, {size}L)"))


def with_direction(packets):
    return packets.withColumn("is_fwd", C.direction() == "fwd")


def _bytes(side):
    return F.coalesce(F.sum(F.when(side, F.col("payload_len"))), F.lit(0))


def _flag(name):
    return F.count_if(F.col(f"tcp_flags.{name}"))


def _unordered():
    """Measures that merge in any order."""
    unusual = (F.col("src_port") > 0) & ~F.col("src_port").isin(*fixed.SERVICE_PORTS)
    size = F.col("payload_len").cast("double")
    length = F.col("pkt_len").cast("double")
    return {
        "n": F.count(F.lit(1)),
        "fwd_bytes": _bytes(F.col("is_fwd")),
        "bwd_bytes": _bytes(~F.col("is_fwd")),
        "first_us": F.min("ts_us"),
        "last_us": F.max("ts_us"),
        "unusual": F.count_if(unusual),
        "pay_sum": F.sum("payload_len"),
        "pay_sq": F.sum(size * size),
        "pay_max": F.max("payload_len"),
        "len_sum": F.sum("pkt_len"),
        "len_sq": F.sum(length * length),
        "psh": _flag("PSH"),
        "ack": _flag("ACK"),
        "syn": _flag("SYN"),
        "fin": _flag("FIN"),
        "rst": _flag("RST"),
    }


def _gaps(gap="gap_us", leader="is_fwd"):
    """Measures of the gaps; `leader` tells the direction of the earlier packet."""
    g = F.col(gap)
    return {
        **C.moments("gap", g),
        "gap_min": F.min(g),
        "gap_max": F.max(g),
        "fwd_gaps": F.count_if(F.col(leader) & g.isNotNull()),
        "fwd_bursts": F.count_if(F.col(leader) & (g < fixed.BURST_GAP_US)),
    }


def _aliased(measures):
    return [c.alias(name) for name, c in measures.items()]


def _measure(packets):
    """One shuffle on (source, bucket); columns nobody reads drop out of the plan."""
    order = Window.partitionBy(*KEYS).orderBy("ts_us", "packet_id")
    gapped = packets.withColumn("gap_us", F.lead("ts_us").over(order) - F.col("ts_us"))
    return gapped.groupBy(*KEYS).agg(
        *_aliased(_unordered()),
        *_aliased(_gaps()),
        F.count_distinct("dst_ip").alias("destinations"),
    )


_LARGEST = {"last_us", "pay_max", "gap_max"}
_SMALLEST = {"first_us", "gap_min"}


def _merge(name):
    if name in _LARGEST:
        return F.max(name)
    if name in _SMALLEST:
        return F.min(name)
    return F.sum(name)


def _measure_sliced(packets, slice_us, destinations=True):
    """The same measures, each bucket cut into slices of time: one scan and two exchanges, of packets by
    slice and of slice summaries by bucket."""
    sliced = packets.withColumn("_slice", F.expr(f"(ts_us - bucket_us) div {slice_us}L"))
    order = Window.partitionBy(*KEYS, "_slice").orderBy("ts_us", "packet_id")
    gapped = sliced.withColumn("gap_us", F.lead("ts_us").over(order) - F.col("ts_us"))
    unordered, gaps = _unordered(), _gaps()
    # The last packet of a slice is the one without a following packet.
    tail = F.max(F.when(F.col("gap_us").isNull(), F.col("is_fwd")))
    targets = {"_targets": F.collect_set("dst_ip")} if destinations else {}
    pieces = gapped.groupBy(*KEYS, "_slice").agg(
        *_aliased(unordered), *_aliased(gaps), tail.alias("tail_fwd"), *_aliased(targets)
    )
    # A few rows per bucket are left: the gap to the next slice joins its summary.
    bucket = Window.partitionBy(*KEYS)
    seam = F.lead("first_us").over(bucket.orderBy("_slice")) - F.col("last_us")
    center = (F.max("last_us").over(bucket) - F.min("first_us").over(bucket)) / (F.sum("n").over(bucket) - 1)
    seamed = pieces.withColumns({"seam_us": seam, "_center": F.when(F.sum("n").over(bucket) > 1, center)})
    seams = {k: v for k, v in _gaps("seam_us", "tail_fwd").items() if k not in C.moment_names("gap")}
    if destinations:
        # Distinct destinations do not add up over slices: one row per slice and destination, the first
        # of a slice with its measures. All this stays on the exchange by source and bucket.
        rest = [c for c in seamed.columns if c not in (*KEYS, "_targets")]
        spread = seamed.select(*KEYS, *rest, F.posexplode_outer("_targets").alias("_place", "_target"))
        seamed = spread.select(
            *KEYS, *[F.when(F.coalesce("_place", F.lit(0)) == 0, F.col(c)).alias(c) for c in rest], "_target"
        )
    counted = F.count_distinct("_target") if destinations else F.lit(None).cast("bigint")
    merged = seamed.groupBy(*KEYS).agg(
        counted.alias("destinations"),
        *[_merge(n).alias(n) for n in [*unordered, *gaps] if n not in C.moment_names("gap")],
        *[c.alias(f"seam_{n}") for n, c in seams.items()],
        C.stitched_m2("gap", "seam_us", "_center").alias("gap_m2"),
    )
    return merged.withColumns(
        {
            "gap_min": F.least("gap_min", "seam_gap_min"),
            "gap_max": F.greatest("gap_max", "seam_gap_max"),
            "fwd_gaps": F.col("fwd_gaps") + F.col("seam_fwd_gaps"),
            "fwd_bursts": F.col("fwd_bursts") + F.col("seam_fwd_bursts"),
        }
    ).drop(*[f"seam_{n}" for n in seams])


def finish(measured, seconds=fixed.WINDOW_SECONDS, start="bucket", min_packets=fixed.MIN_PACKETS):
    """Turn merged measures into the 27 features; drops windows below `min_packets`."""
    n = F.col("n").cast("double")
    gaps = F.col("n") - 1
    total_bytes = F.col("fwd_bytes") + F.col("bwd_bytes")
    span = F.col("last_us") - F.col("first_us")
    start_us = F.col("first_us") if start == "first_packet" else F.col("bucket_us")
    length = (F.col("last_us") - start_us) / 1e6
    features = {
        "request_count": F.col("n"),
        "total_fwd_bytes": F.col("fwd_bytes"),
        "total_bwd_bytes": F.col("bwd_bytes"),
        "total_bytes": total_bytes,
        "upload_download_ratio": F.col("fwd_bytes") / F.greatest("bwd_bytes", F.lit(1)),
        "burst_count": F.col("fwd_bursts"),
        "fwd_burst_count": F.col("fwd_bursts"),
        "burst_ratio": F.col("fwd_bursts") / F.greatest("fwd_gaps", F.lit(1)),
        "unusual_port_ratio": F.col("unusual") / n,
        "request_rate": n / F.greatest(span / 1e6, F.lit(0.001)),
        "inter_request_time_mean": F.when(gaps > 0, span / gaps / 1e6).otherwise(F.lit(0.0)),
        "inter_request_time_std": F.when(gaps > 1, F.sqrt(F.col("gap_m2") / gaps)).otherwise(0.0) / 1e6,
        "inter_request_time_min": F.coalesce(F.col("gap_min") / 1e6, F.lit(0.0)),
        "inter_request_time_max": F.coalesce(F.col("gap_max") / 1e6, F.lit(0.0)),
        "window_duration": length,
        "mean_payload_size": F.col("pay_sum") / n,
        "std_payload_size": C.spread(F.col("n"), F.col("pay_sum"), F.col("pay_sq")),
        "max_payload_size": F.col("pay_max").cast("double"),
        "mean_packet_size": F.col("len_sum") / n,
        "std_packet_size": C.spread(F.col("n"), F.col("len_sum"), F.col("len_sq")),
        "psh_flag_count": F.col("psh"),
        "ack_flag_count": F.col("ack"),
        "syn_flag_count": F.col("syn"),
        "fin_flag_count": F.col("fin"),
        "rst_flag_count": F.col("rst"),
        "unique_destinations": F.col("destinations"),
        "is_long_session": (length > fixed.LONG_SESSION_SECONDS).cast("int"),
    }
    kept = measured.filter(F.col("n") >= min_packets)
    return kept.select(
        "src_ip",
        (start_us / 1e6).alias("window_start"),
        (F.col("bucket_us") / 1e6 + float(seconds)).alias("window_end"),
        *[c.alias(name) for name, c in features.items()],
    )


def window_features(
    packets,
    seconds=fixed.WINDOW_SECONDS,
    start="bucket",
    min_packets=fixed.MIN_PACKETS,
    ordered=True,
    destinations=True,
):
    """All features of every source and window.

    `start` is "bucket" (window start is the bucket start) or "first_packet".
    With `ordered=False` no packet order is prepared: use it when only mergeable
    columns are selected, so that packets are combined before the shuffle. With
    `destinations=False` distinct destinations are left out (null).
    """
    prepared = with_direction(with_bucket(packets, seconds))
    slice_us = max(1, int(seconds * 1_000_000) // SLICES)
    measured = _measure_sliced(prepared, slice_us, destinations) if ordered else _measure(prepared)
    return finish(measured, seconds, start, min_packets)


def packet_counts(packets, seconds=fixed.WINDOW_SECONDS):
    """Packets per source and tumbling window, small windows included."""
    return (
        with_bucket(packets, seconds)
        .groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("packets"), F.sum("pkt_len").alias("bytes"))
        .select("src_ip", (F.col("bucket_us") / 1e6).alias("window_start"), "packets", "bytes")
    )


def window_counters(packets, seconds=fixed.WINDOW_SECONDS, min_packets=fixed.MIN_PACKETS):
    """Windows made and skipped, packets and active sources."""
    sized = packet_counts(packets, seconds)
    return sized.agg(
        F.count_if(F.col("packets") >= min_packets).alias("windows_created"),
        F.count_if(F.col("packets") < min_packets).alias("windows_skipped"),
        F.coalesce(F.sum("packets"), F.lit(0)).alias("total_packets_processed"),
        F.count_distinct("src_ip").alias("active_sources"),
    )


def runtime_vector(windows, names=None):
    """The ordered vector of a window; unusable values are 0, single precision."""
    names = names or fixed.RUNTIME_FEATURES
    present = set(windows.columns)
    cells = [C.finite(F.col(n)) if n in present else F.lit(0.0) for n in names]
    return F.array(*[c.cast("float") for c in cells])
