"""Bidirectional flows rebuilt from packets, and their features.

A flow is the unordered pair of endpoints, without idle timeout. Packets are
measured by endpoint ("a" is the smaller one); which endpoint is the client is
the sender of the first packet, found by a mergeable aggregate, so one shuffle
on the endpoint pair serves everything.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed

KEYS = ["a_ip", "a_port", "b_ip", "b_port"]
ORDER = ["ts_us", "packet_id"]
MIN_PACKETS = 2
HEADER_BYTES = 40
SLICE_US = 60_000_000


def with_endpoints(packets):
    """Canonical endpoint pair and which endpoints the packet comes from."""
    later = (F.col("src_ip") > F.col("dst_ip")) | (
        (F.col("src_ip") == F.col("dst_ip")) & (F.col("src_port") > F.col("dst_port"))
    )
    keyed = packets.withColumns(
        {
            "a_ip": F.when(later, F.col("dst_ip")).otherwise(F.col("src_ip")),
            "a_port": F.when(later, F.col("dst_port")).otherwise(F.col("src_port")),
            "b_ip": F.when(later, F.col("src_ip")).otherwise(F.col("dst_ip")),
            "b_port": F.when(later, F.col("src_port")).otherwise(F.col("dst_port")),
        }
    )
    return keyed.withColumns(
        {
            "from_a": (F.col("src_ip") == F.col("a_ip")) & (F.col("src_port") == F.col("a_port")),
            "from_b": (F.col("src_ip") == F.col("b_ip")) & (F.col("src_port") == F.col("b_port")),
        }
    )


def assemble(packets, within=None):
    """One row per flow: endpoints as the first packet saw them, and packet counts.

    All parts are mergeable, so packets are combined before the shuffle.
    """
    # One number orders by time, then id; unlike a struct it can be kept in a hash
    # aggregate, so packets are combined without a sort.
    place = F.col("ts_us").cast("decimal(38,0)") * F.lit(str(2**63)).cast("decimal(19,0)") + F.col("packet_id")
    first_is_a = F.min_by("from_a", place)
    grouped = with_endpoints(packets).groupBy(*(within or []), *KEYS)
    flows = grouped.agg(
        first_is_a.alias("opened_by_a"),
        F.count_if("from_a").alias("a_n"),
        F.count_if("from_b").alias("b_n"),
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
    )
    return _oriented_keys(flows).select(
        *(within or []),
        "src_ip",
        "src_port",
        "dst_ip",
        "dst_port",
        _pick("n", "fwd").alias("fwd_packets"),
        _pick("n", "bwd").alias("bwd_packets"),
        "first_us",
        "last_us",
    )


def _pick(name, side):
    """A measure of the client (fwd) or the server (bwd)."""
    own, other = ("a", "b") if side == "fwd" else ("b", "a")
    return F.when(F.col("opened_by_a"), F.col(f"{own}_{name}")).otherwise(F.col(f"{other}_{name}"))


def _oriented_keys(frame):
    a_first = F.col("opened_by_a")
    return frame.withColumns(
        {
            "src_ip": F.when(a_first, F.col("a_ip")).otherwise(F.col("b_ip")),
            "src_port": F.when(a_first, F.col("a_port")).otherwise(F.col("b_port")),
            "dst_ip": F.when(a_first, F.col("b_ip")).otherwise(F.col("a_ip")),
            "dst_port": F.when(a_first, F.col("b_port")).otherwise(F.col("a_port")),
        }
    )


def _gap_measures(prefix, gap):
    return {
        **C.moments(f"{prefix}_gap", gap),
        f"{prefix}_gap_min": F.min(gap),
        f"{prefix}_gap_max": F.max(gap),
    }


def _gaps(all_gap, a_gap, b_gap):
    return {
        **_gap_measures("all", all_gap),
        **_gap_measures("a", a_gap),
        **_gap_measures("b", b_gap),
        "bursts": F.count_if(all_gap < fixed.BURST_GAP_US),
    }


def _side(side):
    mine = F.col(f"from_{side}")

    def only(c):
        return F.when(mine, c)

    length = F.col("pkt_len")
    wide = length.cast("double")
    return {
        f"{side}_n": F.count_if(mine),
        f"{side}_len": F.coalesce(F.sum(only(length)), F.lit(0)),
        f"{side}_len_sq": F.coalesce(F.sum(only(wide * wide)), F.lit(0.0)),
        f"{side}_len_min": F.min(only(length)),
        f"{side}_len_max": F.max(only(length)),
        f"{side}_pay": F.coalesce(F.sum(only(F.col("payload_len"))), F.lit(0)),
        f"{side}_data": F.count_if(mine & (F.col("payload_len") > 0)),
        f"{side}_psh": F.count_if(mine & F.col("tcp_flags.PSH")),
        f"{side}_urg": F.count_if(mine & F.col("tcp_flags.URG")),
        f"{side}_head": F.max(only(F.when(F.col(f"{side}_gap").isNull(), length))),
        f"{side}_first": F.min(only(F.col("ts_us"))),
        f"{side}_last": F.max(only(F.col("ts_us"))),
    }


def _unordered():
    flags = {name.lower(): F.count_if(F.col(f"tcp_flags.{name}")) for name in fixed.TCP_FLAG_BITS}
    return {
        "opened_by_a": F.max(F.when(F.col("all_gap").isNull(), F.col("from_a"))),
        "first_us": F.min("ts_us"),
        "last_us": F.max("ts_us"),
        **flags,
        **_side("a"),
        **_side("b"),
    }


def _with_gaps(packets, keys):
    """Gap to the previous packet of the flow and of the same endpoint, in one sort."""
    order = Window.partitionBy(*keys).orderBy(*ORDER)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ts = F.col("ts_us")

    def since(side):
        mine = F.col(f"from_{side}")
        return F.when(mine, ts - F.last(F.when(mine, ts), ignorenulls=True).over(earlier))

    return packets.withColumns(
        {"all_gap": ts - F.lag("ts_us").over(order), "a_gap": since("a"), "b_gap": since("b")}
    )


def _aliased(measures):
    return [c.alias(n) for n, c in measures.items()]


def _merge(name):
    if name.endswith("_head") or name == "opened_by_a":
        # Each slice names its own first packet; the earliest slice that has one counts.
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("_slice")))
    if name.endswith(("_min", "_first")) or name == "first_us":
        return F.min(name)
    if name.endswith(("_max", "_last")) or name == "last_us":
        return F.max(name)
    return F.sum(name)


def _measure(packets, keys):
    """All measures of a flow, cut into slices of time that are stitched."""
    sliced = packets.withColumn("_slice", F.expr(f"ts_us div {SLICE_US}L"))
    unordered = _unordered()
    gaps = _gaps(F.col("all_gap"), F.col("a_gap"), F.col("b_gap"))
    pieces = (
        _with_gaps(sliced, [*keys, "_slice"])
        .groupBy(*keys, "_slice")
        .agg(*_aliased(unordered), *_aliased(gaps))
    )
    flow = Window.partitionBy(*keys)
    earlier = flow.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)

    def seam(first, last):
        return F.col(first) - F.last(last, ignorenulls=True).over(earlier)

    def center(first, last, n):
        gaps = F.sum(n).over(flow) - 1
        return F.when(gaps > 0, (F.max(last).over(flow) - F.min(first).over(flow)) / gaps)

    seamed = pieces.withColumns(
        {
            "all_center": center("first_us", "last_us", F.col("a_n") + F.col("b_n")),
            "a_center": center("a_first", "a_last", F.col("a_n")),
            "b_center": center("b_first", "b_last", F.col("b_n")),
            "all_seam": seam("first_us", "last_us"),
            "a_seam": seam("a_first", "a_last"),
            "b_seam": seam("b_first", "b_last"),
        }
    )
    sides = ("all", "a", "b")
    around = {n for side in sides for n in C.moment_names(f"{side}_gap")}
    seams = _gaps(F.col("all_seam"), F.col("a_seam"), F.col("b_seam"))
    seams = {n: c for n, c in seams.items() if n not in around}
    merged = seamed.groupBy(*keys).agg(
        *[_merge(n).alias(n) for n in [*unordered, *gaps] if n not in around],
        *[c.alias(f"seam_{n}") for n, c in seams.items()],
        *[C.stitched_m2(f"{s}_gap", f"{s}_seam", f"{s}_center").alias(f"{s}_gap_m2") for s in sides],
    )
    stitched = {}
    for n in seams:
        if n.endswith("_min"):
            stitched[n] = F.least(n, f"seam_{n}")
        elif n.endswith("_max"):
            stitched[n] = F.greatest(n, f"seam_{n}")
        else:
            stitched[n] = F.col(n) + F.col(f"seam_{n}")
    return merged.withColumns(stitched).drop(*[f"seam_{n}" for n in seams])


def _gap_columns(label, n, span, m2, low, high, with_total=True):
    """Total, mean, deviation and extremes of one kind of gap, in microseconds."""
    zero = F.lit(0.0)
    columns = {
        f"{label} Total": F.coalesce(span.cast("double"), zero),
        f"{label} Mean": F.when(n > 0, span / n).otherwise(zero),
        f"{label} Std": F.when(n > 1, F.sqrt(m2 / n)).otherwise(zero),
        f"{label} Max": F.coalesce(high.cast("double"), zero),
        f"{label} Min": F.coalesce(low.cast("double"), zero),
    }
    if not with_total:
        del columns[f"{label} Total"]
    return columns


def _finish(measured, extra):
    names = ["n", "len", "len_sq", "len_min", "len_max", "pay", "data", "psh", "urg", "head",
             "first", "last", "gap_m2", "gap_min", "gap_max"]
    sides = {f"{side}_{n}": _pick(n, side) for side in ("fwd", "bwd") for n in names}
    f = _oriented_keys(measured).withColumns(sides)

    n = F.col("fwd_n") + F.col("bwd_n")
    zero = F.lit(0)
    duration = F.greatest((F.col("last_us") - F.col("first_us")).cast("double"), F.lit(1.0))
    seconds = duration / 1e6
    all_len = F.col("fwd_len") + F.col("bwd_len")
    all_sq = F.col("fwd_len_sq") + F.col("bwd_len_sq")
    all_var = C.variance(n, all_len, all_sq)
    low = F.coalesce(F.least("fwd_len_min", "bwd_len_min"), zero)
    high = F.coalesce(F.greatest("fwd_len_max", "bwd_len_max"), zero)

    def mean(total_name, side):
        count = F.col(f"{side}_n")
        return F.when(count > 0, F.col(f"{side}_{total_name}") / F.greatest(count, F.lit(1))).otherwise(F.lit(0.0))

    def side_lengths(label, side):
        std = C.spread(F.greatest(f"{side}_n", F.lit(1)), F.col(f"{side}_len"), F.col(f"{side}_len_sq"))
        return {
            f"{label} Packet Length Max": F.coalesce(f"{side}_len_max", zero),
            f"{label} Packet Length Min": F.coalesce(f"{side}_len_min", zero),
            f"{label} Packet Length Mean": mean("len", side),
            f"{label} Packet Length Std": F.when(F.col(f"{side}_n") > 1, std).otherwise(F.lit(0.0)),
        }

    def side_gaps(label, side, with_total=True):
        gaps = F.col(f"{side}_n") - 1
        span = F.when(gaps > 0, F.col(f"{side}_last") - F.col(f"{side}_first"))
        return _gap_columns(
            label, F.greatest(gaps, F.lit(1)), F.coalesce(span, zero),
            F.col(f"{side}_gap_m2"),
            F.col(f"{side}_gap_min"), F.col(f"{side}_gap_max"), with_total,
        )

    gaps = n - 1
    flow_gaps = _gap_columns(
        "Flow IAT", F.greatest(gaps, F.lit(1)), F.col("last_us") - F.col("first_us"),
        F.col("all_gap_m2"), F.col("all_gap_min"), F.col("all_gap_max"), False,
    )
    out = {
        "Flow Duration": duration,
        "Total Fwd Packets": F.col("fwd_n"),
        "Total Backward Packets": F.col("bwd_n"),
        "Total Length of Fwd Packets": F.col("fwd_len"),
        "Total Length of Bwd Packets": F.col("bwd_len"),
        **side_lengths("Fwd", "fwd"),
        **side_lengths("Bwd", "bwd"),
        "Flow Bytes/s": all_len / seconds,
        "Flow Packets/s": n / seconds,
        **flow_gaps,
        **side_gaps("Fwd IAT", "fwd"),
        **side_gaps("Bwd IAT", "bwd"),
        "Fwd PSH Flags": F.col("fwd_psh"),
        "Bwd PSH Flags": F.col("bwd_psh"),
        "Fwd URG Flags": F.col("fwd_urg"),
        "Bwd URG Flags": F.col("bwd_urg"),
        **{f"{x} Flag Count": F.col(x.lower()) for x in ("FIN", "SYN", "RST", "ACK", "PSH", "URG")},
        "CWE Flag Count": zero,
        "ECE Flag Count": zero,
        "Fwd Packets/s": F.col("fwd_n") / seconds,
        "Bwd Packets/s": F.col("bwd_n") / seconds,
        "Min Packet Length": low,
        "Max Packet Length": high,
        "Packet Length Mean": all_len / n,
        "Packet Length Std": F.sqrt(all_var),
        "Packet Length Variance": all_var,
        "Down/Up Ratio": F.col("bwd_len") / F.greatest("fwd_len", F.lit(1)),
        "Average Packet Size": all_len / n,
        "Avg Fwd Segment Size": mean("pay", "fwd"),
        "Avg Bwd Segment Size": mean("pay", "bwd"),
        "Fwd Header Length": F.col("fwd_n") * HEADER_BYTES,
        "Bwd Header Length": F.col("bwd_n") * HEADER_BYTES,
        "Fwd Header Length.1": zero,
        "min_seg_size_forward": zero,
        "Subflow Fwd Packets": F.col("fwd_n"),
        "Subflow Fwd Bytes": F.col("fwd_len"),
        "Subflow Bwd Packets": F.col("bwd_n"),
        "Subflow Bwd Bytes": F.col("bwd_len"),
        "Init_Win_bytes_forward": F.coalesce("fwd_head", zero),
        "Init_Win_bytes_backward": F.coalesce("bwd_head", zero),
        **side_gaps("Active", "fwd", with_total=False),
        **side_gaps("Idle", "bwd", with_total=False),
        "upload_download_ratio": F.col("fwd_len") / F.greatest("bwd_len", F.lit(1)),
        "burst_count": F.col("bursts"),
        "burst_ratio": F.col("bursts") / F.greatest(gaps, F.lit(1)),
        "unusual_port_ratio": F.lit(0.0),
        "requests_per_second": n / seconds,
        "inter_request_time_std": flow_gaps["Flow IAT Std"],
        "act_data_pkt_fwd": F.col("fwd_data"),
        "Flow Key": F.concat(
            F.col("src_ip"), F.lit(":"), F.col("src_port").cast("string"), F.lit("→"),
            F.col("dst_ip"), F.lit(":"), F.col("dst_port").cast("string"),
        ),
        "n_packets": n,
        "src_port": F.col("src_port"),
        "dst_port": F.col("dst_port"),
        "Destination Port": F.col("dst_port"),
    }
    kept = f.filter(n >= MIN_PACKETS)
    return kept.select(*extra, *[c.alias(name) for name, c in out.items()])


def flow_features(packets, within=None):
    """Features of every TCP flow with at least two packets.

    `within` names columns that keep flows apart (such as the capture file and
    its label); they are carried to the result.
    """
    within = list(within or [])
    keys = [*within, *KEYS]
    tcp = with_endpoints(packets.filter(F.col("protocol") == "TCP"))
    return _finish(_measure(tcp, keys), within)


def window_features_of_flows(flows):
    """Flow rows under the names of window features; what a flow cannot tell is 0."""
    def col(name):
        if name not in flows.columns:
            return F.lit(0.0)
        return C.numeric_or_zero(F.col(f"`{name}`").cast("string"))

    fwd, bwd = col("Total Length of Fwd Packets"), col("Total Length of Bwd Packets")
    seconds = col("Flow Duration") / 1e6
    out = {
        "request_count": (col("Total Fwd Packets") + col("Total Backward Packets")).cast("bigint"),
        "total_fwd_bytes": fwd.cast("bigint"),
        "total_bwd_bytes": bwd.cast("bigint"),
        "total_bytes": (fwd + bwd).cast("bigint"),
        "upload_download_ratio": fwd / F.greatest(bwd, F.lit(1.0)),
        "burst_count": F.lit(0),
        "burst_ratio": F.lit(0.0),
        "unusual_port_ratio": F.lit(0.0),
        "request_rate": col("Flow Packets/s"),
        "inter_request_time_mean": col("Flow IAT Mean") / 1e6,
        "inter_request_time_std": col("Flow IAT Std") / 1e6,
        "inter_request_time_min": col("Flow IAT Min") / 1e6,
        "inter_request_time_max": col("Flow IAT Max") / 1e6,
        "window_duration": seconds,
        "mean_payload_size": col("Average Packet Size"),
        "std_payload_size": col("Packet Length Std"),
        "max_payload_size": col("Max Packet Length"),
        "mean_packet_size": col("Average Packet Size"),
        "std_packet_size": col("Packet Length Std"),
        **{f"{x.lower()}_flag_count": col(f"{x} Flag Count").cast("bigint")
           for x in ("PSH", "ACK", "SYN", "FIN", "RST")},
        "unique_destinations": F.lit(1),
        "is_long_session": (seconds > fixed.LONG_SESSION_SECONDS).cast("int"),
    }
    return flows.withColumns({k: v for k, v in out.items()}).drop(
        *[c for c in flows.columns if c in fixed.FLOW_FEATURES]
    )
