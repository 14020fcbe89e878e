"""Rule score, severity and the fusion of the three detectors into alerts."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed

DETECTOR_COLUMNS = {
    "model_score": "double",
    "prediction": "int",
    "online_score": "double",
    "online_prediction": "int",
    "baseline_count": "bigint",
}


def rule_score(windows, limits=None):
    """Weighted sum of four signals, at most 1. The upload signal needs both a high
    ratio and enough bytes; regular timing only counts with enough packets."""
    lim = {**fixed.RULE_LIMITS, **(limits or {})}
    ratio = F.coalesce("upload_download_ratio", F.lit(0.0))
    uploads = (ratio > lim["upload_ratio"]) & (
        F.coalesce("total_bytes", F.lit(0)) > lim["total_bytes"]
    )
    bursts = F.coalesce("burst_count", F.lit(0)) > lim["burst_count"]
    ports = F.coalesce("unusual_port_ratio", F.lit(0.0)) > lim["unusual_port"]
    regular = (F.coalesce("inter_request_time_std", F.lit(1.0)) < lim["iat_std"]) & (
        F.coalesce("request_count", F.lit(0)) >= lim["min_requests"]
    )
    signals = {"upload_ratio": uploads, "burst_count": bursts, "unusual_port": ports, "iat_std": regular}
    parts = [F.when(s, F.lit(fixed.RULE_WEIGHTS[k])).otherwise(F.lit(0.0)) for k, s in signals.items()]
    score = F.least(F.round(C.total(parts), 6), F.lit(1.0))
    return windows.withColumn("rule_score", score).withColumn("severity", C.severity(score))


def severity_counts(scored):
    return scored.groupBy("severity").agg(F.count(F.lit(1)).alias("windows"))


def flow_proxy_score(flows, fwd="fwd_bytes", bwd="bwd_bytes", psh="psh_count",
                     fwd_n="fwd_packets", bwd_n="bwd_packets", duration="duration_us"):
    """The rule on flow columns: ratio > 2, pushed share > 0.3, shorter than 10 min."""
    ratio = C.clip(C.finite(F.col(fwd) / C.zero_to_one(F.col(bwd).cast("double"))), 0.0, 100.0)
    packets = C.zero_to_one((F.col(fwd_n) + F.col(bwd_n)).cast("double"))
    pushed = C.clip(F.col(psh) / packets, 0.0, 1.0)
    short = C.clip(F.col(duration).cast("double"), 0.0, 1e12) < fixed.HEURISTIC_DURATION_US
    score = (
        F.when(ratio > 2.0, F.lit(0.30)).otherwise(F.lit(0.0))
        + F.when(pushed > fixed.HEURISTIC_PSH, F.lit(0.25)).otherwise(F.lit(0.0))
        + F.when(short, F.lit(0.25)).otherwise(F.lit(0.0))
    )
    return flows.withColumn("proxy_score", F.round(F.least(score, F.lit(1.0)), 6))


def fuse(scored, threshold=fixed.RULE_ALERT_THRESHOLD):
    """Triggers, alert flag and final severity of every window.

    Detectors that did not run have no columns or nulls and raise no trigger.
    Without a rule trigger, a model or baseline trigger sets MEDIUM.
    """
    frame = scored
    for name, kind in DETECTOR_COLUMNS.items():
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit(None).cast(kind))
    by_rule = F.col("rule_score") > threshold
    by_model = F.coalesce(F.col("prediction") == 1, F.lit(False))
    by_baseline = F.coalesce(F.col("online_prediction") == 1, F.lit(False))
    named = F.array(
        F.when(by_rule, F.lit("BURST_RULE")),
        F.when(by_model, F.lit("OFFLINE_MODEL")),
        F.when(by_baseline, F.lit("ONLINE_UNKNOWN_ANOMALY")),
    )
    overridden = ~by_rule & (by_model | by_baseline)
    return (
        frame.withColumn("triggers", F.array_compact(named))
        .withColumn("alert", F.size("triggers") > 0)
        .withColumn("severity", F.when(overridden, F.lit("MEDIUM")).otherwise(F.col("severity")))
    )


def alert_summary(fused):
    """Windows checked, windows flagged and flagged windows by severity."""
    flagged = F.col("alert")
    counts = {
        f"{name.lower()}_alerts": F.count_if(flagged & (F.col("severity") == name))
        for name, _ in fixed.SEVERITY_FLOORS
    }
    return fused.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(flagged).alias("flagged"),
        *[c.alias(n) for n, c in counts.items()],
    )


def summary_line(summary):
    """The summary as one sentence."""
    text = F.format_string(
        "Summary: %d/%d windows flagged (CRITICAL=%d HIGH=%d MEDIUM=%d LOW=%d)",
        "flagged", "checked", "critical_alerts", "high_alerts", "medium_alerts", "low_alerts",
    )
    return summary.select(
        F.when(F.col("checked") == 0, F.lit("No windows processed yet.")).otherwise(text).alias("summary")
    )


def _percent(c):
    return F.concat(C.fixed_text(c * 100, 1), F.lit("%"))


def _verdict(flag, yes):
    return F.when(F.col(flag) == 1, F.lit(yes)).otherwise(F.lit("NORMAL"))


def _reasons(fused, most, indent):
    if "reason_codes" not in fused.columns:
        return F.lit(None).cast("string")
    lines = F.transform(F.slice("reason_codes", 1, most), lambda r: F.concat(F.lit(indent), r))
    shown = F.col("online_score").isNotNull() & (F.size(lines) > 0)
    return F.when(shown, F.array_join(lines, "\n"))


def alert_text(fused, stamp=None):
    """Multi-line text of each alert; lines of detectors that did not run are left out.

    `stamp` holds the alert time in epoch seconds, the window end unless given.
    """
    stamp = stamp if stamp is not None else F.col("window_end")
    rule = "━" * 24
    trigger_lines = F.array_join(
        F.transform(
            "triggers",
            lambda t: F.concat(
                F.lit("  ["), t, F.lit("] "),
                F.element_at(F.create_map(*[F.lit(x) for kv in fixed.TRIGGER_LABELS.items() for x in kv]), t),
            ),
        ),
        "\n",
    )
    bytes_line = F.concat(
        F.lit("  Total bytes:   "), C.grouped_text(F.col("total_bytes")),
        F.lit("  (↑"), C.grouped_text(F.col("total_fwd_bytes")),
        F.lit(" / ↓"), C.grouped_text(F.col("total_bwd_bytes")), F.lit(")"),
    )
    lines = [
        F.lit("━━━ EXFILTRATION ALERT ━━━"),
        F.concat(F.lit("["), F.col("severity"), F.lit("]  "), C.utc_text(stamp, "yyyy-MM-dd HH:mm:ss")),
        F.concat(F.lit("  Source IP:     "), F.col("src_ip")),
        F.concat(F.lit("  Window start:  "), C.fixed_text(F.col("window_start"), 0),
                 F.lit("  ("), C.utc_text(F.col("window_start"), "HH:mm:ss"), F.lit("  UTC)")),
        F.concat(F.lit("  Requests:      "), F.col("request_count").cast("string")),
        bytes_line,
        F.concat(F.lit("  Upload ratio:  "), C.fixed_text(F.col("upload_download_ratio"), 2), F.lit("x")),
        F.concat(F.lit("  Burst count:   "), F.col("burst_count").cast("string"),
                 F.lit("  (ratio: "), C.fixed_text(F.col("burst_ratio"), 2), F.lit(")")),
        F.concat(F.lit("  Unusual ports: "), _percent(F.col("unusual_port_ratio"))),
        F.concat(F.lit("  Destinations: "), F.col("unique_destinations").cast("string")),
        F.concat(F.lit("  Session len:  "), C.fixed_text(F.col("window_duration"), 1), F.lit("s")),
        F.when(F.size("triggers") > 0, F.concat(F.lit("  ── Triggers ──\n"), trigger_lines)),
        F.lit("  ── Scores ──"),
        F.concat(F.lit("  Burst score:   "), C.fixed_text(F.col("rule_score"), 3)),
        F.concat(F.lit("  Model score:   "), C.fixed_text(F.col("model_score"), 3)),
        F.when(F.col("prediction").isNotNull(),
               F.concat(F.lit("  Prediction:    "), _verdict("prediction", "EXFILTRATION"))),
        F.concat(F.lit("  Online score:  "), C.fixed_text(F.col("online_score"), 3),
                 F.lit("  ("), _verdict("online_prediction", "ANOMALY"), F.lit(")")),
        F.when(F.col("online_score").isNotNull(),
               F.concat(F.lit("  Baseline n:   "), F.col("baseline_count").cast("string"))),
        _reasons(fused, 5, "    "),
        F.lit(rule),
    ]
    return fused.filter("alert").select(
        "src_ip", "window_start", F.concat_ws("\n", *lines).alias("alert_text")
    )


def compact_text(fused, stamp=None):
    """Short metadata-only message of each alert, with at most three reasons."""
    stamp = stamp if stamp is not None else F.col("window_end")
    lines = [
        F.lit("EXFILTRATION ALERT"),
        F.concat(F.lit("Severity: "), F.col("severity")),
        F.concat(F.lit("Time: "), C.utc_text(stamp, "yyyy-MM-dd HH:mm:ss")),
        F.concat(F.lit("Source IP: "), F.col("src_ip")),
        F.concat(F.lit("Requests: "), F.col("request_count").cast("string")),
        F.concat(F.lit("Bytes: "), C.grouped_text(F.col("total_bytes")),
                 F.lit(" (up "), C.grouped_text(F.col("total_fwd_bytes")),
                 F.lit(" / down "), C.grouped_text(F.col("total_bwd_bytes")), F.lit(")")),
        F.concat(F.lit("Upload ratio: "), C.fixed_text(F.col("upload_download_ratio"), 2), F.lit("x")),
        F.concat(F.lit("Burst count: "), F.col("burst_count").cast("string")),
        F.concat(F.lit("Burst score: "), C.fixed_text(F.col("rule_score"), 3)),
        F.concat(F.lit("Model score: "), C.fixed_text(F.col("model_score"), 3)),
        F.when(F.col("prediction").isNotNull(),
               F.concat(F.lit("Prediction: "), _verdict("prediction", "EXFILTRATION"))),
        F.concat(F.lit("Online score: "), C.fixed_text(F.col("online_score"), 3),
                 F.lit(" ("), _verdict("online_prediction", "ANOMALY"), F.lit(")")),
        _reasons(fused, 3, "  "),
        F.lit("Payload content was not included."),
    ]
    return fused.filter("alert").select(
        "src_ip", "window_start", F.concat_ws("\n", *lines).alias("message")
    )


def info_line(fused, stamp=None):
    """One line for each window that raised no alert."""
    stamp = stamp if stamp is not None else F.col("window_end")
    line = F.concat(
        F.lit("[INFO] "), C.utc_text(stamp, "yyyy-MM-dd HH:mm:ss"),
        F.lit("  IP="), F.col("src_ip"),
        F.lit("  req="), F.col("request_count").cast("string"),
        F.lit("  bytes="), C.grouped_text(F.col("total_bytes")),
        F.lit("  ratio="), C.fixed_text(F.col("upload_download_ratio"), 2),
        F.lit("  score="), C.fixed_text(F.col("rule_score"), 3),
    )
    return fused.filter(~F.col("alert")).select("src_ip", "window_start", line.alias("info"))


def both_agree(frame, first, second):
    """Flag only what both detectors flag."""
    return frame.withColumn("agreed", ((F.col(first) == 1) & (F.col(second) == 1)).cast("int"))


def detection_latency(attack_packets, fused):
    """Seconds from a source's first attack packet to the end of the first alerted
    window that ends after it."""
    starts = attack_packets.groupBy("src_ip").agg(F.min("ts_us").alias("attack_us"))
    alerts = fused.filter("alert").select("src_ip", "window_end")
    return (
        starts.join(alerts, "src_ip")
        .filter(F.col("window_end") * 1e6 > F.col("attack_us"))
        .groupBy("src_ip")
        .agg(
            (F.min("attack_us") / 1e6).alias("attack_start"),
            F.min("window_end").alias("alert_time"),
            (F.min("window_end") - F.min("attack_us") / 1e6).alias("latency_seconds"),
        )
    )
