"""From packets to alerts, in batch."""

from leakwatch.functions import fixed
from leakwatch.operators import baseline, models, rules, windows
from leakwatch.sources import packets as packet_source


def score_windows(
    window_rows,
    model=None,
    meta=None,
    window_seconds=fixed.WINDOW_SECONDS,
    online=True,
    online_threshold=fixed.ONLINE_THRESHOLD,
    warmup=fixed.WARMUP_WINDOWS,
    rule_threshold=fixed.RULE_ALERT_THRESHOLD,
):
    """Rule, model and baseline scores of window rows, fused into alerts.

    Without a model, or with one that does not fit the rows, the other detectors
    decide alone.
    """
    frame = rules.rule_score(window_rows)
    if model is not None:
        frame = models.predict_windows(frame, model, meta, window_seconds)
    if online:
        frame = baseline.monitor(frame, online_threshold, warmup)
    return rules.fuse(frame, rule_threshold)


def detect(raw_packets, seconds=fixed.WINDOW_SECONDS, http=True, host=None, **options):
    """Parse, filter, window, score and fuse raw packets."""
    packets = packet_source.parse_packets(raw_packets)
    if http:
        packets = packet_source.http_only(packets)
    packets = packet_source.host_only(packets, host)
    rows = windows.window_features(packets, seconds)
    return score_windows(rows, window_seconds=seconds, **options)


def write_alerts(fused, path):
    """Alert rows partitioned by severity."""
    alerts = fused.filter("alert")
    alerts.write.mode("overwrite").partitionBy("severity").parquet(path)
