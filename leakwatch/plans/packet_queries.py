"""Queries over packets and their windows."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import baseline, models, rules, windows
from leakwatch.plans.registry import query, rounded, sql
from leakwatch.sources import packets as P
from leakwatch.sources import views
from leakwatch.sources.uploads import upload_metadata


def raw(spark, sf):
    return views.load(spark, sf, "raw_packets")


def parsed_raw(spark, sf):
    return P.parse_packets(raw(spark, sf))


def packets(spark, sf):
    return P.parse_packets(views.load(spark, sf, "packets"))


RAW = views.duck("raw_packets")
PARSED_RAW = """parsed AS (
  SELECT *, CASE proto WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' END AS protocol
  FROM raw_packets WHERE proto IN (6, 17))"""
DECODED = """directed AS (
  SELECT *, (flags & 1) <> 0 AS fin, (flags & 2) <> 0 AS syn, (flags & 4) <> 0 AS rst,
         (flags & 8) <> 0 AS psh, (flags & 16) <> 0 AS ack,
         CASE WHEN (flags & 2) <> 0 THEN (flags & 16) = 0
              WHEN (flags & 5) <> 0 THEN true
              WHEN src_port > 49152 THEN true
              WHEN dst_port > 49152 THEN false
              ELSE true END AS is_fwd,
         ts_us - ts_us % 60000000 AS bucket
  FROM packets)"""
GAPPED = """gapped AS (
  SELECT *, lead(ts_us) OVER (PARTITION BY src_ip, bucket ORDER BY ts_us, packet_id) - ts_us AS gap
  FROM directed)"""
WINDOWS = """wf AS (
  SELECT src_ip, bucket, bucket / 1e6 AS window_start, bucket / 1e6 + 60 AS window_end,
    min(ts_us) / 1e6 AS first_packet,
    count(*) AS request_count,
    CAST(coalesce(sum(payload_len) FILTER (is_fwd), 0) AS BIGINT) AS total_fwd_bytes,
    CAST(coalesce(sum(payload_len) FILTER (NOT is_fwd), 0) AS BIGINT) AS total_bwd_bytes,
    CAST(sum(payload_len) AS BIGINT) AS total_bytes,
    coalesce(sum(payload_len) FILTER (is_fwd), 0) / greatest(coalesce(sum(payload_len) FILTER (NOT is_fwd), 0), 1)
      AS upload_download_ratio,
    count(*) FILTER (is_fwd AND gap < 100000) AS burst_count,
    count(*) FILTER (is_fwd AND gap < 100000) AS fwd_burst_count,
    count(*) FILTER (is_fwd AND gap < 100000) / greatest(count(gap) FILTER (is_fwd), 1) AS burst_ratio,
    count(*) FILTER (src_port > 0 AND src_port NOT IN
      (80, 443, 8080, 8443, 53, 22, 21, 25, 110, 143, 993, 995, 587, 465)) / count(*) AS unusual_port_ratio,
    count(*) / greatest((max(ts_us) - min(ts_us)) / 1e6, 0.001) AS request_rate,
    coalesce(avg(gap), 0) / 1e6 AS inter_request_time_mean,
    coalesce(stddev_pop(gap), 0) / 1e6 AS inter_request_time_std,
    coalesce(min(gap), 0) / 1e6 AS inter_request_time_min,
    coalesce(max(gap), 0) / 1e6 AS inter_request_time_max,
    (max(ts_us) - bucket) / 1e6 AS window_duration,
    avg(payload_len) AS mean_payload_size,
    stddev_pop(payload_len) AS std_payload_size,
    CAST(max(payload_len) AS DOUBLE) AS max_payload_size,
    avg(pkt_len) AS mean_packet_size,
    stddev_pop(pkt_len) AS std_packet_size,
    count(*) FILTER (psh) AS psh_flag_count,
    count(*) FILTER (ack) AS ack_flag_count,
    count(*) FILTER (syn) AS syn_flag_count,
    count(*) FILTER (fin) AS fin_flag_count,
    count(*) FILTER (rst) AS rst_flag_count,
    count(DISTINCT dst_ip) AS unique_destinations,
    CASE WHEN (max(ts_us) - bucket) / 1e6 > 300 THEN 1 ELSE 0 END AS is_long_session
  FROM gapped GROUP BY src_ip, bucket HAVING count(*) >= 3)"""
WF = [views.duck("packets"), DECODED, GAPPED, WINDOWS]

DOUBLES = {
    "upload_download_ratio", "burst_ratio", "unusual_port_ratio", "request_rate",
    "inter_request_time_mean", "inter_request_time_std", "inter_request_time_min",
    "inter_request_time_max", "window_duration", "mean_payload_size", "std_payload_size",
    "max_payload_size", "mean_packet_size", "std_packet_size",
}


def _columns(names):
    return ", ".join(f"round({n}, 6) AS {n}" if n in DOUBLES else n for n in names)


def window_check(*names):
    return sql(*WF, f"SELECT src_ip, window_start, {_columns(names)} FROM wf")


def window_columns(spark, sf, *names, ordered=False):
    rows = windows.window_features(packets(spark, sf), ordered=ordered, destinations="unique_destinations" in names)
    return rounded(rows.select("src_ip", "window_start", *names))


# --- packets -----------------------------------------------------------------------


@query("packet_scan", sql(RAW, """
SELECT proto, count(*) AS packets, CAST(sum(pkt_len) AS BIGINT) AS bytes, min(ts_us) AS first_us, max(ts_us) AS last_us
FROM raw_packets GROUP BY proto"""))
def packet_scan(spark, sf):
    return raw(spark, sf).groupBy("proto").agg(
        F.count(F.lit(1)).alias("packets"),
        F.sum("pkt_len").alias("bytes"),
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
    )


@query("packet_parse_projection", sql(RAW, PARSED_RAW, """
SELECT packet_id, ts_us, src_ip, dst_ip, src_port, dst_port, payload_len, pkt_len, protocol,
       CASE WHEN protocol = 'UDP' THEN 'UDP' ELSE CAST(flags AS VARCHAR) END AS flags
FROM parsed"""))
def packet_parse_projection(spark, sf):
    return parsed_raw(spark, sf).drop("tcp_flags")


@query("tcp_flag_decode", sql(RAW, PARSED_RAW, """
SELECT packet_id, coalesce((flags & 1) <> 0, false) AS fin, coalesce((flags & 2) <> 0, false) AS syn,
       coalesce((flags & 4) <> 0, false) AS rst, coalesce((flags & 8) <> 0, false) AS psh,
       coalesce((flags & 16) <> 0, false) AS ack, coalesce((flags & 32) <> 0, false) AS urg
FROM parsed"""))
def tcp_flag_decode(spark, sf):
    flags = [F.col(f"tcp_flags.{n}").alias(n.lower()) for n in fixed.TCP_FLAG_BITS]
    return parsed_raw(spark, sf).select("packet_id", *flags)


@query("protocol_names", sql(RAW, """
SELECT CASE proto WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' ELSE 'proto-' || proto END AS protocol, count(*) AS packets
FROM raw_packets GROUP BY 1"""))
def protocol_names(spark, sf):
    named = raw(spark, sf).select(P.protocol_name(F.col("proto")).alias("protocol"))
    return named.groupBy("protocol").agg(F.count(F.lit(1)).alias("packets"))


@query("http_port_filter", sql(RAW, PARSED_RAW, """
SELECT packet_id, src_port, dst_port FROM parsed
WHERE src_port IN (443, 80) OR dst_port IN (443, 80)"""))
def http_port_filter(spark, sf):
    return P.http_only(parsed_raw(spark, sf), [443, 80]).select("packet_id", "src_port", "dst_port")


@query("live_capture_filter", sql(RAW, PARSED_RAW, """
SELECT packet_id, src_ip, dst_ip FROM parsed
WHERE protocol = 'TCP' AND (src_port IN (80, 443, 8000, 8080, 8443) OR dst_port IN (80, 443, 8000, 8080, 8443))
  AND (src_ip = '203.0.113.2' OR dst_ip = '203.0.113.2')"""))
def live_capture_filter(spark, sf):
    return P.live_filter(parsed_raw(spark, sf), "203.0.113.2").select("packet_id", "src_ip", "dst_ip")


@query("host_filter", sql(RAW, PARSED_RAW, """
SELECT packet_id, src_ip, dst_ip FROM parsed WHERE src_ip = '203.0.113.1' OR dst_ip = '203.0.113.1'"""))
def host_filter(spark, sf):
    return P.host_only(parsed_raw(spark, sf), "203.0.113.1").select("packet_id", "src_ip", "dst_ip")


@query("packet_direction", sql(views.duck("packets"), DECODED, """
SELECT packet_id, CASE WHEN is_fwd THEN 'fwd' ELSE 'bwd' END AS direction FROM directed"""))
def packet_direction(spark, sf):
    return packets(spark, sf).select("packet_id", C.direction().alias("direction"))


@query("packet_summary", sql(RAW, PARSED_RAW, """
SELECT packet_id, printf('%.3f', ts_us / 1e6) || '  ' || src_ip || ':' || src_port || ' → ' || dst_ip || ':' || dst_port
  || '  [' || protocol || ']  len=' || pkt_len || '  payload=' || payload_len AS summary
FROM parsed"""))
def packet_summary(spark, sf):
    return P.packet_line(parsed_raw(spark, sf))


@query("capture_counters", sql(RAW, PARSED_RAW, """
SELECT (SELECT count(*) FROM raw_packets) AS packets_seen,
       count(*) FILTER (web) AS packets_queued,
       count(*) FILTER (NOT web) AS packets_skipped,
       (SELECT count(*) FROM raw_packets WHERE proto NOT IN (6, 17)) AS parse_errors,
       (SELECT round(count(*) / ((max(ts_us) - min(ts_us)) / 1e6), 6) FROM raw_packets) AS packets_per_second
FROM (SELECT src_port IN (80, 443, 8000, 8080, 8443) OR dst_port IN (80, 443, 8000, 8080, 8443) AS web FROM parsed) t"""))
def capture_counters(spark, sf):
    return rounded(P.capture_counters(raw(spark, sf)))


@query("upload_request_meta", sql(views.duck("uploads"), """
SELECT request_id, client_ip, client_port, content_length, substr(sha256(body), 1, 16) AS content_sha,
       coalesce(session_id, 'N/A') AS session_id, coalesce(mode, 'N/A') AS mode,
       coalesce(chunk_id, seq, 'N/A') AS chunk_id
FROM uploads WHERE content_length <= 10485760"""))
def upload_request_meta(spark, sf):
    return upload_metadata(views.load(spark, sf, "uploads"))


# --- windows -----------------------------------------------------------------------


@query("tumbling_packet_counts", sql(views.duck("packets"), """
SELECT src_ip, (ts_us // 10000000) * 10 + 0e0 AS window_start, count(*) AS packets, CAST(sum(pkt_len) AS BIGINT) AS bytes
FROM packets GROUP BY src_ip, ts_us // 10000000"""))
def tumbling_packet_counts(spark, sf):
    return windows.packet_counts(packets(spark, sf), fixed.TRAINING_WINDOW_SECONDS)


@query("window_min_packets", sql(views.duck("packets"), """
SELECT src_ip, (ts_us // 1000000) * 1 + 0e0 AS window_start, count(*) AS request_count
FROM packets GROUP BY src_ip, ts_us // 1000000 HAVING count(*) >= 3"""))
def window_min_packets(spark, sf):
    rows = windows.window_features(packets(spark, sf), seconds=1, ordered=False)
    return rows.select("src_ip", "window_start", "request_count")


@query("window_first_packet_start", sql(*WF, """
SELECT src_ip, first_packet AS window_start, window_end,
       round(bucket / 1e6 + window_duration - first_packet, 6) AS window_duration FROM wf"""))
def window_first_packet_start(spark, sf):
    rows = windows.window_features(packets(spark, sf), start="first_packet", ordered=False)
    return rounded(rows.select("src_ip", "window_start", "window_end", "window_duration"))


BYTES = ("request_count", "total_fwd_bytes", "total_bwd_bytes", "total_bytes")
GAPS = ("inter_request_time_mean", "inter_request_time_std", "inter_request_time_min", "inter_request_time_max")
SIZES = ("mean_payload_size", "std_payload_size", "max_payload_size", "mean_packet_size", "std_packet_size")
FLAGS = ("psh_flag_count", "ack_flag_count", "syn_flag_count", "fin_flag_count", "rst_flag_count")
BURSTS = ("burst_count", "fwd_burst_count", "burst_ratio")
TIMES = ("request_rate", "window_duration", "is_long_session")


@query("window_bytes_by_direction", window_check(*BYTES))
def window_bytes_by_direction(spark, sf):
    return window_columns(spark, sf, *BYTES)


@query("upload_ratio", window_check("upload_download_ratio"))
def upload_ratio(spark, sf):
    return window_columns(spark, sf, "upload_download_ratio")


@query("iat_stats", window_check(*GAPS))
def iat_stats(spark, sf):
    return window_columns(spark, sf, *GAPS, ordered=True)


@query("burst_stats", window_check(*BURSTS))
def burst_stats(spark, sf):
    return window_columns(spark, sf, *BURSTS, ordered=True)


@query("unusual_port_ratio", window_check("unusual_port_ratio"))
def unusual_port_ratio(spark, sf):
    return window_columns(spark, sf, "unusual_port_ratio")


@query("window_durations", window_check(*TIMES))
def window_durations(spark, sf):
    return window_columns(spark, sf, *TIMES)


@query("long_sessions", sql(views.duck("packets"), """
SELECT src_ip, (ts_us // 600000000) * 600 + 0e0 AS window_start,
       CASE WHEN (max(ts_us) - (ts_us // 600000000) * 600000000) / 1e6 > 300 THEN 1 ELSE 0 END AS is_long_session
FROM packets GROUP BY src_ip, ts_us // 600000000 HAVING count(*) >= 3"""))
def long_sessions(spark, sf):
    rows = windows.window_features(packets(spark, sf), seconds=600, ordered=False)
    return rows.select("src_ip", "window_start", "is_long_session")


@query("size_stats", window_check(*SIZES))
def size_stats(spark, sf):
    return window_columns(spark, sf, *SIZES)


@query("flag_counts", window_check(*FLAGS))
def flag_counts(spark, sf):
    return window_columns(spark, sf, *FLAGS)


@query("unique_destinations", window_check("unique_destinations"))
def unique_destinations(spark, sf):
    return window_columns(spark, sf, "unique_destinations")


@query("window_features", window_check("window_end", *fixed.WINDOW_FEATURES))
def window_features(spark, sf):
    return rounded(windows.window_features(packets(spark, sf)))


@query("window_counters", sql(views.duck("packets"), """
SELECT count(*) FILTER (n >= 3) AS windows_created, count(*) FILTER (n < 3) AS windows_skipped,
       CAST(sum(n) AS BIGINT) AS total_packets_processed, count(DISTINCT src_ip) AS active_sources
FROM (SELECT src_ip, count(*) AS n FROM packets GROUP BY src_ip, ts_us // 1000000) t"""))
def window_counters(spark, sf):
    return windows.window_counters(packets(spark, sf), seconds=1)


_VECTOR = " || ' ' || ".join(
    f"printf('%.3f', CAST(CAST({n} AS FLOAT) AS DOUBLE))" for n in fixed.RUNTIME_FEATURES
)


def _vector_text(vector):
    return F.array_join(F.transform(vector, lambda v: C.fixed_text(v, 3)), " ")


@query("runtime_vector", sql(*WF, f"SELECT src_ip, window_start, {_VECTOR} AS vector FROM wf"))
def runtime_vector(spark, sf):
    rows = windows.window_features(packets(spark, sf))
    vector = windows.runtime_vector(rows)
    return rows.select("src_ip", "window_start", _vector_text(vector).alias("vector"))


_COMPACT = " || ' ' || ".join(
    f"printf('%.3f', CAST(CAST({n} AS FLOAT) AS DOUBLE))" for n in fixed.COMPACT_FEATURES
)


@query("compact_vector", sql(*WF, f"SELECT src_ip, window_start, {_COMPACT} AS vector FROM wf"))
def compact_vector(spark, sf):
    rows = windows.window_features(packets(spark, sf))
    vector = windows.runtime_vector(rows, fixed.COMPACT_FEATURES)
    return rows.select("src_ip", "window_start", _vector_text(vector).alias("vector"))


# --- rules and alerts -----------------------------------------------------------------

SCORED = """scored AS (
  SELECT *, CASE WHEN rule_score >= 0.85 THEN 'CRITICAL' WHEN rule_score >= 0.70 THEN 'HIGH'
                 WHEN rule_score >= 0.50 THEN 'MEDIUM' WHEN rule_score >= 0.30 THEN 'LOW' ELSE 'INFO' END AS severity
  FROM (
    SELECT *, CAST((CASE WHEN upload_download_ratio > {ratio} AND total_bytes > {bytes} THEN 4 ELSE 0 END
                + CASE WHEN burst_count > {bursts} THEN 2 ELSE 0 END
                + CASE WHEN unusual_port_ratio > {ports} THEN 2 ELSE 0 END
                + CASE WHEN inter_request_time_std < 0.05 AND request_count >= 5 THEN 2 ELSE 0 END) AS DOUBLE) / 10 AS rule_score
    FROM wf) t)"""
DEFAULT_SCORED = SCORED.format(ratio=100, bytes=50000, bursts=50, ports=0.8)
LOW_LIMITS = {"upload_ratio": 2.0, "total_bytes": 1000, "burst_count": 10, "unusual_port": 0.4}
LOW_SCORED = SCORED.format(ratio=2, bytes=1000, bursts=10, ports=0.4)


def scored_windows(spark, sf, limits=None):
    return rules.rule_score(windows.window_features(packets(spark, sf)), limits)


@query("rule_score", sql(*WF, DEFAULT_SCORED, "SELECT src_ip, window_start, rule_score, severity FROM scored"))
def rule_score(spark, sf):
    return scored_windows(spark, sf).select("src_ip", "window_start", "rule_score", "severity")


@query("rule_score_low_limits", sql(*WF, LOW_SCORED, "SELECT src_ip, window_start, rule_score, severity FROM scored"))
def rule_score_low_limits(spark, sf):
    return scored_windows(spark, sf, LOW_LIMITS).select("src_ip", "window_start", "rule_score", "severity")


@query("severity_counts", sql(*WF, LOW_SCORED, "SELECT severity, count(*) AS windows FROM scored GROUP BY severity"))
def severity_counts(spark, sf):
    return rules.severity_counts(scored_windows(spark, sf, LOW_LIMITS))


_X = ", ".join(f"CAST({n} AS DOUBLE)" for n in fixed.RUNTIME_FEATURES)
_W = ", ".join(str(fixed.BASELINE_WEIGHTS[n]) for n in fixed.RUNTIME_FEATURES)
_NAMES = ", ".join(f"'{n}'" for n in fixed.RUNTIME_FEATURES)


def monitor_ctes(warmup=10, threshold=0.5):
    """The sequential baseline as a recursive query: one step per window."""
    return [
        f"""ordered AS (
  SELECT src_ip, window_start, row_number() OVER (PARTITION BY src_ip ORDER BY window_start) AS rn, [{_X}] AS x FROM wf)""",
        f"""steps AS (
  SELECT src_ip, window_start, rn, x, 1::BIGINT AS n, x AS mean, [0e0 for i in range(17)] AS m2,
         0e0 AS score, 0 AS flagged, 0::BIGINT AS n_before, x AS mean_before, [0e0 for i in range(17)] AS std,
         [0e0 for i in range(17)] AS z
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT src_ip, window_start, rn, x,
         CASE WHEN flagged = 1 THEN n ELSE n + 1 END,
         CASE WHEN flagged = 1 THEN mean ELSE [mean[i] + (x[i] - mean[i]) / (n + 1) for i in range(1, 18)] END,
         CASE WHEN flagged = 1 THEN m2 ELSE
           [m2[i] + (x[i] - mean[i]) * (x[i] - (mean[i] + (x[i] - mean[i]) / (n + 1))) for i in range(1, 18)] END,
         score, flagged, n, mean, std, z
  FROM (
    SELECT *, CASE WHEN n >= {warmup} AND score >= {threshold} THEN 1 ELSE 0 END AS flagged
    FROM (
      SELECT *, CASE WHEN n < {warmup} THEN 0e0 ELSE
                  least(list_sum([[{_W}][i] * least(z[i], 10e0) / 2 for i in range(1, 18)]) / 13.5e0, 1e0) END AS score
      FROM (
        SELECT *, [CASE WHEN n < 2 OR std[i] < 1e-8 THEN 0e0 ELSE abs(x[i] - mean[i]) / std[i] END for i in range(1, 18)] AS z
        FROM (
          SELECT o.src_ip, o.window_start, o.rn, o.x, s.n, s.mean, s.m2,
                 [sqrt(s.m2[i] / s.n) for i in range(1, 18)] AS std
          FROM steps s JOIN ordered o ON o.src_ip = s.src_ip AND o.rn = s.rn + 1
        ) a ) b ) c ) d)""",
        f"""monitored AS (
  SELECT src_ip, window_start, round(score, 4) AS online_score, flagged AS online_prediction, n AS baseline_count,
    CASE WHEN n_before < {warmup} THEN ['warmup_' || n || '/{warmup}']
    ELSE list_concat(
      list_filter([
        CASE WHEN n_before < 2 THEN [{_NAMES}][i] || '=N/A (baseline n=' || n_before || ')'
             WHEN std[i] < 1e-8 THEN [{_NAMES}][i] || '=const (std≈0)'
             WHEN z[i] > 2 THEN [{_NAMES}][i] || CASE WHEN x[i] > mean_before[i] THEN '↑' ELSE '↓' END
               || printf(' %.2f (baseline μ=%.2f σ=%.2f, z=%.1f)', x[i], mean_before[i], std[i], z[i]) END
        for i in range(1, 18)], lambda r: r IS NOT NULL),
      CASE WHEN flagged = 0 THEN ['within_baseline'] ELSE
        [printf('HIGH_Z: %s=%.1fσ', t.name, t.z) for t in
          list_sort([{{'z': z[i], 'place': -i, 'name': [{_NAMES}][i]}} for i in range(1, 18) if z[i] > 2], 'DESC')[1:3]] END)
    END AS reason_codes
  FROM steps)""",
    ]


def recursive(*ctes_and_body):
    return "WITH RECURSIVE " + sql(*ctes_and_body)[len("WITH "):]


MONITORED = [*WF, *monitor_ctes()]
MONITOR_SELECT = """SELECT src_ip, window_start, online_score, online_prediction, baseline_count,
  array_to_string(reason_codes, ' | ') AS reasons FROM monitored"""


def monitor_output(frame):
    return frame.select(
        "src_ip", "window_start", "online_score", "online_prediction", "baseline_count",
        F.array_join("reason_codes", " | ").alias("reasons"),
    )


@query("online_monitor", recursive(*MONITORED, MONITOR_SELECT))
def online_monitor(spark, sf):
    return monitor_output(baseline.monitor(windows.window_features(packets(spark, sf))))


@query("online_monitor_strict", recursive(*WF, *monitor_ctes(5, 0.7), MONITOR_SELECT))
def online_monitor_strict(spark, sf):
    rows = windows.window_features(packets(spark, sf))
    return monitor_output(baseline.monitor(rows, threshold=0.7, warmup=5))


@query("online_monitor_disabled", sql(*WF, """
SELECT src_ip, window_start, 0e0 AS online_score, 0 AS online_prediction, 0::BIGINT AS baseline_count,
       'online_monitor_disabled' AS reasons FROM wf"""))
def online_monitor_disabled(spark, sf):
    rows = windows.window_features(packets(spark, sf), ordered=False)
    return monitor_output(baseline.monitor(rows, enabled=False))


@query("monitor_stats", recursive(*MONITORED, """
SELECT count(*) AS windows_processed, CAST(sum(online_prediction) AS BIGINT) AS anomalies_detected,
       count(DISTINCT src_ip) AS baselines_created FROM monitored"""))
def monitor_stats(spark, sf):
    return baseline.monitor_stats(baseline.monitor(windows.window_features(packets(spark, sf))))


@query("monitor_source_stats", recursive(*MONITORED, """
SELECT src_ip, count(*) AS windows_processed, CAST(sum(online_prediction) AS BIGINT) AS anomalies_detected,
       max(baseline_count) AS baseline_count FROM monitored WHERE src_ip <> '10.0.0.1' GROUP BY src_ip"""))
def monitor_source_stats(spark, sf):
    kept = baseline.without_sources(windows.window_features(packets(spark, sf)), ["10.0.0.1"])
    return baseline.source_stats(baseline.monitor(kept))


# A stand-in model whose score SQL can state: the share of bursts.
FUSED = [
    *MONITORED,
    DEFAULT_SCORED,
    """fused AS (
  SELECT *, len(triggers) > 0 AS alert,
         CASE WHEN NOT by_rule AND len(triggers) > 0 THEN 'MEDIUM' ELSE rule_severity END AS severity
  FROM (
    SELECT s.* EXCLUDE (severity), s.severity AS rule_severity, m.* EXCLUDE (src_ip, window_start),
           burst_ratio AS model_score, CASE WHEN burst_ratio >= 0.8 THEN 1 ELSE 0 END AS prediction,
           rule_score > 0.7 AS by_rule,
           list_filter([CASE WHEN rule_score > 0.7 THEN 'BURST_RULE' END,
                        CASE WHEN burst_ratio >= 0.8 THEN 'OFFLINE_MODEL' END,
                        CASE WHEN online_prediction = 1 THEN 'ONLINE_UNKNOWN_ANOMALY' END], lambda t: t IS NOT NULL) AS triggers
    FROM scored s JOIN monitored m USING (src_ip, window_start)) t)""",
]


def fused(spark, sf):
    rows = baseline.monitor(scored_windows(spark, sf))
    decided = rows.withColumn("model_score", F.col("burst_ratio")).withColumn(
        "prediction", models.raw_score_prediction(F.col("model_score"), fixed.FOREST_THRESHOLD)
    )
    return rules.fuse(decided)


@query("alert_fusion", recursive(*FUSED, """
SELECT src_ip, window_start, alert, severity, array_to_string(triggers, '+') AS triggers FROM fused"""))
def alert_fusion(spark, sf):
    return fused(spark, sf).select(
        "src_ip", "window_start", "alert", "severity", F.array_join("triggers", "+").alias("triggers")
    )


@query("severity_override", recursive(*FUSED, """
SELECT src_ip, window_start,
       CASE WHEN rule_score > 0.9 THEN rule_severity
            WHEN prediction = 1 OR online_prediction = 1 THEN 'MEDIUM' ELSE rule_severity END AS severity
FROM fused"""))
def severity_override(spark, sf):
    rows = fused(spark, sf).drop("triggers", "alert")
    again = rules.fuse(rows.withColumn("severity", C.severity(F.col("rule_score"))), threshold=0.9)
    return again.select("src_ip", "window_start", "severity")


ALERT_TEXT = """
SELECT src_ip, window_start,
  '━━━ EXFILTRATION ALERT ━━━' || chr(10)
  || '[' || severity || ']  ' || strftime(make_timestamp(CAST(window_end * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') || chr(10)
  || '  Source IP:     ' || src_ip || chr(10)
  || '  Window start:  ' || printf('%.0f', window_start) || '  ('
  || strftime(make_timestamp(CAST(window_start * 1000000 AS BIGINT)), '%H:%M:%S') || '  UTC)' || chr(10)
  || '  Requests:      ' || request_count || chr(10)
  || '  Total bytes:   ' || format('{:,}', total_bytes) || '  (↑' || format('{:,}', total_fwd_bytes)
  || ' / ↓' || format('{:,}', total_bwd_bytes) || ')' || chr(10)
  || '  Upload ratio:  ' || printf('%.2f', upload_download_ratio) || 'x' || chr(10)
  || '  Burst count:   ' || burst_count || '  (ratio: ' || printf('%.2f', burst_ratio) || ')' || chr(10)
  || '  Unusual ports: ' || printf('%.1f', unusual_port_ratio * 100) || '%' || chr(10)
  || '  Destinations: ' || unique_destinations || chr(10)
  || '  Session len:  ' || printf('%.1f', window_duration) || 's' || chr(10)
  || '  ── Triggers ──' || chr(10)
  || array_to_string([CASE t WHEN 'BURST_RULE' THEN '  [BURST_RULE] Burst exfil score'
       WHEN 'OFFLINE_MODEL' THEN '  [OFFLINE_MODEL] Offline model'
       ELSE '  [ONLINE_UNKNOWN_ANOMALY] Online anomaly (unknown pattern)' END for t in triggers], chr(10)) || chr(10)
  || '  ── Scores ──' || chr(10)
  || '  Burst score:   ' || printf('%.3f', rule_score) || chr(10)
  || '  Model score:   ' || printf('%.3f', model_score) || chr(10)
  || '  Prediction:    ' || CASE WHEN prediction = 1 THEN 'EXFILTRATION' ELSE 'NORMAL' END || chr(10)
  || '  Online score:  ' || printf('%.3f', online_score) || '  ('
  || CASE WHEN online_prediction = 1 THEN 'ANOMALY' ELSE 'NORMAL' END || ')' || chr(10)
  || '  Baseline n:   ' || baseline_count || chr(10)
  || CASE WHEN len(reason_codes) > 0 THEN array_to_string(['    ' || r for r in reason_codes[1:5]], chr(10)) || chr(10) ELSE '' END
  || '━━━━━━━━━━━━━━━━━━━━━━━━' AS alert_text
FROM fused WHERE alert"""


@query("alert_text", recursive(*FUSED, ALERT_TEXT))
def alert_text(spark, sf):
    return rules.alert_text(fused(spark, sf))


@query("alert_compact_text", recursive(*FUSED, """
SELECT src_ip, window_start,
  'EXFILTRATION ALERT' || chr(10) || 'Severity: ' || severity || chr(10)
  || 'Time: ' || strftime(make_timestamp(CAST(window_end * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') || chr(10)
  || 'Source IP: ' || src_ip || chr(10) || 'Requests: ' || request_count || chr(10)
  || 'Bytes: ' || format('{:,}', total_bytes) || ' (up ' || format('{:,}', total_fwd_bytes)
  || ' / down ' || format('{:,}', total_bwd_bytes) || ')' || chr(10)
  || 'Upload ratio: ' || printf('%.2f', upload_download_ratio) || 'x' || chr(10)
  || 'Burst count: ' || burst_count || chr(10)
  || 'Burst score: ' || printf('%.3f', rule_score) || chr(10)
  || 'Model score: ' || printf('%.3f', model_score) || chr(10)
  || 'Prediction: ' || CASE WHEN prediction = 1 THEN 'EXFILTRATION' ELSE 'NORMAL' END || chr(10)
  || 'Online score: ' || printf('%.3f', online_score) || ' ('
  || CASE WHEN online_prediction = 1 THEN 'ANOMALY' ELSE 'NORMAL' END || ')' || chr(10)
  || CASE WHEN len(reason_codes) > 0 THEN array_to_string(['  ' || r for r in reason_codes[1:3]], chr(10)) || chr(10) ELSE '' END
  || 'Payload content was not included.' AS message
FROM fused WHERE alert"""))
def alert_compact_text(spark, sf):
    return rules.compact_text(fused(spark, sf))


@query("info_lines", recursive(*FUSED, """
SELECT src_ip, window_start,
  '[INFO] ' || strftime(make_timestamp(CAST(window_end * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S')
  || '  IP=' || src_ip || '  req=' || request_count || '  bytes=' || format('{:,}', total_bytes)
  || '  ratio=' || printf('%.2f', upload_download_ratio) || '  score=' || printf('%.3f', rule_score) AS info
FROM fused WHERE NOT alert"""))
def info_lines(spark, sf):
    return rules.info_line(fused(spark, sf))


SUMMARY = """summary AS (
SELECT count(*) AS checked, count(*) FILTER (alert) AS flagged,
       count(*) FILTER (alert AND severity = 'CRITICAL') AS critical_alerts,
       count(*) FILTER (alert AND severity = 'HIGH') AS high_alerts,
       count(*) FILTER (alert AND severity = 'MEDIUM') AS medium_alerts,
       count(*) FILTER (alert AND severity = 'LOW') AS low_alerts
FROM fused)"""


@query("alert_summary", recursive(*FUSED, SUMMARY, "SELECT * FROM summary"))
def alert_summary(spark, sf):
    return rules.alert_summary(fused(spark, sf))


@query("alert_summary_line", recursive(*FUSED, SUMMARY, """
SELECT printf('Summary: %d/%d windows flagged (CRITICAL=%d HIGH=%d MEDIUM=%d LOW=%d)', flagged, checked,
              critical_alerts, high_alerts, medium_alerts, low_alerts) AS summary FROM summary"""))
def alert_summary_line(spark, sf):
    return rules.summary_line(rules.alert_summary(fused(spark, sf)))


@query("ensemble_agreement", recursive(*FUSED, """
SELECT src_ip, window_start, CASE WHEN prediction = 1 AND online_prediction = 1 THEN 1 ELSE 0 END AS agreed FROM fused"""))
def ensemble_agreement(spark, sf):
    both = rules.both_agree(fused(spark, sf), "prediction", "online_prediction")
    return both.select("src_ip", "window_start", "agreed")


@query("detection_latency", recursive(*FUSED, """
SELECT a.src_ip, round(min(attack_us) / 1e6, 6) AS attack_start, min(window_end) AS alert_time,
       round(min(window_end) - min(attack_us) / 1e6, 6) AS latency_seconds
FROM (SELECT src_ip, min(ts_us) AS attack_us FROM packets WHERE attack GROUP BY src_ip) a
JOIN fused f ON f.src_ip = a.src_ip AND f.alert AND f.window_end * 1e6 > attack_us
GROUP BY a.src_ip"""))
def detection_latency(spark, sf):
    attacks = views.load(spark, sf, "packets").filter("attack")
    return rounded(rules.detection_latency(attacks, fused(spark, sf)))


# --- parts of the baseline ------------------------------------------------------------


@query("running_mean_var", sql(*WF, """
SELECT src_ip, count(*) AS n, round(avg(total_bytes), 3) AS mean,
       round(var_pop(total_bytes), 1) AS variance, round(stddev_pop(total_bytes), 3) AS std FROM wf GROUP BY src_ip"""))
def running_mean_var(spark, sf):
    rows = windows.window_features(packets(spark, sf), ordered=False)
    out = baseline.running_moments(rows, ["src_ip"], "total_bytes")
    return out.select("src_ip", "n", F.round("mean", 3).alias("mean"),
                      F.round("variance", 1).alias("variance"), F.round("std", 3).alias("std"))


@query("merge_partial_moments", sql(*WF, """
SELECT src_ip, count(*) AS n, round(avg(request_count), 6) AS mean,
       round(var_pop(request_count) * count(*), 4) AS m2 FROM wf GROUP BY src_ip"""))
def merge_partial_moments(spark, sf):
    rows = windows.window_features(packets(spark, sf), ordered=False)
    hourly = rows.withColumn("part", F.floor(F.col("window_start") / 300))
    parts = baseline.moments(hourly, ["src_ip", "part"], "request_count")
    out = baseline.merge_moments(parts, ["src_ip"])
    return out.select("src_ip", "n", F.round("mean", 6).alias("mean"), F.round("m2", 4).alias("m2"))


@query("baseline_warmup", sql(*WF, """
SELECT src_ip, window_start, CAST(row_number() OVER (PARTITION BY src_ip ORDER BY window_start) AS INT) AS position,
       row_number() OVER (PARTITION BY src_ip ORDER BY window_start) <= 10 AS warming_up FROM wf"""))
def baseline_warmup(spark, sf):
    gated = baseline.warmup_gate(windows.window_features(packets(spark, sf), ordered=False))
    return gated.select("src_ip", "window_start", "position", "warming_up")


def _z_sql(n):
    past = "(PARTITION BY src_ip ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (f"CASE WHEN count(*) OVER {past} >= 2 AND stddev_pop({n}) OVER {past} >= 1e-8 "
            f"THEN abs({n} - avg({n}) OVER {past}) / stddev_pop({n}) OVER {past} ELSE 0e0 END AS z_{n}")


EXPANDING = ("expanding AS (SELECT src_ip, window_start, "
             + ", ".join(_z_sql(n) for n in fixed.RUNTIME_FEATURES) + " FROM wf)")


def expanding(spark, sf):
    return baseline.expanding_z(windows.window_features(packets(spark, sf)))


@query("zscore_expanding", sql(*WF, EXPANDING, "SELECT src_ip, window_start, "
       + ", ".join(f"round(z_{n}, 5) AS z_{n}" for n in fixed.RUNTIME_FEATURES) + " FROM expanding"))
def zscore_expanding(spark, sf):
    z = expanding(spark, sf).select("src_ip", "window_start", *[f"z_{n}" for n in fixed.RUNTIME_FEATURES])
    return rounded(z, 5)


@query("weighted_anomaly_score", sql(*WF, EXPANDING, "SELECT src_ip, window_start, round(least(("
       + " + ".join(f"{fixed.BASELINE_WEIGHTS[n]}e0 * least(z_{n}, 10e0) / 2e0" for n in fixed.RUNTIME_FEATURES)
       + ") / 13.5e0, 1e0), 6) AS anomaly_score FROM expanding"))
def weighted_anomaly_score(spark, sf):
    scored = baseline.weighted_score(expanding(spark, sf))
    return rounded(scored.select("src_ip", "window_start", "anomaly_score"))


@query("top3_deviations", sql(*WF, EXPANDING, "SELECT src_ip, window_start, array_to_string("
       "[printf('HIGH_Z: %s=%.1fσ', t.name, t.z) for t in list_sort(list_filter(["
       + ", ".join(f"{{'z': z_{n}, 'place': -{i}, 'name': '{n}'}}" for i, n in enumerate(fixed.RUNTIME_FEATURES))
       + "], lambda c: round(c.z, 9) > 2), 'DESC')[1:3]], ', ') AS top FROM expanding"))
def top3_deviations(spark, sf):
    top = baseline.top_deviations(expanding(spark, sf))
    return top.select("src_ip", "window_start", F.array_join("top_deviations", ", ").alias("top"))


@query("baseline_profile", sql(*WF, " UNION ALL ".join(
    f"SELECT src_ip, count(*) AS n, '{n}' AS feature, round(avg({n}), 4) AS mean, round(var_pop({n}), 2) AS variance "
    "FROM wf GROUP BY src_ip" for n in fixed.RUNTIME_FEATURES)))
def baseline_profile(spark, sf):
    out = baseline.profile(windows.window_features(packets(spark, sf)))
    return out.select("src_ip", "n", "feature", F.round("mean", 4).alias("mean"),
                      F.round("variance", 2).alias("variance"))
