"""Packet, flow, score and upload views over the general test tables.

Each view is one SQL text in integer arithmetic. The text serves both engines:
only integer division and the epoch conversion are spelled differently, so the
operators and their checks start from the same rows.
"""

# Whole microseconds since 2024-01-01 without any time-zone conversion.
_SPARK_MICROS = (
    "CAST(CAST(CAST(CAST(ts AS TIMESTAMP_NTZ) - TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    " AS INTERVAL SECOND) AS DECIMAL(20, 6)) * 1000000 AS BIGINT)"
)
_DUCK_MICROS = "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00'))"

PACKETS = """
SELECT event_id AS packet_id,
       ts_us,
       concat('10.0.', CAST(s {div} 256 AS STRING), '.', CAST(s % 256 AS STRING)) AS src_ip,
       concat('203.0.113.', CAST(event_id % 5 AS STRING)) AS dst_ip,
       CAST(CASE WHEN srv THEN service ELSE 50000 + h END AS INT) AS src_port,
       CAST(CASE WHEN srv THEN 50000 + h ELSE service END AS INT) AS dst_port,
       CAST(payload AS INT) AS payload_len,
       CAST(payload + 54 AS INT) AS pkt_len,
       CAST(6 AS INT) AS proto,
       CAST(flag_byte AS INT) AS flags,
       attack,
       drip
FROM (
  SELECT *,
         CASE WHEN attack AND NOT srv THEN 20000 + 10 * h
              WHEN attack THEN 10
              WHEN srv THEN 1000 + 3 * h
              WHEN drip THEN 5000 + 10 * h
              ELSE 100 + h END AS payload,
         widx * 60000000 + (CASE WHEN attack THEN in_us {div} 100 ELSE in_us END) AS ts_us
  FROM (
    SELECT *,
           NOT attack AND widx >= 12 AND (s * 3 + widx) % 11 = 4 AS drip,
           CASE WHEN attack THEN h % 50 = 0 ELSE h % 10 < 6 END AS srv
    FROM (
      SELECT *, widx >= 12 AND (s * 5 + widx) % 7 = 0 AS attack
      FROM (
        SELECT *, off_us {div} 60000000 AS widx, off_us % 60000000 AS in_us
        FROM (
          SELECT event_id,
                 user_id {div} 30 AS s,
                 {micros} {div} 1440 AS off_us,
                 (event_id * 7919) % 1000 AS h,
                 CASE (event_id * 7919) % 1000 % 3 WHEN 0 THEN 443 WHEN 1 THEN 80 ELSE 8080 END AS service,
                 (CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
                   + (CASE WHEN event_type = 'signup' THEN 2 ELSE 16 END)
                   + (CASE WHEN event_type IN ('purchase', 'click') THEN 8 ELSE 0 END) AS flag_byte
          FROM {events}
        ) AS based
      ) AS placed
    ) AS marked
  ) AS typed
) AS sized
"""

# The same packets as a capture would deliver them: some UDP, some neither.
RAW_PACKETS = """
SELECT packet_id, ts_us, src_ip, dst_ip, src_port, dst_port, payload_len, pkt_len,
       CAST(CASE WHEN packet_id % 97 = 0 THEN 17 WHEN packet_id % 101 = 0 THEN 1 ELSE 6 END AS INT) AS proto,
       CAST(CASE WHEN packet_id % 97 = 0 THEN NULL ELSE flags END AS INT) AS flags
FROM (""" + PACKETS + """) AS packets
"""

FLOW_PACKETS = """
SELECT packet_id, ts_us,
       CASE WHEN srv THEN server ELSE client END AS src_ip,
       CASE WHEN srv THEN client ELSE server END AS dst_ip,
       CAST(CASE WHEN srv THEN 443 ELSE client_port END AS INT) AS src_port,
       CAST(CASE WHEN srv THEN client_port ELSE 443 END AS INT) AS dst_port,
       CAST(payload AS INT) AS payload_len,
       CAST(payload + 54 AS INT) AS pkt_len,
       CAST(6 AS INT) AS proto,
       CAST(flag_byte AS INT) AS flags
FROM (
  SELECT event_id AS packet_id,
         off_us AS ts_us,
         h % 10 < 6 AS srv,
         concat('10.0.', CAST(user_id {div} 250 AS STRING), '.', CAST(user_id % 250 AS STRING)) AS client,
         concat('203.0.113.', CAST(user_id % 5 AS STRING)) AS server,
         50000 + off_us {div} 600000000 AS client_port,
         CASE WHEN h % 10 < 6 THEN 1000 + 3 * h ELSE 100 + h END AS payload,
         flag_byte
  FROM (
    SELECT event_id, user_id,
           {micros} {div} 1440 AS off_us,
           (event_id * 7919) % 1000 AS h,
           (CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
             + (CASE WHEN event_type = 'signup' THEN 2 ELSE 16 END)
             + (CASE WHEN event_type IN ('purchase', 'click') THEN 8 ELSE 0 END) AS flag_byte
    FROM {events}
  ) AS based
) AS sided
"""

FLOWS = """
SELECT o_orderkey AS flow_id,
       o_orderpriority AS source_file,
       CASE WHEN h < 10 THEN 'Bot' WHEN h < 12 THEN ' Infiltration' WHEN h < 100 THEN 'DoS Hulk' ELSE 'BENIGN' END AS label,
       nz * (1 + h % 20) AS fwd_packets,
       nz * (h % 15) AS bwd_packets,
       nz * (p % 10000) AS fwd_bytes,
       nz * (CASE WHEN h % 4 = 0 THEN 0 ELSE (o_orderkey * 31) % 50000 END) AS bwd_bytes,
       nz * ((o_orderkey * 104729) % 1200000000) AS duration_us,
       nz * (h % 9) AS psh_count,
       CASE WHEN nz = 0 THEN CAST(0 AS DOUBLE)
            WHEN h % 97 = 0 THEN CAST('Infinity' AS DOUBLE)
            WHEN h % 89 = 0 THEN CAST('NaN' AS DOUBLE)
            ELSE CAST((p % 10000) + (CASE WHEN h % 4 = 0 THEN 0 ELSE (o_orderkey * 31) % 50000 END) AS DOUBLE) * 1000000
                 / greatest((o_orderkey * 104729) % 1200000000, 1) END AS flow_bytes_s,
       CASE h % 5 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 WHEN 3 THEN 22 ELSE 8080 END AS dst_port
FROM (
  SELECT o_orderkey, o_orderpriority,
         (o_orderkey * 7919) % 1000 AS h,
         CASE WHEN (o_orderkey * 7919) % 1000 % 101 = 0 THEN 0 ELSE 1 END AS nz,
         CAST(floor(o_totalprice) AS BIGINT) AS p
  FROM {orders}
) AS based
"""

SCORES = """
SELECT model, id, label, CAST(mille AS DOUBLE) / 1000 AS score, split
FROM (
  SELECT 'supervised' AS model, id, label, u * 7 {div} 10 + label * 300 AS mille, split FROM {based}
  UNION ALL
  SELECT 'supervised_old' AS model, id, label, u * 8 {div} 10 + label * 200 AS mille, split FROM {based}
  UNION ALL
  SELECT 'anomaly' AS model, id, label, v * 9 {div} 10 + label * 20 AS mille, split FROM {based}
) AS unioned
"""

_SCORE_BASE = """(
  SELECT o_orderkey AS id,
         CASE WHEN (o_orderkey * 7919) % 1000 < 30 THEN 1 ELSE 0 END AS label,
         (o_orderkey * 613) % 1000 AS u,
         (o_orderkey * 911) % 1000 AS v,
         CASE WHEN (o_orderkey * 31) % 100 < 70 THEN 'train'
              WHEN (o_orderkey * 31) % 100 < 85 THEN 'test' ELSE 'val' END AS split
  FROM {orders}
) AS based"""

UPLOADS = """
SELECT conv_id * 1000 + turn AS request_id,
       concat('10.1.', CAST(conv_id % 250 AS STRING), '.', CAST(turn % 250 AS STRING)) AS client_ip,
       CAST(50000 + turn AS INT) AS client_port,
       CAST(length(text) AS BIGINT) * (CASE WHEN turn % 9 = 0 THEN 100000 ELSE 1 END) AS content_length,
       text AS body,
       CAST(conv_id AS STRING) AS session_id,
       CASE WHEN role = 'system' THEN NULL ELSE role END AS mode,
       CASE WHEN turn % 2 = 0 THEN CAST(turn AS STRING) END AS chunk_id,
       CASE WHEN turn % 3 = 0 THEN CAST(turn AS STRING) END AS seq
FROM {conversations}
"""

_TEXTS = {
    "packets": PACKETS,
    "raw_packets": RAW_PACKETS,
    "flow_packets": FLOW_PACKETS,
    "flows": FLOWS,
    "scores": SCORES.replace("{based}", _SCORE_BASE),
    "uploads": UPLOADS,
}
_TABLES = {
    "packets": "events",
    "raw_packets": "events",
    "flow_packets": "events",
    "flows": "orders",
    "scores": "orders",
    "uploads": "conversations",
}


def load(spark, sf_dir, view):
    """A view as a DataFrame over `<sf_dir>/<table>.parquet`."""
    table = _TABLES[view]
    text = _TEXTS[view].replace("{div}", "div").replace("{micros}", _SPARK_MICROS)
    frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(text, **{table: frame})


def duck(view):
    """The same view as a common table expression for the checking engine."""
    text = _TEXTS[view].replace("{div}", "//").replace("{micros}", _DUCK_MICROS)
    text = text.replace("{" + _TABLES[view] + "}", _TABLES[view])
    return f"{view} AS ({text})"
