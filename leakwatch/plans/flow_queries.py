"""Queries over flows: assembly, labels, cleaning, preparation, statistics."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed, schemas
from leakwatch.operators import explore, flows, labels, oversample, prep, rules
from leakwatch.plans.registry import query, rounded, sql
from leakwatch.session import fresh_dir, staged
from leakwatch.sources import flows as flow_source
from leakwatch.sources import packets as P
from leakwatch.sources import views

SHORT = {
    "fwd_bytes": "fwd_bytes",
    "bwd_bytes": "bwd_bytes",
    "duration": "duration_us",
    "psh": "psh_count",
    "fwd_packets": "fwd_packets",
    "bwd_packets": "bwd_packets",
}
NUMERIC = ["fwd_packets", "bwd_packets", "fwd_bytes", "bwd_bytes", "duration_us", "psh_count", "flow_bytes_s"]
POINT = ["fwd_packets", "bwd_packets", "fwd_bytes", "psh_count"]
FLOWS = views.duck("flows")
LABELLED = """labelled AS (
  SELECT *, CASE WHEN trim(label) IN ('Bot', 'Infiltration') OR (
      least(fwd_bytes / (CASE WHEN bwd_bytes = 0 THEN 1 ELSE bwd_bytes END), 100) > 5
      AND duration_us < 600000000
      AND least(psh_count / (CASE WHEN fwd_packets + bwd_packets = 0 THEN 1 ELSE fwd_packets + bwd_packets END), 1) > 0.3
    ) THEN 1 ELSE 0 END AS exfil_label
  FROM flows)"""
CLEAN = """clean AS (
  SELECT * REPLACE (CASE WHEN isnan(flow_bytes_s) OR isinf(flow_bytes_s) THEN 0e0 ELSE flow_bytes_s END AS flow_bytes_s)
  FROM labelled)"""


def flow_rows(spark, sf):
    return views.load(spark, sf, "flows")


def labelled(spark, sf):
    return labels.assign_labels(flow_rows(spark, sf), label="label", names=SHORT)


def flow_packets(spark, sf):
    return P.parse_packets(views.load(spark, sf, "flow_packets"))


# --- loading ------------------------------------------------------------------------

CSV_NAMES = {
    "flow_id": " Flow Number",
    "duration_us": " Flow Duration",
    "fwd_packets": "Total Fwd Packets",
    "bwd_packets": " Total Backward Packets",
    "fwd_bytes": "Total Length of Fwd Packets ",
    "bwd_bytes": " Total Length of Bwd Packets",
    "psh_count": " PSH Flag Count",
    "flow_bytes_s": "Flow Bytes/s",
    "label": " Label",
}


def write_flow_files(spark, sf):
    """The flow table as untidy CSV folders, one per order priority. Returns tag -> path."""
    root = fresh_dir(spark, "flow-csv")
    rows = flow_rows(spark, sf)
    names = [F.col(k).alias(v) for k, v in CSV_NAMES.items()]
    # A later column repeats an earlier name once the blanks are trimmed.
    untidy = rows.select("source_file", *names, F.lit(-1).alias("Flow Duration"))
    untidy.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).partitionBy("source_file").csv(root)
    tags = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "plain": "4-NOT SPECIFIED", "low": "5-LOW"}
    return {**{t: f"{root}/source_file={v}" for t, v in tags.items()}, "absent": f"{root}/source_file=none"}


def loaded_flows(spark, sf):
    return flow_source.load_flows(spark, write_flow_files(spark, sf))


@query("flow_load_union", sql(FLOWS, """
SELECT CASE source_file WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
         WHEN '5-LOW' THEN 'low' ELSE 'plain' END AS source_tag,
       trim(label) AS label, count(*) AS flows, CAST(sum(duration_us) AS DOUBLE) AS duration_us,
       count(*) FILTER (isinf(flow_bytes_s)) AS infinite_rates, count(*) FILTER (isnan(flow_bytes_s)) AS missing_rates
FROM flows GROUP BY 1, 2"""))
def flow_load_union(spark, sf):
    rate = F.col("`Flow Bytes/s`")
    return loaded_flows(spark, sf).groupBy(
        F.col("_source_file").alias("source_tag"), F.trim("Label").alias("label")
    ).agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("Flow Duration").alias("duration_us"),
        F.count_if(F.abs(rate) == float("inf")).alias("infinite_rates"),
        F.count_if(F.isnan(rate)).alias("missing_rates"),
    )


@query("flow_file_labels", sql(FLOWS, LABELLED, """
SELECT exfil_label, count(*) AS flows, CAST(sum(fwd_bytes) AS DOUBLE) AS fwd_bytes FROM labelled GROUP BY exfil_label"""))
def flow_file_labels(spark, sf):
    """CSV files through loading and labelling."""
    rows = labels.assign_labels(loaded_flows(spark, sf))
    return rows.groupBy("exfil_label").agg(
        F.count(F.lit(1)).alias("flows"), F.sum("Total Length of Fwd Packets").alias("fwd_bytes")
    )


SCENARIO_SQL = """CASE packet_id % 4 WHEN 0 THEN 'baseline' WHEN 1 THEN 'burst_exfil'
  WHEN 2 THEN 'slow_exfil' ELSE 'https_exfil' END"""


def write_scenario_files(spark, sf):
    """Flow packets in one directory per scenario."""
    root = fresh_dir(spark, "scenarios")
    rows = views.load(spark, sf, "flow_packets")
    name = F.col("packet_id") % 4
    scenario = (
        F.when(name == 0, F.lit("baseline")).when(name == 1, F.lit("burst_exfil"))
        .when(name == 2, F.lit("slow_exfil")).otherwise(F.lit("https_exfil"))
    )
    rows.withColumn("scenario", scenario).write.partitionBy("scenario").parquet(root)
    return root


@query("scenario_label_from_path", sql(views.duck("flow_packets"), f"""
SELECT {SCENARIO_SQL} AS "Scenario", CASE WHEN packet_id % 4 = 0 THEN 0 ELSE 1 END AS "Label",
       count(*) AS packets, CAST(sum(pkt_len) AS BIGINT) AS bytes
FROM flow_packets GROUP BY 1, 2"""))
def scenario_label_from_path(spark, sf):
    rows = flow_source.read_scenarios(spark, write_scenario_files(spark, sf), schemas.RAW_PACKET)
    return rows.groupBy("Scenario", "Label").agg(
        F.count(F.lit(1)).alias("packets"), F.sum("pkt_len").alias("bytes")
    )


# --- flows from packets ---------------------------------------------------------------

PAIRED = """paired AS (
  SELECT *, least(src_ip || ':' || src_port, dst_ip || ':' || dst_port) || '|'
            || greatest(src_ip || ':' || src_port, dst_ip || ':' || dst_port) AS pair
  FROM {packets})"""
ORIENTED = """oriented AS (
  SELECT *, src_ip = c_ip AND src_port = c_port AS is_fwd, (flags & 1) <> 0 AS fin, (flags & 2) <> 0 AS syn,
         (flags & 8) <> 0 AS psh, (flags & 16) <> 0 AS ack
  FROM (
    SELECT *, first_value(src_ip) OVER w AS c_ip, first_value(src_port) OVER w AS c_port,
              first_value(dst_ip) OVER w AS s_ip, first_value(dst_port) OVER w AS s_port
    FROM paired WINDOW w AS (PARTITION BY pair{extra} ORDER BY ts_us, packet_id)) t)"""
FLOW_GAPS = """flow_gaps AS (
  SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY pair{extra} ORDER BY ts_us, packet_id) AS gap,
         ts_us - lag(ts_us) OVER (PARTITION BY pair{extra}, is_fwd ORDER BY ts_us, packet_id) AS side_gap
  FROM oriented)"""


def flow_ctes(packets="flow_packets", extra=""):
    return [PAIRED.replace("{packets}", packets), ORIENTED.replace("{extra}", extra),
            FLOW_GAPS.replace("{extra}", extra)]


@query("flow_assembly", sql(views.duck("flow_packets"), *flow_ctes()[:2], """
SELECT c_ip AS src_ip, c_port AS src_port, s_ip AS dst_ip, s_port AS dst_port,
       count(*) FILTER (is_fwd) AS fwd_packets, count(*) FILTER (NOT is_fwd) AS bwd_packets,
       min(ts_us) AS first_us, max(ts_us) AS last_us
FROM oriented GROUP BY pair, c_ip, c_port, s_ip, s_port"""))
def flow_assembly(spark, sf):
    return flows.assemble(flow_packets(spark, sf))


FLOW_SELECT = """
SELECT {extra} c_ip || ':' || c_port || '→' || s_ip || ':' || s_port AS "Flow Key",
  c_port AS src_port, s_port AS dst_port, s_port AS "Destination Port", count(*) AS n_packets,
  greatest(max(ts_us) - min(ts_us), 1) + 0e0 AS "Flow Duration",
  count(*) FILTER (is_fwd) AS "Total Fwd Packets", count(*) FILTER (NOT is_fwd) AS "Total Backward Packets",
  CAST(coalesce(sum(pkt_len) FILTER (is_fwd), 0) AS BIGINT) AS "Total Length of Fwd Packets",
  CAST(coalesce(sum(pkt_len) FILTER (NOT is_fwd), 0) AS BIGINT) AS "Total Length of Bwd Packets",
  {sides},
  round(sum(pkt_len) / (greatest(max(ts_us) - min(ts_us), 1) / 1e6), 3) AS "Flow Bytes/s",
  round(count(*) / (greatest(max(ts_us) - min(ts_us), 1) / 1e6), 3) AS "Flow Packets/s",
  round(coalesce(avg(gap), 0), 3) AS "Flow IAT Mean", round(coalesce(stddev_pop(gap), 0), 3) AS "Flow IAT Std",
  coalesce(max(gap), 0) + 0e0 AS "Flow IAT Max", coalesce(min(gap), 0) + 0e0 AS "Flow IAT Min",
  count(*) FILTER (is_fwd AND psh) AS "Fwd PSH Flags", count(*) FILTER (NOT is_fwd AND psh) AS "Bwd PSH Flags",
  0::BIGINT AS "Fwd URG Flags", 0::BIGINT AS "Bwd URG Flags",
  count(*) FILTER (fin) AS "FIN Flag Count", count(*) FILTER (syn) AS "SYN Flag Count", 0::BIGINT AS "RST Flag Count",
  count(*) FILTER (ack) AS "ACK Flag Count", count(*) FILTER (psh) AS "PSH Flag Count", 0::BIGINT AS "URG Flag Count",
  0 AS "CWE Flag Count", 0 AS "ECE Flag Count",
  round(count(*) FILTER (is_fwd) / (greatest(max(ts_us) - min(ts_us), 1) / 1e6), 3) AS "Fwd Packets/s",
  round(count(*) FILTER (NOT is_fwd) / (greatest(max(ts_us) - min(ts_us), 1) / 1e6), 3) AS "Bwd Packets/s",
  min(pkt_len) AS "Min Packet Length", max(pkt_len) AS "Max Packet Length",
  round(avg(pkt_len), 3) AS "Packet Length Mean", round(stddev_pop(pkt_len), 3) AS "Packet Length Std",
  round((count(*) * sum(pkt_len * pkt_len) - sum(pkt_len) * sum(pkt_len)) / (count(*) * count(*)), 5) AS "Packet Length Variance",
  round(coalesce(sum(pkt_len) FILTER (NOT is_fwd), 0) / greatest(coalesce(sum(pkt_len) FILTER (is_fwd), 0), 1), 3) AS "Down/Up Ratio",
  round(avg(pkt_len), 3) AS "Average Packet Size",
  round(coalesce(avg(payload_len) FILTER (is_fwd), 0), 3) AS "Avg Fwd Segment Size",
  round(coalesce(avg(payload_len) FILTER (NOT is_fwd), 0), 3) AS "Avg Bwd Segment Size",
  40 * count(*) FILTER (is_fwd) AS "Fwd Header Length", 40 * count(*) FILTER (NOT is_fwd) AS "Bwd Header Length",
  0 AS "Fwd Header Length.1", 0 AS min_seg_size_forward,
  count(*) FILTER (is_fwd) AS "Subflow Fwd Packets", count(*) FILTER (NOT is_fwd) AS "Subflow Bwd Packets",
  CAST(coalesce(sum(pkt_len) FILTER (is_fwd), 0) AS BIGINT) AS "Subflow Fwd Bytes",
  CAST(coalesce(sum(pkt_len) FILTER (NOT is_fwd), 0) AS BIGINT) AS "Subflow Bwd Bytes",
  coalesce(arg_min(pkt_len, ts_us * 100000000 + packet_id) FILTER (is_fwd), 0) AS "Init_Win_bytes_forward",
  coalesce(arg_min(pkt_len, ts_us * 100000000 + packet_id) FILTER (NOT is_fwd), 0) AS "Init_Win_bytes_backward",
  round(coalesce(sum(pkt_len) FILTER (is_fwd), 0) / greatest(coalesce(sum(pkt_len) FILTER (NOT is_fwd), 0), 1), 3) AS upload_download_ratio,
  count(*) FILTER (gap < 100000) AS burst_count,
  round(count(*) FILTER (gap < 100000) / (count(*) - 1), 3) AS burst_ratio,
  0e0 AS unusual_port_ratio,
  round(count(*) / (greatest(max(ts_us) - min(ts_us), 1) / 1e6), 3) AS requests_per_second,
  round(coalesce(stddev_pop(gap), 0), 3) AS inter_request_time_std,
  count(*) FILTER (is_fwd AND payload_len > 0) AS act_data_pkt_fwd
FROM flow_gaps GROUP BY {extra} pair, c_ip, c_port, s_ip, s_port HAVING count(*) >= 2"""


def _side_sql():
    cells = []
    for label, idle, cond in (("Fwd", "Active", "is_fwd"), ("Bwd", "Idle", "NOT is_fwd")):
        f = f"FILTER ({cond})"
        cells += [
            f'coalesce(max(pkt_len) {f}, 0) AS "{label} Packet Length Max"',
            f'coalesce(min(pkt_len) {f}, 0) AS "{label} Packet Length Min"',
            f'round(coalesce(avg(pkt_len) {f}, 0), 3) AS "{label} Packet Length Mean"',
            f'round(coalesce(stddev_pop(pkt_len) {f}, 0), 3) AS "{label} Packet Length Std"',
            f'coalesce(sum(side_gap) {f}, 0) + 0e0 AS "{label} IAT Total"',
        ]
        for name in (f"{label} IAT", idle):
            cells += [
                f'round(coalesce(avg(side_gap) {f}, 0), 3) AS "{name} Mean"',
                f'round(coalesce(stddev_pop(side_gap) {f}, 0), 3) AS "{name} Std"',
                f'coalesce(max(side_gap) {f}, 0) + 0e0 AS "{name} Max"',
                f'coalesce(min(side_gap) {f}, 0) + 0e0 AS "{name} Min"',
            ]
    return ", ".join(cells)


def flow_select(extra=""):
    return FLOW_SELECT.replace("{extra}", extra).replace("{sides}", _side_sql())


@query("flow_features", sql(views.duck("flow_packets"), *flow_ctes(), flow_select()))
def flow_features(spark, sf):
    out = flows.flow_features(flow_packets(spark, sf))
    spread_of = F.round("`Packet Length Variance`", 5)
    plain = rounded(out.withColumn("_variance", spread_of.cast("string")), 3)
    return plain.withColumn("Packet Length Variance", F.col("_variance").cast("double")).drop("_variance")


@query("flow_iat_by_direction", sql(views.duck("flow_packets"), *flow_ctes(), """
SELECT c_ip || ':' || c_port || '→' || s_ip || ':' || s_port AS "Flow Key",
  coalesce(sum(side_gap) FILTER (is_fwd), 0) + 0e0 AS "Fwd IAT Total", coalesce(max(side_gap) FILTER (is_fwd), 0) + 0e0 AS "Fwd IAT Max",
  coalesce(sum(side_gap) FILTER (NOT is_fwd), 0) + 0e0 AS "Bwd IAT Total", coalesce(max(side_gap) FILTER (NOT is_fwd), 0) + 0e0 AS "Bwd IAT Max"
FROM flow_gaps GROUP BY pair, c_ip, c_port, s_ip, s_port HAVING count(*) >= 2"""))
def flow_iat_by_direction(spark, sf):
    out = flows.flow_features(flow_packets(spark, sf))
    return out.select("`Flow Key`", "`Fwd IAT Total`", "`Fwd IAT Max`", "`Bwd IAT Total`", "`Bwd IAT Max`")


@query("scenario_flows", sql(views.duck("flow_packets"),
       f"named AS (SELECT *, {SCENARIO_SQL} AS scenario FROM flow_packets)",
       *flow_ctes("named", ", scenario"), """
SELECT scenario AS "Scenario", CASE WHEN scenario = 'baseline' THEN 0 ELSE 1 END AS "Label",
       count(*) AS flows, CAST(sum(n) AS BIGINT) AS packets, CAST(sum(bursts) AS BIGINT) AS burst_count
FROM (SELECT scenario, pair, count(*) AS n, count(*) FILTER (gap < 100000) AS bursts
      FROM flow_gaps GROUP BY scenario, pair HAVING count(*) >= 2) t GROUP BY scenario"""))
def scenario_flows(spark, sf):
    """Captures by scenario directory to labelled flows."""
    rows = flow_source.read_scenarios(spark, write_scenario_files(spark, sf), schemas.RAW_PACKET)
    parsed = P.parse_packets(rows)
    out = flows.flow_features(parsed, within=["Scenario", "Label"])
    return out.groupBy("Scenario", "Label").agg(
        F.count(F.lit(1)).alias("flows"), F.sum("n_packets").alias("packets"),
        F.sum("burst_count").alias("burst_count"),
    )


def csv_named(spark, sf):
    """The flow view under CSV column names, with a text column among the numbers."""
    return flow_rows(spark, sf).select(
        "flow_id",
        F.col("fwd_packets").alias("Total Fwd Packets"),
        F.col("bwd_packets").alias("Total Backward Packets"),
        F.col("fwd_bytes").alias("Total Length of Fwd Packets"),
        F.col("bwd_bytes").alias("Total Length of Bwd Packets"),
        F.col("duration_us").alias("Flow Duration"),
        F.col("psh_count").alias("PSH Flag Count"),
        F.col("flow_bytes_s").alias("Flow Packets/s"),
        F.col("label").alias("Flow IAT Mean"),
    )


@query("flow_to_window_features", sql(FLOWS, """
SELECT flow_id, fwd_packets + bwd_packets AS request_count, fwd_bytes AS total_fwd_bytes, bwd_bytes AS total_bwd_bytes,
       fwd_bytes + bwd_bytes AS total_bytes, round(fwd_bytes / greatest(bwd_bytes, 1), 6) AS upload_download_ratio,
       CASE WHEN isnan(flow_bytes_s) THEN 0e0 WHEN isinf(flow_bytes_s) THEN -1e0 ELSE round(flow_bytes_s, 6) END AS request_rate,
       0e0 AS inter_request_time_mean, round(duration_us / 1e6, 6) AS window_duration, psh_count AS psh_flag_count,
       1 AS unique_destinations, CASE WHEN duration_us / 1e6 > 300 THEN 1 ELSE 0 END AS is_long_session
FROM flows"""))
def flow_to_window_features(spark, sf):
    out = flows.window_features_of_flows(csv_named(spark, sf))
    rate = F.when(F.abs(F.col("request_rate")) == float("inf"), F.lit(-1.0)).otherwise(F.col("request_rate"))
    return rounded(out.withColumn("request_rate", rate).select(
        "flow_id", "request_count", "total_fwd_bytes", "total_bwd_bytes", "total_bytes", "upload_download_ratio",
        "request_rate", "inter_request_time_mean", "window_duration", "psh_flag_count", "unique_destinations",
        "is_long_session",
    ))


# --- cleaning and labels ------------------------------------------------------------------


@query("clean_inf_nan", sql(FLOWS, """
SELECT flow_id, CASE WHEN isnan(flow_bytes_s) OR isinf(flow_bytes_s) THEN 0e0 ELSE round(flow_bytes_s, 6) END AS flow_bytes_s
FROM flows"""))
def clean_inf_nan(spark, sf):
    return rounded(labels.clean_columns(flow_rows(spark, sf), ["flow_bytes_s"]).select("flow_id", "flow_bytes_s"))


@query("drop_zero_rows", sql(FLOWS, """
SELECT flow_id FROM flows
WHERE fwd_packets + bwd_packets + fwd_bytes + bwd_bytes + duration_us + psh_count > 0
   OR NOT (isnan(flow_bytes_s) OR isinf(flow_bytes_s) OR flow_bytes_s = 0)"""))
def drop_zero_rows(spark, sf):
    rows = labels.clean_columns(flow_rows(spark, sf), NUMERIC)
    return labels.drop_zero_rows(rows, NUMERIC).select("flow_id")


@query("clean_features", sql(FLOWS, LABELLED, CLEAN, """
SELECT exfil_label, count(*) AS flows, CAST(sum(fwd_bytes) AS DOUBLE) AS fwd_bytes, CAST(sum(duration_us) AS DOUBLE) AS duration_us
FROM clean WHERE fwd_packets + bwd_packets + fwd_bytes + bwd_bytes + duration_us + psh_count + flow_bytes_s + dst_port > 0
GROUP BY exfil_label"""))
def clean_features(spark, sf):
    rows, _ = labels.clean_features(labelled(spark, sf), keep=("flow_id",))
    return rows.groupBy("exfil_label").agg(
        F.count(F.lit(1)).alias("flows"), F.sum("fwd_bytes").alias("fwd_bytes"), F.sum("duration_us").alias("duration_us")
    )


@query("numeric_columns", sql(FLOWS, """
SELECT unnest(['Flow Duration', 'Total Fwd Packets', 'Flow Bytes/s', 'PSH Flag Count']) AS feature, count(*) AS n FROM flows"""))
def numeric_columns(spark, sf):
    """Bad, metadata and text columns are left out; counts show the rows behind the rest."""
    frame = flow_rows(spark, sf).select(
        F.col("duration_us").alias("Flow Duration"), F.col("fwd_packets").alias("Total Fwd Packets"),
        F.col("flow_bytes_s").alias("Flow Bytes/s"), F.col("psh_count").alias("PSH Flag Count"),
        F.col("bwd_packets").alias("Fwd Header Length"), F.col("bwd_bytes").alias("min_seg_size_forward"),
        F.col("dst_port").alias("Destination Port"), F.col("label").alias("Label"), F.col("source_file").alias("Note"),
    )
    names = labels.numeric_columns(frame)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.count(F.col(f"`{n}`")).alias("n")) for n in names])
    return frame.agg(cells.alias("cells")).select(F.inline("cells"))


@query("normal_only", sql(FLOWS, LABELLED, "SELECT flow_id FROM labelled WHERE exfil_label = 0"))
def normal_only(spark, sf):
    return labels.normal_only(labelled(spark, sf), "exfil_label").select("flow_id")


@query("label_map", sql(FLOWS, """
SELECT flow_id, CASE WHEN trim(label) IN ('Bot', 'Infiltration') THEN 1 ELSE 0 END AS label_code FROM flows"""))
def label_map(spark, sf):
    return flow_rows(spark, sf).select("flow_id", labels.label_code(F.col("label")).alias("label_code"))


@query("heuristic_label", sql(FLOWS, LABELLED, "SELECT flow_id, exfil_label FROM labelled"))
def heuristic_label(spark, sf):
    return labelled(spark, sf).select("flow_id", "exfil_label")


@query("derived_log_features", sql(FLOWS, """
SELECT flow_id, round(r, 6) AS upload_ratio, round(p, 6) AS psh_ratio, round(ln(1 + r), 6) AS log_upload_ratio,
       round(ln(1 + least(greatest(duration_us, 0), 1e12)), 6) AS log_duration
FROM (SELECT *, least(fwd_bytes / (CASE WHEN bwd_bytes = 0 THEN 1 ELSE bwd_bytes END), 100e0) AS r,
             least(psh_count / (CASE WHEN fwd_packets + bwd_packets = 0 THEN 1 ELSE fwd_packets + bwd_packets END), 1e0) AS p
      FROM flows) t"""))
def derived_log_features(spark, sf):
    out = labels.derived_columns(flow_rows(spark, sf), SHORT)
    return rounded(out.select("flow_id", "upload_ratio", "psh_ratio", "log_upload_ratio", "log_duration"))


@query("safe_div", sql(FLOWS, """
SELECT flow_id, CASE WHEN bwd_bytes = 0 THEN -1e0 ELSE round(fwd_bytes / bwd_bytes, 6) END AS byte_ratio,
       CASE WHEN psh_count = 0 OR isnan(flow_bytes_s) OR isinf(flow_bytes_s) THEN 0e0
            ELSE round(flow_bytes_s / psh_count, 6) END AS rate_per_push
FROM flows"""))
def safe_div(spark, sf):
    return rounded(flow_rows(spark, sf).select(
        "flow_id",
        C.safe_div("fwd_bytes", "bwd_bytes", -1.0).alias("byte_ratio"),
        C.safe_div("flow_bytes_s", "psh_count").alias("rate_per_push"),
    ))


PROXY = """proxied AS (
  SELECT *, (CASE WHEN least(fwd_bytes / (CASE WHEN bwd_bytes = 0 THEN 1 ELSE bwd_bytes END), 100) > 2 THEN 30 ELSE 0 END
    + CASE WHEN least(psh_count / (CASE WHEN fwd_packets + bwd_packets = 0 THEN 1 ELSE fwd_packets + bwd_packets END), 1) > 0.3 THEN 25 ELSE 0 END
    + CASE WHEN duration_us < 600000000 THEN 25 ELSE 0 END) / 100 AS proxy_score
  FROM labelled)"""


@query("flow_proxy_score", sql(FLOWS, LABELLED, PROXY, "SELECT flow_id, proxy_score FROM proxied"))
def flow_proxy_score(spark, sf):
    return rules.flow_proxy_score(flow_rows(spark, sf)).select("flow_id", "proxy_score")


@query("upload_feature_subset", sql(views.duck("flow_packets"), *flow_ctes(),
       "SELECT " + ", ".join(f'"{n}"' for n in fixed.UPLOAD_FEATURES) + " FROM (" + flow_select() + ") t"))
def upload_feature_subset(spark, sf):
    return rounded(labels.upload_subset(flows.flow_features(flow_packets(spark, sf))), 3)


# --- preparation ---------------------------------------------------------------------------


def _ranked(rows="labelled", by="exfil_label", id_col="flow_id", seed=fixed.SEED):
    over = f"PARTITION BY {by}" if by else ""
    mixed = C.mix_sql(id_col, seed)
    return f"""ranked AS (
  SELECT *, row_number() OVER ({over} ORDER BY {mixed}, {id_col}) AS rank, count(*) OVER ({over}) AS n_of FROM {rows})"""


SPLIT = """split_rows AS (
  SELECT *, CASE WHEN rank <= floor(n_of * 0.7e0 + 0.5e0) THEN 'train' WHEN rank <= floor(n_of * 0.85e0 + 0.5e0) THEN 'test'
                 ELSE 'val' END AS split FROM ranked)"""


def split_rows(spark, sf):
    return prep.stratified_split(labelled(spark, sf), "flow_id", "exfil_label")


@query("stratified_split", sql(FLOWS, LABELLED, _ranked(), SPLIT, "SELECT flow_id, exfil_label, split FROM split_rows"))
def stratified_split(spark, sf):
    return split_rows(spark, sf).select("flow_id", "exfil_label", "split")


@query("split_summary", sql(FLOWS, LABELLED, _ranked(), SPLIT, """
SELECT coalesce(split, 'total') AS split, count(*) AS n_rows, CAST(sum(exfil_label) AS BIGINT) AS n_positive,
       round(sum(exfil_label) / count(*), 6) AS positive_rate
FROM split_rows GROUP BY GROUPING SETS ((split), ())"""))
def split_summary(spark, sf):
    return rounded(prep.split_summary(split_rows(spark, sf), "exfil_label"))


@query("standardize", sql(FLOWS, LABELLED, _ranked(), SPLIT, """
SELECT flow_id, round((fwd_packets - m1) / s1, 6) AS fwd_packets, round((fwd_bytes - m2) / s2, 6) AS fwd_bytes
FROM split_rows, (SELECT avg(fwd_packets) AS m1, stddev_pop(fwd_packets) AS s1, avg(fwd_bytes) AS m2, stddev_pop(fwd_bytes) AS s2
                  FROM split_rows WHERE split = 'train') t"""))
def standardize(spark, sf):
    rows, names = split_rows(spark, sf), ["fwd_packets", "fwd_bytes"]
    scaler = prep.fit_scaler(rows.filter("split = 'train'"), names)
    return rounded(prep.standardize(rows, names, scaler).select("flow_id", *names))


@query("standardize_on_normal", sql(FLOWS, LABELLED, """
SELECT flow_id, round((duration_us - m) / s, 6) AS duration_us
FROM labelled, (SELECT avg(duration_us) AS m, stddev_pop(duration_us) AS s FROM labelled WHERE exfil_label = 0) t"""))
def standardize_on_normal(spark, sf):
    rows = labelled(spark, sf)
    scaler = prep.fit_scaler(labels.normal_only(rows, "exfil_label"), ["duration_us"])
    return rounded(prep.standardize(rows, ["duration_us"], scaler).select("flow_id", "duration_us"))


@query("subsample_ratio", sql(FLOWS, LABELLED, _ranked(), """
SELECT flow_id, exfil_label FROM ranked
WHERE rank <= CASE WHEN exfil_label = 1 THEN least((SELECT count(*) FROM labelled WHERE exfil_label = 1), 300)
                   ELSE 3000 - least((SELECT count(*) FROM labelled WHERE exfil_label = 1), 300) END"""))
def subsample_ratio(spark, sf):
    out = prep.subsample_ratio(labelled(spark, sf), 3000, id_col="flow_id", label="exfil_label")
    return out.select("flow_id", "exfil_label")


@query("subsample_realistic", sql(FLOWS, LABELLED, _ranked(), """
SELECT flow_id, exfil_label FROM ranked WHERE rank <= CASE WHEN exfil_label = 1 THEN 100 ELSE 4900 END"""))
def subsample_realistic(spark, sf):
    out = prep.subsample_realistic(labelled(spark, sf), 5000, id_col="flow_id", label="exfil_label")
    return out.select("flow_id", "exfil_label")


@query("uniform_subsample", sql(FLOWS, LABELLED, _ranked(by=""), "SELECT flow_id FROM ranked WHERE rank <= 5000"))
def uniform_subsample(spark, sf):
    return prep.uniform_subsample(labelled(spark, sf), 5000, "flow_id").select("flow_id")


@query("class_weights", sql(FLOWS, LABELLED, """
SELECT exfil_label, count(*) AS n, round((SELECT count(*) FROM labelled) / (2 * count(*)), 6) AS weight
FROM labelled GROUP BY exfil_label"""))
def class_weights(spark, sf):
    return rounded(prep.class_weights(labelled(spark, sf), "exfil_label"))


KNN = """minority AS (SELECT * FROM labelled WHERE exfil_label = 1),
knn AS (
  SELECT id, neighbour, distance_sq, rank FROM (
    SELECT a.flow_id AS id, b.flow_id AS neighbour, d AS distance_sq,
           row_number() OVER (PARTITION BY a.flow_id ORDER BY d, b.flow_id) AS rank
    FROM minority a JOIN minority b ON a.flow_id <> b.flow_id,
         LATERAL (SELECT CAST((a.fwd_packets - b.fwd_packets) ** 2 + (a.bwd_packets - b.bwd_packets) ** 2
                  + (a.fwd_bytes - b.fwd_bytes) ** 2 + (a.psh_count - b.psh_count) ** 2 AS DOUBLE) AS d) l
  ) t WHERE rank <= 5)"""


def minority(spark, sf):
    # Written first: a filter on the label's expression would carry all of it into every scan.
    rows = staged(labelled(spark, sf).withColumn("other", 1 - F.col("exfil_label")), "labelled")
    return labels.normal_only(rows, "other")


@query("minority_knn", sql(FLOWS, LABELLED, KNN, "SELECT id, neighbour, distance_sq, CAST(rank AS INT) AS rank FROM knn"))
def minority_knn(spark, sf):
    return oversample.nearest_neighbours(minority(spark, sf), POINT, 5, "flow_id")


DRAW = C.draw_keys_sql("flow_id", "c")


@query("smote_rows", sql(FLOWS, LABELLED, KNN, _ranked("minority", "").replace("ranked AS", "ordered_minority AS"), f"""
wanted AS (SELECT (SELECT count(*) FROM minority) AS n,
    greatest(CAST(floor((SELECT count(*) FROM labelled WHERE exfil_label = 0) * 0.3e0) AS BIGINT), (SELECT count(*) FROM minority))
    - (SELECT count(*) FROM minority) AS extra),
copies AS (SELECT o.*, c AS copy, {DRAW[0]} AS one, {DRAW[1]} AS two FROM ordered_minority o, wanted w,
    LATERAL (SELECT unnest(range(1, w.extra // w.n + CASE WHEN rank <= w.extra % w.n THEN 2 ELSE 1 END)) AS c) l),
made AS (SELECT c.flow_id, c.fwd_packets AS p1, c.bwd_packets AS p2, c.fwd_bytes AS p3, c.psh_count AS p4,
    q.fwd_packets AS q1, q.bwd_packets AS q2, q.fwd_bytes AS q3, q.psh_count AS q4, {C.unit_of_sql(('one', 'two'), 43)} AS u
  FROM copies c JOIN knn k ON k.id = c.flow_id AND k.rank = floor({C.unit_of_sql(('one', 'two'), 42)} * 5) + 1
  JOIN minority q ON q.flow_id = k.neighbour)""", """
SELECT flow_id, round(p1 + u * (q1 - p1), 4) AS fwd_packets, round(p2 + u * (q2 - p2), 4) AS bwd_packets,
       round(p3 + u * (q3 - p3), 4) AS fwd_bytes, round(p4 + u * (q4 - p4), 4) AS psh_count FROM made"""))
def smote_rows(spark, sf):
    out = oversample.interpolate_minority(labelled(spark, sf), POINT, 0.3, "flow_id", "exfil_label")
    return rounded(out.filter("synthetic").select("flow_id", *POINT), 4)


@query("smote_counts", sql(FLOWS, LABELLED, """
SELECT exfil_label, CASE WHEN exfil_label = 0 THEN count(*)
    ELSE greatest(count(*), CAST(floor((SELECT count(*) FROM labelled WHERE exfil_label = 0) * 0.3e0) AS BIGINT)) END AS n
FROM labelled GROUP BY exfil_label"""))
def smote_counts(spark, sf):
    out = oversample.interpolate_minority(labelled(spark, sf), POINT, 0.3, "flow_id", "exfil_label")
    return out.groupBy("exfil_label").agg(F.count(F.lit(1)).alias("n"))


@query("jitter_augment", sql(FLOWS, LABELLED, "few AS (SELECT * FROM labelled WHERE trim(label) = 'Bot')",
       _ranked("few", ""), f"""
copies AS (SELECT r.*, c AS copy, {DRAW[0]} AS one, {DRAW[1]} AS two FROM ranked r,
    LATERAL (SELECT unnest(range(1, (n_of * 2) // n_of + CASE WHEN rank <= (n_of * 2) % n_of THEN 2 ELSE 1 END)) AS c) l)""", f"""
SELECT flow_id, CAST(fwd_packets AS DOUBLE) AS fwd_packets, CAST(fwd_bytes AS DOUBLE) AS fwd_bytes, 0 AS copy FROM few
UNION ALL
SELECT flow_id, round(greatest(0e0, fwd_packets + {C.normal_of_sql(('one', 'two'), 42)} * greatest(fwd_packets * 0.08e0, 1e0)), 5),
       round(greatest(0e0, fwd_bytes + {C.normal_of_sql(('one', 'two'), 43)} * greatest(fwd_bytes * 0.08e0, 1e0)), 5), copy FROM copies"""))
def jitter_augment(spark, sf):
    few = flow_rows(spark, sf).filter(F.trim("label") == "Bot")
    out = oversample.jitter(few, ["fwd_packets", "fwd_bytes"], few.count() * 3, "flow_id")
    return rounded(out, 5)


# --- statistics -----------------------------------------------------------------------------


@query("label_rollup", sql(FLOWS, """
SELECT coalesce(source_file, '*') AS file, coalesce(l, '*') AS label, count(*) AS flows,
       CAST(grouping(source_file) * 2 + grouping(l) AS BIGINT) AS level
FROM (SELECT source_file, trim(label) AS l FROM flows) t GROUP BY ROLLUP (source_file, l)"""))
def label_rollup(spark, sf):
    return explore.label_rollup(flow_rows(spark, sf))


@query("class_mean_ratio", sql(FLOWS, LABELLED, CLEAN, " UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(a, 4) AS normal_mean, round(b, 4) AS exfil_mean, round(b / a, 6) AS ratio FROM "
    f"(SELECT avg({n}) FILTER (exfil_label = 0) AS a, avg({n}) FILTER (exfil_label = 1) AS b FROM clean) t"
    for n in NUMERIC)))
def class_mean_ratio(spark, sf):
    out = explore.class_mean_ratio(labelled(spark, sf), NUMERIC)
    return out.select("feature", F.round("normal_mean", 4).alias("normal_mean"),
                      F.round("exfil_mean", 4).alias("exfil_mean"), F.round("ratio", 6).alias("ratio"))


@query("differing_features", sql(FLOWS, LABELLED, CLEAN, "SELECT feature FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, avg({n}) FILTER (exfil_label = 1) / avg({n}) FILTER (exfil_label = 0) AS r FROM clean"
    for n in NUMERIC) + ") t WHERE r > 2 OR r < 0.5"))
def differing_features(spark, sf):
    return explore.class_mean_ratio(labelled(spark, sf), NUMERIC, only_different=True).select("feature")


@query("port_share_topk", sql(FLOWS, LABELLED, """
SELECT exfil_label, dst_port, flows, round(share, 6) AS share, CAST(place AS INT) AS place FROM (
  SELECT exfil_label, dst_port, count(*) AS flows, count(*) / sum(count(*)) OVER (PARTITION BY exfil_label) AS share,
         row_number() OVER (PARTITION BY exfil_label ORDER BY count(*) DESC, dst_port) AS place
  FROM labelled GROUP BY exfil_label, dst_port) t WHERE place <= 3"""))
def port_share_topk(spark, sf):
    return rounded(explore.port_share(labelled(spark, sf)))


@query("class_histogram", sql(FLOWS, LABELLED, """
SELECT exfil_label, bin, n, bin * 15e6 AS bin_start, round(n / (sum(n) OVER (PARTITION BY exfil_label) * 15e6) * 1e9, 6) AS density
FROM (SELECT exfil_label, CAST(least(floor(least(greatest(duration_us, 0), 1.2e9) / 15e6), 79) AS INT) AS bin, count(*) AS n
      FROM labelled GROUP BY 1, 2) t"""))
def class_histogram(spark, sf):
    out = explore.class_histogram(labelled(spark, sf), "duration_us", 0, 1.2e9)
    return rounded(out.withColumn("density", F.col("density") * 1e9))


COMOMENTS = fixed.CORRELATION_FEATURES
PAIRS = [(a, b) for i, a in enumerate(COMOMENTS) for b in COMOMENTS[i + 1:]]
MATRIX = "features AS MATERIALIZED (SELECT " + ", ".join(f'coalesce("{n}", 0)::DOUBLE AS "{n}"' for n in COMOMENTS) + " FROM (" + flow_select("") + ") f)"
CORRELATED = "matrix AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN stddev_pop(\"{a}\") > 0 AND stddev_pop(\"{b}\") > 0 "
    f"THEN corr(\"{a}\", \"{b}\") END AS r FROM features" for a, b in PAIRS) + ")"


@query("correlation_matrix", sql(
    views.duck("flow_packets"), *flow_ctes("flow_packets", ""), MATRIX, CORRELATED, "SELECT feature_a, feature_b, round(r, 6) AS r FROM matrix"))
def correlation_matrix(spark, sf):
    """The 16 features of the correlation study, of flows assembled from packets."""
    return rounded(explore.correlation_matrix(flow_features(spark, sf), COMOMENTS))


@query("high_corr_pairs", sql(
    views.duck("flow_packets"), *flow_ctes("flow_packets", ""), MATRIX, CORRELATED,
    "SELECT feature_a, feature_b, round(r, 6) AS r FROM matrix WHERE abs(r) > 0.95"))
def high_corr_pairs(spark, sf):
    matrix = explore.correlation_matrix(flow_features(spark, sf), COMOMENTS)
    return rounded(explore.high_correlations(matrix))


@query("correlation_far_from_zero", sql(FLOWS, LABELLED, CLEAN, """
SELECT 'a' AS feature_a, 'b' AS feature_b, round(corr(fwd_packets, psh_count), 6) AS r FROM clean"""))
def correlation_far_from_zero(spark, sf):
    """Moved by 1e9, two columns correlate as before."""
    moved = flow_rows(spark, sf).select((C.finite(F.col("fwd_packets")) + 1e9).alias("a"), (C.finite(F.col("psh_count")) + 1e9).alias("b"))
    return rounded(explore.correlation_matrix(moved, ["a", "b"]))
