"""Streaming runs over the test tables, checked by the SQL of their batch twins."""

from pyspark.sql import functions as F

from leakwatch.functions import fixed, schemas
from leakwatch.operators import store
from leakwatch.plans import packet_queries as batch
from leakwatch.plans.packet_queries import (
    DEFAULT_SCORED, MONITOR_SELECT, MONITORED, PARSED_RAW, RAW, monitor_output, window_check,
)
from leakwatch.plans.registry import query, rounded, sql
from leakwatch.session import fresh_dir, staged
from leakwatch.sources import packets as P
from leakwatch.sources import views
from leakwatch.streaming import alerts, monitor, run, windows

DAY_US = 86_400_000_000


def land_packets(spark, sf, view, parts=3):
    """Packets as files that arrive in order of time, then one far-off packet that
    lets the last windows close. Returns the folder."""
    folder = fresh_dir(spark, "landing")
    # The view is computed once; its rows are read for the limits and for each part.
    rows = staged(views.load(spark, sf, view).select(*schemas.RAW_PACKET.names), "landing-rows")
    low, high = rows.agg(F.min("ts_us"), F.max("ts_us")).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        inside = F.col("ts_us").between(low + i * step, low + (i + 1) * step - 1)
        rows.filter(inside).write.mode("append").parquet(folder)
    closing = [(-1, high + DAY_US, "0.0.0.0", "0.0.0.0", 0, 0, 0, 0, 6, 0)]
    spark.createDataFrame(closing, schemas.RAW_PACKET).coalesce(1).write.mode("append").parquet(folder)
    return folder


def run_windows(spark, sf):
    """Packets to window features through the streaming aggregation; the output folder."""
    folder = land_packets(spark, sf, "packets")
    out = fresh_dir(spark, "windows")
    stream = P.parse_packets(P.stream_packets(spark, folder, files_per_trigger=2))
    # Files of one landing step may be read in any order, so the step is the delay allowed.
    features = windows.window_features(stream, slice_seconds=5, late="15 minutes")
    with run.rocksdb_state(spark):
        run.finish(run.to_table(features, out, fresh_dir(spark, "windows-checkpoint")))
    return out


def land_windows(spark, rows, steps=3, files=2):
    """Window rows as folders of one file each, whose order is that of time only from step to step; the last holds one
    window far off, which lets the others out. Returns the folders and the delay that covers a step."""
    low, high = rows.agg(F.min("window_end"), F.max("window_end")).first()
    size = (high - low) / steps + 1
    step = F.floor((F.col("window_end") - low) / size)
    number = F.pmod(F.xxhash64("src_ip", "window_start"), F.lit(files))
    batches = []
    for i in range(steps):
        for j in range(files):
            batches.append(rows.filter((step == i) & (number == j)))
    batches.append(rows.limit(1).withColumns({"src_ip": F.lit(CLOSING), "window_end": F.lit(high + 9 * size)}))
    folders = []
    for batch in batches:
        folders.append(fresh_dir(spark, "window-batch"))
        batch.coalesce(1).write.parquet(folders[-1])
    return folders, f"{int(2 * size)} seconds"


CLOSING = "closing"


def run_monitor(spark, sf):
    """The window table as a stream through the keyed baseline: one file a trigger, out of order, with a restart from
    the checkpoint half way. Returns the output folder."""
    rows = spark.read.parquet(run_windows(spark, sf))
    folders, late = land_windows(spark, rows)
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "monitored", "monitor-checkpoint"))
    half = len(folders) // 2
    with run.rocksdb_state(spark):
        for arriving in (folders[:half], folders[half:]):
            for folder in arriving:
                spark.read.parquet(folder).coalesce(1).write.mode("append").parquet(inbox)
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
            scored = monitor.monitor(stream, late=late)
            run.finish(run.to_table(scored, out, checkpoint))
    return out


@query("packet_stream_ingest", sql(RAW, PARSED_RAW, """
SELECT packet_id, ts_us, src_ip, dst_ip, src_port, dst_port, payload_len, pkt_len, protocol,
       CASE WHEN protocol = 'UDP' THEN 'UDP' ELSE CAST(flags AS VARCHAR) END AS flags
FROM parsed"""))
def packet_stream_ingest(spark, sf):
    folder, out = land_packets(spark, sf, "raw_packets"), fresh_dir(spark, "ingested")
    stream = P.parse_packets(P.stream_packets(spark, folder, files_per_trigger=2))
    run.finish(run.to_table(stream, out, fresh_dir(spark, "ingest-checkpoint")))
    return spark.read.schema(schemas.PACKET).parquet(out).filter("packet_id >= 0").drop("tcp_flags")


@query("window_features_stream", window_check("window_end", *fixed.WINDOW_FEATURES))
def window_features_stream(spark, sf):
    return rounded(spark.read.parquet(run_windows(spark, sf)))


@query("online_monitor_stream", batch.recursive(*MONITORED, MONITOR_SELECT))
def online_monitor_stream(spark, sf):
    return monitor_output(spark.read.parquet(run_monitor(spark, sf)).filter(F.col("src_ip") != CLOSING))


@query("alerts_stream", batch.recursive(*MONITORED, DEFAULT_SCORED, """
SELECT s.src_ip, s.window_start, rule_score,
       CASE WHEN rule_score > 0.7 THEN s.severity ELSE 'MEDIUM' END AS severity,
       array_to_string(list_filter([CASE WHEN rule_score > 0.7 THEN 'BURST_RULE' END,
         CASE WHEN online_prediction = 1 THEN 'ONLINE_UNKNOWN_ANOMALY' END], lambda t: t IS NOT NULL), '+') AS triggers
FROM scored s JOIN monitored m USING (src_ip, window_start) WHERE rule_score > 0.7 OR online_prediction = 1"""))
def alerts_stream(spark, sf):
    folder = run_monitor(spark, sf)
    out = fresh_dir(spark, "alerts")
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    run.finish(alerts.alert_sink(stream, out, fresh_dir(spark, "alert-checkpoint")))
    return alerts.read_alerts(spark, out).filter(F.col("src_ip") != CLOSING).select(
        "src_ip", "window_start", "rule_score", "severity", F.array_join("triggers", "+").alias("triggers")
    )


def bound_model(spark, seconds=60):
    """A saved model on one feature, loaded as a streaming job does at its start."""
    path = fresh_dir(spark, "stream-model")
    parts = {"weights": [1.0], "intercept": -1.2}
    store.save(store.Saved("linear", ["upload_download_ratio"], window_seconds=seconds, parts=parts), path, spark)
    return store.load(spark, path)


@query("alerts_stream_model", batch.recursive(*MONITORED, DEFAULT_SCORED, """
SELECT s.src_ip, s.window_start, CASE WHEN s.upload_download_ratio > 1.2 THEN 1 ELSE 0 END AS prediction,
       CASE WHEN rule_score > 0.7 THEN s.severity ELSE 'MEDIUM' END AS severity,
       array_to_string(list_filter([CASE WHEN rule_score > 0.7 THEN 'BURST_RULE' END,
         CASE WHEN s.upload_download_ratio > 1.2 THEN 'OFFLINE_MODEL' END,
         CASE WHEN online_prediction = 1 THEN 'ONLINE_UNKNOWN_ANOMALY' END], lambda t: t IS NOT NULL), '+') AS triggers
FROM scored s JOIN monitored m USING (src_ip, window_start)
WHERE rule_score > 0.7 OR online_prediction = 1 OR s.upload_download_ratio > 1.2"""))
def alerts_stream_model(spark, sf):
    """Alerts of a stream with all three triggers: rule, saved model and baseline."""
    folder, out = run_monitor(spark, sf), fresh_dir(spark, "alerts")
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    stream = stream.filter(F.col("src_ip") != CLOSING)
    run.finish(alerts.alert_sink(stream, out, fresh_dir(spark, "alert-checkpoint"), model=bound_model(spark), window_seconds=60))
    return alerts.read_alerts(spark, out).select(
        "src_ip", "window_start", "prediction", "severity", F.array_join("triggers", "+").alias("triggers")
    )
