import pytest
from pyspark.sql import functions as F

from leakwatch.functions import fixed
from leakwatch.operators import evaluate, labels, prep
from leakwatch.plans import detection, training
from leakwatch.session import fresh_dir, shared_root
from leakwatch.sources import flows, uploads
from leakwatch.streaming import alerts, monitor, run


def write_text(path, text):
    with open(path, "w") as out:
        out.write(text)


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def test_untidy_csv(spark, folder):
    write_text(f"{folder}/a.csv", " Flow Duration,Flow Bytes/s, Label,Flow Duration\n5,Infinity,BENIGN,99\nx,NaN, Bot ,98\n")
    write_text(f"{folder}/b.csv", "Label, Extra\nDoS,7\n")
    files = {"a": f"{folder}/a.csv", "b": f"{folder}/b.csv", "gone": f"{folder}/none.csv"}
    out = flows.load_flows(spark, files).orderBy("_source_file", "Label").collect()
    assert [r["_source_file"] for r in out] == ["a", "a", "b"]
    assert set(out[0].asDict()) == {"Flow Duration", "Flow Bytes/s", "Label", "Extra", "_source_file"}
    by_label = {r["Label"].strip(): r for r in out}
    assert by_label["BENIGN"]["Flow Duration"] == 5.0 and by_label["BENIGN"]["Flow Bytes/s"] == float("inf")
    assert by_label["Bot"]["Flow Duration"] is None and by_label["DoS"]["Extra"] == 7.0
    with pytest.raises(FileNotFoundError):
        flows.load_flows(spark, {"gone": files["gone"]})


def test_default_files_are_named():
    assert flows.default_files("/x")["monday"].startswith("/x/Monday") and len(flows.default_files("/x")) == 8


def test_labels_and_heuristic(spark):
    rows = [
        ("Bot", 1.0, 1.0, 1.0, 0.0, 1.0, 1.0), (" Infiltration ", 1.0, 1.0, 1.0, 0.0, 1.0, 1.0),
        ("DoS Hulk", 1.0, 1.0, 1.0, 0.0, 1.0, 1.0), ("BENIGN", 600.0, 100.0, 5e8, 4.0, 5.0, 5.0),
        ("BENIGN", 600.0, 100.0, 6e8, 4.0, 5.0, 5.0), ("BENIGN", 10.0, 0.0, float("nan"), 1.0, 1.0, 0.0),
        ("BENIGN", float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0),
    ]
    names = list(labels.CSV_NAMES.values())
    schema = "Label string, " + ", ".join(f"`{n}` double" for n in names)
    out = labels.assign_labels(spark.createDataFrame(rows, schema))
    assert [r["exfil_label"] for r in out.collect()] == [1, 1, 0, 1, 0, 1, 0]


def test_cleaning_drops_bad_columns_and_empty_rows(spark):
    rows = [(1, 0.0, float("nan"), 5.0, "x", 0), (2, 1.0, float("inf"), 5.0, "y", 1), (3, 2.0, -3.0, 0.0, "z", 1)]
    frame = spark.createDataFrame(rows, "flow_id bigint, a double, b double, `Fwd Header Length` double, note string, exfil_label int")
    out, names = labels.clean_features(frame, keep=("flow_id",))
    assert names == ["a", "b"]
    assert [tuple(r) for r in out.orderBy("flow_id").collect()] == [(2, 1.0, 0.0, 1), (3, 2.0, -3.0, 1)]


def test_upload_metadata(spark):
    rows = [(1, "c", 5, 10, "abc", None, None, None, "7"), (2, "c", 5, 10 * 1024 * 1024 + 1, "x", None, None, None, None), (3, "c", 5, 0, "", "s", "m", "1", "2")]
    frame = spark.createDataFrame(rows, "request_id int, client_ip string, client_port int, content_length bigint, body string, session_id string, mode string, chunk_id string, seq string")
    out = {r["request_id"]: r for r in uploads.upload_metadata(frame).collect()}
    assert set(out) == {1, 3} and uploads.rejected_uploads(frame).count() == 1
    assert out[1]["content_sha"] == "ba7816bf8f01cfea" and (out[1]["session_id"], out[1]["chunk_id"]) == ("N/A", "7")
    assert out[3]["chunk_id"] == "1"


def test_alert_sink_is_repeatable(spark, sf):
    """Windows through the keyed baseline and the alert sink; the batch twin agrees."""
    from leakwatch.operators import windows
    from leakwatch.plans import packet_queries

    rows = windows.window_features(packet_queries.packets(spark, sf))
    last = rows.limit(1).withColumns({"src_ip": F.lit("closing"), "window_start": F.lit(1e9), "window_end": F.lit(1e9)})
    source, out, infos = (fresh_dir(spark, n) for n in ("source", "alerts", "infos"))
    for low, high in ((0, 900), (900, 10**9)):
        rows.filter((F.col("window_start") >= low) & (F.col("window_start") < high)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    scored = fresh_dir(spark, "scored")
    with run.rocksdb_state(spark):
        last.coalesce(1).write.mode("append").parquet(source)
        run.finish(run.to_table(monitor.monitor(stream), scored, fresh_dir(spark, "check")))
    again = spark.readStream.schema(spark.read.parquet(scored).schema).parquet(scored).filter("src_ip <> 'closing'")
    run.finish(alerts.alert_sink(again, out, fresh_dir(spark, "check"), infos))
    want = detection.score_windows(rows).filter("alert")
    got = alerts.read_alerts(spark, out)
    key = ["src_ip", "window_start", "severity", "online_score"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    alerted = got.count()
    assert spark.read.parquet(infos).count() + alerted == rows.count()
    # The same batch written twice leaves one copy.
    write = alerts._write_batch(out, None, fixed.RULE_ALERT_THRESHOLD)
    ours = spark.read.parquet(scored).filter("src_ip <> 'closing'")
    write(ours, 0)
    write(ours, 0)
    assert alerts.read_alerts(spark, out).count() == alerted


def test_reset_row_clears_the_stream_state(spark):
    from helpers import window_frame

    rows = window_frame(spark, [{} for _ in range(6)] + [{"src_ip": "closing"}]).withColumn("reset", F.col("window_start") == 180.0)
    source, out = fresh_dir(spark, "source"), fresh_dir(spark, "out")
    rows.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    with run.rocksdb_state(spark):
        run.finish(run.to_table(monitor.monitor(stream, warmup=3), out, fresh_dir(spark, "check")))
    got = [r["baseline_count"] for r in spark.read.parquet(out).filter("src_ip <> 'closing'").orderBy("window_start").collect()]
    assert got == [1, 2, 3, 1, 2]


def test_detection_from_raw_packets(spark, sf):
    from leakwatch.sources import views

    fused = detection.detect(views.load(spark, sf, "packets"))
    rows = fused.filter("array_contains(triggers, 'BURST_RULE')").collect()
    assert len(rows) == 3 and {r["severity"] for r in rows} == {"HIGH"} and fused.count() == 30
    path = fresh_dir(spark, "alerts")
    detection.write_alerts(fused, path)
    assert spark.read.parquet(path).count() == fused.filter("alert").count()


def test_training_job(spark, sf):
    from leakwatch.plans import flow_queries

    rows = flow_queries.flow_rows(spark, sf).select(
        "flow_id", F.col("label").alias("Label"),
        *[F.col(short).alias(labels.CSV_NAMES[k]) for k, short in flow_queries.SHORT.items()],
    )
    scaled, names = training.prepare(rows, "flow_id")
    assert len(names) == 6
    mine, _ = training.anomaly_scores(scaled, names, trees=20)
    dense, _ = training.supervised_scores(scaled, names, iterations=5)
    both = mine.unionByName(dense).cache()
    out = training.report(both).collect()
    assert {r["kind"] for r in out} == {"anomaly", "supervised"} and all(0 <= r["auc"] <= 1 for r in out)
    path = fresh_dir(spark, "splits")
    training.write_report(training.report(both), evaluate.threshold_scan(both), path)
    training.write_dataset_summary(scaled, names, f"{path}/summary")
    assert spark.read.json(f"{path}/report").count() == 2
    samples = spark.read.json(f"{path}/threshold_samples").groupBy("model").count().collect()
    assert {r["model"] for r in samples} == {"anomaly", "supervised"}
    totals = spark.read.json(f"{path}/summary").filter("split = 'total'").first()
    assert totals["n_rows"] == scaled.count() and totals["n_features"] == 6
    scaler = prep.fit_scaler(scaled, names)
    prep.save_scaler(scaler, f"{path}/scaler")
    assert prep.load_scaler(spark, f"{path}/scaler").first() == scaler.first()
    prep.save_splits(scaled, path, names)
    assert spark.read.parquet(f"{path}/rows").count() == scaled.count()


def test_shared_folder_is_the_cluster_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_root(spark) == named.rstrip("/")
