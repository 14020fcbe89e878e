"""Alert and info sinks of a stream of scored windows."""

from pyspark.sql import functions as F

from leakwatch.functions import fixed
from leakwatch.operators import rules, store


def _write_batch(alert_path, info_path, threshold, model=None, window_seconds=None):
    def write(frame, batch_id):
        if model is not None:
            # Whether the model fits is looked up for every batch; if not, its columns are null.
            frame = model.predict(frame, window_seconds=window_seconds)
        # Written twice below, so the batch is computed once.
        fused = rules.fuse(rules.rule_score(frame), threshold).persist()
        # Overwriting the folder of the batch makes a repeated batch harmless.
        alerts = fused.filter("alert")
        alerts.write.mode("overwrite").parquet(f"{alert_path}/batch={batch_id}")
        if info_path:
            infos = fused.filter(~F.col("alert")).select(
                "src_ip", "window_start", "request_count", "total_bytes", "rule_score"
            )
            infos.write.mode("overwrite").parquet(f"{info_path}/batch={batch_id}")
        fused.unpersist()

    return write


def alert_sink(windows, alert_path, checkpoint, info_path=None,
               threshold=fixed.RULE_ALERT_THRESHOLD, model=None, window_seconds=None, **trigger):
    """Fuse each micro-batch and append its alerts (and rows without alert).

    `model` is a saved detector (see `operators.store`) that is bound to the query: it scores every batch, and its
    decision joins those of the rule and the baseline. A decision must not depend on the batch, so an anomaly model needs
    a threshold of its own; `window_seconds` is the length of the stream's windows, which the model must share.
    """
    if model is not None and model.kind in store.ANOMALY_KINDS:
        raise ValueError("the median of a batch is no threshold: bind a model with a fixed one")
    writer = windows.writeStream.foreachBatch(_write_batch(alert_path, info_path, threshold, model, window_seconds))
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_alerts(spark, alert_path):
    return spark.read.option("mergeSchema", False).parquet(alert_path)
