"""Starting queries and reading their progress."""

from collections import Counter
from contextlib import contextmanager

from pyspark.sql.streaming import StreamingQueryListener

from leakwatch.session import ROCKSDB


class RowCounter(StreamingQueryListener):
    """Input and late rows of every query over all its triggers, however many.

    A query itself keeps the progress of its last triggers only. Add it with
    `spark.streams.addListener` before queries start; events arrive shortly after their trigger.
    """

    def __init__(self):
        self.late, self.seen, self.triggers = Counter(), Counter(), Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        query = str(progress.id)
        self.triggers[query] += 1
        self.seen[query] += progress.numInputRows
        self.late[query] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


@contextmanager
def rocksdb_state(spark, partitions=None):
    """Settings for stateful queries started inside the block.

    State is kept in RocksDB. Its partition count is fixed for the life of a
    checkpoint and each partition is committed on every trigger, so it follows
    the cores of the cluster rather than the batch default; name it to plan ahead.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def to_table(stream, path, checkpoint, mode="append", **trigger):
    """Write a stream as Parquet; by default until all input that is there is done."""
    writer = stream.writeStream.format("parquet").outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def finish(query):
    """Wait for a query that ends by itself; its failure is raised here."""
    query.awaitTermination()
    return query


def late_rows(query):
    """Rows dropped behind the watermark over the progress that is still kept; see `RowCounter` for all."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def throughput(query):
    """Input rows and rows per second of each kept micro-batch."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]
