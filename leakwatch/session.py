"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(name="leakwatch", master=None, shuffle_partitions=None, extra=None):
    """A session with the settings the library relies on.

    On a cluster leave `master` and `shuffle_partitions` unset: the submit
    command names the master and AQE sizes the shuffles.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        # Recording the Python line of every column costs more than planning does here.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_one_machine(master):
    """Whether driver and executors are one process (local-cluster is not)."""
    return master == "local" or master.startswith("local[")


def shared_root(spark):
    """The folder all executors see: the one the cluster names in
    `spark.checkpoint.dir`. Only where that is unset on a single machine is a
    temporary folder made, once per session; elsewhere it would not be shared."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not is_one_machine(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = spark.conf.get("leakwatch.work.dir", None)
    if not made:
        made = tempfile.mkdtemp(prefix="leakwatch-")
        spark.conf.set("leakwatch.work.dir", made)
    return made


def fresh_dir(spark, purpose):
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/leakwatch/{purpose}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint in the shared folder; survives lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/leakwatch/checkpoints")
    return df.checkpoint(eager=True)


def staged(df, purpose):
    """Write a table to the shared folder and read it back: later steps prune its columns."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
