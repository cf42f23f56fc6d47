"""Session settings and the scratch area that lazily built plans write to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "txnguard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Nothing here depends on the data size: adaptive execution coalesces or
    splits shuffle partitions at run time, and splits skewed join keys.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The JVM never compiles a method above 8000 bytes of bytecode; rather
        # than interpret one, run that stage operator by operator.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Building a plan is cheaper without the Python call site per expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_directory(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A session without the setting gets a folder in the warehouse, which all
    executors reach as well; never one of a single machine's temporary folders.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/txnguard_scratch"
        spark.conf.set(_CHECKPOINT_KEY, configured)
    return configured.rstrip("/")


def _scratch_root(spark: SparkSession):
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(f"{shared_directory(spark)}/txnguard-{context.applicationId}")
    return root, root.getFileSystem(context._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    root, files = _scratch_root(spark)
    files.deleteOnExit(root)
    return f"{root.toString()}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch data early; results read from it are gone."""
    root, files = _scratch_root(spark)
    files.delete(root, True)


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_directory(spark))


def materialize(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage for a result that several branches of a plan read, and
    survives the loss of executors because the files are not theirs. Reading
    one value of ``partition_by`` skips the other files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
