"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Documents can be long: bound an Arrow batch by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}

SPLIT_BYTES = 128 << 20


def get_spark(app_name: str = "sftpipe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def allow_repeated_keys(spark: SparkSession) -> None:
    """Let JSON objects repeat a key, which parsing depends on, in a session that ``get_spark``
    has not made."""
    name = "spark.sql.variant.allowDuplicateKeys"
    if spark.conf.get(name, "false") != RECOMMENDED_CONF[name]:
        spark.conf.set(name, RECOMMENDED_CONF[name])


def bound_batches(spark: SparkSession) -> None:
    """Hold Arrow batches of long texts to the recommended size, in a session that ``get_spark``
    has not made: a batch is held by the JVM and, as objects, by the Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(RECOMMENDED_CONF[name])
    if not 0 < int(spark.conf.get(name, "10000")) <= most:
        spark.conf.set(name, str(most))


def bound_active_batches() -> None:
    """``bound_batches`` for column expressions, which name no session."""
    if spark := SparkSession.getActiveSession():
        bound_batches(spark)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made
    only for a local master, where driver and executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sftpipe-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a reader of it.

    Cuts the lineage and survives lost executors, and later readers get column
    pruning, pushed filters and true size statistics, which a checkpointed RDD
    does not give.
    """
    return write_counted(df, name)[0]


def write_counted(df: DataFrame, name: str, count: Column | None = None) -> tuple[DataFrame, int]:
    """``write_stage`` and an aggregate, by default the row count, observed by the same job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation()
    counted = F.count(F.lit(1)) if count is None else count
    df.observe(seen, counted.alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"] or 0


def append_stage(df: DataFrame, path: str | None = None, name: str = "parts") -> str:
    """Write ``df`` into the stage at ``path``, a new one without it; return its path."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("append").parquet(path)
    return path


def release_stages(spark: SparkSession) -> None:
    """Delete this application's stages, once none of its results is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy steps one partition per core when the input is small.

    Judged by the optimizer's size estimate, so nothing runs. An input with a scan
    split for at least half of the cores is left alone: no text is shuffled there.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores / 2 * SPLIT_BYTES:
        return df
    return df.repartition(cores, key)
