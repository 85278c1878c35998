"""Session set-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lookups of a batch or a page by id reach the Bloom filters of the files.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_ARROW_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Rows that go to a Python worker at once where they hold whole texts. The executor keeps a batch twice outside its
# heap, as Arrow and as what is sent, in buffers of twice the size it had before.
TEXTS_AT_ONCE = 500


def build_session(app: str = "treeseek", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process.
    """
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="treeseek-")
    spark.conf.set(_CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path never used before, below the shared folder."""
    return os.path.join(
        shared_dir(spark), spark.sparkContext.applicationId, f"{label}-{uuid.uuid4().hex[:12]}"
    )


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system has it, if it lies on a mounted file system."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder. For the end of a job:
    DataFrames that were materialised cannot be read afterwards."""
    folder = os.path.join(shared_dir(spark), spark.sparkContext.applicationId)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy outlives a lost executor and cuts the lineage, and later readers
    still get column pruning and filter push-down from Parquet.
    """
    return materialise_counted(df, label)[0]


def materialise_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As :func:`materialise`, with the number of rows, counted while writing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs run inside send at most so many rows to a Python worker at once; a smaller setting of the session holds."""
    before = int(spark.conf.get(_ARROW_ROWS_CONF))
    if 0 < before <= most:
        yield
        return
    spark.conf.set(_ARROW_ROWS_CONF, str(most))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS_CONF, str(before))


def materialise_texts(df: DataFrame, label: str) -> DataFrame:
    """As :func:`materialise`, for a frame that sends whole texts through Python: ``TEXTS_AT_ONCE`` rows at a time."""
    with arrow_rows(df.sparkSession, TEXTS_AT_ONCE):
        return materialise(df, label)


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many tasks as there are cores.

    For work that costs much per row on input of few splits, such as one file
    with one row group. Input with enough splits is left as it is. Not for
    frames with shuffles in them: asking those for their tasks would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
