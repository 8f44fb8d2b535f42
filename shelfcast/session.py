"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The first lets a join on (id, day) reuse a partitioning by id, so the windows that
# follow need no further shuffle. The others keep partitions small when shuffle output
# is merged: a few narrow columns grow into a hundred features after the shuffle, and a
# price week into seven days. Without the last, partitions are merged until there are no
# more than cores, so that a task's rows grow with the input up to 64 MB of shuffled bytes.
PLAN_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
}
SETTINGS = {
    **PLAN_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# A shuffle partition of this size sorts in an executor's memory without spilling.
PARTITION_BYTES = 128 * 1024 * 1024
# Rows take about so many times the bytes of their compressed columns.
EXPANSION = 4


def shuffle_partitions(input_bytes: int, least: int = 200) -> int:
    """Shuffle partitions for a job that shuffles ``input_bytes``; AQE merges what is too many."""
    return max(least, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app_name: str = "shelfcast", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the library's settings; ``input_bytes`` sizes its shuffles."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))} if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_plan_settings(spark: SparkSession) -> None:
    """Put the plan settings on a session somebody else built; they hold for all its queries."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Raise the session's shuffle partitions to what a fact of this stored size needs; never lower them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    have = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(EXPANSION * stored, least=have))


@functools.cache
def _local_dir() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="shelfcast-")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as tasks outside the JVM need it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") else full


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return _qualified(spark, named)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return "file://" + _local_dir().name


@functools.cache
def _application_dir(spark: SparkSession, base: str) -> str:
    """A folder of this application below ``base``; its file system removes it when the application ends."""
    folder = f"{base}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, kept until the application ends."""
    folder = _application_dir(spark, shared_dir(spark))
    return os.path.join(folder, f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here.

    With ``by`` there is a folder per value, so a reader of one value opens only its files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame, label: str) -> None:
    """Remove the files of a table that ``written`` made under ``label`` and nothing reads any more."""
    spark = df.sparkSession
    base = _application_dir(spark, shared_dir(spark))
    for folder in {os.path.dirname(name) for name in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if f"{os.path.basename(base)}/{label}-" in folder:
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fits(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads no further than that."""
    return df.limit(limit + 1).count() <= limit


def small_side(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast when ``df`` is proven small, else leave the join to shuffle."""
    return F.broadcast(df) if fits(df, limit) else df
