"""Where a plan is cut: tables and checkpoints in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where a session names none (tests), a local one of its own."""
    path = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.conf.set(SETTING, path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discarded(*frames: DataFrame) -> None:
    """Delete stored frames that nothing reads any more."""
    for df in frames:
        removed(df.sparkSession, df.stored_at)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def renamed(spark: SparkSession, old: str, new: str) -> None:
    (a, fs), (b, _) = _at(spark, old), _at(spark, new)
    fs.mkdirs(b.getParent())
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {old}")


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    p, fs = _at(spark, path + ".tmp")
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    renamed(spark, path + ".tmp", path)


def read_file(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode("utf-8")
    finally:
        source.close()


def bounded(df: DataFrame, limit: int, what: str) -> list:
    """All rows of a table that must be small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows


def removed(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A small input that a scan leaves in fewer parts than there are cores, over all of them; a larger one as it is.

    A file of one row group is one task however long its rows take; inputs of
    many row groups are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
