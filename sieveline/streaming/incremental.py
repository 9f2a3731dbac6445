"""Resumable runs: each micro-batch of new files is decided, deduplicated against all before it, and committed.

The checkpoint knows which files are done. Keys of texts seen so far are a
table beside the output; a batch is written with its number in the path, so
one that is run again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..operators.dedup import exact_key, mark_exact
from ..plans import storage
from ..plans.pipeline import decide
from ..sources.files import JSON_GLOB, parsed
from .manifest import Manifest


def read_stream(spark: SparkSession, root: str, files_per_batch: int = 64) -> DataFrame:
    """(raw, _shard) of the lines of new JSON Lines files."""
    lines = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", JSON_GLOB).option("maxFilesPerTrigger", files_per_batch).text(root)
    return lines.where(F.trim("value") != "").select(F.col("value").alias("raw"), F.col("_metadata.file_name").alias("_shard"))


def _keys(spark: SparkSession, path: str, below: int) -> DataFrame:
    if not storage.exists(spark, path):  # no batch has been written yet
        return spark.createDataFrame([], "key string, batch bigint")
    return spark.read.schema("key string, batch bigint").parquet(path).where(F.col("batch") < below)


def batch_writer(cfg: Config, on_batch: Callable[[int, DataFrame], None] | None = None, manifest: Manifest | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a batch's decided records and its new keys, then names its files in the manifest."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keys = cfg.output("keys")
        lines = batch.withColumn("_line_num", F.monotonically_increasing_id())  # orders the lines of a batch
        marked = mark_exact(parsed(lines, cfg.text_key), F.col("text"), ["_shard", "_line_num"])
        key = F.sha2(exact_key(F.col("text")), 256)
        seen = _keys(spark, keys, number).select(F.col("key").alias("__seen")).distinct()
        marked = marked.withColumn("__key", key).join(seen, F.col("__key") == F.col("__seen"), "left")
        marked = marked.withColumn("is_exact_dup", F.col("is_exact_dup") | F.col("__seen").isNotNull())
        decided = decide(marked.drop("__seen"), cfg, marked_exact=True)
        out = f"{cfg.output('decided')}/batch={number}"
        decided.drop("__key").write.mode("overwrite").parquet(out)
        new = marked.where("__key is not null and not is_exact_dup").select(F.col("__key").alias("key")).distinct()
        new.write.mode("overwrite").parquet(f"{keys}/batch={number}")
        if manifest is not None:  # the files of a batch are at most those of its trigger
            for row in batch.select("_shard").distinct().collect():
                manifest.mark("processed_files", row[0])
            manifest.save(spark)
        if on_batch:
            on_batch(number, spark.read.parquet(out))

    return write


def run(spark: SparkSession, root: str, cfg: Config, files_per_batch: int = 64, on_batch: Callable[[int, DataFrame], None] | None = None, manifest: Manifest | None = None) -> StreamingQuery:
    """Decide the files that are new since the last run, then stop; await its termination."""
    return (
        read_stream(spark, root, files_per_batch).writeStream.foreachBatch(batch_writer(cfg, on_batch, manifest))
        .option("checkpointLocation", cfg.output("checkpoint")).trigger(availableNow=True).start()
    )


def pending(files: DataFrame, manifest: DataFrame, name: str = "name") -> DataFrame:
    """The files that a manifest (file_name, state) does not call done."""
    done = manifest.where(F.col("state").isin("done", "processed", "uploaded")).select(F.col("file_name").alias("__done")).distinct()
    return files.join(done, files[name] == done["__done"], "left_anti")
