"""Shards as files: one JSON Lines file a shard, under the names that shards have.

Spark writes a folder for each shard; its one part is then renamed on the same
file system. Shards are bounded in size, so one task writes each of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prepare import split_oversized
from ..plans.storage import listed, removed, renamed, write_file

OnShard = Callable[[str], None]


def _written(df: DataFrame, line: Column, name: Column, order: list[str], path: str, on_shard: OnShard | None) -> list[str]:
    """Write each name's lines, in order; names of the finished files."""
    spark = df.sparkSession
    parts = f"{path}/_parts"
    rows = df.select(line.cast("string").alias("value"), name.alias("__name"), *order)
    rows.repartition("__name").sortWithinPartitions("__name", *order).select("value", "__name").write.mode("overwrite").partitionBy("__name").text(parts)
    done = []
    for folder in listed(spark, parts):
        if folder.startswith("__name="):
            own = [n for n in listed(spark, f"{parts}/{folder}") if n.startswith("part-")]
            file = f"{path}/{folder.removeprefix('__name=')}"
            renamed(spark, f"{parts}/{folder}/{own[0]}", file)
            done.append(file)
            if on_shard:
                on_shard(file)
    removed(spark, parts)
    return done


def write_rolled(df: DataFrame, line: Column, shard_index: str, order: list[str], path: str, on_shard: OnShard | None = None) -> list[str]:
    """One file for each ``shard_index`` (``sharding.rolled`` or ``balanced``), in record order; ``on_shard`` sees each that is finished."""
    return _written(df, line, F.format_string("shard-%05d.jsonl", F.col(shard_index)), order, path, on_shard)


def write_hash_shards(df: DataFrame, line: str, shard: str, n: int, path: str, target_bytes: int | None = None, on_shard: OnShard | None = None) -> list[str]:
    """One file for each of ``n`` shards, empty ones too; with a target, a shard that exceeds it is split into parts."""
    rows = split_oversized(df, shard, F.col(line), target_bytes) if target_bytes else df.withColumn("part", F.lit(0))
    whole = F.format_string("shard-%05d.jsonl", F.col(shard))
    several = rows.where("part > 0").select(F.col(shard).alias("__several")).distinct()
    rows = rows.join(several, F.col(shard) == F.col("__several"), "left")
    name = F.when(F.col("__several").isNull(), whole).otherwise(F.format_string("shard-%05d-%03d.jsonl", F.col(shard), F.col("part")))
    done = _written(rows, F.col(line), name, [], path, on_shard)
    made = {int(f.rsplit("shard-", 1)[1][:5]) for f in done}
    for k in sorted(set(range(n)) - made):
        file = f"{path}/shard-{k:05d}.jsonl"
        write_file(df.sparkSession, file, "")
        done.append(file)
        if on_shard:
            on_shard(file)
    return sorted(done)
