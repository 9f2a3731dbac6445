"""Training shards: end-of-text marks, stable hash sharding, splitting of large shards."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE

EOS = "<|endoftext|>"


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+$", "")


def ensure_eos(text: Column, mark: str = EOS) -> Column:
    """The text with one mark at its end, whether or not it had one."""
    own = rstrip(text)
    return F.when(own.endswith(mark), own).otherwise(F.concat(own, F.lit(" " + mark)))


def eos_added(text: Column, mark: str = EOS) -> Column:
    return ensure_eos(text, mark) != rstrip(text)


def shard_count(total_bytes: Column, target_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(total_bytes / F.lit(target_bytes)).cast("int"))


def shard_id(text: Column, n: Column | int, seed: str = "42") -> Column:
    """A shard for a text, the same in every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}\n"), text))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(n) if isinstance(n, int) else n).cast("int")


def shard_id_blake(text: Column, n: int, seed: str = "42") -> Column:
    """The same by BLAKE2b, for shards that must agree with ones made that way."""

    @F.pandas_udf("int")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else int.from_bytes(hashlib.blake2b(f"{seed}\n{t}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") % n)

    return of(text)


def line_bytes(line: Column) -> Column:
    return (F.octet_length(line) + 1).cast("bigint")


def shard_sizes(df: DataFrame, shard: str, line: Column) -> DataFrame:
    return df.groupBy(shard).agg(F.count("*").alias("n_records"), F.sum(line_bytes(line)).alias("n_bytes"))


def split_oversized(df: DataFrame, shard: str, line: Column, target_bytes: int, slack: float = 1.2, seed: int = 42) -> DataFrame:
    """Adds ``part``: shards beyond ``slack`` times the target are hashed again into enough parts; others have part 0.

    Sizes are an aggregation of one row per shard; the rows are not moved for it.
    """
    sizes = df.groupBy(F.col(shard).alias("__shard")).agg(F.sum(line_bytes(line)).alias("__bytes"))
    parts = F.when(F.col("__bytes") > F.lit(target_bytes * slack), F.greatest(F.lit(2), F.ceil(F.col("__bytes") / F.lit(target_bytes)))).otherwise(1).cast("int")
    sizes = sizes.select("__shard", parts.alias("__parts"))
    digest = F.md5(F.concat((F.lit(seed) + F.col(shard)).cast("string"), F.lit("\n"), line))
    part = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.col("__parts")).cast("int")
    return df.join(sizes, F.col(shard) == F.col("__shard")).withColumn("part", part).drop("__shard", "__parts")


def counters(lines: DataFrame, raw: str = "raw", key: str = "text", mark: str = EOS) -> DataFrame:
    """What becomes of the lines of JSON Lines files: blank ones are skipped, others written or counted by what is wrong.

    A record without the key, or with a null there, has no text; any other
    value counts as one that is not a string and is written as its JSON.
    """
    value = F.try_variant_get(F.try_parse_json(raw), f"$.{key}", "string")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), f"$.{key}", "variant"))
    blank = F.regexp_replace(F.col(raw), f"[{SPACE}]+", "") == ""
    top = F.schema_of_variant(F.try_parse_json(raw))
    rows = lines.select(
        blank.alias("blank"), top.isNull().alias("bad"), (~top.startswith("OBJECT")).alias("other"), value.alias("value"), kind.alias("kind"),
    )
    live = ~F.col("blank")
    parsed = live & ~F.col("bad") & ~F.col("other")
    missing = parsed & (F.col("kind").isNull() | (F.col("kind") == "VOID"))
    written = parsed & ~missing
    n = lambda c, name: F.count(F.when(c, 1)).alias(name)
    return rows.agg(
        F.count("*").alias("total"), n(F.col("blank"), "skipped"), n(live & (F.col("bad") | F.col("other")), "invalid_json"), n(missing, "missing_text"),
        n(written & (F.col("kind") != "STRING"), "non_string"), n(written, "written"), n(written & F.coalesce(eos_added(F.col("value"), mark), F.lit(False)), "eos_added"),
    )
