"""A first look at a dataset: the leading records of each file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.profiles import TURKISH
from ..functions.text import count_of


def leading(df: DataFrame, by: str, order: Sequence[str], k: int = 100) -> DataFrame:
    """The first k records of each file (Spark prunes within each task before the shuffle)."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k).drop("__n")


def summary(df: DataFrame, text: Column, by: str) -> DataFrame:
    """Lengths, letters of the target language and markup; a missing text counts as an empty one."""
    t = F.coalesce(text, F.lit(""))
    has = lambda c, name: F.count(F.when(c, 1)).alias(name)
    n = F.length(t)
    letters = F.sum(count_of(t, TURKISH.special_chars))
    return df.agg(
        F.count_distinct(by).alias("n_files"), F.count("*").alias("n_records"), F.min(n).alias("min_length"), F.max(n).alias("max_length"),
        F.floor(F.sum(n) / F.count("*")).cast("bigint").alias("avg_length"), (F.floor(letters / F.greatest(F.sum(n), F.lit(1)) * 1e6 + 0.5) / 1e6).alias("special_char_ratio"),
        has(F.lower(t).contains("<html") | F.lower(t).contains("<div"), "html_records"), has(t.contains("http://") | t.contains("https://"), "url_records"),
    )


def key_frequencies(lines: DataFrame, raw: Column) -> DataFrame:
    """How many of the JSON records have each key; keys that begin with _ are left out."""
    keys = F.explode(F.array_distinct(F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))).alias("key")
    return lines.select(keys).where(~F.col("key").startswith("_")).groupBy("key").agg(F.count("*").alias("n"))


def record_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(F.col(by).alias("file")).agg(F.count("*").alias("n_records"))


def previews(df: DataFrame, text: Column, order: Sequence[str], k: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(k).select(F.substring(F.coalesce(text, F.lit("")), 1, 300).alias("preview"))
