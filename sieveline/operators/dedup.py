"""Exact and near deduplication, keep-first by a given order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import once, strip
from ..plans.storage import discarded, stored


#: Shingles that are hashed by all permutations at a time.
STEP = 256


def exact_key(text: Column) -> Column:
    return F.lower(strip(text))


def mark_exact(df: DataFrame, text: Column, order: Sequence[str]) -> DataFrame:
    """Adds ``is_exact_dup``: an earlier row has the same text but for case and outer white space.

    The key is a 256-bit digest, so what is shuffled does not grow with the
    texts, and its first row is found by a partial aggregation: a text that
    most rows share leaves each task as one row. Rows without a text are none.
    """
    keyed = df.withColumn("__key", once(F.sha2(exact_key(text), 256))).withColumn("__at", F.struct(*order))
    first = keyed.where("__key is not null").groupBy("__key").agg(F.min("__at").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    return keyed.join(first, "__key", "left").withColumn("is_exact_dup", F.coalesce(F.col("__at") > F.col("__first"), F.lit(False))).drop("__key", "__at", "__first", "__n")


def exact_stats(marked: DataFrame, text: Column) -> DataFrame:
    n = F.count(text)
    dup = F.count(F.when(F.col("is_exact_dup") & text.isNotNull(), 1))
    return marked.agg(
        n.alias("total_checked"), (n - dup).alias("unique_count"), dup.alias("duplicate_count"),
        (F.floor(dup / F.greatest(n, F.lit(1)) * 1e4 + 0.5) / 1e4).alias("duplicate_ratio"),
    )


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct k-character substrings; a shorter text is one of its own."""
    own = exact_key(text)
    return F.when(F.length(own) < k, F.array(own)).otherwise(F.array_distinct(F.regexp_extract_all(own, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))))


def _hashes(text: str, k: int) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(cp) - k + 1, 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(k, len(cp))):
        h = h * np.uint64(0x100000001B3) + cp[i : i + n]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return np.unique(h ^ (h >> np.uint64(31)))


def band_keys(df: DataFrame, id_cols: Sequence[str], text_col: str, cfg: Config) -> DataFrame:
    """A row for each band of each text's MinHash signature."""
    rng = np.random.default_rng(cfg.seed)
    n = cfg.bands * cfg.rows
    # multiplication by a random odd number permutes the hashes, and its order is that of the high bits
    a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    k, bands, rows = cfg.shingle, cfg.bands, cfg.rows
    ids = list(id_cols)
    if n > cfg.permutations:
        raise ValueError("bands * rows must not exceed the permutations")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = np.zeros((len(pdf), bands), np.int64)
            space = np.empty((STEP, n), np.uint32)  # small enough to stay in a core's cache
            for i, t in enumerate(pdf["__text"]):
                h = (_hashes(t, k) >> np.uint64(32)).astype(np.uint32)
                least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
                for s in range(0, len(h), STEP):
                    part = h[s : s + STEP, None]
                    now = np.multiply(part, a, out=space[: len(part)])
                    now += b
                    np.minimum(least, now.min(axis=0), out=least)
                least = least.astype(np.uint64)
                mixed = np.zeros(bands, np.uint64)
                for r in range(rows):
                    mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ least.reshape(bands, rows)[:, r]
                out[i] = mixed.view(np.int64)
            flat = pdf[ids].loc[pdf.index.repeat(bands)].reset_index(drop=True)
            flat["band"] = np.tile(np.arange(bands, dtype=np.int32), len(pdf))
            flat["bucket"] = out.reshape(-1)
            yield flat

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ids) + ", band int, bucket bigint"
    own = df.select(*ids, exact_key(F.col(text_col)).alias("__text")).where("__text is not null")
    return own.mapInPandas(run, schema)


def mark_near(df: DataFrame, text_col: str, order: str, cfg: Config) -> DataFrame:
    """Adds ``is_near_dup`` by greedy LSH: a row is one if an earlier row that is none shares a bucket with it.

    ``order`` is a unique column. Rows settle in rounds: one that comes first
    among the open rows of all its buckets is kept, and with it all other rows
    of those buckets are settled as duplicates, so what is left never meets a
    settled row again. A round looks at each bucket's least row only, writes
    only the rows that are still open, and no pair of a bucket is ever written
    out; a bucket that most rows share aggregates before its shuffle.
    """
    bucket = ["band", "bucket"]
    buckets = stored(band_keys(df, [order], text_col, cfg), "buckets")
    # a row alone in all its buckets is kept; only shared buckets take part in the rounds
    shared = buckets.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").select(*bucket)
    live = stored(buckets.join(shared, bucket, "left_semi"), "open")
    discarded(buckets)
    dups = []
    while not live.isEmpty():
        least = live.groupBy(*bucket).agg(F.min(order).alias("u"))
        firsts = live.join(least, bucket).groupBy(order).agg(F.min(F.col("u") == F.col(order)).alias("first")).where("first").select(order)
        done = live.join(firsts, order, "left_semi").select(*bucket).distinct()
        settled = live.join(done, bucket, "left_semi").groupBy(order).agg(F.lit(True).alias("settled")).join(firsts.withColumn("kept", F.lit(True)), order, "left")
        settled = stored(settled.select(order, F.coalesce("kept", F.lit(False)).alias("kept")), "settled")
        dups.append(settled.where("not kept").select(order))
        rest = stored(live.join(settled, order, "left_anti"), "open")
        discarded(live)
        live = rest
    discarded(live)
    if not dups:
        return df.withColumn("is_near_dup", F.lit(False))
    found = reduce(DataFrame.union, dups).withColumn("__dup", F.lit(True))
    return df.join(found, order, "left").withColumn("is_near_dup", F.coalesce("__dup", F.lit(False))).drop("__dup")


def near_stats(marked: DataFrame) -> DataFrame:
    n, dup = F.count("*"), F.count(F.when(F.col("is_near_dup"), 1))
    return marked.agg(n.alias("total_checked"), (n - dup).alias("unique_count"), dup.alias("near_duplicate_count"))


def first_rows(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy("__key").orderBy(*order)
    return df.withColumn("__key", key).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__key", "__n")
