"""Mixing sources to target shares of tokens, by Pareto order sampling.

A mixture of T tokens wants ``share * T`` of each source. Each document of the
source is expected ``m = min(c * weight, max_repeats)`` times, with c such that
the expected tokens are those wanted. The whole part of m is allotted for
certain; the fraction p is an inclusion probability, and a sample of fixed size
in tokens is drawn by Pareto order sampling: documents are ranked by their
random odds over their inclusion odds, u / (1 - u) : p / (1 - p), and taken in
that order until the size is reached. The random numbers are hashes of the
seed and the id, so a mixture can be drawn again.

Without a size, T is the largest at which no source that has documents needs
more than its repeats. With ``once_per_text`` a text that stands k times weighs
1 / k; else all documents weigh the same.

Sources, weight levels and rank bins are counted by partial aggregation, so a
source that holds most rows is never one task: the bin in which the size is
reached is counted in bins of its own, and of those only the one in which it is
reached, a millionth of the ranks, is ordered row by row. Spellings of a source (case, outer blanks,
hyphens) are one; documents of other sources, and null, empty and blank texts,
take no part; a source without documents is reported with a share of 0; rows
that repeat an id are ranked alike; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import bounded, stored
from .textvec import arrow, docs_in, rows_of

#: Where the cluster keeps the rank file; a parameter, as is the pattern.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: splits text before the merges, as the rank file was made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows that a table of targets may have.
TARGETS = 10_000
BINS = 1024
#: Levels to a doubling of the weight.
LEVELS = 64
LONGEST = 100_000


def canonical(source: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(source)), "-", "_")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: A space between two other characters: a token may begin there but none goes on across it, whatever stands around.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def _count(encoding, text: str) -> int:
    """Tokens of a text; a very long one is encoded in pieces that end where a token must."""
    n = at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + LONGEST) if len(text) - at > LONGEST else None
        end = cut.start() if cut else len(text)
        n += len(encoding.encode_ordinary(text[at:end]))
        at = end
    return n


def _sizes(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for batch in batches:
            ids, texts = rows_of(batch)
            sources = [s for s, t in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True) if t and not t.isspace()]
            yield arrow({
                "doc_id": ids, "source": pa.array(sources, pa.string()), "n_tokens": np.array([_count(encoding, t) for t in texts], np.int64),
                "digest": pa.array([hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts], pa.binary()),
            })

    return run


def sizes(df: DataFrame, sources: list[str], id_col: str, text_col: str, source_col: str, ranks: str, once_per_text: bool = False) -> DataFrame:
    """(doc_id, source, n_tokens, weight) of the documents of the given sources."""
    docs = docs_in(df, id_col, text_col, canonical(F.col(source_col).cast("string")).alias("source")).where(F.col("source").isin(sources))
    counted = stored(docs.mapInArrow(_sizes(ranks), "doc_id bigint, source string, n_tokens bigint, digest binary"), "sizes")
    if not once_per_text:
        return counted.select("doc_id", "source", "n_tokens", F.lit(1.0).alias("weight"))
    copies = counted.groupBy("source", "digest").agg(F.count("*").alias("k")).where("k > 1")
    return counted.join(copies, ["source", "digest"], "left").select("doc_id", "source", "n_tokens", (1 / F.coalesce("k", F.lit(1))).alias("weight"))


def _factor(levels: list[tuple[float, int]], wanted: float, repeats: int) -> float:
    """c with sum(min(c * weight, repeats) * tokens) = wanted; the largest useful where all is not enough."""
    levels = sorted(levels, reverse=True)
    rest = wanted
    open_tokens = sum(w * t for w, t in levels)
    for w, t in levels:
        c = rest / open_tokens if open_tokens > 0 else float("inf")
        if c * w <= repeats:
            return c
        rest -= repeats * t
        open_tokens -= w * t
        if rest <= 0:
            break
    return repeats / min(w for w, _ in levels)


def _plan(rows: list, targets: dict[str, tuple[float, int]], size: float | None) -> tuple[float, dict[str, float]]:
    tokens: dict[str, int] = {}
    levels: dict[str, list[tuple[float, int]]] = {}
    for source, level, n in rows:
        tokens[source] = tokens.get(source, 0) + n
        levels.setdefault(source, []).append((2.0 ** (level / LEVELS), n))
    if size is None:
        size = min((targets[s][1] * n / targets[s][0] for s, n in tokens.items() if targets[s][0] > 0), default=0.0)
    return size, {s: _factor(levels[s], targets[s][0] * size, targets[s][1]) for s in tokens}


def selection(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: float | None = None, seed: int = 1, ranks: str = RANKS, once_per_text: bool = False) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of the mixture of about ``tokens`` tokens."""
    spark = df.sparkSession
    rows = targets.select(canonical(F.col("source").cast("string")), F.col("target_share").cast("double"), F.col("max_repeats").cast("int"))
    wanted: dict[str, tuple[float, int]] = {}
    for name, share, repeats in bounded(rows, TARGETS, "targets"):
        if name is not None and share is not None and repeats is not None and share > 0 and repeats > 0:
            old = wanted.get(name, (0.0, 0))
            wanted[name] = (old[0] + share, max(old[1], repeats))
    # weights are levels from here on, so that what the driver sees is bounded by sources and levels
    sized = sizes(df, sorted(wanted), id_col, text_col, source_col, ranks, once_per_text).withColumn("level", F.round(F.log2(F.greatest("weight", F.lit(2.0**-40))) * LEVELS).cast("int"))
    sized = stored(sized, "weights")
    total, factors = _plan(sized.groupBy("source", "level").agg(F.sum("n_tokens")).collect(), wanted, tokens)
    plan = F.broadcast(spark.createDataFrame([(s, wanted[s][0] * total, c, wanted[s][1]) for s, c in factors.items()], "source string, wanted double, factor double, repeats int"))

    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    expected = F.least(F.col("factor") * F.pow(F.lit(2.0), F.col("level") / LEVELS), F.col("repeats").cast("double"))
    drawn = (
        sized.join(plan, "source")
        .withColumn("m", expected)
        # a fraction within rounding of a whole copy is the whole copy
        .withColumn("whole", F.floor(F.col("m") + 1e-9)).withColumn("p", F.greatest(F.col("m") - F.col("whole"), F.lit(0.0)))
        .withColumn("rank", F.when(F.col("p") > 1e-9, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))))
        .withColumn("fine", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS * BINS).cast("bigint")).withColumn("bin", F.floor(F.col("fine") / BINS))
    )
    by_source = drawn.groupBy("source").agg((F.first("wanted") - F.sum(F.col("whole") * F.col("n_tokens"))).alias("rest"))
    ranked = drawn.where("rank is not null")

    def edge(bins: DataFrame, column: str) -> DataFrame:
        """Of each source the bin in which its size is reached, and the tokens before it; ``bins`` has at most BINS rows a source."""
        order = Window.partitionBy("source").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("base") + F.coalesce(F.sum("n").over(order), F.lit(0))
        rows = bins.select("source", column, "rest", before.alias("before")).where("before < rest")
        return rows.groupBy("source").agg(F.max(column).alias("edge"), F.max_by("before", column).alias("base"), F.first("rest").alias("rest"))

    coarse = edge(ranked.groupBy("source", "bin").agg(F.sum("n_tokens").alias("n"), F.lit(0).alias("base")).join(by_source, "source"), "bin")
    inner = ranked.join(F.broadcast(coarse), "source").where("bin = edge").groupBy("source", "fine").agg(F.sum("n_tokens").alias("n"), F.first("base").alias("base"), F.first("rest").alias("rest"))
    chosen = drawn.join(F.broadcast(edge(inner, "fine")), "source", "left")  # one row a source
    at_edge = F.coalesce(F.col("fine") == F.col("edge"), F.lit(False))
    inside = chosen.where(~at_edge).withColumn("taken", F.coalesce((F.col("fine") < F.col("edge")).cast("int"), F.lit(0)))
    ordered = Window.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a document is taken where at least half of it fits
    last = chosen.where(at_edge).withColumn("taken", (F.col("base") + F.sum("n_tokens").over(ordered) - F.col("n_tokens") / 2 <= F.col("rest")).cast("int"))
    copies = (F.col("whole") + F.col("taken")).cast("int").alias("copies")
    out = [x.select("doc_id", "source", "n_tokens", copies) for x in (inside, last)]
    return out[0].union(out[1]).where("copies > 0")


def report(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each source its target, and the share of tokens, documents and copies it reached."""
    reached = chosen.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"), F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"))
    every = targets.select(canonical(F.col("source").cast("string")).alias("source"), F.col("target_share").cast("double").alias("target_share"), "max_repeats").where("source is not null")
    every = every.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = every.join(reached, "source", "left").select("source", "target_share", "max_repeats", zero("n_docs"), zero("n_copies"), zero("most_copies"), zero("n_tokens"))
    # the window is over the report's rows, one for each source
    return rows.withColumn("share", F.col("n_tokens") / F.greatest(F.sum("n_tokens").over(Window.partitionBy(F.lit(0))), F.lit(1)))
