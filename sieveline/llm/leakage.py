"""Evaluation passages in training text, through suffix arrays of its shards.

Each block of documents is a shard: its words become ranks, prefix doubling
sorts the suffixes, and every suffix of every evaluation item is searched in
the array, one word deeper at a time, by binary search within the interval the
words before left. What is left at depth ``MIN_WORDS`` are the documents that
hold the passage; the match is then followed to its full length. A document
never spans two shards and a suffix never leaves its document, so shards need
no exchange.

The evaluation texts become word hashes in files of the shared folder, a group
of about ``GROUP_CHARS`` characters each, which Spark copies to every machine
once. A task sorts the suffixes of a shard once and searches it for one group
after the other, so documents are read once whatever the number of items, and
neither the driver nor the plan holds any of them.

Defined results: null, empty and blank texts on either side match nothing, nor
do items of fewer words than ``MIN_WORDS``; items with equal texts are each
reported; rows that repeat an id give one row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import listed, stored
from .textvec import Block, arrow, blocks, docs_in, first_of_runs, rows_of, signed

MIN_WORDS = 10
#: Characters of evaluation text that a task holds at a time, as word hashes.
GROUP_CHARS = 8_000_000
#: Characters of a shard.
SHARD_CHARS = 1 << 21
#: Depth in words to which suffixes are sorted; matches are followed beyond it.
DEPTH = 16

FOUND = "doc_id bigint, item_id bigint, n_words int, item_word int, start bigint"


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``rank`` by their first DEPTH values."""
    step, r = 1, rank.astype(np.uint64)
    while True:
        nxt = np.zeros(len(r), np.uint64)
        nxt[: len(r) - step] = r[step:] + np.uint64(1)
        key = (r << np.uint64(32)) | nxt
        order = np.argsort(key)
        step *= 2
        if step >= DEPTH:
            return order
        new = first_of_runs(key[order])
        r = np.empty(len(key), np.uint64)
        r[order] = np.cumsum(new).astype(np.uint64)
        if new.all():
            return order


def _narrow(words: Callable[[np.ndarray], np.ndarray], lo: np.ndarray, hi: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each value within its own interval of the array."""
    lo, hi = lo.copy(), hi.copy()
    while (live := lo < hi).any():
        mid = (lo + hi) >> 1
        w = words(np.minimum(mid, hi - 1).clip(0))
        below = live & ((w <= value) if right else (w < value))
        lo = np.where(below, mid + 1, lo)
        hi = np.where(live & ~below, mid, hi)
    return lo


class Items:
    """Words of some evaluation items, with a gap of no word after each item."""

    def __init__(self, rows: Iterable[tuple[int, np.ndarray]]) -> None:
        hashes, item, place, length = [], [], [], []
        for number, own in rows:
            if len(own) >= MIN_WORDS:
                hashes += [own, np.zeros(1, np.uint64)]
                item.append(np.full(len(own) + 1, number))
                place.append(np.arange(len(own) + 1))
                length.append(len(own) - np.arange(len(own) + 1))
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.hash, self.item, self.place, self.left = cat(hashes, np.uint64), cat(item, np.int64), cat(place, np.int64), cat(length, np.int64)


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of each item; items of too few words have no row."""
    for batch in batches:
        ids, texts = rows_of(batch)
        for block in blocks(texts):
            _, _, h, doc = block.words()
            bounds = np.searchsorted(doc, np.arange(block.n + 1))
            keep = np.flatnonzero(np.diff(bounds) >= MIN_WORDS)
            yield arrow({
                "item_id": ids[block.first + keep],
                "words": pa.array([signed(h[bounds[i] : bounds[i + 1]]) for i in keep], pa.list_(pa.int64())),
            })


class Shard:
    """A block of documents with the suffix array of its words."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.s, _, h, self.doc = block.words()
        self.known, rank = np.unique(h, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        cut = np.flatnonzero(np.diff(self.doc)) + 1
        self.at = np.insert(np.arange(len(h)), cut, -1)  # the gaps between documents
        self.text = np.concatenate((np.insert(rank, cut, 0), np.zeros(DEPTH, np.int64)))
        self.sa = suffix_array(self.text[:-DEPTH]) if len(h) else np.zeros(0, np.int64)


def search(shard: Shard, items: Items) -> dict[str, np.ndarray]:
    """The longest match of each item in each document of a shard."""
    known, text, sa, at, doc = shard.known, shard.text, shard.sa, shard.at, shard.doc
    empty = {k: np.zeros(0, np.int64) for k in ("doc", "item_id", "n_words", "item_word", "start")}
    if not len(known) or not len(items.hash):
        return empty
    found = np.searchsorted(known, items.hash)
    same = known[np.minimum(found, len(known) - 1)] == items.hash
    ids = np.where(same & (items.left > 0), found + 1, -1)
    ids = np.concatenate((ids, np.full(DEPTH, -1)))
    q = np.flatnonzero(items.left >= MIN_WORDS)
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(sa))
    for depth in range(MIN_WORDS):
        value = ids[q + depth]
        keep = value >= 0
        q, lo, hi, value = q[keep], lo[keep], hi[keep], value[keep]
        word = lambda i, d=depth: text[sa[i] + d]
        lo, hi = _narrow(word, lo, hi, value, False), _narrow(word, lo, hi, value, True)
        keep = lo < hi
        q, lo, hi = q[keep], lo[keep], hi[keep]
        if not len(q):
            return empty
    n = hi - lo
    which = np.repeat(np.arange(len(q)), n)
    place = sa[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    q = q[which]
    length = np.full(len(q), MIN_WORDS)
    live = np.arange(len(q))
    padded = np.concatenate((ids, [-1]))
    while len(live):
        a, b = q[live] + length[live], place[live] + length[live]
        go = (a < len(padded)) & (b < len(text))
        go[go] = (padded[a[go]] >= 0) & (padded[a[go]] == text[b[go]])
        live = live[go]
        length[live] += 1
    d = doc[at[place]]
    order = np.lexsort((items.place[q], -length, items.item[q], d))
    d, item = d[order], items.item[q][order]
    best = order[first_of_runs(d) | first_of_runs(item)]
    p = at[place[best]]
    return {"doc": doc[p], "item_id": items.item[q[best]], "n_words": length[best], "item_word": items.place[q[best]], "start": shard.s[p] - shard.block.start[doc[p]]}


def _held(name: str) -> Items:
    """A group of items, from the copy of its file that Spark brought to this machine."""
    table = pq.read_table(SparkFiles.get(name))
    words = table.column("words").combine_chunks()
    values, offsets = words.values.to_numpy(zero_copy_only=False).view(np.uint64), words.offsets.to_numpy(zero_copy_only=False)
    return Items((number, values[offsets[i] : offsets[i + 1]]) for i, number in enumerate(table.column("item_id").to_pylist()))


def _finder(names: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _held(names[0]) if len(names) == 1 else None
        for batch in batches:
            ids, texts = rows_of(batch)
            for block in blocks(texts, SHARD_CHARS):
                shard = Shard(block)
                for name in names:
                    hits = search(shard, only or _held(name))
                    doc = hits.pop("doc")
                    yield arrow({"doc_id": ids[block.first + doc]} | {k: v.astype(np.int64 if k in ("item_id", "start") else np.int32) for k, v in hits.items()})

    return run


def matches(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The longest passage of each item in each document that holds one of MIN_WORDS words.

    ``n_words`` is its length, ``item_word`` the item's word it begins at and
    ``start`` its first code point in the document.
    """
    spark = df.sparkSession
    own = docs_in(items, item_col, item_text_col)
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    groups = own.mapInArrow(_words, "item_id bigint, words array<bigint>").distinct().repartition(max(1, -(-chars // GROUP_CHARS)), "item_id")
    table = stored(groups, "items")
    names = []
    for name in listed(spark, table.stored_at):
        if name.endswith(".parquet"):
            spark.sparkContext.addFile(f"{table.stored_at}/{name}")
            names.append(name)
    found = docs_in(df, id_col, text_col).mapInArrow(_finder(names), FOUND)
    return found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_words", "item_word", "start"), F.struct("n_words", -F.col("start"))).alias("m")).select("doc_id", "item_id", "m.*")


def leaked_items(found: DataFrame, items: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Of each item, the documents it leaked into and its longest leaked passage."""
    counts = found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("n_words").alias("longest_words"))
    ids = items.select(F.col(item_col).cast("bigint").alias("item_id")).where("item_id is not null").distinct()
    return ids.join(counts, "item_id", "left").select("item_id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("longest_words", F.lit(0)).alias("longest_words"))


def without_leaks(df: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents, whole rows, that hold no evaluation passage."""
    bad = found.select(F.col("doc_id").alias("__leaked")).distinct()
    return df.join(bad, df[id_col] == bad["__leaked"], "left_anti")
