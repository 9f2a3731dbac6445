"""Vectorised text primitives shared by the training-data operators.

Documents of an Arrow batch are joined into one code point array, and every
step (character classes, words, rolling hashes, minimisers) is a numpy pass
over that array, so the cost of a character is a few nanoseconds and no Python
loop runs per word or per window. Blocks are cut at ``BLOCK_CHARS`` so that a
worker's memory does not depend on the batch; a longer document is a block of
its own and is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 19
#: Documents of a block, so that keys which pack a document's number beside other bits never run over.
BLOCK_DOCS = 4096
#: Highest code point with an entry in the character tables (end of the CJK extensions).
TABLE_END = 0x323B0
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread bits from any integer array."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """True for letters and digits; the last entry stands for all code points beyond."""
    table = np.fromiter((chr(i).isalnum() for i in range(TABLE_END)), bool, TABLE_END)
    table[-1] = False
    return table


@lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """Code point of the lower-case letter; i, dotless i and their capitals are one."""
    table = np.arange(TABLE_END, dtype=np.uint32)
    for i in range(TABLE_END):
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = min(ord(low), TABLE_END - 1)
    for c in "Iıİ":
        table[ord(c)] = ord("i")
    return table


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    table = np.fromiter((chr(i).isalpha() for i in range(TABLE_END)), bool, TABLE_END)
    table[-1] = False
    return table


#: Bits of a trigram's hash.
TRIGRAM_BITS = 20


def trigrams(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of letters, and a hash of each with its neighbours, without case; what is no letter is one neighbour."""
    letter = letter_table()[cp]
    c = np.where(letter, fold_table()[cp], 0).astype(U64)
    before = np.concatenate((np.zeros(1, U64), c[:-1]))
    after = np.concatenate((c[1:], np.zeros(1, U64)))
    return letter, (mix(before << U64(40) | c << U64(20) | after) & U64((1 << TRIGRAM_BITS) - 1)).astype(np.int64)


class _Powers:
    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, b in (("up", _BASE), ("down", _INVERSE)):
                    p = np.full(size, b, U64)
                    p[0] = 1
                    setattr(self, name, np.cumprod(p))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Block:
    """Some documents as one code point array, a NUL after each.

    ``cp`` holds the code points, ``start`` and ``end`` each document's bounds
    in it, ``index`` the document's position in the caller's list.
    """

    def __init__(self, texts: Sequence[str], first: int) -> None:
        self.texts = texts
        joined = "\0".join(texts) + "\0"
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths
        self.first = first
        self.n = len(texts)

    def clipped(self) -> np.ndarray:
        return np.minimum(self.cp, TABLE_END - 1)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of values[i] * BASE**i, one longer than values."""
        up, _ = _powers.upto(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[:-1], out=out[1:])
        return out

    @staticmethod
    def span_hash(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hash of values[s:e]; equal spans have equal hashes wherever they stand."""
        _, down = _powers.upto(len(prefix))
        return mix((prefix[e] - prefix[s]) * down[s])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash, document) of each run of letters and digits; hashes ignore case."""
        cp = self.clipped()
        is_word = alnum_table()[cp]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False]))))
        s, e = edge[::2], edge[1::2]
        h = self.span_hash(self.prefix(mix(fold_table()[cp])), s, e)
        return s, e, h, np.searchsorted(self.end, s, side="left")

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, document, number) of each line, separated by a line feed."""
        stop = np.flatnonzero((self.cp == 10) | self._is_end())
        s = np.concatenate(([0], stop[:-1] + 1)).astype(np.int64)
        doc = np.searchsorted(self.end, stop, side="left")
        first = np.searchsorted(doc, np.arange(self.n), side="left")
        return s, stop, doc, np.arange(len(stop)) - first[doc]

    def _is_end(self) -> np.ndarray:
        mark = np.zeros(len(self.cp), bool)
        mark[self.end] = True
        return mark


def blocks(texts: Sequence[str], size: int = BLOCK_CHARS) -> Iterator[Block]:
    """Cut a list of texts into blocks of about ``size`` characters and at most ``BLOCK_DOCS`` texts."""
    first = chars = 0
    for i, t in enumerate(texts):
        if i > first and (chars + len(t) > size or i - first == BLOCK_DOCS):
            yield Block(texts[first:i], first)
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        yield Block(texts[first:], first)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w values, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[w - span : w - span + n])


def first_of_runs(x: np.ndarray) -> np.ndarray:
    """Mask of the places where a sorted array takes a new value."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, U64).view(np.int64)


def docs_in(df: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """Only what an operator reads, under names of its own: other columns never meet its own.

    A row without an id or a text takes no part; texts of white space only are
    left out by the readers, for they know all of Unicode's.
    """
    out = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    return out.where("doc_id is not null and text is not null and text <> ''")


def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """Ids and texts of the rows that have a text."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    texts = batch.column(1).to_pylist()
    keep = [i for i, t in enumerate(texts) if t and not t.isspace()]
    if len(keep) < len(texts):
        return ids[keep], [texts[i] for i in keep]
    return ids, texts


def read(batches: Iterable[pa.RecordBatch], size: int = BLOCK_CHARS) -> Iterator[tuple[np.ndarray, Block]]:
    """Ids of the documents and their block, for each block of each batch."""
    for batch in batches:
        ids, texts = rows_of(batch)
        for block in blocks(texts, size):
            yield ids[block.first : block.first + block.n], block


def arrow(columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
