"""Repetition inside a document, kept as a ledger of rule bits.

Every rule is evaluated once per document in one pass over its text. The
ledger holds the measurements and one failure bit per rule; a policy is a
versioned mask over those bits, so changing what is rejected, or asking what a
rule adds to the others, never reads the texts again: both are bitwise
aggregations over the ledger.

Defined results: a document without words has shares of 0 and no bit; null,
empty and blank texts and rows without an id are not in the ledger; rows that
repeat an id give a row each; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import U64, Block, arrow, docs_in, first_of_runs, mix, read

GRAM = 5


@dataclass(frozen=True)
class Rule:
    """Fails where ``measure`` is at least ``limit`` and the document has ``least`` words."""

    bit: int
    name: str
    measure: str
    limit: float
    least: int = 0


RULES = (
    Rule(0, "repeated_words", "repeated_word_share", 0.30),
    Rule(1, "repeated_lines", "repeated_line_share", 0.30, 20),
    Rule(2, "repeated_line_chars", "repeated_line_char_share", 0.20, 20),
    Rule(3, "repeated_paragraphs", "repeated_paragraph_share", 0.30, 20),
    Rule(4, "repeated_sentences", "repeated_sentence_share", 0.30, 20),
    Rule(5, "top_trigram", "top_trigram_share", 0.18, 20),
)

#: Policies by (name, version): the rules that reject a document.
POLICIES = {
    ("five_word_runs", 1): ("repeated_words",),
    ("strict", 1): ("repeated_words", "repeated_lines", "repeated_paragraphs"),
    ("strict", 2): tuple(r.name for r in RULES),
}

MEASURES = ("repeated_word_share", "repeated_line_share", "repeated_line_char_share", "repeated_paragraph_share", "repeated_sentence_share", "top_trigram_share")
LEDGER = "doc_id bigint, n_words bigint, " + ", ".join(f"{m} double" for m in MEASURES) + ", fail_bits bigint"


def later_occurrences(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True for an item whose value stands at an earlier place of the same document."""
    if not len(value):
        return np.zeros(0, bool)
    key = mix(value ^ mix(doc.astype(U64) + U64(0x51ED270B)))
    order = np.argsort(key)
    new = first_of_runs(key[order])
    earliest = np.minimum.reduceat(order, np.flatnonzero(new))
    out = np.ones(len(value), bool)
    out[earliest] = False
    return out


def top_share(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Of each document, the count of its most frequent value."""
    out = np.zeros(n)
    if len(value):
        key = mix(value ^ mix(doc.astype(U64) + U64(0x51ED270B)))
        order = np.argsort(key)
        at = np.flatnonzero(first_of_runs(key[order]))
        np.maximum.at(out, doc[order[at]], np.diff(np.append(at, len(order))))
    return out


def grams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each run of n words within a document."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    m = len(h) - n + 1
    g = h[:m].copy()
    for i in range(1, n):
        g = g * U64(0xD6E8FEB86659FD93) + h[i : i + m]
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return at, g[at]


def measure(block: Block) -> dict[str, np.ndarray]:
    n = block.n
    _, _, h, doc = block.words()
    words = np.bincount(doc, minlength=n)
    at, g = grams(h, doc, GRAM)
    hit = at[later_occurrences(doc[at], g)]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + GRAM, -1)
    repeated = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    out = {"n_words": words, "repeated_word_share": repeated / np.maximum(words, 1)}

    folded = block.prefix(mix(block.cp))
    s, e, line_doc, _ = block.lines()
    size = e - s
    blank = np.add.reduceat((block.cp > 32) & ~block._is_end(), s) == 0
    use = np.flatnonzero((size > 0) & ~blank)
    again = later_occurrences(line_doc[use], block.span_hash(folded, s[use], e[use]))
    lines = np.bincount(line_doc[use], minlength=n)
    chars = np.bincount(line_doc[use], size[use], minlength=n)
    out["repeated_line_share"] = np.bincount(line_doc[use][again], minlength=n) / np.maximum(lines, 1)
    out["repeated_line_char_share"] = np.bincount(line_doc[use][again], size[use][again], minlength=n) / np.maximum(chars, 1)

    # A paragraph is a run of non-blank lines, a sentence ends at . ! ? or the paragraph's line.
    starts = use[np.concatenate(([True], (np.diff(use) > 1) | (np.diff(line_doc[use]) > 0)))[: len(use)]]
    last = np.append(np.searchsorted(use, starts)[1:], len(use)) - 1 if len(use) else np.zeros(0, np.int64)
    ps, pe = s[starts], e[use[last]] if len(use) else s[:0]
    p_doc = line_doc[starts]
    again = later_occurrences(p_doc, block.span_hash(folded, ps, pe))
    out["repeated_paragraph_share"] = np.bincount(p_doc[again], minlength=n) / np.maximum(np.bincount(p_doc, minlength=n), 1)

    cp = block.cp
    stop = (cp == 46) | (cp == 33) | (cp == 63) | (cp == 0x2026)
    stop[:-1] &= (cp[1:] == 32) | (cp[1:] == 10) | block._is_end()[1:]
    cut = np.flatnonzero(stop | (cp == 10) | block._is_end())
    ss = np.concatenate(([0], cut[:-1] + 1)).astype(np.int64)
    ss += (cp[ss] == 32) & (ss < cut)
    s_doc = np.searchsorted(block.end, cut, side="left")
    keep = cut - ss > 1
    again = later_occurrences(s_doc[keep], block.span_hash(folded, ss[keep], cut[keep]))
    out["repeated_sentence_share"] = np.bincount(s_doc[keep][again], minlength=n) / np.maximum(np.bincount(s_doc[keep], minlength=n), 1)

    at, g = grams(h, doc, 3)
    out["top_trigram_share"] = 3 * top_share(doc[at], g, n) / np.maximum(words, 3)
    bits = np.zeros(n, np.int64)
    for r in RULES:
        bits |= ((out[r.measure] >= r.limit) & (words >= max(r.least, 1))).astype(np.int64) << r.bit
    return out | {"fail_bits": bits}


def _ledger(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, block in read(batches):
        yield arrow({"doc_id": ids} | measure(block))


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measurements and a bit for each rule that it fails."""
    return docs_in(df, id_col, text_col).mapInArrow(_ledger, LEDGER)


def mask(policy: str, version: int) -> int:
    names = POLICIES[policy, version]
    return sum(1 << r.bit for r in RULES if r.name in names)


def rejected(book: DataFrame, policy: str, version: int) -> DataFrame:
    """The ledger's rows that a policy rejects."""
    return book.where(F.col("fail_bits").bitwiseAND(F.lit(mask(policy, version))) != 0)


def ablation(book: DataFrame) -> DataFrame:
    """What each policy rejects, and what each of its rules adds to the others.

    The documents are first counted by their bits, of which there are at most
    2 ** rules, so a single small shuffle serves all policies.
    """
    by_bits = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rows = [
        F.struct(F.lit(p).alias("policy"), F.lit(v).alias("version"), F.lit(r.name).alias("rule"), F.lit(mask(p, v)).cast("bigint").alias("mask"), F.lit(1 << r.bit).cast("bigint").alias("bit"))
        for (p, v), names in POLICIES.items()
        for r in RULES
        if r.name in names
    ]
    failing = F.col("fail_bits").bitwiseAND(F.col("p.mask"))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return (
        by_bits.withColumn("p", F.explode(F.array(*rows)))
        .groupBy("p.policy", "p.version", "p.rule")
        .agg(
            count(failing != 0)("rejected_by_policy"),
            count(failing.bitwiseAND(F.col("p.bit")) != 0)("failed_rule"),
            count(failing == F.col("p.bit"))("rejected_by_rule_alone"),
        )
    )
