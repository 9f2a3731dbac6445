"""Per-document text statistics as partial counts of chunks, and what they say of a document's kind.

A document is cut into chunks of ``CHUNK`` characters; most have one. A chunk's
counts are a state that merges with its neighbour's: sums for all lines that
are whole, the line it begins in and the line it ends in as open sums, and the
word pieces at its two ends, so a word or a line that was cut counts once, with
its own properties. A document of one chunk is whole with it; the states of
others merge up a tree of ``FAN`` chunks a node, so no task ever holds them.
Characters whose class depends on their neighbours see two characters beyond
the cut. A chunk that looks like no language is also counted with look-alike
letters folded and wrong decodings undone, and both counts go up the tree; the
kind of a document that looks like no language is taken from the latter.

The common words and the letter trigrams that make a word look like one come
from two fixed tables, the common words and the labelled passages, which may
have ``FIXED_ROWS`` and ``labels.PASSAGES`` rows.

Defined results, the same at every length: null, empty and blank texts and rows
without an id give no row; rows that repeat an id give a row each; other
columns of the input are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import bounded, stored
from . import confusables, decoding, labels
from .textvec import TABLE_END, TRIGRAM_BITS, Block, alnum_table, arrow, blocks, docs_in, trigrams

CHUNK = 1 << 13
FAN = 32
CONTEXT = 2
FIXED_ROWS = 100_000
PIECE = 40

#: Sums of a line.
LINE = ("chars", "solid", "letters", "known", "words", "word_chars", "stop", "pipe", "semicolon", "tab", "comma", "gap", "ends", "digits", "symbols", "bullet", "closed")
#: Sums of a document's whole lines.
DOC = (
    "chars", "solid", "letters", "known", "words", "word_chars", "stop", "digits", "symbols",
    "lines", "filled", "closed_lines", "bullet_lines", "prose_lines", "prose_chars", "row_lines", "row_chars", "item_lines", "item_chars",
)
_L = {k: i for i, k in enumerate(LINE)}
_BULLETS = "-*•–·▸●■▪◦»›+"


@dataclass(frozen=True)
class Limits:
    """Bounds of the kinds; shares are of a document's characters other than white space."""

    junk_known: float = 0.30
    look_closer: float = 0.55
    rows_share: float = 0.50
    prose_share: float = 0.30
    least_items: int = 3


@lru_cache(maxsize=1)
def _digits() -> np.ndarray:
    return np.fromiter((chr(i).isdigit() for i in range(TABLE_END)), bool, TABLE_END)


@lru_cache(maxsize=1)
def _spaces() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(TABLE_END)), bool, TABLE_END)


class Language:
    """The common words and known trigrams, as arrays."""

    def __init__(self, words: Iterable[str], passages: Iterable[str]) -> None:
        self.stop = np.unique(np.concatenate([b.words()[2] for b in blocks(sorted(set(words)) or [""])]))
        self.known = np.zeros(1 << TRIGRAM_BITS, bool)
        for b in blocks(sorted(passages)):
            letter, t = trigrams(b.clipped())
            self.known[t[letter]] = True

    def is_stop(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.stop, hashes)
        return self.stop[np.minimum(at, len(self.stop) - 1)] == hashes if len(self.stop) else np.zeros(len(hashes), bool)


def line_sums(block: Block, language: Language, left: np.ndarray | None = None, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sums, document) of each line; ``left`` and ``right`` are characters of context that are not counted."""
    cp = block.clipped()
    n = len(cp)
    inside = ~block._is_end() & (cp != 10)
    counted = np.ones(n, bool)
    if left is not None:
        for k in range(CONTEXT):
            counted[np.minimum(block.start + k, n - 1)[left > k]] = False
            counted[np.maximum(block.end - 1 - k, 0)[right > k]] = False
        # context takes no part in lines: its line feeds are blanked
        cp = np.where(counted | ~inside & (cp != 10), cp, np.where(cp == 10, 32, cp))
        inside = ~block._is_end() & (cp != 10)
    space = _spaces()[cp] | ~inside
    solid = ~space
    after_space = np.concatenate((space[1:], [True]))
    before_space = np.concatenate(([True], space[:-1]))
    quote = np.isin(cp, [34, 39, 0x201D, 0x2019, 0xBB, 41])
    after_quote = np.concatenate((quote[1:], [False]))
    end_mark = (cp == 46) | (cp == 33) | (cp == 63) | (cp == 0x2026) | (cp == 0xFF0E)
    ends = end_mark & (after_space | after_quote)
    letter, tri = trigrams(cp)
    digit = _digits()[cp]
    alnum = alnum_table()[cp]
    gap = (cp == 32) & ~before_space & after_space & np.concatenate((inside[1:], [False]))

    stop_at = np.flatnonzero((cp == 10) | block._is_end())
    s = np.concatenate(([0], stop_at[:-1] + 1)).astype(np.int64)
    doc = np.searchsorted(block.end, stop_at, side="left")

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask & counted)))
        return sums[stop_at] - sums[s]

    out = np.zeros((len(s), len(LINE)))
    for k, m in (
        ("chars", inside), ("solid", solid), ("letters", letter), ("known", letter & language.known[tri]), ("pipe", cp == 124), ("semicolon", cp == 59), ("tab", cp == 9),
        ("comma", (cp == 44) & ~after_space), ("gap", gap), ("ends", ends), ("digits", digit), ("symbols", solid & ~alnum),
    ):
        out[:, _L[k]] = total(m)
    ws, we, wh, _ = block.words()
    own = counted[ws] | counted[we - 1]
    ws, we, wh = ws[own], we[own], wh[own]
    line = np.searchsorted(stop_at, ws, side="left")
    out[:, _L["words"]] = np.bincount(line, minlength=len(s))
    out[:, _L["word_chars"]] = total(alnum)
    out[:, _L["stop"]] = np.bincount(line, language.is_stop(wh), minlength=len(s))

    # the first and the last solid character of each line
    at = np.flatnonzero(solid & counted)
    if len(at):
        f = np.searchsorted(at, s)
        l = np.searchsorted(at, stop_at) - 1
        has = f <= l
        first, last = at[np.minimum(f, len(at) - 1)], at[np.maximum(l, 0)]
        numbered = np.zeros(len(s), bool)
        k = first.copy()
        for _ in range(3):  # a number of one to three digits and a full stop or bracket, or a bare bullet
            k = np.where(digit[np.minimum(k, n - 1)], k + 1, k)
        k = np.minimum(k, n - 1)
        numbered = has & (k > first) & np.isin(cp[k], [46, 41]) & space[np.minimum(k + 1, n - 1)] & (k + 1 < stop_at)
        out[:, _L["ends"]] -= numbered & (cp[k] == 46)
        out[:, _L["bullet"]] = has & (numbered | np.isin(cp[first], [ord(c) for c in _BULLETS]) & space[np.minimum(first + 1, n - 1)])
        out[:, _L["closed"]] = has & (end_mark[last] | quote[last] & (last > s) & end_mark[np.maximum(last - 1, 0)])
    return out, doc


def closed(lines: np.ndarray) -> np.ndarray:
    """Document sums (a row each) of whole lines: what each line is, and its counts."""
    g = lambda k: lines[:, _L[k]]
    solid, words = g("solid"), g("words")
    cells = np.maximum.reduce([g("pipe"), g("semicolon"), g("tab"), g("comma"), g("gap")])
    filled = solid > 0
    row = filled & (cells >= 2) & ((g("closed") == 0) | (g("stop") < 2)) & (g("ends") <= 1)
    prose = filled & ~row & ((g("ends") >= 1) & (words >= 4) | (words >= 11))
    item = filled & ~row & ~prose
    cols = [g(k) for k in ("chars", "solid", "letters", "known", "words", "word_chars", "stop", "digits", "symbols")]
    cols += [np.ones(len(lines)), filled, filled & (g("closed") > 0), filled & (g("bullet") > 0), prose, prose * solid, row, row * solid, item, item * solid]
    return np.stack(cols, axis=1).astype(float)


def document_sums(block: Block, language: Language) -> np.ndarray:
    lines, doc = line_sums(block, language)
    sums = closed(lines)
    out = np.zeros((block.n, len(DOC)))
    for i in range(len(DOC)):
        out[:, i] = np.bincount(doc, sums[:, i], minlength=block.n)
    return out


def kinds(sums: np.ndarray, limits: Limits = Limits()) -> np.ndarray:
    """'prose', 'list', 'table' or 'junk' for each row of document sums."""
    d = {k: sums[:, i] for i, k in enumerate(DOC)}
    solid = np.maximum(d["solid"], 1)
    junk = d["known"] / solid < limits.junk_known
    rows = (d["row_chars"] / solid >= limits.rows_share) & (d["row_lines"] >= limits.least_items)
    other = (d["prose_chars"] / solid < limits.prose_share) & (d["item_lines"] >= limits.least_items) & (d["item_chars"] >= d["row_chars"])
    return np.select([junk, rows, other], ["junk", "table", "list"], "prose")


MEASURES = "n_chars bigint, n_words bigint, n_lines bigint, avg_word_length double, alpha_ratio double, digit_ratio double, symbol_ratio double, stopword_coverage double, closed_line_share double, bullet_line_share double, prose_share double, row_share double, known_share double, kind string"


def measured(sums: np.ndarray) -> dict[str, np.ndarray]:
    d = {k: sums[:, i] for i, k in enumerate(DOC)}
    per = lambda a, b: a / np.maximum(b, 1)
    return {
        "n_chars": (d["chars"] + d["lines"] - 1).astype(np.int64), "n_words": d["words"].astype(np.int64), "n_lines": d["lines"].astype(np.int64),
        "avg_word_length": per(d["word_chars"], d["words"]), "alpha_ratio": per(d["letters"], d["chars"] + d["lines"] - 1), "digit_ratio": per(d["digits"], d["chars"] + d["lines"] - 1),
        "symbol_ratio": per(d["symbols"], d["solid"]), "stopword_coverage": per(d["stop"], d["words"]), "closed_line_share": per(d["closed_lines"], d["filled"]),
        "bullet_line_share": per(d["bullet_lines"], d["filled"]), "prose_share": per(d["prose_chars"], d["solid"]), "row_share": per(d["row_chars"], d["solid"]), "known_share": per(d["known"], d["solid"]),
    }


def _readable(texts: Sequence[str], coder: decoding.Coder) -> list[str]:
    """Look-alike letters folded and wrong decodings undone, for texts that look like no language."""
    out = []
    for t in texts:
        lines = t.split("\n")
        for i, fixed, _ in decoding.repaired_lines(t, coder):
            if fixed is not None:
                lines[i] = fixed
        out.append(confusables.normal_form(confusables.skeleton("\n".join(lines))))
    return out


class Fixed:
    """The fixed tables on the driver; they go to the workers with the function."""

    def __init__(self, words: DataFrame, samples: DataFrame, documents: DataFrame | None = None) -> None:
        self.words = [r[0] for r in bounded(words.select("word").where("word is not null"), FIXED_ROWS, "common words")]
        self.right, seen = labels.sample(documents, samples) if documents is not None else labels.sample(samples.limit(0), samples, "sample_id")
        self.dictionaries = decoding.dictionaries(self.right, seen)

    def language(self) -> Language:
        return Language(self.words, [t for ts in self.right.values() for t in ts])


# --- chunks and their states ---------------------------------------------------------


def _open_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two parts of one line as one: sums add; the bullet is the first part's that is not blank, the closing mark the last's."""
    out = a + b
    out[_L["bullet"]] = a[_L["bullet"]] if a[_L["solid"]] else b[_L["bullet"]]
    out[_L["closed"]] = b[_L["closed"]] if b[_L["solid"]] else a[_L["closed"]]
    return out


def _word(piece: str | None) -> str:
    return piece or ""


def merge(a: dict, b: dict, language: Language) -> dict:
    """The state of two neighbouring pieces of a document; associative."""
    joined = np.array(b["head"], float)
    x, y = _word(a["last_word"]), _word(b["first_word"])
    whole_a = not a["broken"] and a["head"][_L["word_chars"]] == len(x) and a["head"][_L["solid"]] == len(x) > 0
    whole_b = not b["broken"] and b["head"][_L["word_chars"]] == len(y) and b["head"][_L["solid"]] == len(y) > 0
    if x and y:
        stop = lambda w: float(len(w) < PIECE and language.is_stop(Block([w], 0).words()[2]).any())
        joined[_L["words"]] -= 1
        joined[_L["stop"]] += stop(x + y) - stop(x) - stop(y)
    first = (x + y)[:PIECE] if whole_a and x and y else a["first_word"] if a["first_word"] or a["head"][_L["chars"]] or a["broken"] else b["first_word"]
    last = (x + y)[-PIECE:] if whole_b and x and y else b["last_word"]
    sums = np.array(a["sums"], float) + np.array(b["sums"], float)
    if a["broken"]:
        tail = _open_lines(np.array(a["tail"], float), joined)
        if b["broken"]:
            sums += closed(tail[None])[0]
            return a | {"sums": sums, "tail": np.array(b["tail"], float), "first_word": first, "last_word": last}
        return a | {"sums": sums, "tail": tail, "first_word": first, "last_word": last}
    head = _open_lines(np.array(a["head"], float), joined)
    return a | {"sums": sums, "head": head, "tail": np.array(b["tail"], float), "broken": b["broken"], "first_word": first, "last_word": last}


def whole(state: dict) -> np.ndarray:
    """Document sums of a state that covers its document."""
    sums = np.array(state["sums"], float) + closed(np.array(state["head"], float)[None])[0]
    return sums + closed(np.array(state["tail"], float)[None])[0] if state["broken"] else sums


def chunk_state(text: str, left: int, right: int, language: Language) -> dict:
    """State of a chunk given with ``left`` and ``right`` characters of context."""
    body = text[left : len(text) - right]
    lines, _ = line_sums(Block([text], 0), language, np.array([left]), np.array([right]))
    # words that reach into the context are pieces here
    block = Block([body], 0)
    s, e, h, _ = block.words()
    stop_at = np.flatnonzero(block.cp == 10)
    line = np.searchsorted(stop_at, s, side="left")
    lines[:, _L["words"]] = np.bincount(line, minlength=len(lines))
    lines[:, _L["stop"]] = np.bincount(line, language.is_stop(h), minlength=len(lines))
    first = body[: e[0]][:PIECE] if len(s) and s[0] == 0 else ""
    last = body[s[-1] :][-PIECE:] if len(s) and e[-1] == len(body) else ""
    broken = len(lines) > 1
    inner = closed(lines[1:-1]).sum(axis=0) if len(lines) > 2 else np.zeros(len(DOC))
    return {"sums": inner, "head": lines[0], "tail": lines[-1] if broken else np.zeros(len(LINE)), "broken": broken, "first_word": first, "last_word": last}


SOLID, KNOWN = DOC.index("solid"), DOC.index("known")
NAMES = [c.split()[0] for c in MEASURES.split(", ")]
#: A chunk's row: its measures where it is the whole document, else its state.
ROW = f"doc_id bigint, row bigint, chunk bigint, n int, state binary, {MEASURES}"


def _in_doubt(sums: np.ndarray, limits: Limits) -> np.ndarray:
    return sums[:, KNOWN] / np.maximum(sums[:, SOLID], 1) < limits.look_closer


def _finished(raw: np.ndarray, readable: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """Measures and kind of documents given their sums as they stand and as made readable."""
    kind = np.where(_in_doubt(raw, limits), kinds(readable, limits), kinds(raw, limits))
    return measured(raw) | {"kind": kind.astype(object)}


def _chunks(fixed: Fixed, limits: Limits):
    """Count the chunks (doc_id, text, row, chunk, n, left, right)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, coder = fixed.language(), decoding.Coder(fixed.dictionaries)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            doc, row, chunk, n, left, right = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4, 5, 6))
            for block in blocks(texts):
                own = slice(block.first, block.first + block.n)
                sums = document_sums(block, language)
                one = np.flatnonzero((n[own] == 1) & (sums[:, SOLID] > 0))
                raw, readable = sums[one], sums[one]
                doubt = np.flatnonzero(_in_doubt(raw, limits))
                if len(doubt):
                    readable = raw.copy()
                    readable[doubt] = document_sums(Block(_readable([block.texts[one[i]] for i in doubt], coder), 0), language)
                at = block.first + one
                yield _rows(doc[at], row[at], chunk[at], n[at], [None] * len(at), _finished(raw, readable, limits))
                parts = np.flatnonzero(n[own] > 1) + block.first
                if len(parts):
                    states = [_both(texts[i], int(left[i]), int(right[i]), language, coder, limits) for i in parts]
                    yield _rows(doc[parts], row[parts], chunk[parts], n[parts], states, None)

    return run


def _both(text: str, left: int, right: int, language: Language, coder: decoding.Coder, limits: Limits) -> bytes:
    """States of a chunk as it stands and, where it is in doubt, as made readable between its context."""
    raw = chunk_state(text, left, right, language)
    if not _in_doubt(whole(raw)[None], limits)[0]:
        return pickle.dumps((raw, raw))
    end = len(text) - right
    body = _readable([text[left:end]], coder)[0]
    return pickle.dumps((raw, chunk_state(text[:left] + body + text[end:], left, right, language)))


def _rows(doc: np.ndarray, row: np.ndarray, chunk: np.ndarray, n: np.ndarray, states: list[bytes | None], measures: dict[str, np.ndarray] | None) -> pa.RecordBatch:
    kinds_of = {c.split()[0]: {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}[c.split()[1]] for c in MEASURES.split(", ")}
    own = {k: pa.nulls(len(doc), t) if measures is None else pa.array(measures[k], t) for k, t in kinds_of.items()}
    return arrow({"doc_id": doc.astype(np.int64), "row": row.astype(np.int64), "chunk": chunk.astype(np.int64), "n": n.astype(np.int32), "state": pa.array(states, pa.binary())} | own)


def _merge_node(fixed: Fixed):
    made: list[Language] = []

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(fixed.language())
        rows = pdf.sort_values("chunk")
        raw, readable = pickle.loads(rows["state"].iloc[0])
        for state in rows["state"].iloc[1:]:
            a, b = pickle.loads(state)
            raw, readable = merge(raw, a, made[0]), merge(readable, b, made[0])
        first = rows.iloc[0]
        return pd.DataFrame([{"doc_id": first["doc_id"], "row": first["row"], "chunk": int(first["chunk"]) // FAN, "state": pickle.dumps((raw, readable))}])

    return run


def _whole_documents(limits: Limits):
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                both = [pickle.loads(s) for s in pdf["state"]]
                raw, readable = (np.stack([whole(b[i]) for b in both]) for i in (0, 1))
                out = pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()} | _finished(raw, readable, limits))
                yield out[raw[:, SOLID] > 0]

    return run


def statistics(df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), chunk: int = CHUNK) -> DataFrame:
    """One row per document: its statistics and kind."""
    fixed = Fixed(words, samples)
    docs = docs_in(df, id_col, text_col)
    number = lambda x: F.lit(x).cast("int")
    short = docs.where(F.length("text") <= chunk).select("doc_id", "text", F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("chunk"), number(1).alias("n"), number(0).alias("left"), number(0).alias("right"))
    # cut in one pass over the text; each piece is given with the characters beside it
    long = docs.where(F.length("text") > chunk).select("doc_id", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("parts"))
    beside = lambda i, at: F.substring(F.coalesce(F.get("parts", i), F.lit("")), at, CONTEXT)
    piece = lambda x, i: F.struct(i.cast("bigint").alias("chunk"), F.when(i > 0, beside(i - 1, -CONTEXT)).otherwise("").alias("before"), x.alias("own"), beside(i + 1, 1).alias("after"))
    long = long.select("doc_id", "row", F.size("parts").alias("n"), F.explode(F.transform("parts", piece)).alias("x"))
    long = long.select("doc_id", F.concat("x.before", "x.own", "x.after").alias("text"), "row", "x.chunk", "n", F.length("x.before").alias("left"), F.length("x.after").alias("right")).repartition("row", "chunk")
    rows = stored(short.mapInArrow(_chunks(fixed, limits), ROW).union(long.mapInArrow(_chunks(fixed, limits), ROW)), "chunks")
    states = rows.where("n > 1").select("doc_id", "row", "chunk", "state")
    nodes = rows.agg(F.max("n")).first()[0] or 1
    while nodes > 1:
        states = states.groupBy("row", F.floor(F.col("chunk") / FAN)).applyInPandas(_merge_node(fixed), "doc_id bigint, row bigint, chunk bigint, state binary")
        nodes = -(-nodes // FAN)
    cut_up = states.mapInPandas(_whole_documents(limits), f"doc_id bigint, {MEASURES}")
    return rows.where("n = 1").select("doc_id", *NAMES).union(cut_up)
