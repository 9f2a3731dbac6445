"""Main content of web pages: a recurrent labeller of a page's blocks.

A page is the sequence of its leaf blocks, here its non-blank lines. A block
is read as the mean of hashed-word vectors of its words and word pairs, beside
its tag path: what a line of extracted text still shows of the markup it came
from (list mark, cell separators, gaps around it, place in the page, closing
punctuation, shape of its words). A bidirectional LSTM in numpy reads the whole
sequence, so each block is classified by the whole document around it, and
documents of a batch advance together, step by step.

The weights are fitted here by ``fit_blocks.py`` and stand beside this module.
Look-alike letters and wrong decodings are undone before reading; the lines
keep their numbers.

Defined results: null, empty and blank texts and rows without an id have no
lines; documents that are a list, a table or junk have none to remove; rows
that repeat an id give rows each; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import confusables, decoding, statistics
from .textvec import U64, Block, alnum_table, arrow, docs_in, first_of_runs, fold_table, letter_table, mix, read

WEIGHTS = Path(__file__).with_name("block_weights.npz")
BUCKETS = 4096
WIDTH = 20
HIDDEN = 24
SHAPE = 26
THRESHOLD = 0.5
#: What a line of prose may begin with beside letters and digits.
_OPENING = "\"'“”‘’„«([{¿¡—–-*•#"
_FORMS = re.compile("[̀-ͯﬀ-ﬆ＀-￯]")


class Leaves:
    """The leaf blocks of a text block: what the network reads of each non-blank line."""

    def __init__(self, block: Block) -> None:
        cp = block.clipped()
        s, e, doc, number = block.lines()
        space = statistics._spaces()[cp]
        inside = ~block._is_end() & (cp != 10)
        solid = ~space & inside
        sums = lambda m: (lambda c: c[e] - c[s])(np.concatenate(([0], np.cumsum(m))))
        n_solid = sums(solid)
        keep = np.flatnonzero(n_solid > 0)
        self.number, self.doc = number[keep], doc[keep]
        s, e, n_solid = s[keep], e[keep], n_solid[keep]
        n = len(keep)
        at = np.flatnonzero(solid)
        first = at[np.searchsorted(at, s)] if n else s
        last = at[np.searchsorted(at, e) - 1] if n else s
        digit, letter = statistics._digits()[cp], letter_table()[cp]
        sums = lambda m: (lambda c: c[e] - c[s])(np.concatenate(([0], np.cumsum(m))))
        after_space = np.concatenate((space[1:] | ~inside[1:], [True]))
        before_space = np.concatenate(([True], space[:-1] | ~inside[:-1]))
        end_mark = (cp == 46) | (cp == 33) | (cp == 63) | (cp == 0x2026)
        upper = letter & (fold_table()[cp] != cp)
        head = letter & np.concatenate(([True], ~letter[:-1]))

        ws, we, wh, _ = block.words()
        owner = np.searchsorted(e, ws, side="left")
        numeric = digit[ws]
        ids = np.where(numeric, 1 + np.minimum(we - ws, 9), 16 + (wh % U64(BUCKETS - 16)).astype(np.int64))
        pair = (owner[1:] == owner[:-1]) & ~numeric[1:] & ~numeric[:-1] if len(ws) > 1 else np.zeros(0, bool)
        pair_ids = 16 + (mix(wh[:-1] * U64(31) + wh[1:]) % U64(BUCKETS - 16)).astype(np.int64) if len(ws) > 1 else np.zeros(0, np.int64)
        self.ids = np.concatenate((ids, pair_ids[pair]))
        self.owner = np.concatenate((owner, owner[1:][pair]))
        n_words = np.bincount(owner, minlength=n)

        start = np.flatnonzero(first_of_runs(self.doc)) if n else np.zeros(0, np.int64)
        length = np.diff(np.append(start, n))
        place = np.arange(n) - np.repeat(start, length)
        total = np.repeat(length, length)
        before = np.concatenate(([0], np.diff(self.number)))
        before[start] = self.number[start] + 1
        following = np.concatenate((before[1:], [1]))
        following[start[1:] - 1] = 1
        first_cp, last_cp = cp[first], cp[last]
        ends = sums(end_mark & after_space)
        closed = end_mark[last]
        per = lambda a, b: a / np.maximum(b, 1)
        cells = [sums(cp == ord(c)) for c in "|>»·"]
        gap = sums((cp == 32) & ~before_space & after_space & np.concatenate((inside[1:], [False])))
        shape = [
            np.log1p(n_words) / 3, np.log1p(n_solid) / 5, closed, np.minimum(ends, 4) / 4, per(sums(digit & inside), n_solid), per(sums(upper & inside), n_solid),
            per(sums(head & upper), np.maximum(sums(head), 1)), np.isin(first_cp, [45, 42, 0x2022, 0x2013]) & space[np.minimum(first + 1, len(cp) - 1)],
            ~alnum_table()[first_cp] & ~np.isin(first_cp, [ord(c) for c in _OPENING]), (last_cp == 41), *(np.minimum(c, 4) / 4 for c in cells), np.minimum(gap, 4) / 4, sums(cp == 58) > 0, last_cp == 58,
            sums(cp == 64) > 0, sums(cp == 169) > 0, np.minimum(before - 1, 2) / 2, np.minimum(following - 1, 2) / 2, place == 0, place == total - 1,
            place / np.maximum(total - 1, 1), np.log1p(total) / 4, (n_words <= 4),
        ]
        self.shape = np.stack(shape, axis=1).astype(np.float32) if n else np.zeros((0, SHAPE), np.float32)
        self.start, self.length, self.n = start, length, n

    def means(self, table: np.ndarray) -> np.ndarray:
        """Mean word vector of each leaf."""
        out = np.zeros((self.n, table.shape[1]), np.float32)
        if len(self.ids):
            order = np.argsort(self.owner, kind="stable")
            owner = self.owner[order]
            at = np.flatnonzero(first_of_runs(owner))
            out[owner[at]] = np.add.reduceat(table[self.ids[order]], at, axis=0) / np.diff(np.append(at, len(owner)))[:, None]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def recur(x: np.ndarray, start: np.ndarray, length: np.ndarray, w: np.ndarray, b: np.ndarray, backward: bool, keep: dict | None = None) -> np.ndarray:
    """Hidden states of an LSTM over each document's leaves; documents advance together."""
    hidden = w.shape[1] // 4
    out = np.zeros((len(x), hidden), np.float32)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    h = np.zeros((len(start), hidden), np.float32)
    c = np.zeros_like(h)
    wx, wh = w[: x.shape[1]], w[x.shape[1] :]
    pre = x @ wx + b
    trace = []
    for t in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -t, side="left"))
        at = start[:live] + (length[:live] - 1 - t if backward else t)
        z = pre[at] + h[:live] @ wh
        gates = _sigmoid(z[:, : 3 * hidden])
        g = np.tanh(z[:, 3 * hidden :])
        i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
        old_c, old_h = c[:live].copy() if keep is not None else None, h[:live].copy() if keep is not None else None
        c[:live] = f * c[:live] + i * g
        squashed = np.tanh(c[:live])
        h[:live] = o * squashed
        out[at] = h[:live]
        if keep is not None:
            trace.append((live, at, i, f, o, g, old_c, old_h, squashed))
    if keep is not None:
        keep["trace"], keep["docs"] = trace, len(start)
    return out


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    def scores(self, leaves: Leaves) -> np.ndarray:
        """Probability that each leaf is no content."""
        if not leaves.n:
            return np.zeros(0, np.float32)
        w = self.w
        x = np.concatenate((leaves.means(w["words"]), leaves.shape), axis=1)
        ahead = recur(x, leaves.start, leaves.length, w["w_ahead"], w["b_ahead"], False)
        back = recur(x, leaves.start, leaves.length, w["w_back"], w["b_back"], True)
        return _sigmoid(np.concatenate((ahead, back), axis=1) @ w["w_out"] + w["b_out"])[:, 0]


@lru_cache(maxsize=1)
def labeller() -> Labeller:
    with np.load(WEIGHTS) as stored:
        return Labeller(dict(stored))


def readable(block: Block, coder: decoding.Coder) -> Block:
    """The block with wrong decodings and look-alike letters undone; lines keep their numbers."""
    texts = list(block.texts)
    for d in decoding.odd_documents(block):
        lines = texts[d].split("\n")
        for i, fixed, _ in decoding.repaired_lines(texts[d], coder):
            if fixed is not None:
                lines[i] = fixed.replace("\n", " ")
        texts[d] = "\n".join(lines)
    changed = [t if t.isascii() else confusables.normal_form(confusables.skeleton(t)) if _strange(t) else t for t in texts]
    return block if changed == list(block.texts) else Block(changed, block.first)


def _strange(text: str) -> bool:
    return bool(confusables._DROP.search(text) or confusables._TWIN.search(text) or confusables._SPACE.search(text) or _FORMS.search(text))




def removed(block: Block, model: Labeller, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, line, score) of the lines that are no content; ``kind`` is each document's."""
    leaves = Leaves(block)
    score = model.scores(leaves)
    drop = np.flatnonzero((score >= THRESHOLD) & (kind[leaves.doc] == "prose"))
    return leaves.doc[drop], leaves.number[drop], score[drop]


def _kinds(block: Block, language: statistics.Language) -> np.ndarray:
    return statistics.kinds(statistics.document_sums(block, language))


def _lines(fixed: statistics.Fixed):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, coder, model = fixed.language(), decoding.Coder(fixed.dictionaries), labeller()
        for ids, block in read(batches):
            plain = readable(block, coder)
            doc, line, score = removed(plain, model, _kinds(plain, language))
            yield arrow({"doc_id": ids[doc], "line_no": line.astype(np.int64), "score": score.astype(float)})

    return run


def _bodies(fixed: statistics.Fixed):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, coder, model = fixed.language(), decoding.Coder(fixed.dictionaries), labeller()
        for ids, block in read(batches):
            plain = readable(block, coder)
            doc, line, _ = removed(plain, model, _kinds(plain, language))
            gone: dict[int, set[int]] = {}
            for d, k in zip(doc.tolist(), line.tolist(), strict=True):
                gone.setdefault(d, set()).add(k)
            out = [t if d not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]).strip("\n") for d, t in enumerate(block.texts)]
            yield arrow({"doc_id": ids, "text": pa.array(out, pa.string()), "n_removed": pa.array([len(gone.get(d, ())) for d in range(block.n)], pa.int64())})

    return run


def furniture(df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines that are not headline or body, with the network's probability."""
    return docs_in(df, id_col, text_col).mapInArrow(_lines(statistics.Fixed(words, samples)), "doc_id bigint, line_no bigint, score double")


def main_content(df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's text without those lines."""
    return docs_in(df, id_col, text_col).mapInArrow(_bodies(statistics.Fixed(words, samples)), "doc_id bigint, text string, n_removed bigint")
