"""Language of documents and of their passages, by word-first backoff.

A known word is scored by its log frequency in each language (less a constant
of the word, which no comparison of languages sees). An unseen word
falls back to its 5-character grams, and where those are unseen as well to
shorter ones, down to single letters. Scores are bounded, so that no word
decides alone; backed-off words count for less. They add up over a sentence; a document's main language is the one most of its
words stand in, sentence by sentence.

The model is fitted on the labelled passages, then once more with those
documents of a bounded labelled sample (``labels.PER_LANGUAGE``) whose label
the first model confirms.

The languages are those of the labelled passages. A text of which the model
knows too few words in the language that it looks most like (``COVERED``) is in
none of them.

A passage is a run of at least ``RUN`` consecutive full sentences (closed by a
full stop or the like, ``LEAST`` words or more) in a language other than the
main one. Look-alike letters and wrong decodings are undone before scoring.

Defined results: null, empty and blank texts have no row; texts without a
language (junk) or in none of the languages have a null language, with the
confidence of that; a tie goes to the first language of the alphabet; rows that repeat an id give rows each; other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as pages
from . import decoding, labels, statistics
from .textvec import Block, arrow, blocks, docs_in, first_of_runs, fold_table, rows_of

ORDERS = (5, 4, 3, 2, 1)
RUN = 2
LEAST = 4
FLOOR = -7.0
BACKED_OFF = 0.4
#: Margin of a sentence's language over the document's, in nats, below which the sentence is the document's.
MARGIN = 4.0
#: Share of a text's words, but for numbers, that the model must have seen in the language.
COVERED = 0.27


class Model:
    """Log posteriors of words and character grams, by language."""

    def __init__(self, texts: dict[str, list[str]]) -> None:
        self.langs = tuple(sorted(texts))
        words: list[dict[int, float]] = []
        spelled: dict[int, str] = {}
        grams: list[list[Counter]] = []
        for lang in self.langs:
            count: Counter = Counter()
            for block in blocks(texts.get(lang, []) or [" "]):
                s, e, h, _ = block.words()
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                cp = fold_table()[block.clipped()]
                for w, i, k in zip(u.tolist(), first.tolist(), n.tolist(), strict=True):
                    if w not in spelled:
                        spelled[w] = cp[s[i] : e[i]].tobytes().decode("utf-32-le")
                    if spelled[w].isalpha():
                        count[w] += k
            words.append(count)
            own = [Counter() for _ in ORDERS]
            for w, k in count.items():
                for c, n in zip(own, ORDERS, strict=True):
                    for g in _grams(spelled[w], n):
                        c[g] += min(k, 5)
            grams.append(own)
        self.hashes = np.array(sorted(set().union(*words)), np.uint64)
        raw = np.array([[c.get(w, 0) for c in words] for w in self.hashes.tolist()], float).reshape(-1, len(self.langs))
        self.held = raw > 0
        total = np.maximum(np.array([sum(c.values()) for c in words], float), 1)
        self.scores = _posterior(np.log((raw + 0.05) / (total + 0.05 * max(len(raw), 1))))
        self.grams: list[dict[str, np.ndarray]] = []
        for i, _ in enumerate(ORDERS):
            keys = sorted(set().union(*(g[i] for g in grams)))
            raw = np.array([[g[i].get(k, 0) for g in grams] for k in keys], float).reshape(-1, len(self.langs))
            total = np.maximum(np.array([sum(g[i].values()) for g in grams], float), 1)
            post = _posterior(np.log((raw + 0.1) / (total + 0.1 * max(len(keys), 1))))
            self.grams.append(dict(zip(keys, post, strict=True)))
        self.memory: dict[int, np.ndarray] = {}

    def backed_off(self, word: str) -> np.ndarray:
        if not word.isalpha():
            return np.zeros(len(self.langs))
        for table, n in zip(self.grams, ORDERS, strict=True):
            own = _grams(word, n)
            known = [table[g] for g in own if g in table]
            if known and 2 * len(known) >= len(own):
                return BACKED_OFF * np.maximum(np.sum(known, axis=0) / max(1.0, len(known) ** 0.5), FLOOR)
        return np.zeros(len(self.langs))

    def words(self, block: Block) -> tuple[np.ndarray, ...]:
        """(start, end, document, scores, languages that hold it) of the words; digits score nothing."""
        s, e, h, doc = block.words()
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, u), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == u if len(self.hashes) else np.zeros(len(u), bool)
        table = np.zeros((len(u), len(self.langs)))
        table[known] = self.scores[at[known]]
        held = np.zeros(table.shape, bool)
        held[known] = self.held[at[known]]
        folded = fold_table()[block.clipped()]
        for i in np.flatnonzero(~known):
            w = int(u[i])
            got = self.memory.get(w)
            if got is None:
                if len(self.memory) > 300_000:
                    self.memory.clear()
                got = self.memory[w] = self.backed_off(folded[s[first[i]] : e[first[i]]].tobytes().decode("utf-32-le", "replace"))
            table[i] = got
        inverse = inverse.reshape(-1)
        return s, e, doc, table[inverse], held[inverse]


def _grams(word: str, n: int) -> list[str]:
    w = f" {word} " if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _posterior(x: np.ndarray) -> np.ndarray:
    if not len(x):
        return x
    x = x - x.max(axis=1, keepdims=True)
    return np.maximum(x - np.log(np.exp(x).sum(axis=1, keepdims=True)), FLOOR)


class Sentences:
    """The sentences of a block: bounds, document, scores, number of words, whether full."""

    def __init__(self, block: Block, model: Model) -> None:
        cp = block.clipped()
        end = block._is_end()
        space = statistics._spaces()[cp] | end
        mark = (cp == 46) | (cp == 33) | (cp == 63) | (cp == 0x2026)
        close = np.isin(cp, [34, 39, 0x201D, 0x2019, 0x201C, 0xBB, 41])
        before = np.concatenate(([False], mark[:-1]))
        stop = (mark | close & before) & np.concatenate((space[1:], [True]))
        cut = np.flatnonzero(stop | (cp == 10) | end)
        s, e, doc, scores, held = model.words(block)
        own = np.searchsorted(cut, s, side="left")
        n = len(cut)
        self.n_words = np.bincount(own, minlength=n)
        per = lambda x: np.stack([np.bincount(own, x[:, k], minlength=n) for k in range(len(model.langs))], axis=1)
        self.scores, self.held = per(scores), per(held)
        keep = np.flatnonzero(self.n_words > 0)
        order = np.full(n, -1)
        order[keep] = np.arange(len(keep))
        first = np.full(len(keep), 0, np.int64)
        if len(s):
            at = np.flatnonzero(first_of_runs(own))
            first = s[at]
        self.start, self.end = first, cut[keep] + 1
        self.doc = np.searchsorted(block.end, cut[keep], side="left")
        self.end = np.minimum(self.end, block.end[self.doc]) if len(keep) else self.end
        self.full = stop[cut[keep]] & (self.n_words[keep] >= LEAST)
        self.n_letters = np.bincount(own, ~statistics._digits()[cp[s]], minlength=n)[keep]
        self.n_words, self.scores, self.held = self.n_words[keep], self.scores[keep], self.held[keep]
        self.n = block.n


def _per_doc(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(doc, values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


def _confidence(scores: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Share of the best language when a word's evidence is averaged over the words' root."""
    x = scores / np.maximum(np.sqrt(np.maximum(words, 1)), 1)[:, None]
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x.max(axis=1) / x.sum(axis=1)


def judged(block: Block, model: Model, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int, float]]]:
    """(main language, -1 for none, with its confidence) of each document, and its passages.

    A passage is (document, start, end, language, confidence) in the block's
    texts. ``skip`` marks characters of lines that are no content.
    """
    t = Sentences(block, model)
    if not len(t.doc):
        return np.full(block.n, -1), np.ones(block.n), []
    full = t.full if skip is None else t.full & ~skip[t.start]
    best = t.scores.argmax(axis=1)
    votes = np.zeros((len(best), len(model.langs)))
    votes[np.arange(len(best)), best] = t.n_words
    some = np.bincount(t.doc, full, minlength=block.n) > 0
    use = np.where(some[t.doc], full, True)
    sums = _per_doc(t.doc[use > 0], t.scores[use > 0], block.n)
    shares = _per_doc(t.doc[use > 0], votes[use > 0], block.n)
    main = np.where(shares.max(axis=1) > 0, shares.argmax(axis=1), -1)
    n_words = np.bincount(t.doc[use > 0], t.n_words[use > 0], minlength=block.n)
    confidence = _confidence(sums, n_words)
    # the share of words, but for numbers, seen in the main language
    mine = (use > 0) & (main[t.doc] >= 0)
    held = np.bincount(t.doc[mine], t.held[mine, main[t.doc[mine]]], minlength=block.n)
    covered = held / np.maximum(np.bincount(t.doc[mine], t.n_letters[mine], minlength=block.n), 1)
    foreign = (main < 0) | (covered < COVERED)
    main, confidence = np.where(foreign, -1, main), np.where(foreign, 1 - covered, confidence)
    passages: list[tuple[int, int, int, int, float]] = []
    at = np.flatnonzero((full > 0) & (main[t.doc] >= 0))
    if len(at):
        own = main[t.doc[at]]
        lang = np.where(t.scores[at, best[at]] - t.scores[at, own] >= MARGIN, best[at], own)
        new = first_of_runs(t.doc[at]) | first_of_runs(lang)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        for f, l in zip(first.tolist(), last.tolist(), strict=True):
            if l - f + 1 >= RUN and lang[f] != own[f]:
                d = int(t.doc[at[f]])
                total = t.scores[at[f : l + 1]].sum(axis=0)[None]
                sure = _confidence(total, np.array([t.n_words[at[f : l + 1]].sum()]))[0]
                passages.append((d, int(t.start[at[f]] - block.start[d]), int(t.end[at[l]] - block.start[d]), int(lang[f]), float(sure)))
    return main, confidence, passages


def fitted(right: dict[str, list[str]], seen: dict[str, list[str]]) -> dict[str, list[str]]:
    """The texts to fit on: the passages, and the sample's documents that their model confirms."""
    first = Model(right)
    out = {k: list(v) for k, v in right.items()}
    for lang, texts in seen.items():
        for block in blocks(texts):
            main, confidence, passages = judged(block, first)
            mixed = {p[0] for p in passages}
            out.setdefault(lang, []).extend(t for i, t in enumerate(block.texts) if main[i] >= 0 and first.langs[main[i]] == lang and confidence[i] > 0.5 and i not in mixed and not decoding._odd().search(t))
    return out


class Judge:
    """What the driver fits and the workers judge with."""

    def __init__(self, df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str, text_col: str, lang_col: str) -> None:
        self.fixed = statistics.Fixed(words, samples)
        right, seen = labels.sample(df, samples, id_col, text_col, lang_col)
        self.texts = fitted(right, seen)

    def ready(self) -> None:
        self.model = Model(self.texts)
        self.coder = decoding.Coder(self.fixed.dictionaries)
        self.known = self.fixed.language()

    def of(self, block: Block) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int, float]]]:
        plain = pages.readable(block, self.coder)
        kind = statistics.kinds(statistics.document_sums(plain, self.known))
        main, confidence, passages = judged(plain, self.model)
        junk = kind == "junk"
        main, confidence = np.where(junk, -1, main), np.where(junk & (main >= 0), 1 - confidence, confidence)
        if plain is not block:  # positions of a changed text are given in the original by its lines
            passages = [(d, *_back(plain.texts[d], block.texts[d], s, e), k, c) for d, s, e, k, c in passages]
        return main, confidence, [p for p in passages if main[p[0]] >= 0]


def _back(new: str, old: str, start: int, end: int) -> tuple[int, int]:
    """Bounds in the original of a span of the readable text: its lines, where lengths differ."""
    if len(new) == len(old):
        return start, end
    first, last = new.count("\n", 0, start), new.count("\n", 0, end)
    lines = old.split("\n")
    begin = sum(len(x) + 1 for x in lines[:first])
    return begin, begin + len("\n".join(lines[first : last + 1]))


def _documents(judge: Judge):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge.ready()
        for batch in batches:
            ids, texts = rows_of(batch)
            marks = batch.column(2).to_pylist()
            said = [m for m, t in zip(marks, batch.column(1).to_pylist(), strict=True) if t and not t.isspace()]
            for block in blocks(texts):
                main, confidence, passages = judge.of(block)
                other: dict[int, set[str]] = {}
                for p in passages:
                    other.setdefault(p[0], set()).add(judge.model.langs[p[3]])
                yield arrow({
                    "doc_id": ids[block.first : block.first + block.n], "label": pa.array(said[block.first : block.first + block.n], pa.string()),
                    "lang": pa.array([judge.model.langs[k] if k >= 0 else None for k in main], pa.string()), "confidence": confidence.astype(float),
                    "others": pa.array([sorted(other.get(i, ())) for i in range(block.n)], pa.list_(pa.string())),
                })

    return run


def _segments(text: str, main: int, confidence: float, found: list[tuple[int, int, int, float]]) -> Iterator[tuple[int, int, int, float]]:
    """The text cut at its passages: (start, end, language, confidence), the main language's between them."""
    at = 0
    for start, end, lang, sure in sorted(found):
        if start > at and not text[at:start].isspace():
            yield at, start, main, confidence
        else:
            start = at
        yield start, end, lang, sure
        at = end
    if at < len(text):
        yield at, len(text), main, confidence


def _passages(judge: Judge):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge.ready()
        for batch in batches:
            ids, texts = rows_of(batch)
            for block in blocks(texts):
                main, confidence, found = judge.of(block)
                own: dict[int, list] = {}
                for p in found:
                    own.setdefault(p[0], []).append(p[1:])
                rows = [(ids[block.first + d], *x, x[2] != main[d]) for d in range(block.n) for x in _segments(block.texts[d], int(main[d]), float(confidence[d]), own.get(d, []))]
                column = lambda i, kind: pa.array([r[i] for r in rows], kind)  # noqa: B023,E731
                yield arrow({
                    "doc_id": column(0, pa.int64()), "start": column(1, pa.int64()), "end": column(2, pa.int64()),
                    "lang": pa.array([judge.model.langs[r[3]] if r[3] >= 0 else None for r in rows], pa.string()), "confidence": column(4, pa.float64()), "other": column(5, pa.bool_()),
                })

    return run


def documents(df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each document's label (canonical), main language with a confidence, and the languages of its other passages."""
    judge = Judge(df, words, samples, id_col, text_col, lang_col)
    rows = docs_in(df, id_col, text_col, labels.canonical(F.col(lang_col).cast("string")).alias("label"))
    return rows.mapInArrow(_documents(judge), "doc_id bigint, label string, lang string, confidence double, others array<string>")


def passages(df: DataFrame, words: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each document cut into segments of one language with a confidence; ``other`` marks passages in another language than the main one."""
    judge = Judge(df, words, samples, id_col, text_col, lang_col)
    return docs_in(df, id_col, text_col).mapInArrow(_passages(judge), "doc_id bigint, start bigint, end bigint, lang string, confidence double, other boolean")


def mislabelled(found: DataFrame) -> DataFrame:
    """A row for each language of a document whose label is missing or wrong, or that mixes languages."""
    found = found.where("lang is not null")
    wrong = F.col("label").isNull() | (F.col("label") != F.col("lang")) | (F.size("others") > 0)
    return found.where(wrong).select("doc_id", F.explode(F.array_distinct(F.concat(F.array("lang"), "others"))).alias("lang"))
