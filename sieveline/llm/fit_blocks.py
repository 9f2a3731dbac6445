"""Fits the block labeller's weights: python -m sieveline.llm.fit_blocks OUT TABLES...

No page comes labelled, so a teacher labels a bounded sample of documents
(``DOCUMENTS`` of each folder of tables) by what recurs: lines that, numbers and names aside, stand in
many different pages are furniture, as are rows made of cells that do, lines
that begin with one, and the titles that follow a heading which recurs above
ever other titles. The network learns from those labels what such lines look
like and stand beside, and is what labels pages afterwards.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Sequence

import numpy as np

from .blocks import _OPENING, BUCKETS, HIDDEN, SHAPE, WIDTH, Labeller, Leaves, recur
from .textvec import blocks

DOCUMENTS = 12_000
EPOCHS = 9
RECURS = 10
_CELL = re.compile(r"\s*[|>»·]\s*|\s{2,}")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_NAME = re.compile(r"\b(?=\w*[^\W\d_a-zçğıöşüâ])\w{5,}\b")
_END = re.compile(r"[.!?…][\"”»’)]*$")


def _mask(line: str) -> str:
    return re.sub(r"\d+", "0", re.sub(r"\S+@\S+", "@", line.strip().lstrip("-*•– ")))


def _nameless(masked: str) -> list[str]:
    return [masked[: m.start()] + "N" + masked[m.end() :] for m in _NAME.finditer(masked)]


class Teacher:
    def __init__(self, texts: Sequence[str]) -> None:
        lines, around, forms = Counter(), defaultdict(set), defaultdict(set)
        cells = Counter()
        for t in texts:
            own = [x for x in t.split("\n") if x.strip()]
            seen = set()
            for k, x in enumerate(own):
                for part in {x, *_SENTENCE.split(x)}:
                    m = _mask(part)
                    if m in seen:
                        continue
                    seen.add(m)
                    lines[m] += 1
                    if len(around[m]) < 60:
                        around[m].add(hash((own[k - 1] if k else "", own[k + 1] if k + 1 < len(own) else "")))
                    for form in _nameless(m):
                        if len(forms[form]) < 60:
                            forms[form].add(m)
                for c in _CELL.split(x) if len(_CELL.split(x)) > 2 else ():
                    cells[_mask(c)] += 1
        # copies of an article repeat its lines between the same neighbours, furniture does not
        self.known = {m for m, n in lines.items() if n >= RECURS and len(around[m]) >= RECURS * 0.8}
        self.forms: set[str] = set()
        # what is rarer, or holds a name, must stand in pages that have such lines, and hardly elsewhere
        inside: Counter = Counter()
        for t in texts:
            parts = {_mask(p) for x in t.split("\n") if x.strip() for p in (x, *_SENTENCE.split(x))}
            if len(parts & self.known) >= 3:
                inside.update(parts)
        in_pages = lambda ms: sum(inside[m] for m in ms) >= 0.95 * sum(lines[m] for m in ms)
        often = {m for m, n in lines.items() if n >= RECURS // 2 and len(around[m]) >= RECURS * 0.4 and in_pages([m])}
        self.forms = {f for f, ms in forms.items() if len(ms) >= 4 and len(f.split()) > 1 and sum(lines[m] for m in ms) >= RECURS // 2 and in_pages(ms)}
        self.known = {m for m in self.known if inside[m] >= 0.8 * lines[m]} | often
        # a sign that lines without a sentence begin with, in pages only, is a mark of lists of other articles
        signs, signs_in = Counter(), Counter()
        for t in texts:
            own = [x.strip() for x in t.split("\n") if x.strip()]
            page = len({_mask(x) for x in own} & self.known) >= 3
            for x in own:
                if self._sign(x):
                    signs[x[0]] += 1
                    signs_in[x[0]] += page
        self.signs = {c for c, n in signs.items() if n >= RECURS and signs_in[c] >= 0.9 * n}
        self.cells = self.known | {c for c, n in cells.items() if n >= 8 and c}
        after = defaultdict(lambda: [0, 0])
        for t in texts:
            own = [x for x in t.split("\n") if x.strip()]
            for k in range(len(own) - 1):
                m = _mask(own[k])
                if m in self.known:
                    title = not self.plain(own[k + 1]) and not _END.search(own[k + 1]) and len(own[k + 1].split()) < 12
                    after[m][title] += 1
        self.headings = {m for m, (no, yes) in after.items() if yes >= 3 and yes > 0.6 * (no + yes) and "0" not in m}

    @staticmethod
    def _sign(line: str) -> bool:
        return not line[0].isalnum() and line[0] not in _OPENING and line[1:2].isspace() and not _END.search(line)

    def plain(self, line: str) -> bool:
        """Furniture by itself."""
        m = _mask(line)
        if m in self.known or any(f in self.forms for f in _nameless(m)) or self._sign(line.strip()) and line.strip()[0] in self.signs:
            return True
        parts = [p for p in _SENTENCE.split(line.strip()) if p]
        if len(parts) > 1 and all(_mask(p) in self.known or any(f in self.forms for f in _nameless(_mask(p))) for p in parts):
            return True
        cells = [c for c in _CELL.split(line.strip()) if c]
        if len(cells) > 1 and _mask(cells[0]) in self.cells and (sum(_mask(c) in self.cells or any(f in self.forms for f in _nameless(_mask(c))) for c in cells) >= len(cells) - 1):
            return True
        head, colon, rest = line.strip().partition(":")
        return bool(colon and rest) and not _END.search(line.strip()) and (head.strip() in self.inline or head.strip() + ":" in self.known)

    inline: frozenset[str] = frozenset()

    def learn_inline(self, texts: Sequence[str]) -> None:
        heads, where = Counter(), defaultdict(set)
        for t in texts:
            for x in t.split("\n"):
                head, colon, rest = x.strip().partition(":")
                if colon and rest.startswith(" ") and 1 <= len(head.split()) <= 5 and not _END.search(x.strip()) and not re.search(r"\d", head):
                    heads[head.strip()] += 1
                    where[head.strip()].add(rest.strip())
        self.inline = frozenset(h for h, n in heads.items() if n >= RECURS and len(h.split()) >= 2 and len(where[h]) >= RECURS)

    def labels(self, text: str) -> list[int]:
        """1 for each non-blank line that is furniture."""
        own = [x for x in text.split("\n") if x.strip()]
        sure = [self.plain(x) for x in own]
        if sum(sure) < 2 and not (sum(sure) and any(_mask(x) in self.known for x in own)):
            return [0] * len(own)
        short = [len(re.findall(r"\w+", x)) <= 2 and not _END.search(x) for x in own]
        for k in range(1, len(own) - 1):  # an item of a menu between two others
            sure[k] = sure[k] or short[k] and all(sure[i] and short[i] for i in (k - 1, k + 1))
        out, listing = [], False
        for x, f in zip(own, sure, strict=True):
            if f:
                listing = _mask(x) in self.headings or listing and not _END.search(x)
                out.append(1)
            elif _END.search(x.strip()) or len(x.split()) > 14:
                listing = False
                out.append(0)
            else:
                out.append(int(listing))
        return out


def _adam(w: dict[str, np.ndarray], grads: dict[str, np.ndarray], state: dict, rate: float) -> None:
    state["t"] = state.get("t", 0) + 1
    for k, g in grads.items():
        m = state.setdefault("m" + k, np.zeros_like(w[k]))
        v = state.setdefault("v" + k, np.zeros_like(w[k]))
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w[k] -= rate * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.999 ** state["t"])) + 1e-8)


def _through(x: np.ndarray, d_out: np.ndarray, keep: dict, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of an LSTM's input, weights and bias."""
    hidden = w.shape[1] // 4
    n_in = x.shape[1]
    dx, dw = np.zeros_like(x), np.zeros_like(w)
    db = np.zeros(w.shape[1], np.float32)
    dh = np.zeros((keep["docs"], hidden), np.float32)
    dc = np.zeros_like(dh)
    for live, at, i, f, o, g, old_c, old_h, squashed in reversed(keep["trace"]):
        h = dh[:live] + d_out[at]
        c = dc[:live] + h * o * (1 - squashed**2)
        dz = np.concatenate((c * g * i * (1 - i), c * old_c * f * (1 - f), h * squashed * o * (1 - o), c * i * (1 - g**2)), axis=1)
        dw[:n_in] += x[at].T @ dz
        dw[n_in:] += old_h.T @ dz
        db += dz.sum(axis=0)
        dx[at] = dz @ w[:n_in].T
        dh[:live] = dz @ w[n_in:].T
        dc[:live] = c * f
    return dx, dw, db


def fit(texts: Sequence[str], labels: Sequence[list[int]], epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    n_in = WIDTH + SHAPE
    normal = lambda *s, k=0.1: (rng.standard_normal(s) * k).astype(np.float32)
    bias = np.zeros(4 * HIDDEN, np.float32)
    bias[HIDDEN : 2 * HIDDEN] = 1
    w = {"words": normal(BUCKETS, WIDTH, k=0.3), "w_ahead": normal(n_in + HIDDEN, 4 * HIDDEN), "b_ahead": bias.copy(), "w_back": normal(n_in + HIDDEN, 4 * HIDDEN), "b_back": bias.copy(), "w_out": normal(2 * HIDDEN, 1), "b_out": np.zeros(1, np.float32)}
    state: dict = {}
    index = np.arange(len(texts))
    for epoch in range(epochs):
        rng.shuffle(index)
        loss = seen = 0.0
        rate = 0.004 * (0.5 ** (epoch / 4))
        for k in range(0, len(index), 64):
            part = [texts[i] for i in index[k : k + 64]]
            y = np.array([v for i in index[k : k + 64] for v in labels[i]], np.float32)
            (block,) = blocks(part, 1 << 30)
            leaves = Leaves(block)
            x = np.concatenate((leaves.means(w["words"]), leaves.shape), axis=1)
            use = (rng.random(x.shape) > 0.1).astype(np.float32) / 0.9
            use[:, WIDTH:] = 1
            x = x * use
            a, b = {}, {}
            states = np.concatenate((recur(x, leaves.start, leaves.length, w["w_ahead"], w["b_ahead"], False, a), recur(x, leaves.start, leaves.length, w["w_back"], w["b_back"], True, b)), axis=1)
            p = 1 / (1 + np.exp(-(states @ w["w_out"] + w["b_out"])[:, 0]))
            loss += float(-np.sum(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))
            seen += len(y)
            d = ((p - y) / len(y))[:, None]
            ds = d @ w["w_out"].T
            xa, wa, ba = _through(x, ds[:, :HIDDEN], a, w["w_ahead"])
            xb, wb, bb = _through(x, ds[:, HIDDEN:], b, w["w_back"])
            dm = ((xa + xb) * use)[:, :WIDTH]
            counts = np.bincount(leaves.owner, minlength=leaves.n)
            dt = np.zeros_like(w["words"])
            np.add.at(dt, leaves.ids, dm[leaves.owner] / counts[leaves.owner][:, None])
            grads = {"words": dt, "w_ahead": wa, "b_ahead": ba, "w_back": wb, "b_back": bb, "w_out": states.T @ d, "b_out": d.sum(axis=0)}
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            if norm > 1:
                grads = {n: g / norm for n, g in grads.items()}
            _adam(w, grads, state, rate)
        print(epoch, round(loss / max(seen, 1), 5), flush=True)
    return w


def agreement(model: Labeller, texts: Sequence[str], labels: Sequence[list[int]]) -> tuple[float, float]:
    """Precision and recall of the network against labels."""
    hit = said = true = 0
    first = 0
    for block in blocks(texts):
        p = model.scores(Leaves(block)) >= 0.5
        y = np.array([v for i in range(block.n) for v in labels[first + i]], bool)
        first += block.n
        hit, said, true = hit + (p & y).sum(), said + p.sum(), true + y.sum()
    return hit / max(1, said), hit / max(1, true)


def sample_of(tables: str) -> list[str]:
    """Texts of the documents with the least ids, read as the operator reads them."""
    import duckdb

    from . import decoding, statistics
    from .blocks import readable

    con = duckdb.connect()
    path = f"{tables}/documents.parquet"
    import os

    path += "/*.parquet" if os.path.isdir(path) else ""
    rows = con.execute(f"select distinct text, min(doc_id) from '{path}' where text is not null and trim(text) <> '' group by text order by 2 limit {DOCUMENTS}").fetchall()
    inner = lambda t: f"{tables}/{t}.parquet" + ("/*.parquet" if os.path.isdir(f"{tables}/{t}.parquet") else "")
    passages: dict[str, list[str]] = {}
    for lang, text in con.execute(f"select lang, text from '{inner('lang_samples')}'").fetchall():
        passages.setdefault(lang, []).append(text)
    coder = decoding.Coder(decoding.dictionaries(passages, {}))
    words = [r[0] for r in con.execute(f"select word from '{inner('common_words')}'").fetchall()]
    language = statistics.Language(words, [t for ts in passages.values() for t in ts])
    out = []
    for block in blocks([r[0] for r in rows]):
        plain = readable(block, coder)
        kind = statistics.kinds(statistics.document_sums(plain, language))
        out += [t for t, k in zip(plain.texts, kind, strict=True) if k == "prose" and t.strip()]
    return out


def main(out: str, *folders: str) -> None:
    texts = [t for f in folders for t in sample_of(f)]
    np.random.default_rng(1).shuffle(texts)
    teacher = Teacher(texts)
    teacher.learn_inline(texts)
    labels = [teacher.labels(t) for t in texts]
    cut = len(texts) * 9 // 10
    pages = [i for i in range(cut) if any(labels[i])]
    # pages in the rarer languages count twice, documents that are no pages a third; pages whose letters were lost
    # to a wrong decoding are read as they are, so some are learned that way
    rare = [i for i in pages if not re.search("[ışğİŞĞ]", texts[i])]
    learned = pages + rare + [i for i in range(0, cut, 3) if not any(labels[i])]
    lost = pages[::4]
    gone = [re.sub(r"[^\x00-\x7f]", lambda m: "\ufffd" if m[0].isalpha() else m[0], texts[i]) for i in lost]
    w = fit([texts[i] for i in learned] + gone, [labels[i] for i in learned + lost])
    print("precision, recall on the rest:", agreement(Labeller(w), texts[cut:], labels[cut:]))
    np.savez_compressed(out, **{k: v.astype(np.float16) for k, v in w.items()})


if __name__ == "__main__":
    main(*sys.argv[1:])
