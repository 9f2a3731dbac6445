"""Text that went through a wrong character decoding, by minimum description length.

A chain undoes a wrong decoding: it writes the text's non-ASCII runs with the
character set they were wrongly read with, and reads the bytes with the right
one. Every chain that applies to a document's odd lines is tried, and chains of
chains; each candidate is compressed with a zstandard dictionary of each
language, and the chain with the least compressed size plus its own cost wins.
Where none is shorter than the text as it stands, the text is left unchanged.

The dictionaries are the labelled passages and a bounded labelled sample of
the documents (``labels.PER_LANGUAGE``). Only lines with characters that none
of the languages writes, with usual ones in a row that only a wrongly read UTF-8
sequence puts there, or with Cyrillic in inverted case, are odd, however
long the rest of the document is; in a document with a chain, the chain is
tried on every other line as well. A line all in capitals is compared as if in
small letters, so that a heading is not taken for inverted case.

Characters that are odd to the languages here may be right in another one, so a
chain must have evidence beside its length. A step to UTF-8 has it where most
of the odd characters make whole sequences of letters or signs. Any other step
must turn words into words whose letters follow each other as in one of the
languages that write their script, and did not so before; for a chain of several
steps so many different ones that chance would not meet them among all chains
of the length. Without evidence a text is left unchanged.

The search (``Search``) tries every chain up to the depth, in every language:
texts that several chains make are looked at once, those without evidence are
not compressed (and dropped as soon as the words not yet looked at cannot give
it), and no other is left out. ``Search(beam=3)`` extends the best
three candidates of a length only, in the languages that fit the text's ASCII
letters; ``QUICK`` is that search, which operators 2, 3 and 6 read texts with.

Defined results: null, empty and blank texts take no part; lines are split at
line feeds and counted from 0; a lost original gives a null ``repaired``; rows
that repeat an id give a row each; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product, repeat
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import confusables, labels
from .textvec import TABLE_END, TRIGRAM_BITS, U64, Block, arrow, blocks, docs_in, mix, read, trigrams

#: Bytes that a step of a chain costs.
STEP = 3
#: Bytes that an odd character costs beyond its code.
ODD = 2
#: Bytes of a language's dictionary.
DICTIONARY = 160_000
#: Share of the letters' trigrams around what a chain changed that a language must know, and by how much more than before.
KNOWN, GAIN = 0.68, 0.15
#: What it must be where the rest of the text is too short (fewer than FEW letters) to show its language.
ALONE, FEW = 0.85, 40
#: What it must be, and exceed what it was by, where a chain turns letters of the languages into others.
CLEAR = 0.25
#: How far the share of the trigrams of a text's ASCII words may lie below what a new text of the language has, and below the best language's.
FIT, NEAR = 0.1, 0.04
#: A language whose share is so many times the second best's fits as well.
AHEAD = 1.25

#: What the languages and their typography write beyond ASCII.
LETTERS = "çğıöşüÇĞİÖŞÜâîûəƏäÄßàæéèêëïôœùÿÀÉÈÊÎÔáíñóúÁÍÑÓÚ"
TYPOGRAPHY = "¿¡ºª…–—‘’“”„«»‹›·•°§©®™€№▸●■▪◦→"
CYRILLIC = "".join(map(chr, range(0x410, 0x450))) + "ёЁ"
_LEGACY_ONLY = "■"  # a bullet to typographers, but also the commonest wrong reading of ş

#: Character sets that texts are wrongly read as, and 8-bit sets they are written in.
READ_AS = ("cp1252", "cp1254", "cp437", "cp850", "cp857", "cp866", "cp1251", "koi8-r", "cp1250", "cp1253", "cp1257", "cp852", "iso8859-2", "iso8859-5", "iso8859-7", "mac-roman")
WRITTEN_IN = ("cp1254", "cp1252", "cp1251", "koi8-r", "cp866", "cp857")
#: (wrongly read as, written in) of the steps. What a character set leaves undefined stands for its own byte.
STEPS = tuple([(a, "utf-8") for a in READ_AS] + [(a, b) for b in WRITTEN_IN for a in READ_AS if a != b])
_RUN = re.compile("[^\x00-\x7f]+")
_CUT = re.compile("([^\x00-\x7f]+)")
_CYRILLIC_RUN = re.compile("[Ѐ-ӿ]")
#: A Cyrillic word that begins small and goes on in capitals.
_INVERTED_WORD = re.compile(r"(?<![^\W\d_])[а-яё][А-ЯЁ]")
#: Typography, which no language's words hold.
_SIGN = f"[{re.escape(TYPOGRAPHY)}]"
_SIGNS = re.compile(f"(?<!{_SIGN})(?:(?<![^\\W\\d_]){_SIGN}++|{_SIGN}++(?![^\\W\\d_]))")
_BETWEEN = {ord("’"): None, ord("–"): "\0", ord("—"): "\0"}
_TYPOGRAPHY = frozenset(TYPOGRAPHY)
#: White space that no step changes.
_ASCII_SPACE = re.compile("[\t-\r\x1c-\x20]+")
_LONE = re.compile(r"(?:^|(?<=\s))\?(?=\s|$)")


def _bare(word: str) -> str:
    """A word without the signs around it; of those between its letters an apostrophe joins, a dash parts, and any other is no letter of a word."""
    return word if _TYPOGRAPHY.isdisjoint(word) else _SIGNS.sub("", word).translate(_BETWEEN)


def _bare_all(words: list[str], at: list[int]) -> list[str]:
    """Words without white space, those at some places bare; made in one pass, for a line feed between them is no letter and no sign."""
    if at:
        bare = _SIGNS.sub("", "\n".join([words[k] for k in at]))
        for c, new in _BETWEEN.items():
            bare = bare.replace(chr(c), new or "")
        for k, w in zip(at, bare.split("\n")):
            words[k] = w
    return words


@lru_cache(maxsize=512)
def _bytes_of(charset: str) -> dict[str, int]:
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(charset)] = b
        except UnicodeDecodeError:
            pass
        out.setdefault(chr(b) if b < 160 else "", b)  # an undefined byte came through as a control character
    out.pop("", None)
    return out


@lru_cache(maxsize=1)
def _pairs() -> tuple[dict[str, int], dict[str, int]]:
    """By character, a bit for each set it was wrongly read with where its byte begins a UTF-8 sequence, and where it goes on with one."""
    first, second = Counter(), Counter()
    for i, wrong in enumerate(READ_AS):
        for c, b in _bytes_of(wrong).items():
            first[c] |= (0xC2 <= b < 0xF5) << i
            second[c] |= (b < 0xC0) << i
    return dict(first), dict(second)


@lru_cache(maxsize=512)
def _map(wrong: str, right: str) -> dict[int, str]:
    out = {}
    for c, b in _bytes_of(wrong).items():
        try:
            new = bytes([b]).decode(right)
        except UnicodeDecodeError:
            continue
        if new in _usual():  # a byte without such a letter was not written in this set
            out[ord(c)] = new
    return out


@lru_cache(maxsize=512)
def _letters_of(wrong: str, right: str) -> frozenset[str]:
    return frozenset(map(chr, _map(wrong, right)))


def _decoded(run: str, wrong: str, right: str) -> str:
    """A run of non-ASCII characters decoded anew, where its bytes allow it."""
    if right != "utf-8":
        return run.translate(_map(wrong, right))
    if len(run) < 2:
        return run
    table = _bytes_of(wrong)
    try:
        return bytes([table[c] for c in run]).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return _sequences(run, table)


class Runs:
    """A text cut at its runs of non-ASCII characters, of which few differ; each is decoded once a step."""

    def __init__(self, text: str) -> None:
        self.parts = _CUT.split(text)
        self.counts = Counter(self.parts[1::2])
        self.seen: set[tuple[str, ...]] = {tuple(self.counts)}
        self.length = len(text)

    def undone(self, wrong: str, right: str) -> tuple[Callable[[], str] | None, int, int]:
        """The decoded text (made when called), at least how many odd characters it has, and its length; None for one seen before."""
        new = {r: _decoded(r, wrong, right) for r in self.counts}
        made = tuple(new.values())
        if made in self.seen:
            return None, 0, 0
        self.seen.add(made)
        table = odd_table()
        odd = sum(k * sum(c != "Â" and table[min(ord(c), TABLE_END - 1)] for c in new[r]) for r, k in self.counts.items())
        length = self.length + sum(k * (len(new[r]) - len(r)) for r, k in self.counts.items())

        def text() -> str:
            parts = list(self.parts)
            parts[1::2] = [new[r] for r in parts[1::2]]
            return "".join(parts)

        return text, int(odd), length


def undo(text: str, wrong: str, right: str) -> str:
    """The text with each run of non-ASCII characters decoded anew."""
    return _RUN.sub(lambda m: _decoded(m[0], wrong, right), text)


def _sequences(run: str, table: dict[str, int]) -> str:
    """The run's whole UTF-8 sequences decoded, the rest left."""
    out, i = [], 0
    while i < len(run):
        lead = table.get(run[i], 0)
        n = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
        part = run[i : i + n]
        if n > 1:
            try:
                part, i = bytes([table[c] for c in part]).decode("utf-8"), i + n - 1
            except (KeyError, UnicodeDecodeError):
                part = run[i]
        out.append(part)
        i += 1
    return "".join(out)


@lru_cache(maxsize=1)
def _usual() -> set[str]:
    usual = set(LETTERS + TYPOGRAPHY + CYRILLIC) - set(_LEGACY_ONLY)
    usual |= set(confusables.CYRILLIC[0] + confusables.GREEK[0])
    usual |= {chr(i) for i in (*range(128), *range(0x300, 0x370), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFFF0), *range(0x1F000, 0x1FB00))}
    return usual | {c for c in map(chr, range(128, 0x10000)) if c.isspace() and c != "\x85" or confusables._DROP.match(c)}


@lru_cache(maxsize=1)
def odd_table() -> np.ndarray:
    """True for characters that none of the languages writes."""
    table = np.ones(TABLE_END, bool)
    table[[ord(c) for c in _usual() if ord(c) < TABLE_END]] = False
    table[-1] = False
    return table


@lru_cache(maxsize=1)
def _readings() -> dict[str, str]:
    """UTF-8 sequences of two and three bytes whose wrong reading holds usual characters only, and what they stand for."""
    usual, out = _usual(), {}
    for wrong in READ_AS:
        of: dict[int, list[str]] = {}
        for c, b in _bytes_of(wrong).items():
            if c in usual:
                of.setdefault(b, []).append(c)
        for new in (*LETTERS, *TYPOGRAPHY, *CYRILLIC):
            if new in usual:
                for old in product(*(of.get(b, ()) for b in new.encode())):
                    out["".join(old)] = new
    return out


@lru_cache(maxsize=1)
def _sequence() -> str:
    """A pattern of such sequences, where no text would have their characters side by side.

    Two-byte ones of a mark after a letter take more: a Latin letter that does
    not end a word in capitals, a Cyrillic one before a Latin word, or two in a
    row where they stand for Cyrillic, whose letters seldom stand alone.
    """
    of = lambda keep: "|".join(re.escape(k) for k, new in sorted(_readings().items()) if keep(k, new)) or "(?!)"
    pair = lambda k, new: len(k) == 2 and new not in CYRILLIC
    capital = "[A-Z" + "".join(c for c in LETTERS if c.isupper()) + "]"
    own = [c for c in CYRILLIC if c not in confusables.CYRILLIC[0]]
    ways = (
        of(lambda k, new: len(k) == 3 or k == "Ä°"),
        f"(?<!{capital}{capital})(?:{of(lambda k, new: pair(k, new) and k[0] in LETTERS)})",
        f"(?:{of(lambda k, new: pair(k, new) and k[0] in own and not k[1].isspace())})(?=[A-Za-z{LETTERS}])",
        f"(?:{of(lambda k, new: new in CYRILLIC)}){{2,}}",
    )
    return "(?=[" + "".join(sorted({k[0] for k in _readings()})) + "])(?:" + "|".join(ways) + ")"


@lru_cache(maxsize=1)
def _ends_of_readings() -> tuple[np.ndarray, np.ndarray]:
    """True for the first, and for the second characters of such sequences."""
    tables = np.zeros((2, TABLE_END), bool)
    for k in _readings():
        tables[0, ord(k[0])] = tables[1, ord(k[1])] = True
    return tables[0], tables[1]


@lru_cache(maxsize=1)
def _odd() -> re.Pattern[str]:
    table = odd_table().copy()
    table[ord("Â")] = False
    low = "".join(re.escape(chr(i)) for i in np.flatnonzero(table[:0x3000]))
    own = f"[{low}\\ue000-\\uf8ff\\ufff0-\\uffff]"
    # Cyrillic without a Latin twin, inside a Latin word
    cyrillic = "[" + "".join(c for c in CYRILLIC if c not in confusables.CYRILLIC[0]) + "]"
    latin = f"[A-Za-z{LETTERS}]"
    # Â begins a word or stands in one; before anything else it is the first byte of a pair
    return re.compile(f"{own}|Â(?![^\\W\\d_])|{_sequence()}|(?<={latin}){cyrillic}|{cyrillic}(?={latin})")


@lru_cache(maxsize=1)
def _scripts() -> np.ndarray:
    """1 for Latin letters, 2 for Cyrillic ones without a Latin twin."""
    table = np.zeros(TABLE_END, np.uint8)
    table[[*range(65, 91), *range(97, 123), *map(ord, LETTERS)]] = 1
    table[[ord(c) for c in CYRILLIC if c not in confusables.CYRILLIC[0]]] = 2
    return table


@dataclass(frozen=True)
class Search:
    """Steps of a chain at most, and how many candidates a further step is tried on (None: all, in every language)."""

    depth: int = 3
    beam: int | None = None


QUICK = Search(beam=3)


class Coder:
    """Compressed sizes of a text with the dictionary of each language, and the trigrams of its letters."""

    def __init__(self, texts: dict[str, bytes], search: Search = QUICK) -> None:
        self.coders, self.search, self.readings = {}, search, Readings()
        self.known: dict[str, np.ndarray] = {}
        self.lanes: np.ndarray | None = None
        self.whole: dict[str, float] = {}
        for lang, raw in texts.items():
            counts = np.zeros(1 << TRIGRAM_BITS, np.int64)
            for block in blocks(raw.decode("utf-8", "ignore").split("\n")):
                letter, t = trigrams(block.clipped())
                np.add.at(counts, t[letter], 1)
            self.known[lang] = counts > 0
            # what share of a new text's trigrams the dictionary may be expected to hold, by those it holds once (Good and Turing)
            self.whole[lang] = 1 - np.count_nonzero(counts == 1) / max(counts.sum(), 1)
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            self.coders[lang] = zstandard.ZstdCompressor(dict_data=d, level=3, write_checksum=False, write_content_size=False, write_dict_id=False)

    def sizes(self, text: str) -> dict[str, int]:
        """By language, of those that write the text's script."""
        raw = text.encode("utf-8", "replace")
        russian = 3 * len(_CYRILLIC_RUN.findall(text)) > len(text)
        return {k: len(c.compress(raw)) for k, c in self.coders.items() if (k == "ru") == russian} or {"": len(raw)}

    def share(self, tokens: list[str], lang: str) -> float:
        """Of the signs beyond ASCII in the tokens and the letters beside them, the share that stands as in the language."""
        if not tokens:
            return 0.0
        cp = Block(tokens, 0).clipped()
        letter, t = trigrams(cp)
        own = cp > 127
        near = own.copy()
        near[1:] |= own[:-1]
        near[:-1] |= own[1:]
        near &= letter | own
        return float((letter & self.known[lang][t])[near].mean()) if near.any() else 0.0

    def stands(self, tokens: list[str]) -> np.ndarray:
        """What the share of each token is the quotient of: a column of hits for each language, then how many signs were looked at."""
        block = Block(tokens, 0)
        cp = block.clipped()
        letter, t = trigrams(cp)
        own = cp > 127
        near = own.copy()
        near[1:] |= own[:-1]
        near[:-1] |= own[1:]
        near &= letter | own
        before = np.concatenate(([0], np.cumsum(near)))
        lo, hi = before[block.start], before[block.end]
        letter, t = letter[near], t[near]
        if len(self.known) < 8 and len(lo) and (hi - lo).max() < 256:
            # eight bits a language of one sum: what runs over in the sum of all tokens cancels out in that of each
            if self.lanes is None:
                self.lanes = sum(known.astype(U64) << U64(8 * k) for k, known in enumerate(self.known.values()))
            c = np.concatenate((np.zeros(1, U64), np.cumsum(np.where(letter, self.lanes[t], U64(0)))))
            hits = np.ascontiguousarray(c[hi] - c[lo], "<u8").view(np.uint8).reshape(-1, 8)[:, : len(self.known)]
            return np.concatenate((hits, (hi - lo)[:, None]), axis=1).astype(np.int32)
        sums = [np.concatenate(([0], np.cumsum(letter & known[t], dtype=np.int32))) for known in self.known.values()]
        return np.stack([c[hi] - c[lo] for c in sums] + [hi - lo], axis=1).astype(np.int32)

    def fits(self, tokens: list[str]) -> set[str] | None:
        """The languages whose trigrams the letters of ASCII tokens follow; None where there are few letters."""
        cp = Block(tokens or [""], 0).clipped()
        letter, t = trigrams(cp)
        shares = {k: float(known[t[letter]].mean()) if letter.any() else 0.0 for k, known in self.known.items()}
        if letter.sum() < FEW:
            return None
        best, second = ([*sorted(shares.values(), reverse=True), 0.0, 0.0])[:2]
        return {k for k, x in shares.items() if x >= self.whole[k] - FIT and x >= best - NEAR or x == best > AHEAD * second}

    def near(self, text: str) -> frozenset[str]:
        """The languages to try a text's decodings in: Russian, and two of those that its ASCII letters fit best."""
        if self.search.beam is None:
            return frozenset(self.coders) | {"ru"}
        sizes = self.sizes(_RUN.sub(" ", text))
        return frozenset(sorted(sizes, key=sizes.get)[:2]) | {"ru"}

    def size(self, text: str, langs: frozenset[str] | None = None) -> int:
        if langs is None:
            return min(self.sizes(text).values())
        raw = text.encode("utf-8", "replace")
        russian = 3 * len(_CYRILLIC_RUN.findall(text)) > len(text)
        return min((len(self.coders[k].compress(raw)) for k in langs if (k == "ru") == russian and k in self.coders), default=len(raw))


def dictionaries(right: dict[str, list[str]], seen: dict[str, list[str]]) -> dict[str, bytes]:
    """Of each language, its passages, after as many clean lines of its sample as fit."""
    out = {}
    for lang, passages in right.items():
        own = "\n".join(passages)
        lines = [line for t in seen.get(lang, ()) for line in t.split("\n") if not _odd().search(line) and not _INVERTED_WORD.search(line)]
        out[lang] = ("\n".join(lines)[: max(0, DICTIONARY - len(own))] + "\n" + own[-DICTIONARY:]).encode()[-2 * DICTIONARY :]
    return out


def _inverted(line: str) -> bool:
    """Cyrillic mostly in capitals, as when one 8-bit set for it is read as another."""
    letters = [c for c in line if "Ѐ" <= c <= "ӿ"]
    return len(letters) > 5 and sum(c.isupper() for c in letters) > 0.5 * len(letters)


def _plain_size(line: str, coder: Coder) -> int:
    """The size of a line as it stands; capitals of a heading cost no more than small letters."""
    return min(coder.size(line), coder.size(line.lower())) if _inverted(line) else coder.size(line)


def _plausible(c: str) -> bool:
    """Letters and signs of the common alphabets, and typography."""
    o = ord(c)
    return c.isalpha() and (0xAA <= o < 0x250 or 0x370 <= o < 0x600 or 0x620 <= o < 0x700 or 0x1E00 <= o < 0x2000) or c in TYPOGRAPHY or 0x2010 <= o < 0x2040 or o in (0xA0, 0x20AC, 0x2122) or o >= 0x1F000 or 0x3040 <= o < 0xD7A4 or 0xFB00 <= o < 0xFB07


def _whole(text: str, step: tuple[str, str]) -> tuple[int, int]:
    """(odd characters that a step to UTF-8 reads as parts of plausible signs, all odd characters); a sign that it reads so is odd."""
    table, read, rest = _bytes_of(step[0]), 0, 0
    for run in _RUN.findall(text):
        i = 0
        while i < len(run):
            lead = table.get(run[i], 0)
            n = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
            try:
                ok = n > 1 and _plausible(bytes([table[c] for c in run[i : i + n]]).decode("utf-8"))
            except (KeyError, UnicodeDecodeError):
                ok = False
            if ok:
                read, i = read + n, i + n
            else:
                rest += odd_table()[min(ord(run[i]), TABLE_END - 1)]
                i += 1
    return read, read + int(rest)


def _supported(old: str, new: str, chain: tuple[tuple[str, str], ...], coder: Coder) -> bool:
    """Whether there is evidence for a chain: whole UTF-8 sequences, or words of a language that were none before."""
    if not all(c in _usual() or _plausible(c) for c in set(new) - set(old)):
        return False
    if all(step[1] == "utf-8" for step in chain):
        text = old
        for step in chain:
            read, of = _whole(text, step)
            if 2 * read < of or not read:
                # a second reading of what the first one made: whole sequences were cut by characters that got lost
                break
            text = undo(text, *step)
        else:
            return True
    words = lambda t: Counter(w for w in t.split() if not w.isascii())
    a, b = words(old), words(new)
    was, now = list((a - b).elements()), list((b - a).elements())
    now = [_bare(w) for w in now]
    different = sorted(set(now))
    cyrillic = 3 * len(_CYRILLIC_RUN.findall("".join(different))) > len("".join(different))
    fits = coder.fits([w for w in new.split() if w.isascii()])
    if fits is None and all(sum(map(str.isalpha, w)) < 2 for w in now):
        return False  # words of one letter show no language
    for lang in coder.known:
        before, after = coder.share(was, lang), coder.share(now, lang)
        if fits is not None and lang not in fits or (lang == "ru") != cyrillic:
            continue  # it does not fit the rest of the text, or writes another script
        least, gain = ALONE if fits is None else KNOWN, GAIN
        if was and all(c in _usual() for w in was for c in w):
            least = gain = CLEAR  # what stood there before were letters of the languages as well, so the gain tells
        if after >= max(least * coder.whole[lang] ** 4, before + gain) and (len(chain) == 1 or _outweighs(different, coder.share(different, lang), len(chain))):
            return True
    return False


def _outweighs(words: list[str], share: float, length: int) -> bool:
    """Whether different words whose signs stand as in a language to this share would not be met by chance among all chains of the length (Chernoff)."""
    signs = sum(c > "\x7f" for w in words for c in w)
    nats = sum(x * log(x / y) for x, y in ((share, CLEAR), (1 - share, 1 - CLEAR)) if x > 0)
    return share > CLEAR and signs * nats >= length * log(len(STEPS))


def _ranks(codes: np.ndarray, size: int) -> tuple[int, np.ndarray]:
    """How many codes below ``size`` differ, and the place of each among them."""
    if size > 1 << 22:
        distinct, at = np.unique(codes, return_inverse=True)
        return len(distinct), at
    there = np.zeros(size, bool)
    there[codes] = True
    place = np.cumsum(there) - 1
    return int(place[-1]) + 1, place[codes]


def _distinct(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which codes below ``size`` there are, and the place of each among them."""
    if size > 4 * len(codes):
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    return np.flatnonzero(there), (np.cumsum(there, dtype=np.int32) - 1)[codes]


class Readings:
    """What every step makes of a run, as numbers of runs; those of one character recur from text to text and stay."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.runs: list[str] = []
        self.next: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.of_char: dict[str, list[str]] = {}
        for c in sorted({c for wrong in READ_AS for c in _bytes_of(wrong)}):
            self.id(c)

    def id(self, run: str) -> int:
        i = self.ids.setdefault(run, len(self.runs))
        if i == len(self.runs):
            self.runs.append(run)
        return i

    def _char(self, c: str) -> list[str]:
        if c not in self.of_char:
            self.of_char[c] = [_map(*step).get(ord(c), c) for step in STEPS if step[1] != "utf-8"]
        return self.of_char[c]

    def steps(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The run that each step makes of a run, and its hash."""
        if i not in self.next:
            run = self.runs[i]
            made, (first, second), may = [run] * len(READ_AS), _pairs(), 0
            for a, b in zip(run, run[1:]):
                may |= first.get(a, 0) & second.get(b, 0)
            if may:
                made = [_decoded(run, wrong, "utf-8") if may >> k & 1 else run for k, wrong in enumerate(READ_AS)]
            made += map("".join, zip(*map(self._char, run))) if len(run) > 1 else self._char(run)
            ids = [self.id(m) if k is None else k for k, m in zip(map(self.ids.get, made), made)]
            self.next[i] = np.array(ids, np.int32), np.fromiter(map(hash, made), np.int64, len(STEPS))
        return self.next[i]

    def forget(self, since: int) -> None:
        """Drop the runs from a number on."""
        for run in self.runs[since:]:
            del self.ids[run]
        del self.runs[since:]
        self.next = {i: x for i, x in self.next.items() if i < since and x[0].max() < since}


class Chains:
    """Every text that chains make of one text, length by length, as a row of the readings of its runs."""

    #: Readings that are looked at together, before those of each step.
    READINGS = 10_000
    #: Readings beyond which those of the last length are dropped, to be made anew where they recur.
    KEPT = 300_000

    def __init__(self, text: str, coder: Coder, readings: Readings) -> None:
        self.text, self.coder, self.readings = text, coder, readings
        self.parts = _CUT.split(text)
        distinct = list(dict.fromkeys(self.parts[1::2]))
        self.first = np.array([[readings.id(r) for r in distinct]], np.int32)
        self.place = [distinct.index(r) for r in self.parts[1::2]]
        self.words = Counter(w for w in text.split() if not w.isascii())
        words = _ASCII_SPACE.split(text)
        self.fits = coder.fits([w for w in words if w.isascii()])
        # other white space may come, go or cut off an ASCII word, and then another language may fit
        self.spaced = any(c.isspace() for c in set("".join(distinct)))
        # words with the same runs have as many readings
        self.alike: dict[tuple[int, ...], dict[str, int]] = {}
        for w, k in Counter(w for w in words if not w.isascii()).items():
            places = tuple(dict.fromkeys(distinct.index(r) for r in _RUN.findall(w)))
            self.alike.setdefault(places, {})[w] = k
        self.skeletons: dict[tuple[str, ...], list[str]] = {}
        for w in self.words:
            self.skeletons.setdefault(tuple(_CUT.split(w)[::2]), []).append(w)
        self.runs = distinct
        # the words that most signs are looked at in come first, so that what has no evidence is told early
        most = lambda words: sum(k * sum(len(r) + 2 for r in _RUN.findall(w)) for w, k in words.items())
        self.groups = sorted(((most(words), places) for places, words in self.alike.items()), key=lambda x: -x[0])
        self.old: dict[str, np.ndarray] = {}
        self.wanted: dict[tuple[int, ...], tuple[set[str], bool]] = {}
        self.values = np.zeros(0, np.uint8)
        self.known, self.allowed, self.spaces, self.plain = set(), set(), set(), set()

    def of(self, row: np.ndarray) -> str:
        new = [self.readings.runs[i] for i in row]
        parts = list(self.parts)
        parts[1::2] = [new[p] for p in self.place]
        return "".join(parts)

    def level(self, rows: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts that a step makes of the rows' and that were not seen before: their rows, the row and the step of the first way to each; all hashes seen."""
        h, tables = np.zeros((len(rows), len(STEPS)), U64), []
        for j in range(rows.shape[1]):
            ids, at = np.unique(rows[:, j], return_inverse=True)
            made, hashes = map(np.stack, zip(*map(self.readings.steps, ids.tolist())))
            h += self._hash(hashes, j)[at]
            tables.append((made, at))
        h, first = np.unique(h.ravel(), return_index=True)
        new = ~np.isin(h, seen, assume_unique=True)
        first = np.sort(first[new])
        parents, steps = first // len(STEPS), first % len(STEPS)
        return np.stack([made[at[parents], steps] for made, at in tables], axis=1), parents, steps, np.concatenate((seen, h[new]))

    @staticmethod
    def _hash(hashes: np.ndarray, j: int) -> np.ndarray:
        return mix(hashes.view(U64) ^ mix(np.array([j + 1])))

    def seen(self) -> np.ndarray:
        return sum(self._hash(np.array([hash(run)]), j) for j, run in enumerate(self.runs))

    def forget(self, since: int) -> None:
        self.readings.forget(since)
        self.values = self.values[:since]

    def _values(self, ids: np.ndarray) -> np.ndarray:
        """Of readings: whether all characters are plausible or stood in the text (1), whether one is white space (2), and whether a sign (4)."""
        if len(self.values) < len(self.readings.runs):
            self.values = np.concatenate((self.values, np.zeros(len(self.readings.runs) - len(self.values), np.uint8)))
        new = np.unique(ids[self.values[ids] == 0])
        for i in new.tolist():
            run = self.readings.runs[i]
            if self.plain.issuperset(run):
                self.values[i] = 9
                continue
            if not self.known.issuperset(run):
                self.known.update(run)
                self.allowed.update(c for c in run if c in _usual() or c in self.text or _plausible(c))
                self.spaces.update(c for c in run if c.isspace())
                self.plain.update(c for c in run if c in self.allowed and c not in self.spaces and c not in _TYPOGRAPHY)
            self.values[i] = 8 | self.allowed.issuperset(run) | (not self.spaces.isdisjoint(run)) << 1 | (not _TYPOGRAPHY.isdisjoint(run)) << 2
        return self.values[ids]

    def _spaced(self, old: str, readings: list[str]) -> np.ndarray:
        """The features of a word and its readings where white space comes or goes."""
        now, was, marks = [], [], np.zeros((len(readings), 3), np.int32)
        for k, new in enumerate(readings):
            if old == new:
                continue
            x, y = (Counter(w for w in t.split() if not w.isascii()) for t in (old, new))
            a, b = list((x - y).elements()), list((y - x).elements())
            was += [(k, w) for w in a]
            now += [(k, _bare(w)) for w in b]
            marks[k] = any(c not in _usual() for w in a for c in w), any(w in self.words for w in b), True
        out = []
        for part in (now, was):
            sums = np.zeros((len(readings), len(self.coder.known) + 1), np.int32)
            if part:
                np.add.at(sums, [k for k, _ in part], self.coder.stands([w for _, w in part]))
            out.append(sums)
        return np.concatenate((*out, marks), axis=1)

    def _features(self, words: dict[str, int], places: tuple[int, ...], ids: np.ndarray) -> np.ndarray:
        """Over words with the same runs, for each row of the runs' readings.

        The sums of the new words and of the old ones that are no more; and
        whether an old one is odd, a new one stood in the text before, or one is
        cut at white space.
        """
        n = len(self.coder.known) + 1
        out = np.zeros((len(ids), 2 * n + 3), np.int32)
        changed = (ids != self.first[0, list(places)]).any(axis=1)
        of = {self.runs[p]: j for j, p in enumerate(places)}
        values = np.bitwise_or.reduce(self._values(ids), axis=1)
        spaced, signed = values & 2 > 0, np.flatnonzero(values & 6 == 4).tolist()
        whole = [[self.readings.runs[i] for i in c.tolist()] for c in ids.T]
        fill = lambda cut, runs: list(map("".join, zip(*(whole[of[x]] if k % 2 else repeat(y, len(ids)) for k, (x, y) in enumerate(zip(runs, cut))))))
        known: dict[tuple[str, ...], np.ndarray] = {}
        for word, count in words.items():
            cut = _CUT.split(word)
            slow = np.full(len(ids), True) if len(word.split()) != 1 or word.split()[0] != word else spaced
            own = np.zeros_like(out)
            if not slow.all():
                near = (cut[0][-2:], *cut[1:-1], cut[-1][:2])  # letters further off are not looked at
                if near not in known:
                    known[near] = self.coder.stands(_bare_all(fill(near, cut), signed))
                own[:, :n] = known[near]
                if word not in self.old:
                    self.old[word] = self.coder.stands([word])
                own[:, n : 2 * n] = self.old[word]
                own[:, 2 * n] = any(c not in _usual() for c in word)
                for other in self.skeletons.get(tuple(cut[::2]), ()):
                    if other != word:
                        want = dict(zip(cut[1::2], _RUN.findall(other)))
                        own[:, 2 * n + 1] |= (ids == [self.readings.ids.get(want[self.runs[p]], -1) for p in places]).all(axis=1)
                own *= changed[:, None]
            if slow.any():
                at = np.flatnonzero(slow)
                full = fill(cut, cut)
                own[at] = self._spaced(word, [full[r] for r in at.tolist()])
            own[:, : 2 * n] *= count
            out += own
        return out

    def _may_stand(self, places: tuple[int, ...], columns: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Rows where a new word of a group may have stood in the text before, or is parted by white space."""
        if places not in self.wanted:
            others = [o for w in self.alike[places] for o in self.skeletons.get(tuple(_CUT.split(w)[::2]), ()) if o != w]
            self.wanted[places] = {r for o in others for r in _RUN.findall(o)}, any(w.split() != [w] for w in self.alike[places])
        runs, parted = self.wanted[places]
        wanted = [self.readings.ids[r] for r in runs if r in self.readings.ids]
        may, spaced = True, parted
        for p in places:
            ids, at, white = columns[p]
            may = may & np.isin(ids, wanted)[at] if wanted else False
            spaced = spaced | white[at]
        return may | spaced

    def _may_be_evident(self, total: np.ndarray, left: int) -> np.ndarray:
        """Rows that may get evidence, or have it already, if every one of the signs left to look at stands as in a language."""
        n = len(self.coder.known)
        odd, good = total[:, 2 * n + 2] > 0, total[:, 2 * n + 3] > 0
        for k, lang in enumerate(self.coder.known):
            most = (total[:, k] + left) / (total[:, n] + left)
            good |= most >= np.where(odd, KNOWN, CLEAR) * self.coder.whole[lang] ** 4 - 1e-9
        return good

    def evident(self, rows: np.ndarray) -> np.ndarray:
        """Rows that may have evidence in their words; every row that ``_supported`` accepts for its words is among them."""
        keep, columns = np.ones(len(rows), bool), []
        for j in range(rows.shape[1]):
            ids, at = _distinct(rows[:, j], len(self.readings.runs))
            values = self._values(ids)
            keep &= (values & 1 > 0)[at]
            columns.append((ids, at, values & 2 > 0))
        kept = np.flatnonzero(keep)
        n = len(self.coder.known)
        total = np.zeros((len(kept), 2 * n + 5), np.int32)
        may_stand = [self._may_stand(places, columns) for _, places in self.groups]
        waiting = np.sum(may_stand, axis=0, dtype=np.int32)[kept]
        left = last = sum(most for most, _ in self.groups)
        for (most, places), stands in zip(self.groups, may_stand):
            if not len(kept):
                return kept
            size, at = 1, np.zeros(len(kept), np.int64)
            for p in places:
                size, at = _ranks(at * len(columns[p][0]) + columns[p][1][kept], size * len(columns[p][0]))
            one = np.zeros(size, np.int64)
            one[at] = np.arange(len(at))
            total += self._features(self.alike[places], places, rows[np.ix_(kept[one], places)])[at]
            waiting -= stands[kept]
            left -= most
            if last - left >= last / 8 and left:
                may, last = (waiting > 0) | self._may_be_evident(total, left), left
                kept, total, waiting = kept[may], total[may], waiting[may]
        now, was, (odd, stood, cut) = total[:, : n + 1], total[:, n + 1 : 2 * n + 2], total[:, 2 * n + 2 :].T > 0
        cut = cut | self.spaced
        share = lambda x, k: x[:, k] / np.maximum(x[:, n], 1)
        good = stood.copy()
        changed = was[:, n] > 0
        for k, lang in enumerate(self.coder.known):
            after, before = share(now, k), share(was, k)
            whole = self.coder.whole[lang] ** 4
            least = np.where(odd, np.where(cut | (self.fits is not None), KNOWN, ALONE), CLEAR)
            enough = after >= np.maximum(least * whole, before + np.where(odd, GAIN, CLEAR)) - 1e-9
            enough |= ~changed & (after >= KNOWN * whole - 1e-9)
            good |= enough & (cut | (self.fits is None or lang in self.fits))
        return kept[good]


def _sequence_chains(text: str, depth: int) -> Iterator[list[tuple[tuple[tuple[str, str], ...], str]]]:
    """Length by length, the chains of steps to UTF-8 whose evidence are whole sequences, and the texts they make."""
    level, seen = [((), text)], {text}
    for _ in range(depth):
        made = []
        for steps, old in level:
            for step in STEPS[: len(READ_AS)]:
                read, of = _whole(old, step)
                if read and 2 * read >= of and (new := undo(old, *step)) not in seen:
                    seen.add(new)
                    made.append(((*steps, step), new))
        level = made
        yield level


def _every_chain(text: str, coder: Coder, best: int, depth: int) -> tuple[tuple[str, str], ...]:
    """Of all chains that have evidence, the one with the least description below ``best``; of equals the shortest, then the first."""
    readings = coder.readings
    start, chain = len(readings.runs), ()
    chains = Chains(text, coder, readings)
    rows, ways, seen = chains.first, np.zeros((1, 0), np.int16), chains.seen()
    for length, sequences in enumerate(_sequence_chains(text, depth), 1):
        found: list[tuple[int, tuple[tuple[str, str], ...], str]] = []

        def weigh(steps: tuple[tuple[str, str], ...], made: str) -> None:
            cost = coder.size(made) + STEP * length
            if cost < best and (cost := cost + ODD * len(_odd().findall(made))) < best:
                found.append((cost, steps, made))

        for steps, made in sequences:
            weigh(steps, made)
        at_once = max(1, Chains.READINGS // rows.shape[1])
        levels, longer = [rows[:0]], [np.zeros((0, length), np.int16)]
        since = len(readings.runs)
        for lo in range(0, len(rows), at_once):
            new, parents, last, seen = chains.level(rows[lo : lo + at_once], seen)
            way = np.concatenate((ways[lo + parents], last[:, None].astype(np.int16)), axis=1)
            for r in chains.evident(new).tolist():
                weigh(tuple(STEPS[i] for i in way[r].tolist()), chains.of(new[r]))
            if length < depth:
                levels.append(new)
                longer.append(way)
            elif len(readings.runs) > since + Chains.KEPT:  # no step follows, and the last texts are by far the most
                chains.forget(since)
        found.sort(key=lambda x: x[:2])
        won = next((x for x in found if _supported(text, x[2], x[1], coder)), None)
        if won:
            best, chain = won[:2]
        rows, ways = np.concatenate(levels), np.concatenate(longer)
    chains.forget(start)
    return chain


def best_chain(text: str, coder: Coder, cyrillic: bool) -> tuple[tuple[str, str], ...]:
    """The chain with the least description of an odd text; empty where it is best left unchanged."""
    odd = len(_odd().findall(text))
    langs = coder.near(text)
    best, chain = coder.size(text, langs) + ODD * odd, ()
    if cyrillic:  # a clean heading in capitals costs no more than in small letters; a word of inverted case is odd
        inverted = len(_INVERTED_WORD.findall(text))
        best = min(best + ODD * inverted, coder.size(text.lower(), langs) + ODD * inverted)
    if not any(odd_table()[min(ord(c), TABLE_END - 1)] for c in set(text)) and not re.search(_sequence(), text):
        # only words of two scripts are odd: look-alike letters may be all there is to it
        plain = confusables.normal_form(confusables.skeleton(text))
        best = min(best, coder.size(plain, langs) + ODD * len(_odd().findall(plain)))
    beam = coder.search.beam
    if beam is None:
        return _every_chain(text, coder, best, coder.search.depth)
    tried, front = {text}, [(best, (), text, odd)]
    for depth in range(1, coder.search.depth + 1):
        found = []
        for _, steps, old, n in front:
            runs = Runs(old)
            counts = Counter(_odd().findall(old))
            for step in STEPS:
                table = _bytes_of(step[0]) if step[1] == "utf-8" else _letters_of(*step)
                if beam is not None and 2 * sum(k for c, k in counts.items() if all(x in table for x in c)) < n:
                    continue  # it would leave most odd characters as they are
                new, least_odd, length = runs.undone(*step)
                shorter = step[1] == "utf-8" and length < len(old)
                if new is None or beam is not None and least_odd > 0.5 * n and not shorter and not cyrillic:
                    continue
                text_of = new()
                if text_of in tried:
                    continue
                tried.add(text_of)
                left = len(_odd().findall(text_of))
                if beam is not None and left > 0.5 * n and not shorter and not cyrillic:
                    continue
                found.append((coder.size(text_of, langs) + ODD * left + STEP * depth, (*steps, step), text_of, left))
        found.sort(key=lambda x: x[:2])
        won = next((x for x in found if x[0] >= best or _supported(text, x[2], x[1], coder)), None)
        if won and won[0] < best:
            best, chain = won[:2]
            if not won[3]:
                break
        front = [x for x in found if beam is None or x[1][-1][1] == "utf-8" and x[3]][:beam]
    return chain


def apply(text: str, chain: Iterable[tuple[str, str]]) -> str:
    for step in chain:
        text = undo(text, *step)
    return text


def repaired_lines(text: str, coder: Coder) -> list[tuple[int, str | None, str]]:
    """(line, its original or None where that is lost, chain) of each line changed by wrong decoding."""
    lines = text.split("\n")
    out: dict[int, tuple[str | None, str]] = {}
    odd = {i for i, line in enumerate(lines) if not line.isascii() and (_odd().search(line) or _inverted(line))}
    open_lines = set(odd)
    chains = []
    while open_lines:
        joined = "\n".join(lines[i] for i in sorted(open_lines))
        # neither headings in capitals nor odd lines of another kind may outweigh the lines whose words show inverted case
        inverted = "\n".join(lines[i] for i in sorted(open_lines) if _INVERTED_WORD.search(lines[i]) and not _odd().search(lines[i]))
        if _odd().search(joined):
            chain = best_chain(joined, coder, False) or inverted and best_chain(inverted, coder, True)
        else:
            chain = best_chain(inverted or joined, coder, True)
        if not chain:
            break
        chains.append(chain)
        name = " ".join(f"{a}>{b}" for a, b in chain)
        for i, line in enumerate(lines):
            if i in out or line.isascii():
                continue
            new = apply(line, chain)
            if new == line:
                continue
            if i in open_lines and (len(_odd().findall(new)) < len(_odd().findall(line)) or _INVERTED_WORD.search(line) and not _odd().search(new)) or coder.size(new) < _plain_size(line, coder):
                out[i] = (None if "�" in line else new, name)
        if not open_lines & set(out):
            break
        open_lines -= set(out)
    for i in odd - set(out):
        if "�" in lines[i] or chains and _odd().search(lines[i]):
            out[i] = (None, "lost")
    if any(step[1] != "utf-8" for c in chains for step in c) and len(out) > 1:
        for i, line in enumerate(lines):
            if i not in out and _LONE.search(line):
                out[i] = (None, "lost")
    return sorted((i, fixed, how) for i, (fixed, how) in out.items())


@lru_cache(maxsize=1)
def _cyrillic_capitals() -> np.ndarray:
    return np.fromiter((0x400 <= i < 0x500 and chr(i).isupper() for i in range(TABLE_END)), bool, TABLE_END)


def odd_documents(block: Block) -> np.ndarray:
    """Documents of a block with an odd character or sequence, words of two scripts, or a line of Cyrillic in inverted case."""
    cp = block.clipped()
    script = _scripts()[cp]
    mixed = np.zeros(len(cp), bool)
    mixed[1:] = script[1:] + script[:-1] == 3
    odd = np.add.reduceat(odd_table()[cp] | mixed, block.start, dtype=np.int64) > 0
    cyrillic = (cp >= 0x400) & (cp < 0x500)
    if cyrillic.any():  # the test of _inverted, for every line
        s, e, doc, _ = block.lines()
        sums = lambda m: (lambda c: c[e] - c[s])(np.concatenate(([0], np.cumsum(m))))
        letters = sums(cyrillic)
        odd[doc[(letters > 5) & (sums(_cyrillic_capitals()[cp]) > 0.5 * letters)]] = True
    first, second = _ends_of_readings()
    near = np.zeros(len(cp), bool)
    near[:-1] = first[cp[:-1]] & second[cp[1:]]
    for d in np.flatnonzero(~odd & np.logical_or.reduceat(near, block.start)):
        odd[d] = bool(_odd().search(block.texts[d]))
    return np.flatnonzero(odd)


def _finder(texts: dict[str, bytes], search: Search):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(texts, search)
        for ids, block in read(batches):
            rows = [(ids[d], *r) for d in odd_documents(block) for r in repaired_lines(block.texts[d], coder)]
            yield arrow({
                "doc_id": pa.array([r[0] for r in rows], pa.int64()), "line_no": pa.array([r[1] for r in rows], pa.int64()),
                "repaired": pa.array([r[2] for r in rows], pa.string()), "chain": pa.array([r[3] for r in rows], pa.string()),
            })

    return run


def damaged_lines(df: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", search: Search = Search()) -> DataFrame:
    """A row for each line that wrong decoding changed, with its original where that can be had."""
    texts = dictionaries(*labels.sample(df, samples, id_col, text_col, lang_col))
    return docs_in(df, id_col, text_col).mapInArrow(_finder(texts, search), "doc_id bigint, line_no bigint, repaired string, chain string")


def restored(df: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", search: Search = Search()) -> DataFrame:
    """Every document's text with its lines restored, and how many were, and how many are lost."""
    texts = dictionaries(*labels.sample(df, samples, id_col, text_col, lang_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(texts, search)
        for ids, block in read(batches):
            out, fixed, lost = list(block.texts), [0] * block.n, [0] * block.n
            for d in odd_documents(block):
                lines = out[d].split("\n")
                for i, line, _ in repaired_lines(out[d], coder):
                    if line is None:
                        lost[d] += 1
                    else:
                        lines[i] = line
                        fixed[d] += 1
                out[d] = "\n".join(lines)
            yield arrow({"doc_id": ids, "text": pa.array(out, pa.string()), "n_restored": pa.array(fixed, pa.int64()), "n_lost": pa.array(lost, pa.int64())})

    return docs_in(df, id_col, text_col).mapInArrow(run, "doc_id bigint, text string, n_restored bigint, n_lost bigint")
