"""Text normalization and the feature vector, as built-in column expressions.

All classes are spelled out, so that Java's regular expressions mean what
Unicode says and no flag decides what white space is. A class is counted as
the length lost when its runs are removed, which visits runs and not
characters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import TURKISH, LanguageProfile

#: Unicode white space.
SPACE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters, to trim.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
CONTROL = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
ZERO_WIDTH = r"[\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}]"
WIDE_SPACE = r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
#: Digits beyond the decimal ones: superscripts, subscripts, circled digits.
OTHER_DIGITS = r"\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}"
URL = r"https?://[^" + SPACE + "]+"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
HTML_TAG = r"<[a-zA-Z/][^>]*>"
SENTENCE_END = r"[.!?\x{2026}][" + SPACE + "]"

FEATURES = (
    "char_count", "word_count", "line_count", "sentence_count", "url_count", "email_count", "html_tag_count", "boilerplate_hits",
    "alpha_ratio", "digit_ratio", "punctuation_ratio", "whitespace_ratio", "turkish_char_ratio", "unique_token_ratio", "repeated_word_frac",
    "repeated_line_ratio", "avg_word_length", "stopword_coverage",
)


def once(value: Column) -> Column:
    """The value, computed where it stands: the optimizer neither copies it to where it is used nor moves a filter on it below it."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed a single time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(text, F.lit(SPACES))


def normalize(text: Column) -> Column:
    """Controls and zero-width characters out, Unicode spaces plain, long runs of line feeds and spaces short, ends stripped."""
    text = F.regexp_replace(text, CONTROL, "")
    text = F.regexp_replace(text, ZERO_WIDTH, "")
    text = F.regexp_replace(text, WIDE_SPACE, " ")
    text = F.regexp_replace(text, r"\n{4,}", "\n\n\n")
    text = F.regexp_replace(text, " {4,}", " ")
    return strip(text)


def round_half_up(x: Column, digits: int) -> Column:
    scale = 10.0**digits
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def words(text: Column) -> Column:
    """The runs between white space."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def count_of(text: Column, inside: str) -> Column:
    """Characters of a class, given as the inside of its brackets."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{inside}]+", ""))


def ignoring_case(pattern: str) -> str:
    """The pattern with the i of both alphabets in classes, and white space spelled out."""
    return "(?iu)" + pattern.replace(r"\s", f"[{SPACE}]").replace(r"\w", r"[\p{L}\p{N}_]")


def boilerplate_hits(text: Column, patterns: Sequence[str]) -> Column:
    """How many of the patterns a text has, whatever its case.

    The text is folded once; a pattern is tried only where the folded text
    holds the letters it begins with, which any match does.
    """
    folded = F.lower(text)
    for sign, plain in (("ı", "i"), ("ſ", "s"), ("\u0307", "")):
        folded = F.replace(folded, F.lit(sign), F.lit(plain))

    def hits(t: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for p in patterns:
            start = re.match(r"\w*", p.replace("ı", "i"))[0]
            match = F.regexp_like(text, F.lit(ignoring_case(p)))
            out = out + (F.contains(t, F.lit(start)) & match).cast("bigint")
        return out

    return let(folded, hits)


def top_count(items: Column) -> Column:
    """Count of an array's most frequent item, in one pass over the sorted array."""
    start = F.struct(F.lit(None).cast("string").alias("item"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["item"] == x, acc["run"] + 1).otherwise(1)
        return F.struct(x.alias("item"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.sort_array(items), start, step, lambda acc: acc["best"])


def features(text: Column, profile: LanguageProfile = TURKISH, names: Sequence[str] = FEATURES) -> Column:
    """The features named, all 18 by default, of a normalized text; zeros for an empty one."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    # lines and classes of signs are for some features only
    lines = lines if "repeated_line_ratio" in names else F.array().cast("array<string>")
    # digits and punctuation are few: they are told apart in what letters and white space leave
    signs = {"alpha_ratio", "digit_ratio", "punctuation_ratio", "whitespace_ratio", "avg_word_length"} & set(names)
    letters = count_of(text, r"\p{L}") if signs else F.lit(0)
    rest = F.regexp_replace(text, r"[\p{L}" + SPACE + "]+", "") if signs else F.lit("")
    parts = F.struct(text.alias("t"), words(F.lower(text)).alias("w"), lines.alias("l"), letters.alias("a"), rest.alias("r"))
    return let(parts, lambda p: _features(p["t"], p["w"], p["l"], p["a"], p["r"], profile, names))


def _features(text: Column, own: Column, lines: Column, letters: Column, rest: Column, profile: LanguageProfile, names: Sequence[str]) -> Column:
    chars, n_words = F.length(text), F.size(own)
    spaces = chars - letters - F.length(rest)
    per_char = lambda n: round_half_up(n / F.greatest(chars, F.lit(1)), 4)
    per_word = lambda n, d=4: round_half_up(n / F.greatest(n_words, F.lit(1)), d)
    long = lambda c: c.cast("bigint")
    # a pattern is tried where the text holds what any match begins with or has
    having = lambda part, pattern: long(F.when(F.contains(text, F.lit(part)), F.regexp_count(text, F.lit(pattern))).otherwise(0))
    values = {
        "char_count": long(chars),
        "word_count": long(n_words),
        "line_count": F.when(chars == 0, F.lit(0)).otherwise(F.size(F.split(text, "\n"))).cast("bigint"),
        "sentence_count": F.when(chars == 0, F.lit(0)).otherwise(F.regexp_count(text, F.lit(SENTENCE_END)) + 1).cast("bigint"),
        "url_count": having("://", URL),
        "email_count": having("@", EMAIL),
        "html_tag_count": having("<", HTML_TAG),
        "boilerplate_hits": boilerplate_hits(text, profile.boilerplate),
        "alpha_ratio": per_char(letters),
        "digit_ratio": per_char(count_of(rest, r"\p{Nd}" + OTHER_DIGITS)),
        "punctuation_ratio": per_char(F.length(F.regexp_replace(rest, r"\p{N}+", ""))),
        "whitespace_ratio": per_char(spaces),
        "turkish_char_ratio": per_char(count_of(text, profile.special_chars)),
        "unique_token_ratio": per_word(F.size(F.array_distinct(own))),
        "repeated_word_frac": per_word(top_count(own)),
        "repeated_line_ratio": F.when(F.size(lines) > 0, round_half_up(1 - F.size(F.array_distinct(lines)) / F.size(lines), 4)).otherwise(F.lit(0.0)),
        # lower case may have more code points than the word: lengths are those of the text as it stands
        "avg_word_length": per_word(chars - spaces, 2),
        "stopword_coverage": per_word(F.size(F.filter(own, lambda w: w.isin(*profile.stopwords)))),
    }
    return F.struct(*(values[k].alias(k) for k in names))


def record_text(value: Column) -> Column:
    """Any value as text; null stays null."""
    return value.cast("string")
