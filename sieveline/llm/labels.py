"""Language labels and the bounded labelled sample that models are fitted on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import bounded
from .textvec import docs_in

#: Other spellings of a language's code.
SPELLINGS = {
    "tr": ("tur", "turkish"),
    "az": ("aze", "azj", "azerbaijani"),
    "en": ("eng", "english"),
    "de": ("deu", "ger", "german"),
    "fr": ("fra", "fre", "french"),
    "es": ("spa", "spanish"),
    "ru": ("rus", "russian"),
}
#: Labels that say nothing.
MISSING = ("", "und", "unknown", "xx")
#: Documents of a language that a model sees, of those with the least hash of their id.
PER_LANGUAGE = 120
#: Characters of such a document that it sees.
SAMPLE_CHARS = 6_000
#: Rows that the table of correct passages may have.
PASSAGES = 100_000


def canonical(label: Column) -> Column:
    """The two-letter code of a label in any spelling; null where the label says nothing."""
    head = F.element_at(F.split(F.lower(F.trim(label)), "[-_]"), 1)
    known = reduce(lambda c, kv: c.when(head.isin(kv[0], *kv[1]), F.lit(kv[0])), SPELLINGS.items(), F.when(F.lit(False), F.lit(None)))
    return F.when(~head.isin(*MISSING), F.coalesce(known, head))


def sample(df: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """Correct passages, and labelled documents, by language; both are bounded.

    The languages are those of the passages. The documents' labels may be
    wrong; who fits a model on them first drops those that a model of the
    correct passages contradicts. Documents are drawn by a hash of their id: a
    first count by language, which reads no text, says how small the hash must
    be for some four times as many as are wanted.
    """
    right: dict[str, list[str]] = {}
    for lang, text in bounded(samples.select(canonical(F.col(lang_col)), text_col).where(F.col(text_col).isNotNull()), PASSAGES, "passages"):
        if lang is not None:
            right.setdefault(lang, []).append(text)
    right = {k: sorted(v) for k, v in sorted(right.items())}
    label = canonical(F.col(lang_col).cast("string"))
    counts = {k: n for k, n in df.groupBy(label.alias("lang")).count().where(F.col("lang").isin(*right)).collect()} if right else {}
    seen: dict[str, list[str]] = {}
    if not counts:
        return right, seen
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    small = reduce(lambda c, kv: c | (F.col("lang") == kv[0]) & (hashed < int((1 << 40) * min(1.0, 4 * per_language / kv[1]))), counts.items(), F.lit(False))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    some = (
        docs_in(df, id_col, text_col, label.alias("lang"))
        .where(small)
        .select("lang", "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .select("lang", "text", F.row_number().over(order).alias("place"))
        .where(F.col("place") <= per_language)
    )
    for lang, text, _ in sorted(some.collect()):
        seen.setdefault(lang, []).append(text)
    return right, seen
