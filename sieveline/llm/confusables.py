"""One form for texts that look alike, by their confusables skeleton.

A text's skeleton is its full (compatibility) decomposition without invisible
characters, each character replaced by the prototype of its look-alikes, then
decomposed again. Originals whose skeletons are equal look the same. The
normal form is a function of the skeleton alone, so equal skeletons have equal
normal forms: accents are composed and, in words that hold a Cyrillic letter
without a Latin twin, the prototypes go back to Cyrillic.

Case, dotted and dotless i, cedillas and quote styles are no confusions.

Defined results: null, empty and blank texts take no part; equal raw texts are
never a pair with each other, for they have no different characters; rows that
repeat an id count once; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import stored
from .textvec import arrow, docs_in, rows_of

#: Letters of other scripts, then the Latin letters that they imitate.
CYRILLIC = ("аеорсухіјѕһԁԛԝӏАВЕКМНОРСТУХІЈЅԌԚԜӀ", "aeopcyxijshdqwlABEKMHOPCTYXIJSGQWI")
GREEK = ("αονρικυχγϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "aovpikuxycjABEZHIKMNOPTYXCJ")
ARMENIAN = ("օսհցոՕՍԼ", "ouhgnOUL")
CHEROKEE = ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏚᏞᏟᏢᏦᏴᏙ", "DRTAJEWMHGZSLCPKBV")
COPTIC = ("ⲞⲢⲤⲦⲬⲎⲒⲔⲘⲚⲟⲣⲥ", "OPCTXHIKMNopc")
LISU = ("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ")
LATIN = ("ɑɡ", "ag")
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿ﾠ\U000e0000-\U000e0fff"
SPACES = "   -   　"

_DROP = re.compile(f"[{INVISIBLE}]+")
_SPACE = re.compile(f"[{SPACES}]")
_PROTOTYPE = {a: b for old, new in (CYRILLIC, GREEK, ARMENIAN, CHEROKEE, COPTIC, LISU, LATIN) for a, b in zip(old, new, strict=True)}
_TWIN = re.compile("[" + "".join(_PROTOTYPE) + "]+")
#: The letter to go back to: of two twins the Russian one, which the reversed order leaves in place.
_BACK = {ord(b): a for a, b in reversed(list(zip(*CYRILLIC, strict=True)))}
_WORD = re.compile(r"[^\W\d_]+")
_ONLY_CYRILLIC = re.compile("[" + "".join(c for c in map(chr, range(0x400, 0x530)) if c not in _PROTOTYPE) + "]")
_ONLY_LATIN = re.compile("[" + "".join(c for c in map(chr, [*range(65, 91), *range(97, 123), 0x131, 0x259]) if ord(c) not in _BACK) + "]")


def skeleton(text: str) -> str:
    """The form in which look-alike texts are equal."""
    if text.isascii():
        return text
    text = _SPACE.sub(" ", unicodedata.normalize("NFKD", _DROP.sub("", text)))
    replaced = _TWIN.sub(lambda m: "".join(_PROTOTYPE[c] for c in m[0]), text)
    return text if replaced == text else unicodedata.normalize("NFKD", replaced)


def normal_form(bones: str) -> str:
    """A readable form of a skeleton: composed, its Cyrillic words wholly Cyrillic."""
    if bones.isascii():
        return bones
    text = bones
    if _ONLY_CYRILLIC.search(bones):
        other = len(_ONLY_LATIN.findall(bones))
        russian = len(_ONLY_CYRILLIC.findall(bones)) > other

        def back(m: re.Match[str]) -> str:
            word = m[0]
            if _ONLY_LATIN.search(word) or not (russian or _ONLY_CYRILLIC.search(word)):
                return word
            return word.translate(_BACK)

        text = _WORD.sub(back, bones)
    return unicodedata.normalize("NFC", text)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _normalized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = rows_of(batch)
        forms = [normal_form(skeleton(t)) for t in texts]
        yield arrow({"doc_id": ids, "text": pa.array(forms, pa.string()), "changed": [a != b for a, b in zip(texts, forms, strict=True)]})


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = rows_of(batch)
        raw = [_digest(t) for t in texts]
        bones = [r if t.isascii() else _digest(skeleton(t)) for t, r in zip(texts, raw, strict=True)]
        yield arrow({"doc_id": ids, "skeleton": pa.array(bones, pa.binary()), "raw": pa.array(raw, pa.binary())})


def normalized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text in its one form, and whether that differs from the original."""
    return docs_in(df, id_col, text_col).mapInArrow(_normalized, "doc_id bigint, text string, changed boolean")


def keys(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """128-bit digests of each document's skeleton and of its raw text."""
    return docs_in(df, id_col, text_col).mapInArrow(_keys, "doc_id bigint, skeleton binary, raw binary")


def lookalikes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs of different raw texts with one skeleton, doc_a < doc_b.

    Raw texts are first counted within their skeleton by a partial aggregation,
    so a large group of plain copies leaves the plan as one row. Pairs are made
    of raw texts, and only then of the documents that hold them: copies of one
    text never meet each other, and what comes out of a join is a pair of the
    result.
    """
    found = stored(keys(df, id_col, text_col), "keys")  # texts are read once
    several = found.groupBy("skeleton").agg(F.min("raw").alias("least"), F.max("raw").alias("most")).where("least <> most").select("skeleton")
    members = stored(found.join(several, "skeleton", "left_semi").distinct(), "lookalikes")
    forms = members.select("skeleton", "raw").distinct()
    a, b = forms.toDF("skeleton", "raw_a"), forms.toDF("skeleton", "raw_b")
    pairs = a.join(b, "skeleton").where("raw_a < raw_b").select("raw_a", "raw_b")
    of = lambda side: members.select(F.col("doc_id").alias(side), F.col("raw").alias(f"raw_{side}"))
    whole = pairs.join(of("a"), "raw_a").join(of("b"), "raw_b")
    return whole.where("a <> b").select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document of a look-alike class: its class, the least document id in it, and the class's sizes."""
    found = stored(keys(df, id_col, text_col), "keys")
    sizes = (
        found.groupBy("skeleton", "raw").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
        .groupBy("skeleton").agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_docs"), F.min("first").alias("class_id"))
        .where("n_forms > 1")
    )
    return found.join(sizes, "skeleton").select("doc_id", "class_id", "n_forms", "n_docs")
