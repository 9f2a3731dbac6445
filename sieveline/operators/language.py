"""Which language a text is in, and whether that is the target.

Predictions are an array of (lang, score), best first. They come from a
provider column, or from a vote of function words; an external model can give
them in a column of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config
from ..functions.profiles import FUNCTION_WORDS, LanguageProfile
from ..functions.text import let, words

#: Characters of a text that a prediction reads.
WINDOW = 5_000
#: Share of the function words below which a language is not named.
LEAST_SHARE = 0.1
#: Features that the decision reads beside the predictions.
SIGNALS = ("turkish_char_ratio", "stopword_coverage")
PREDICTION = "array<struct<lang:string,score:double>>"


def from_column(lang: Column, confidence: float = 0.9) -> Column:
    """A label as the only prediction; none where it is missing."""
    return F.when(F.coalesce(F.trim(lang), F.lit("")) == "", F.array().cast(PREDICTION)).otherwise(F.array(F.struct(F.lower(F.trim(lang)).alias("lang"), F.lit(confidence).alias("score"))))


def by_function_words(text: Column, lists: Mapping[str, Sequence[str]], top: int = 3) -> Column:
    """The languages of most function words.

    A language is scored by the share of its words among those that any of the
    languages has, and one more, so a few words prove little. Languages may
    share words; one alone would win every text that has a word of it.
    """
    own = words(F.lower(F.substring(F.replace(text, F.lit("\n"), F.lit(" ")), 1, WINDOW)))
    in_ = lambda ws: lambda w: w.isin(*ws)

    def voted(known: Column) -> Column:
        votes = F.array(*(F.struct((-F.size(F.filter(known, in_(ws)))).alias("n"), F.lit(k).alias("lang")) for k, ws in sorted(lists.items())))
        shares = F.transform(F.slice(F.array_sort(votes), 1, top), lambda v: F.struct(v["lang"].alias("lang"), (-v["n"] / (F.size(known) + 1)).alias("score")))
        return F.filter(shares, lambda p: p["score"] >= LEAST_SHARE)

    # the text is split once, and each language counts only among the words that some language has
    return let(F.filter(own, in_(sorted({w for ws in lists.values() for w in ws}))), voted)


def default_lists(profile: LanguageProfile) -> dict[str, Sequence[str]]:
    """Function words of the target language and of those it is told from."""
    return FUNCTION_WORDS | {profile.code: profile.stopwords}


def info(predictions: Column, features: Column, method: str) -> Column:
    """The struct that is kept of a prediction; the prediction is computed once."""

    def kept(said: Column) -> Column:
        first = F.get(said, F.lit(0))
        return F.struct(
            F.coalesce(first["lang"], F.lit("unknown")).alias("detected_lang"), F.coalesce(first["score"], F.lit(0.0)).alias("confidence"),
            said.alias("top_languages"), features["turkish_char_ratio"].alias("turkish_char_ratio"), features["stopword_coverage"].alias("stopword_coverage"),
            F.lit(method).alias("lid_method"),
        )

    return let(predictions, kept)


def decision(lang: Column, cfg: Config) -> Column:
    """accept, reject or borderline."""
    target = cfg.profile.code
    letters = lang["turkish_char_ratio"] >= cfg.min_special_char_ratio
    stop = lang["stopword_coverage"] >= cfg.min_stopword_coverage
    near_top = F.exists(F.slice(lang["top_languages"], 1, 2), lambda p: p["lang"] == target)
    score = F.coalesce(F.array_max(F.transform(F.filter(lang["top_languages"], lambda p: p["lang"] == target), lambda p: p["score"])), F.lit(0.0))
    is_target = lang["detected_lang"] == target
    return (
        F.when(is_target & (lang["confidence"] >= cfg.high_confidence), "accept")
        .when(near_top & (score >= cfg.min_confidence) & (letters | stop), "accept")
        .when(letters & stop & near_top, "accept")
        .when(~is_target & (lang["confidence"] >= cfg.reject_confidence) & ~letters & ~stop, "reject")
        .when(letters | stop | near_top, "borderline")
        .when(~is_target & ~letters & ~stop, "reject")
        .otherwise("borderline")
    )
