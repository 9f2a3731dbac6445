"""The whole decision as one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import features, normalize, once
from ..operators import decision, heuristics, language
from ..operators.dedup import mark_exact, mark_near
from ..operators.lm import Model, score, verdict
from .storage import stored


def featured(df: DataFrame, cfg: Config, text: str = "text") -> DataFrame:
    """The text normalized, its features and the hard rules it breaks."""
    out = df.withColumn(text, once(normalize(F.col(text).cast("string")))).withColumn("features", once(features(F.col(text), cfg.profile)))
    return out.withColumn("heuristic_reasons", once(heuristics.reasons(F.col(text), F.col("features"), cfg)))


def signalled(df: DataFrame, cfg: Config, text: str = "text") -> DataFrame:
    """The text normalized, and of its features those that the language decision reads."""
    out = df.withColumn(text, once(normalize(F.col(text).cast("string"))))
    return out.withColumn("features", once(features(F.col(text), cfg.profile, language.SIGNALS)))


def decide(df: DataFrame, cfg: Config = Config(), predictions: Column | None = None, lm: Model | None = None, order: tuple[str, ...] = ("_shard", "_line_num"), marked_exact: bool = False, row_id: str | None = None) -> DataFrame:
    """Adds features, language, perplexity, duplicate flags, quality score, decision and reasons.

    ``df`` has ``text`` and, from a scan, ``status``. Rows without a text are
    given no decision. Duplicates are kept-first by ``order`` over all records,
    rejected ones included.
    """
    if "status" not in df.columns:
        df = df.withColumn("status", F.when(F.col("text").isNull(), "missing_text").otherwise("ok"))
    out = featured(df, cfg)
    said = predictions if predictions is not None else language.by_function_words(F.col("text"), language.default_lists(cfg.profile))
    out = out.withColumn("lang", once(language.info(said, F.col("features"), "provider" if predictions is not None else "function_words")))
    out = out.withColumn("lang_decision", language.decision(F.col("lang"), cfg))
    if lm is None:
        out = out.select("*", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("bigint").alias("num_tokens"), F.lit(None).cast("double").alias("oov_ratio"))
    else:
        key = row_id or order[-1]
        # written once: each way to the duplicates would score the texts again
        scored = stored(score(out, lm, "text", key, cfg).select(key, "num_tokens", "perplexity", "oov_ratio"), "scores")
        out = out.join(scored, key, "left")
    if cfg.enable_exact_dedup and not marked_exact:
        out = mark_exact(out, F.col("text"), list(order))
    elif not marked_exact:
        out = out.withColumn("is_exact_dup", F.lit(False))
    if cfg.enable_near_dedup:
        key = row_id or order[-1]
        rest = mark_near(out.where("not is_exact_dup and text is not null"), "text", key, cfg).select(key, "is_near_dup")
        out = out.join(rest, key, "left").withColumn("is_near_dup", F.coalesce("is_near_dup", F.lit(False)))
    else:
        out = out.withColumn("is_near_dup", F.lit(False))
    out = out.withColumn("quality_score", once(decision.quality_score(F.col("features"), F.col("lang"), F.col("perplexity"), cfg)))
    said, reasons, near = decision.decided(
        F.col("heuristic_reasons"), F.col("lang_decision"), F.col("is_exact_dup"), F.col("is_near_dup"), verdict(F.col("perplexity"), F.col("num_tokens"), F.col("oov_ratio"), cfg), F.col("quality_score"), cfg
    )
    ok = F.col("status") == "ok"
    return out.withColumn("reasons", once(F.when(ok, reasons))).withColumn("decision", F.when(ok, F.when(F.size("reasons") > 0, "reject").otherwise("keep"))).withColumn("is_borderline", F.when(ok, near))
