"""The weighted quality score and the layered decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import round_half_up


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def quality_score(features: Column, lang: Column, perplexity: Column, cfg: Config) -> Column:
    """Fluency, language and heuristics, weighted; a text without a perplexity is neutral in fluency."""
    fluency = F.when(perplexity > 0, clamp(1 - perplexity / F.lit(cfg.max_perplexity))).otherwise(F.lit(0.5))
    known = (
        F.when(lang["detected_lang"] == cfg.profile.code, F.least(F.lit(1.0), lang["confidence"] + 0.2))
        .when(lang["confidence"] > 0, F.greatest(F.lit(0.0), 0.5 - lang["confidence"] * 0.5))
        .otherwise(F.lit(0.5))
    )
    part = lambda name, full, weight: F.least(F.lit(1.0), features[name] / F.lit(full)) * F.lit(weight)
    shape = part("alpha_ratio", 0.7, 0.3) + part("unique_token_ratio", 0.5, 0.2) + part("stopword_coverage", 0.05, 0.3) + part("turkish_char_ratio", 0.05, 0.2)
    return round_half_up(clamp(fluency * F.lit(cfg.weight_lm) + known * F.lit(cfg.weight_language) + shape * F.lit(cfg.weight_heuristic)), 4)


def decided(heuristic: Column, lang_decision: Column, exact_dup: Column, near_dup: Column, lm_reason: Column, score: Column, cfg: Config) -> tuple[Column, Column, Column]:
    """(decision, reasons, is_borderline).

    Heuristic, language and duplicate reasons add up; the language model has a
    say only while a text is kept, and the soft score only after that.
    """
    some = lambda hit, name: F.when(F.coalesce(hit, F.lit(False)), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    hard = F.concat(heuristic, some(lang_decision == "reject", "non_turkish" if cfg.profile.code == "tr" else f"non_{cfg.profile.code}"), some(exact_dup, "exact_duplicate"), some(near_dup, "near_duplicate"))
    low = F.format_string("low_quality_score_%.3f", score)
    soft = F.when(lm_reason.isNotNull(), F.array(lm_reason)).when(score < cfg.soft_threshold, F.array(low)).otherwise(F.array().cast("array<string>"))
    reasons = F.when(F.size(hard) > 0, hard).otherwise(soft)
    return F.when(F.size(reasons) > 0, "reject").otherwise("keep"), reasons, F.abs(score - cfg.soft_threshold) < cfg.borderline_margin


def label(reason: Column) -> Column:
    """A reason to group by: a score in its name is left off."""
    return F.regexp_replace(reason, r"^(low_quality_score)_.*$", "$1")
