"""The hard rules over the feature vector: every one is evaluated, a blank text fails alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import strip


def reasons(text: Column, features: Column, cfg: Config) -> Column:
    """Names of the rules that a text breaks, in the rules' order."""
    f = features
    rules = [
        ("too_short", f["char_count"] < cfg.min_text_length),
        ("too_few_words", f["word_count"] < cfg.min_word_count),
        ("too_long", f["char_count"] > cfg.max_text_length),
        ("low_alpha_ratio", f["alpha_ratio"] < cfg.min_alpha_ratio),
        ("high_digit_ratio", f["digit_ratio"] > cfg.max_digit_ratio),
        ("high_punctuation_ratio", f["punctuation_ratio"] > cfg.max_punctuation_ratio),
        ("too_many_urls", f["url_count"] > cfg.max_url_count),
        ("too_many_emails", f["email_count"] > cfg.max_email_count),
        ("html_remnants", f["html_tag_count"] > cfg.max_html_tags),
        ("excessive_repeated_lines", f["repeated_line_ratio"] > cfg.max_repeated_line_ratio),
        ("excessive_repeated_word", f["repeated_word_frac"] > cfg.max_repeated_word_frac),
        ("low_token_diversity", (f["unique_token_ratio"] < cfg.min_unique_token_ratio) & (f["word_count"] > 20)),
        ("abnormal_avg_word_length_high", (f["avg_word_length"] > cfg.max_avg_word_length) & (f["word_count"] > 10)),
        ("abnormal_avg_word_length_low", (f["avg_word_length"] < cfg.min_avg_word_length) & (f["word_count"] > 10)),
        ("boilerplate_content", f["boilerplate_hits"] > cfg.max_boilerplate_hits),
    ]
    broken = F.array_compact(F.array(*(F.when(hit, F.lit(name)) for name, hit in rules)))
    return F.when(F.coalesce(strip(text), F.lit("")) == "", F.array(F.lit("empty_text"))).otherwise(broken)
