"""Thresholds and paths of a run. Everything here becomes a literal when a plan is built."""

from __future__ import annotations

from dataclasses import dataclass, replace
from pathlib import Path

from .functions.profiles import TURKISH, LanguageProfile


@dataclass(frozen=True)
class Config:
    text_key: str = "text"
    profile: LanguageProfile = TURKISH
    # heuristics
    min_text_length: int = 50
    max_text_length: int = 500_000
    min_word_count: int = 5
    min_alpha_ratio: float = 0.40
    max_digit_ratio: float = 0.50
    max_punctuation_ratio: float = 0.40
    max_url_count: int = 20
    max_email_count: int = 10
    max_html_tags: int = 10
    max_repeated_line_ratio: float = 0.70
    max_repeated_word_frac: float = 0.50
    min_unique_token_ratio: float = 0.10
    min_avg_word_length: float = 1.5
    max_avg_word_length: float = 45.0
    max_boilerplate_hits: int = 5
    # language
    min_confidence: float = 0.3
    high_confidence: float = 0.5
    reject_confidence: float = 0.7
    min_special_char_ratio: float = 0.015
    min_stopword_coverage: float = 0.005
    # language model
    lm_order: int = 5
    max_perplexity: float = 3000.0
    short_text_factor: float = 1.5
    min_lm_tokens: int = 10
    short_text_tokens: int = 30
    lm_window: int = 500
    # deduplication
    enable_exact_dedup: bool = True
    enable_near_dedup: bool = False
    near_threshold: float = 0.80
    permutations: int = 128
    shingle: int = 5
    bands: int = 9
    rows: int = 13
    # score
    soft_threshold: float = 0.25
    weight_lm: float = 0.40
    weight_language: float = 0.30
    weight_heuristic: float = 0.30
    # audit, seed corpus, shards
    audit_samples: int = 200
    borderline_margin: float = 0.10
    seed_shards: int = 3
    seed_records: int = 100_000
    target_shard_mb: int = 55
    # input and output
    input_dir: str | None = None
    input_repo: str | None = None
    output_dir: str = "output"
    output_repo: str | None = None
    shard_filter: str | None = None
    resume: bool = True
    token: str | None = None
    cache_dir: str | None = None
    seed: int = 42

    def resolved(self, root: str | Path) -> Config:
        """Relative folders taken from ``root``, wherever the process was started."""
        at = lambda p: p if p is None or "://" in p or Path(p).is_absolute() else str(Path(root) / p)
        return replace(self, input_dir=at(self.input_dir), output_dir=at(self.output_dir), cache_dir=at(self.cache_dir))

    def output(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"
