"""The engine's queries over a folder of tables, and the SQL they are compared with.

Every query runs over its whole tables. SQL that cannot express an operator,
or is too slow for it, is left out; those are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as tx
from ..functions.profiles import TURKISH, TURKISH_SUFFIXES
from ..operators import dedup, inspection, language, lm, prepare, reports, sharding, tokenizer
from ..operators.decision import label
from ..sources import files, resolver, sinks
from ..streaming.incremental import pending
from .pipeline import decide, featured, signalled
from .storage import bounded, spread

CFG = Config()
#: Thresholds under which more rules fire on clean text.
STRICT = Config(
    min_text_length=400, min_word_count=60, max_text_length=6_000, min_alpha_ratio=0.80, max_digit_ratio=0.03, max_punctuation_ratio=0.04, max_url_count=0, max_email_count=0,
    max_html_tags=0, max_repeated_line_ratio=0.02, max_repeated_word_frac=0.08, min_unique_token_ratio=0.5, min_avg_word_length=4.5, max_avg_word_length=6.5, max_boilerplate_hits=0,
)
TARGET = 20_000
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", *columns), "doc_id")


def predictions() -> Column:
    return language.from_column(F.col("lang_label"))


def decided(spark: SparkSession, sf: str, cfg: Config = CFG, model: lm.Model | None = None) -> DataFrame:
    rows = documents(spark, sf, "source", F.col("lang").alias("lang_label"))
    return decide(rows.withColumnRenamed("source", "_shard"), cfg, predictions(), model, order=("doc_id",), row_id="doc_id")


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", tx.normalize(F.col("text")).alias("text"))


def text_features(spark: SparkSession, sf: str) -> DataFrame:
    return featured(documents(spark, sf).where("text is not null"), CFG).select("doc_id", "features.*")


def _reasons(cfg: Config) -> Query:
    return lambda spark, sf: featured(documents(spark, sf).where("text is not null"), cfg).select("doc_id", F.array_join("heuristic_reasons", ",").alias("reasons"))


def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.reason_histogram(featured(documents(spark, sf).where("text is not null"), STRICT), "heuristic_reasons")


def language_decision(spark: SparkSession, sf: str) -> DataFrame:
    rows = signalled(documents(spark, sf, F.col("lang").alias("lang_label")).where("text is not null"), CFG)
    rows = rows.withColumn("l", language.info(predictions(), F.col("features"), "provider"))
    return rows.select("doc_id", "l.detected_lang", "l.confidence", language.decision(F.col("l"), CFG).alias("lang_decision"))


def language_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.language_histogram(language_decision(spark, sf), F.col("detected_lang"))


def function_word_vote(spark: SparkSession, sf: str) -> DataFrame:
    lists: dict[str, list[str]] = {}
    for lang, word in bounded(table(spark, sf, "common_words"), 100_000, "common words"):  # a fixed table
        lists.setdefault(lang, []).append(word)
    rows = documents(spark, sf).where("text is not null").select("doc_id", language.by_function_words(F.col("text"), lists).alias("p"))
    first = F.get("p", F.lit(0))
    return rows.select("doc_id", F.coalesce(first["lang"], F.lit("unknown")).alias("lang"), tx.round_half_up(F.coalesce(first["score"], F.lit(0.0)), 4).alias("score"))


def default_language(spark: SparkSession, sf: str) -> DataFrame:
    """The decision where no provider names a language: a vote of function words."""
    rows = signalled(documents(spark, sf).where("text is not null"), CFG)
    said = language.by_function_words(F.col("text"), language.default_lists(CFG.profile))
    rows = rows.withColumn("l", tx.once(language.info(said, F.col("features"), "function_words")))
    return rows.select("doc_id", "l.detected_lang", tx.round_half_up(F.col("l.confidence"), 6).alias("confidence"), language.decision(F.col("l"), CFG).alias("lang_decision"))


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", tx.normalize(F.col("text")).alias("text"))
    return dedup.mark_exact(rows, F.col("text"), ["doc_id"]).select("doc_id", "is_exact_dup")


def exact_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", tx.normalize(F.col("text")).alias("text"))
    return dedup.exact_stats(dedup.mark_exact(rows, F.col("text"), ["doc_id"]), F.col("text"))


def shingle_counts(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).where("text is not null").select("doc_id", F.size(dedup.shingles(F.col("text"))).cast("bigint").alias("n_shingles"))


def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", tx.normalize(F.col("text")).alias("text")).where("text is not null")
    marked = dedup.mark_exact(rows, F.col("text"), ["doc_id"]).where("not is_exact_dup")
    return dedup.mark_near(marked, "text", "doc_id", CFG).select("doc_id", "is_near_dup")


def near_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_stats(near_dedup(spark, sf))


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).where("status = 'ok'").select("doc_id", "quality_score")


def decision(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array_join(F.transform("reasons", label), ",")
    return decided(spark, sf).where("status = 'ok'").select("doc_id", "decision", names.alias("reasons"), "quality_score", "is_borderline")


def decision_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.with_ratios(reports.counters(decided(spark, sf)))


def shard_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.counters(decided(spark, sf), ["_shard"]).withColumnRenamed("_shard", "shard")


def shard_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return reports.reason_histogram(decided(spark, sf), by=["_shard"]).withColumnRenamed("_shard", "shard")


def rejection_top20(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top(reports.reason_histogram(table(spark, sf, "decisions")), "reason")


def run_language_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "decisions").groupBy("run_id", F.col("lang_info.detected_lang").alias("lang")).agg(F.count("*").alias("n"))


def perplexity_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "decisions").where("kenlm_perplexity > 0")
    return reports.percentiles(rows, F.col("kenlm_perplexity"), (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99))


def length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return reports.percentiles(documents(spark, sf), F.length("text").cast("double"), (0.25, 0.50, 0.75))


def perplexity_csv(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "decisions").where("kenlm_perplexity > 0").select("decision_id", F.col("kenlm_perplexity").alias("perplexity")).orderBy("perplexity")


def bernoulli_sample(spark: SparkSession, sf: str) -> DataFrame:
    return reports.bernoulli(documents(spark, sf), F.col("doc_id"), 0.05, "s").select("doc_id")


def audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    return reports.at_most(documents(spark, sf), F.col("doc_id"), CFG.audit_samples, seed="a").select("doc_id", F.substring("text", 1, 1000).alias("text"))


def shard_sample(spark: SparkSession, sf: str) -> DataFrame:
    return reports.at_most(documents(spark, sf, "source"), F.col("doc_id"), 5, ["source"], "x").select("doc_id", "source")


def reject_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = decided(spark, sf, STRICT).withColumn("_line_num", F.col("doc_id"))
    return sinks.rejected(rows).select("text", F.array_join(F.transform("_rejection_reasons", label), ",").alias("reasons"), "_quality_score", "_shard", "_line_num")


def _with_eos() -> Column:
    return prepare.ensure_eos(F.col("text"))


def eos_append(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).where("text is not null").select("doc_id", _with_eos().alias("text"), prepare.eos_added(F.col("text")).alias("eos_added"))


def _sharded(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).where("text is not null").select("doc_id", _with_eos().alias("line")).withColumn("shard", prepare.shard_id(F.col("line"), 16))


def hash_shards(spark: SparkSession, sf: str) -> DataFrame:
    return _sharded(spark, sf).select("doc_id", "shard")


def shard_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.shard_sizes(_sharded(spark, sf), "shard", F.col("line"))


def oversize_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = _sharded(spark, sf).withColumn("shard", F.least("shard", F.lit(5)))
    return prepare.split_oversized(rows, "shard", F.col("line"), 100_000).select("doc_id", "shard", "part")


def shard_count(spark: SparkSession, sf: str) -> DataFrame:
    return _sharded(spark, sf).agg(F.sum(prepare.line_bytes(F.col("line"))).alias("n_bytes")).select("n_bytes", prepare.shard_count(F.col("n_bytes"), 50_000).alias("n_shards"))


def rolled_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).where("text is not null")
    return sharding.rolled(rows, "doc_id", prepare.line_bytes(F.col("text")), TARGET).select("doc_id", "shard_index")


def balanced_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).where("text is not null")
    return sharding.balanced(rows, ["doc_id"], prepare.line_bytes(F.col("text")), TARGET).select("doc_id", "shard_index")


def lm_tokens(spark: SparkSession, sf: str) -> DataFrame:
    own = lm.tokens(F.col("text"))
    return documents(spark, sf).where("text is not null").select("doc_id", F.size(own).cast("bigint").alias("n_tokens"), F.md5(F.array_join(lm.window(own, CFG), " ")).alias("window"))


def _seed_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    rows = featured(documents(spark, sf, F.col("lang").alias("lang_label")).where("text is not null"), CFG)
    rows = rows.withColumn("l", language.info(predictions(), F.col("features"), "provider"))
    return rows, lm.seed_accepted(F.col("heuristic_reasons"), language.decision(F.col("l"), CFG))


def _seed(spark: SparkSession, sf: str) -> DataFrame:
    rows, accepted = _seed_rows(spark, sf)
    return lm.seed_corpus(rows, "text", ["doc_id"], accepted, CFG)


def seed_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return _seed(spark, sf).groupBy(F.array_join("sentence", " ").alias("sentence")).agg(F.count("*").alias("n"))


def seed_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows, accepted = _seed_rows(spark, sf)
    return lm.seed_stats(rows, "text", accepted)


def sampled_shards(spark: SparkSession, sf: str) -> DataFrame:
    return lm.sampled_shards(table(spark, sf, "shard_manifest").select(F.col("file_name").alias("shard")), CFG.seed_shards)


def ngram_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lm.ngram_counts(_seed(spark, sf), 2).where("n > 1")


def lm_discounts(spark: SparkSession, sf: str) -> DataFrame:
    d = lm.discounts(lm.ngram_counts(_seed(spark, sf), 2))
    return d.select(*(tx.round_half_up(F.col(c), 6).alias(c) for c in d.columns))


def lm_score(spark: SparkSession, sf: str) -> DataFrame:
    model = lm.train(_seed(spark, sf), CFG)
    return lm.score(documents(spark, sf).where("text is not null"), model, "text", "doc_id", CFG).select("doc_id", "num_tokens", "perplexity", "oov_ratio")


def lm_score_bigram(spark: SparkSession, sf: str) -> DataFrame:
    cfg = replace(CFG, lm_order=2)
    model = lm.train(_seed(spark, sf), cfg)
    return lm.score(documents(spark, sf).where("text is not null"), model, "text", "doc_id", cfg).select("doc_id", "num_tokens", "perplexity", "oov_ratio")


def decision_full(spark: SparkSession, sf: str) -> DataFrame:
    """The decision with a language model trained on the seed corpus and with near deduplication."""
    cfg = replace(CFG, enable_near_dedup=True, lm_order=3)
    names = F.array_join(F.transform("reasons", label), ",")
    rows = decided(spark, sf, cfg, lm.train(_seed(spark, sf), cfg)).where("status = 'ok'")
    return rows.select("doc_id", "decision", names.alias("reasons"), "quality_score", "perplexity", "is_near_dup")


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Through discovery and the Parquet reader, as the command line reads it."""
    paths = [r[0] for r in files.discover(spark, sf).where("path like '%/documents.parquet%'").select("path").collect()]
    return files.read_parquet(spark, paths).select("doc_id", "status", F.md5(F.coalesce("text", F.lit(""))).alias("text"))


def lm_verdict(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "decisions").select("decision_id", F.col("kenlm_perplexity").alias("p"), F.col("features.word_count").alias("n"), F.col("features.unique_token_ratio").alias("o"))
    said = lm.verdict(F.col("p") * 5, F.col("n"), F.coalesce(F.col("o"), F.lit(0.0)), CFG)
    return rows.select("decision_id", F.coalesce(said, F.lit("keep")).alias("verdict"))


def inspect_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, F.coalesce("source", F.lit("none")).alias("file"))
    return inspection.summary(inspection.leading(rows, "file", ["doc_id"]), F.col("text"), "file")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "input_lines").select(F.col("raw_line").alias("raw"), "_shard", "_line_num")


def parse_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).where(F.regexp_replace("raw", f"[{tx.SPACE}]+", "") != "")
    return files.parsed(rows).select("_shard", "_line_num", "status", F.md5(F.coalesce("text", F.lit(""))).alias("text"))


def malformed_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = files.parsed(_lines(spark, sf).where(F.regexp_replace("raw", f"[{tx.SPACE}]+", "") != ""))
    return sinks.malformed(rows).select("text", F.array_join("_rejection_reasons", ",").alias("reasons"), "_line_num")


def prepare_counters(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.counters(_lines(spark, sf))


def key_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return inspection.key_frequencies(files.parsed(_lines(spark, sf)).where("status <> 'malformed'"), F.col("raw"))


def shard_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("file_name")
    return table(spark, sf, "shard_manifest").select(name, files.suffix(name).alias("suffix"), files.stem(name).alias("stem"), files.filtered(name, "1").alias("chosen"))


def pending_files(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "decisions").select(F.col("_shard").alias("name")).where("name is not null").distinct()
    return pending(names, table(spark, sf, "shard_manifest"))


def manifest_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "shard_manifest").select("state", F.size(F.coalesce("errors", F.array())).alias("e"), "n_bytes")
    return rows.groupBy("state").agg(F.count("*").alias("n_files"), F.sum(F.greatest("e", F.lit(0))).alias("n_errors"), F.sum("n_bytes").alias("n_bytes"))


def source_types(spark: SparkSession, sf: str) -> DataFrame:
    where = F.coalesce("url", F.concat(F.lit("data/"), "source"), F.lit("./data"))
    return documents(spark, sf, "url", "source").select("doc_id", resolver.source_type_of(where).alias("kind"))


def word_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return tokenizer.word_frequency(documents(spark, sf), F.col("text"))


def _vocabularies(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    frequency = word_frequency(spark, sf)
    word = lambda t, c: table(spark, sf, t).select(F.explode(F.regexp_extract_all(c, F.lit(f"[{tokenizer.LETTERS}]+"), F.lit(0))).alias("w"))
    donor = word("benchmark", "text").groupBy(F.concat(F.lit("▁"), "w").alias("token")).agg((F.count("*") * 7 % 6000).alias("id"))
    return donor, word("lang_samples", "text").select(F.concat(F.lit("▁"), "w").alias("token")).distinct(), frequency


def token_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return tokenizer.candidates(*_vocabularies(spark, sf)).select("token", "donor_id", "frequency", "score")


def extended_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    donor, base, frequency = _vocabularies(spark, sf)
    base = base.select("token", F.conv(F.substring(F.md5("token"), 1, 6), 16, 10).cast("bigint").alias("id"))
    new = reports.top(tokenizer.candidates(donor, base, frequency).select("token", F.col("score").alias("n")), "token", 200)
    place = F.row_number().over(tokenizer.Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token"))
    return tokenizer.assigned(base, new.select("token", place.alias("place")))


def queries() -> dict[str, Query]:
    named = (
        normalize_text, text_features, reason_histogram, language_decision, language_histogram, function_word_vote, default_language, exact_dedup, exact_dedup_stats, shingle_counts, near_dedup, near_dedup_stats,
        quality_score, decision, decision_summary, shard_report, shard_reasons, rejection_top20, run_language_histogram, perplexity_percentiles, length_percentiles, perplexity_csv,
        bernoulli_sample, audit_sample, shard_sample, reject_records, eos_append, hash_shards, shard_sizes, oversize_split, shard_count, rolled_shards, balanced_shards, lm_tokens, seed_corpus,
        seed_stats, sampled_shards, ngram_counts, lm_discounts, lm_score, lm_score_bigram, lm_verdict, decision_full, parquet_scan, inspect_summary, parse_lines, malformed_records, prepare_counters, key_frequencies, shard_names,
        pending_files, manifest_errors, source_types, word_frequency, token_candidates, extended_vocabulary,
    )
    return {f.__name__: f for f in named} | {"heuristic_reasons": _reasons(CFG), "heuristic_reasons_strict": _reasons(STRICT)}


# --- the same in SQL ---------------------------------------------------------------

_WS = tx.SPACE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _all(t: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({t}, {_q(pattern)}, {_q(by)}, 'g')"


def _lower(t: str) -> str:
    return f"lower(replace({t}, 'İ', 'i' || chr(775)))"


def _strip(t: str) -> str:
    return _all(t, f"^[{_WS}]+|[{_WS}]+$")


def _norm(t: str = "text") -> str:
    t = _all(_all(_all(t, tx.CONTROL), tx.ZERO_WIDTH), tx.WIDE_SPACE, " ")
    t = f"regexp_replace({t}, '\\n{{4,}}', chr(10)||chr(10)||chr(10), 'g')"
    return _strip(_all(t, " {4,}", " "))


def _words(t: str) -> str:
    return f"list_filter(string_split({_all(t, f'[{_WS}]+', ' ')}, ' '), lambda w: w <> '')"


def _half(x: str, digits: int) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def _count(inside: str) -> str:
    return f"length({_all('t', f'[^{inside}]+')})"


def _in(items: tuple[str, ...]) -> str:
    return ", ".join(_q(x) for x in items)


def _hits() -> str:
    parts = []
    for p in TURKISH.boilerplate:
        p = p.replace(r"\s", f"[{_WS}]").replace(r"\w", r"[\p{L}\p{N}_]")
        out, depth = "", 0
        for i, c in enumerate(p):
            depth += c == "["
            depth -= c == "]"
            out += "[iıİI]" if c in "iı" and not depth and p[i - 1 : i] != "\\" else c
        parts.append(f"regexp_matches(t, {_q('(?i)' + out)})::bigint")
    return " + ".join(parts)


def _features_cte(where: str = "text is not null", columns: str = "") -> str:
    per = lambda n: _half(f"{n} / greatest(length(t), 1)", 4)
    word = lambda n, d=4: _half(f"{n} / greatest(len(w), 1)", d)
    zero = lambda k, x: f"CASE WHEN t = '' THEN 0 ELSE {x} END AS {k}"
    f = {
        "char_count": "length(t)", "word_count": "len(w)", "line_count": "len(string_split(t, chr(10)))", "sentence_count": f"len(regexp_extract_all(t, {_q(tx.SENTENCE_END)})) + 1",
        "url_count": f"len(regexp_extract_all(t, {_q(tx.URL)}))", "email_count": f"len(regexp_extract_all(t, {_q(tx.EMAIL)}))", "html_tag_count": f"len(regexp_extract_all(t, {_q(tx.HTML_TAG)}))",
        "boilerplate_hits": _hits(), "alpha_ratio": per(_count(r"\p{L}")), "digit_ratio": per(_count(r"\p{Nd}" + tx.OTHER_DIGITS)),
        "punctuation_ratio": per("length(" + _all("t", r"[\p{L}\p{N}" + _WS + "]+") + ")"), "whitespace_ratio": per(_count(_WS)), "turkish_char_ratio": per(_count(TURKISH.special_chars)),
        "unique_token_ratio": word("len(list_distinct(w))"), "repeated_word_frac": word("coalesce(list_max(map_values(list_histogram(w))), 0)"),
        "repeated_line_ratio": f"CASE WHEN len(ln) > 0 THEN {_half('1 - len(list_distinct(ln)) / len(ln)', 4)} ELSE 0 END",
        "avg_word_length": word(f"(length(t) - {_count(_WS)})", 2), "stopword_coverage": word(f"len(list_filter(w, lambda x: x IN ({_in(TURKISH.stopwords)})))"),
    }
    whole = tuple(k for k in f if k.endswith(("count", "hits")))
    cols = ", ".join(zero(k, f"({x})::bigint" if k in whole else f"({x})::double") for k, x in f.items())
    lines = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"
    return (
        f"n AS (SELECT doc_id, {_norm()} AS t{columns} FROM documents WHERE {where}), "
        f"p AS (SELECT *, {_words(_lower('t'))} AS w, {lines} AS ln FROM n), "
        f"feat AS (SELECT *, {cols} FROM p)"
    )


def _rules(c: Config) -> str:
    rules = [
        ("too_short", f"char_count < {c.min_text_length}"), ("too_few_words", f"word_count < {c.min_word_count}"), ("too_long", f"char_count > {c.max_text_length}"),
        ("low_alpha_ratio", f"alpha_ratio < {c.min_alpha_ratio}"), ("high_digit_ratio", f"digit_ratio > {c.max_digit_ratio}"), ("high_punctuation_ratio", f"punctuation_ratio > {c.max_punctuation_ratio}"),
        ("too_many_urls", f"url_count > {c.max_url_count}"), ("too_many_emails", f"email_count > {c.max_email_count}"), ("html_remnants", f"html_tag_count > {c.max_html_tags}"),
        ("excessive_repeated_lines", f"repeated_line_ratio > {c.max_repeated_line_ratio}"), ("excessive_repeated_word", f"repeated_word_frac > {c.max_repeated_word_frac}"),
        ("low_token_diversity", f"unique_token_ratio < {c.min_unique_token_ratio} AND word_count > 20"),
        ("abnormal_avg_word_length_high", f"avg_word_length > {c.max_avg_word_length} AND word_count > 10"), ("abnormal_avg_word_length_low", f"avg_word_length < {c.min_avg_word_length} AND word_count > 10"),
        ("boilerplate_content", f"boilerplate_hits > {c.max_boilerplate_hits}"),
    ]
    listed = ", ".join(f"CASE WHEN {hit} THEN '{name}' END" for name, hit in rules)
    return f"CASE WHEN t = '' THEN ['empty_text'] ELSE list_filter([{listed}], lambda r: r IS NOT NULL) END"


_LANG = "coalesce(nullif(lower(trim(lang_label)), ''), 'unknown')"


def _lang_cte() -> str:
    tc, sw, tr = "turkish_char_ratio >= 0.015", "stopword_coverage >= 0.005", "detected_lang = 'tr'"
    return (
        f"lg AS (SELECT *, {_LANG} AS detected_lang, CASE WHEN {_LANG} = 'unknown' AND coalesce(trim(lang_label), '') = '' THEN 0.0 ELSE 0.9 END::double AS confidence FROM feat), "
        f"ld AS (SELECT *, CASE WHEN {tr} THEN 'accept' WHEN confidence >= 0.7 AND NOT ({tc}) AND NOT ({sw}) THEN 'reject' WHEN {tc} OR {sw} THEN 'borderline' ELSE 'reject' END AS lang_decision FROM lg)"
    )


def _decided_cte(c: Config = CFG) -> str:
    clamp = lambda x: f"greatest(0.0, least(1.0, {x}))"
    known = "CASE WHEN detected_lang = 'tr' THEN least(1.0, confidence + 0.2) WHEN confidence > 0 THEN greatest(0.0, 0.5 - confidence * 0.5) ELSE 0.5 END::double"
    shape = "(least(1.0, alpha_ratio / 0.7::double) * 0.3::double + least(1.0, unique_token_ratio / 0.5::double) * 0.2::double + least(1.0, stopword_coverage / 0.05::double) * 0.3::double + least(1.0, turkish_char_ratio / 0.05::double) * 0.2::double)"
    score = _half(clamp(f"0.5::double * 0.4::double + ({known}) * 0.3::double + {shape} * 0.3::double"), 4)
    return (
        f"{_features_cte('text is not null', ', lang AS lang_label, source')}, {_lang_cte()}, "
        f"dup AS (SELECT *, row_number() OVER (PARTITION BY {_lower(_strip('t'))} ORDER BY doc_id) > 1 AS is_exact_dup FROM ld), "
        f"sc AS (SELECT *, {score} AS quality_score, list_concat({_rules(c)}, list_concat(CASE WHEN lang_decision = 'reject' THEN ['non_turkish'] ELSE []::varchar[] END, CASE WHEN is_exact_dup THEN ['exact_duplicate'] ELSE []::varchar[] END)) AS hard FROM dup), "
        f"dec AS (SELECT *, CASE WHEN len(hard) > 0 THEN hard WHEN quality_score < {c.soft_threshold} THEN ['low_quality_score'] ELSE []::varchar[] END AS reasons FROM sc)"
    )


def _bucket(key: str, seed: str) -> str:
    return f"('0x' || substr(md5({_q(seed)} || {key}::varchar), 1, 15))::bigint % 10000"


def _shard(line: str, n: str, seed: str = "'42' || chr(10)") -> str:
    return f"(('0x' || substr(md5({seed} || {line}), 1, 15))::bigint % {n})::int"


def _eos(t: str = "text") -> str:
    own = _all(t, f"[{_WS}]+$")
    return f"CASE WHEN ends_with({own}, '{prepare.EOS}') THEN {own} ELSE {own} || ' {prepare.EOS}' END"


def _percentile(table_: str, value: str, shares: tuple[float, ...]) -> str:
    picks = " UNION ALL ".join(f"SELECT 'p{s * 100:g}' AS name, v AS value FROM r WHERE i = floor(n * {s}::double)" for s in shares)
    return (
        f"WITH r AS (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS i, count(*) OVER () AS n FROM {table_}) "
        f"SELECT 'min' AS name, v AS value FROM r WHERE i = 0 UNION ALL {picks} UNION ALL SELECT 'max', v FROM r WHERE i = n - 1"
    )


def _discount(counts: str, name: str) -> str:
    """Discounts of modified Kneser-Ney from the counts of counts."""
    n = ", ".join(f"count(*) FILTER (WHERE n = {k}) AS n{k}" for k in (1, 2, 3, 4))
    y = "(n1 / (n1 + 2 * n2))"
    d = [f"{k} - {k + 1} * {y} * n{k + 1} / nullif(n{k}, 0)" for k in (1, 2, 3)]
    good = " AND ".join(f"coalesce(({x}) BETWEEN 0 AND {k}, false)" for k, x in zip((1, 2, 3), d, strict=True))
    cases = ", ".join(f"CASE WHEN {good} THEN {x} ELSE {f} END AS d{k}" for k, x, f in zip((1, 2, 3), d, lm.FALLBACK, strict=True))
    return f"{name} AS (SELECT {cases} FROM (SELECT {n} FROM {counts}))"


def _bigram_model() -> str:
    """Interpolated modified Kneser-Ney of order two, from the bigrams ``b`` and their counts ``bc``."""
    cut = "CASE WHEN n = 1 THEN d1 WHEN n = 2 THEN d2 ELSE d3 END"
    return (
        "c2 AS (SELECT split_part(gram, ' ', 1) AS a, split_part(gram, ' ', 2) AS b, n FROM bc), c1 AS (SELECT b AS word, count(*) AS n FROM c2 GROUP BY b), voc AS (SELECT word FROM c1), "
        f"{_discount('c2', 'e2')}, {_discount('c1', 'e1')}, "
        f"s1 AS (SELECT sum(n) AS total, sum({cut}) / sum(n) AS gamma, count(*) + 1 AS size FROM c1, e1), "
        f"p1 AS (SELECT word, (n - {cut}) / total + gamma / size AS p FROM c1, e1, s1 UNION ALL SELECT '<unk>', gamma / size FROM s1), "
        f"g2 AS (SELECT a, sum(n) AS total, sum({cut}) / sum(n) AS gamma FROM c2, e2 GROUP BY a), "
        f"p2 AS (SELECT c2.a, c2.b, (n - {cut}) / total + gamma * p1.p AS p FROM c2 JOIN g2 USING (a) JOIN p1 ON p1.word = c2.b, e2)"
    )


_COUNTERS = (
    "count(*) AS total_lines, 0::bigint AS malformed_json, count(*) FILTER (WHERE text IS NULL) AS missing_text, count(*) FILTER (WHERE decision = 'keep') AS kept, "
    "count(*) FILTER (WHERE decision = 'reject') AS rejected, count(*) FILTER (WHERE is_exact_dup) AS exact_duplicates, 0::bigint AS near_duplicates"
)


def oracle_sql() -> dict[str, str]:
    feats = _features_cte()
    dec = _decided_cte()
    every = f"{dec}, every AS (SELECT d.doc_id, d.text, d.source, x.is_exact_dup, x.reasons, CASE WHEN x.doc_id IS NOT NULL THEN CASE WHEN len(x.reasons) > 0 THEN 'reject' ELSE 'keep' END END AS decision FROM documents d LEFT JOIN dec x USING (doc_id))"
    ratio = lambda c: f"{_half(f'{c} / greatest(total_lines, 1)', 4)}"
    normed = f"SELECT doc_id, {_norm()} AS t FROM documents"
    key = _lower(_strip("t"))
    marked = f"SELECT doc_id, t, t IS NOT NULL AND row_number() OVER (PARTITION BY {key} ORDER BY doc_id) > 1 AS is_exact_dup FROM ({normed})"
    sharded = f"SELECT doc_id, line, {_shard('line', '16')} AS shard FROM (SELECT doc_id, {_eos()} AS line FROM documents WHERE text IS NOT NULL)"
    split = f"list_filter(list_transform(string_split(regexp_replace(t, {_q(f'([.!?…])[{_WS}]+')}, '\\1' || chr(1), 'g'), chr(1)), lambda s: {_words(_lower('s'))}), lambda w: len(w) >= 3)"
    labelled = f"{_features_cte('text is not null', ', lang AS lang_label')}, {_lang_cte()}"
    seed = f"{labelled}, ok AS (SELECT doc_id, t FROM ld WHERE len({_rules(CFG)}) = 0 AND lang_decision <> 'reject' AND t <> '' ORDER BY doc_id LIMIT {CFG.seed_records}), sent AS (SELECT unnest({split}) AS s FROM ok)"
    bigrams = f"{seed}, b AS (SELECT unnest(list_transform(generate_series(1, len(x) - 1), lambda i: x[i] || ' ' || x[i + 1])) AS gram FROM (SELECT list_concat(list_concat(['<s>'], s), ['</s>']) AS x FROM sent)), bc AS (SELECT gram, count(*) AS n FROM b GROUP BY gram)"
    own = _words(_lower("replace(text, chr(10), ' ')"))
    votes = f"SELECT doc_id, unnest(list_filter({_words(_lower('substr(replace(text, chr(10), chr(32)), 1, 5000)'))}, lambda x: x <> '')) AS word FROM documents WHERE text IS NOT NULL"
    ranked = (
        "c AS (SELECT doc_id, lang, count(*) AS n FROM v JOIN w USING (word) GROUP BY 1, 2), t AS (SELECT doc_id, count(*) + 1 AS total FROM v WHERE word IN (SELECT word FROM w) GROUP BY 1), "
        f"r AS (SELECT c.doc_id, lang, n / total AS score, row_number() OVER (PARTITION BY c.doc_id ORDER BY n DESC, lang) AS k FROM c JOIN t ON t.doc_id = c.doc_id QUALIFY score >= {language.LEAST_SHARE})"
    )
    listed = ", ".join(f"({_q(k)}, {_q(x)})" for k, ws in language.default_lists(CFG.profile).items() for x in ws)
    lines = f"SELECT raw_line AS raw, _shard, _line_num FROM input_lines WHERE {_all('raw_line', f'[{_WS}]+')} <> ''"
    value = "json_extract(j, '$.text')"
    as_text = f"CASE json_type({value}) WHEN 'VARCHAR' THEN json_extract_string(j, '$.text') WHEN 'NULL' THEN NULL ELSE {value}::varchar END"
    parsed = f"SELECT *, CASE WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'malformed' WHEN ({as_text}) IS NULL THEN 'missing_text' ELSE 'ok' END AS status, CASE WHEN json_type(j) = 'OBJECT' THEN {as_text} END AS text FROM (SELECT *, CASE WHEN json_valid(raw) THEN raw::json END AS j FROM ({lines}))"
    letters = f"[{tokenizer.LETTERS}]+"
    words = f"SELECT unnest(regexp_extract_all(text, {_q(letters)})) AS w FROM documents"
    frequency = f"SELECT word, sum(n)::bigint AS frequency FROM (SELECT w AS word, count(*) AS n FROM ({words}) GROUP BY w UNION ALL SELECT {_lower('w')}, count(*) FROM ({words}) GROUP BY w) GROUP BY word"
    special = f"[{TURKISH.special_chars}]"
    cand = (
        f"WITH f AS ({frequency}), donor AS (SELECT '▁' || w AS token, w AS plain, {_lower('w')} AS low, count(*) * 7 % 6000 AS id FROM (SELECT unnest(regexp_extract_all(text, {_q(letters)})) AS w FROM benchmark) GROUP BY w), "
        f"base AS (SELECT DISTINCT '▁' || w AS token FROM (SELECT unnest(regexp_extract_all(text, {_q(letters)})) AS w FROM lang_samples)), "
        f"c AS (SELECT token, id AS donor_id, plain, low, coalesce(f1.frequency, 0) + coalesce(f2.frequency, 0) AS frequency FROM donor LEFT JOIN f f1 ON f1.word = plain LEFT JOIN f f2 ON f2.word = low "
        f"WHERE token NOT IN (SELECT token FROM base) AND length(plain) >= 3 AND (regexp_matches(plain, {_q(special)}) OR low IN ({_in(TURKISH_SUFFIXES)}))), "
        f"cand AS (SELECT token, donor_id::bigint AS donor_id, frequency::bigint AS frequency, (frequency * 100 + CASE WHEN low IN ({_in(TURKISH_SUFFIXES)}) THEN 2000 ELSE 0 END + 150 + greatest(0, 5000 - donor_id) / 10 + CASE WHEN regexp_matches(plain, {_q(special)}) THEN 200 ELSE 0 END)::double AS score FROM c)"
    )
    big = f"WITH x AS (SELECT doc_id, line, least(shard, 5)::int AS shard FROM ({sharded})), z AS (SELECT shard, sum(strlen(line) + 1) AS b FROM x GROUP BY shard), p AS (SELECT shard, CASE WHEN b > 100000 * 1.2 THEN greatest(2, ceil(b / 100000.0))::int ELSE 1 END AS parts FROM z)"
    return {
        "normalize_text": f"SELECT doc_id, {_norm()} AS text FROM documents",
        "text_features": f"WITH {feats} SELECT doc_id, {', '.join(tx.FEATURES)} FROM feat",
        "heuristic_reasons": f"WITH {feats} SELECT doc_id, array_to_string({_rules(CFG)}, ',') AS reasons FROM feat",
        "heuristic_reasons_strict": f"WITH {feats} SELECT doc_id, array_to_string({_rules(STRICT)}, ',') AS reasons FROM feat",
        "reason_histogram": f"WITH {feats} SELECT reason, count(*) AS n FROM (SELECT unnest({_rules(STRICT)}) AS reason FROM feat) GROUP BY reason",
        "language_decision": f"WITH {_features_cte('text is not null', ', lang AS lang_label')}, {_lang_cte()} SELECT doc_id, detected_lang, confidence, lang_decision FROM ld",
        "language_histogram": f"WITH {_features_cte('text is not null', ', lang AS lang_label')}, {_lang_cte()} SELECT detected_lang AS lang, count(*) AS n FROM ld GROUP BY 1",
        "function_word_vote": f"WITH v AS ({votes}), w AS (SELECT lang, word FROM common_words), {ranked} "
        f"SELECT d.doc_id, coalesce(r.lang, 'unknown') AS lang, {_half('coalesce(r.score, 0)', 4)} AS score FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND k = 1 WHERE d.text IS NOT NULL",
        "default_language": f"WITH {feats}, v AS (SELECT doc_id, unnest({_words(_lower('substr(replace(t, chr(10), chr(32)), 1, 5000)'))}) AS word FROM feat), w AS (SELECT * FROM (VALUES {listed}) AS x(lang, word)), {ranked}, "
        "said AS (SELECT f.*, a.lang AS l1, a.score AS s1, b.lang AS l2, coalesce(tr.score, 0) AS tr FROM feat f LEFT JOIN r a ON a.doc_id = f.doc_id AND a.k = 1 LEFT JOIN r b ON b.doc_id = f.doc_id AND b.k = 2 LEFT JOIN r tr ON tr.doc_id = f.doc_id AND tr.k <= 3 AND tr.lang = 'tr'), "
        "q AS (SELECT *, turkish_char_ratio >= 0.015 AS tc, stopword_coverage >= 0.005 AS sw, coalesce(l1 = 'tr', false) OR coalesce(l2 = 'tr', false) AS near FROM said) "
        f"SELECT doc_id, coalesce(l1, 'unknown') AS detected_lang, {_half('coalesce(s1, 0)', 6)} AS confidence, CASE WHEN coalesce(l1 = 'tr', false) AND s1 >= {CFG.high_confidence} THEN 'accept' WHEN near AND tr >= {CFG.min_confidence} AND (tc OR sw) THEN 'accept' WHEN tc AND sw AND near THEN 'accept' "
        f"WHEN coalesce(l1, '') <> 'tr' AND coalesce(s1, 0) >= {CFG.reject_confidence} AND NOT tc AND NOT sw THEN 'reject' WHEN tc OR sw OR near THEN 'borderline' ELSE 'reject' END AS lang_decision FROM q",
        "exact_dedup": f"SELECT doc_id, is_exact_dup FROM ({marked})",
        "exact_dedup_stats": f"SELECT count(t) AS total_checked, count(t) - count(*) FILTER (WHERE is_exact_dup) AS unique_count, count(*) FILTER (WHERE is_exact_dup) AS duplicate_count, {_half('count(*) FILTER (WHERE is_exact_dup) / greatest(count(t), 1)', 4)} AS duplicate_ratio FROM ({marked})",
        "shingle_counts": f"SELECT doc_id, CASE WHEN length(k) < 5 THEN 1 ELSE len(list_distinct(list_transform(generate_series(1, length(k) - 4), lambda i: substr(k, i, 5)))) END::bigint AS n_shingles FROM (SELECT doc_id, {_lower(_strip('text'))} AS k FROM documents WHERE text IS NOT NULL)",
        "quality_score": f"WITH {dec} SELECT doc_id, quality_score FROM dec",
        "decision": f"WITH {dec} SELECT doc_id, CASE WHEN len(reasons) > 0 THEN 'reject' ELSE 'keep' END AS decision, array_to_string(reasons, ',') AS reasons, quality_score, abs(quality_score - 0.25) < 0.1 AS is_borderline FROM dec",
        "decision_summary": f"WITH {every}, c AS (SELECT {_COUNTERS} FROM every) SELECT *, {ratio('kept')} AS keep_ratio, {ratio('rejected')} AS reject_ratio FROM c",
        "shard_report": f"WITH {every} SELECT source AS shard, {_COUNTERS} FROM every GROUP BY source",
        "shard_reasons": f"WITH {every} SELECT shard, reason, count(*) AS n FROM (SELECT source AS shard, unnest(reasons) AS reason FROM every) GROUP BY 1, 2",
        "rejection_top20": "SELECT reason, count(*) AS n FROM (SELECT regexp_replace(unnest(reasons), '^(low_quality_score)_.*$', '\\1') AS reason FROM decisions) GROUP BY reason ORDER BY n DESC, reason LIMIT 20",
        "run_language_histogram": "SELECT run_id, lang_info.detected_lang AS lang, count(*) AS n FROM decisions GROUP BY 1, 2",
        "perplexity_percentiles": _percentile("decisions WHERE kenlm_perplexity > 0", "kenlm_perplexity", (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)),
        "length_percentiles": _percentile("documents WHERE text IS NOT NULL", "length(text)::double", (0.25, 0.50, 0.75)),
        "perplexity_csv": "SELECT decision_id, kenlm_perplexity AS perplexity FROM decisions WHERE kenlm_perplexity > 0",
        "bernoulli_sample": f"SELECT doc_id FROM documents WHERE {_bucket('doc_id', 's')} < 500",
        "audit_sample": f"SELECT doc_id, substr(text, 1, 1000) AS text FROM documents ORDER BY {_bucket('doc_id', 'a')}, doc_id LIMIT 200",
        "shard_sample": f"SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_bucket('doc_id', 'x')}, doc_id) <= 5",
        "reject_records": f"WITH {_decided_cte(STRICT)} SELECT substr(t, 1, 500) AS text, array_to_string(reasons, ',') AS reasons, quality_score AS _quality_score, source AS _shard, doc_id AS _line_num FROM dec WHERE len(reasons) > 0",
        "eos_append": f"SELECT doc_id, {_eos()} AS text, ({_eos()}) <> {_all('text', f'[{_WS}]+$')} AS eos_added FROM documents WHERE text IS NOT NULL",
        "hash_shards": f"SELECT doc_id, shard FROM ({sharded})",
        "shard_sizes": f"SELECT shard, count(*) AS n_records, sum(strlen(line) + 1)::bigint AS n_bytes FROM ({sharded}) GROUP BY shard",
        "oversize_split": f"{big} SELECT doc_id, x.shard, {_shard('line', 'parts', '(42 + x.shard)::varchar || chr(10)')} AS part FROM x JOIN p USING (shard)",
        "shard_count": f"SELECT sum(strlen(line) + 1)::bigint AS n_bytes, greatest(1, ceil(sum(strlen(line) + 1) / 50000.0))::int AS n_shards FROM ({sharded})",
        "rolled_shards": f"WITH RECURSIVE x AS (SELECT doc_id, strlen(text) + 1 AS n, row_number() OVER (ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL), r AS (SELECT k, doc_id, 0::bigint AS shard_index, n AS filled FROM x WHERE k = 1 UNION ALL SELECT x.k, x.doc_id, CASE WHEN r.filled + x.n > {TARGET} THEN r.shard_index + 1 ELSE r.shard_index END, CASE WHEN r.filled + x.n > {TARGET} THEN x.n ELSE r.filled + x.n END FROM r JOIN x ON x.k = r.k + 1) SELECT doc_id, shard_index FROM r",
        "balanced_shards": f"SELECT doc_id, (coalesce(sum(strlen(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {TARGET})::bigint AS shard_index FROM documents WHERE text IS NOT NULL",
        "lm_tokens": f"SELECT doc_id, len(w)::bigint AS n_tokens, md5(array_to_string(CASE WHEN len(w) > 500 THEN list_concat(list_concat(w[1:166], w[((len(w) - 166) // 2 + 1):((len(w) - 166) // 2 + 166)]), w[(len(w) - 165):len(w)]) ELSE w END, ' ')) AS window FROM (SELECT doc_id, {own} AS w FROM documents WHERE text IS NOT NULL)",
        "seed_corpus": f"WITH {seed} SELECT array_to_string(s, ' ') AS sentence, count(*) AS n FROM sent GROUP BY 1",
        "seed_stats": f"WITH {labelled}, a AS (SELECT *, len({_rules(CFG)}) = 0 AND lang_decision <> 'reject' AS fine FROM ld) SELECT count(*) AS scanned, count(*) FILTER (WHERE fine) AS accepted, coalesce(sum(CASE WHEN fine THEN len({split}) END), 0)::bigint AS sentences FROM a",
        "sampled_shards": "WITH s AS (SELECT DISTINCT file_name AS shard FROM shard_manifest), r AS (SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS r, count(*) OVER () AS n FROM s) SELECT shard FROM r WHERE n <= 3 OR (r % greatest(n // 3, 1) = 0 AND r // greatest(n // 3, 1) < 3)",
        "ngram_counts": f"WITH {bigrams} SELECT gram, n FROM bc WHERE n > 1",
        "lm_discounts": f"WITH {bigrams}, k AS (SELECT count(*) FILTER (WHERE n = 1) AS n1, count(*) FILTER (WHERE n = 2) AS n2, count(*) FILTER (WHERE n = 3) AS n3, count(*) FILTER (WHERE n = 4) AS n4 FROM bc), y AS (SELECT *, n1 / (n1 + 2 * n2) AS y FROM k) SELECT {_half('1 - 2 * y * n2 / n1', 6)} AS d1, {_half('2 - 3 * y * n3 / n2', 6)} AS d2, {_half('3 - 4 * y * n4 / n3', 6)} AS d3 FROM y",
        "lm_score_bigram": f"WITH {bigrams}, {_bigram_model()}, "
        f"d AS (SELECT doc_id, {own} AS w FROM documents WHERE text IS NOT NULL), "
        "o AS (SELECT doc_id, len(w) AS n, list_concat(CASE WHEN len(w) > 500 THEN list_concat(list_concat(w[1:166], w[((len(w) - 166) // 2 + 1):((len(w) - 166) // 2 + 166)]), w[(len(w) - 165):len(w)]) ELSE w END, ['</s>']) AS x FROM d WHERE len(w) >= 10), "
        "k AS (SELECT doc_id, i, x[i] AS word FROM (SELECT doc_id, x, unnest(generate_series(1, len(x))) AS i FROM o)), "
        "m AS (SELECT doc_id, i, CASE WHEN u.word IS NULL THEN '<unk>' ELSE k.word END AS word, (u.word IS NULL)::int AS oov FROM k LEFT JOIN (SELECT DISTINCT word FROM voc) u ON u.word = k.word), "
        "q AS (SELECT *, coalesce(lag(word) OVER (PARTITION BY doc_id ORDER BY i), '<s>') AS before FROM m), "
        "z AS (SELECT q.doc_id, q.oov, CASE WHEN p2.p IS NOT NULL THEN log10(p2.p) ELSE log10(p1.p) + coalesce(log10(g2.gamma), 0) END AS lp FROM q LEFT JOIN p2 ON p2.a = q.before AND p2.b = q.word JOIN p1 ON p1.word = q.word LEFT JOIN g2 ON g2.a = q.before), "
        "t AS (SELECT doc_id, sum(lp) AS lp, count(*) - 1 AS n, sum(oov) AS oov FROM z GROUP BY doc_id) "
        f"SELECT d.doc_id, len(d.w)::bigint AS num_tokens, coalesce({_half('pow(10.0, -t.lp / t.n)', 2)}, -1.0) AS perplexity, coalesce({_half('t.oov / t.n', 4)}, 0.0) AS oov_ratio FROM d LEFT JOIN t USING (doc_id)",
        "parquet_scan": "SELECT doc_id, CASE WHEN text IS NULL THEN 'missing_text' ELSE 'ok' END AS status, md5(coalesce(text, '')) AS text FROM documents",
        "lm_verdict": "SELECT decision_id, CASE WHEN p IS NULL OR p < 0 THEN 'keep' WHEN p > lim THEN 'high_kenlm_perplexity' WHEN o > 0.5 AND p > lim * 0.5 THEN 'high_oov_and_perplexity' ELSE 'keep' END AS verdict FROM (SELECT decision_id, kenlm_perplexity * 5 AS p, CASE WHEN features.word_count < 30 THEN 4500.0 ELSE 3000.0 END AS lim, coalesce(features.unique_token_ratio, 0) AS o FROM decisions)",
        "inspect_summary": f"WITH h AS (SELECT coalesce(source, 'none') AS file, coalesce(text, '') AS t FROM documents QUALIFY row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) <= 100) SELECT count(DISTINCT file) AS n_files, count(*) AS n_records, min(length(t))::int AS min_length, max(length(t))::int AS max_length, floor(sum(length(t)) / count(*))::bigint AS avg_length, {_half(f'sum({_count(TURKISH.special_chars)}) / greatest(sum(length(t)), 1)', 6)} AS special_char_ratio, count(*) FILTER (WHERE contains(lower(t), '<html') OR contains(lower(t), '<div')) AS html_records, count(*) FILTER (WHERE contains(t, 'http://') OR contains(t, 'https://')) AS url_records FROM h",
        "parse_lines": f"SELECT _shard, _line_num, status, md5(coalesce(text, '')) AS text FROM ({parsed})",
        "malformed_records": f"SELECT substr(raw, 1, 500) AS text, 'malformed_json' AS reasons, _line_num FROM ({parsed}) WHERE status = 'malformed'",
        "prepare_counters": f"WITH p AS ({parsed}), a AS (SELECT count(*) AS total FROM input_lines) SELECT total, total - count(*) AS skipped, count(*) FILTER (WHERE status = 'malformed') AS invalid_json, count(*) FILTER (WHERE status = 'missing_text') AS missing_text, count(*) FILTER (WHERE status = 'ok' AND json_type({value}) <> 'VARCHAR') AS non_string, count(*) FILTER (WHERE status = 'ok') AS written, count(*) FILTER (WHERE status = 'ok' AND NOT ends_with({_all('text', f'[{_WS}]+$')}, '{prepare.EOS}')) AS eos_added FROM p, a GROUP BY total",
        "key_frequencies": f"SELECT key, count(*) AS n FROM (SELECT unnest(list_distinct(json_keys(j))) AS key FROM ({parsed}) WHERE status <> 'malformed') WHERE NOT starts_with(key, '_') GROUP BY key",
        "shard_names": "SELECT file_name, regexp_extract(lower(file_name), '(\\.jsonl?(?:\\.gz)?|\\.parquet)$', 1) AS suffix, regexp_replace(file_name, '(?i)\\.(jsonl\\.gz|json\\.gz|jsonl|json|parquet)$', '') AS stem, contains(file_name, '1') AS chosen FROM shard_manifest",
        "pending_files": "SELECT DISTINCT _shard AS name FROM decisions WHERE _shard IS NOT NULL AND _shard NOT IN (SELECT file_name FROM shard_manifest WHERE state IN ('done', 'processed', 'uploaded') AND file_name IS NOT NULL)",
        "manifest_errors": "SELECT state, count(*) AS n_files, sum(coalesce(len(errors), 0))::bigint AS n_errors, sum(n_bytes)::bigint AS n_bytes FROM shard_manifest GROUP BY state",
        "source_types": f"SELECT doc_id, CASE WHEN regexp_matches(s, {_q(resolver.CODE_HOST)}) THEN 'github' WHEN regexp_matches(s, {_q(resolver.HUB_NAME)}) THEN 'huggingface' WHEN contains(s, '/') AND starts_with(s, 'http') THEN 'huggingface' ELSE 'local' END AS kind FROM (SELECT doc_id, coalesce(url, 'data/' || source, './data') AS s FROM documents)",
        "word_frequency": frequency,
        "token_candidates": f"{cand} SELECT token, donor_id, frequency, score FROM cand",
        "extended_vocabulary": f"{cand}, top AS (SELECT token, row_number() OVER (ORDER BY score DESC, token) AS n FROM cand QUALIFY n <= 200), b AS (SELECT token, ('0x' || substr(md5(token), 1, 6))::bigint AS id FROM base) SELECT token, id FROM b UNION ALL SELECT token, (SELECT max(id) FROM b) + n FROM top",
    }
