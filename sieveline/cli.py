"""python -m sieveline.cli --phase all --input DIR --output DIR"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .operators import dedup, inspection, language, lm, prepare, reports, sharding, tokenizer
from .plans.pipeline import decide, featured
from .plans.storage import bounded, exists, write_file
from .sources import files, resolver, sinks, upload, writers
from .streaming import incremental
from .streaming.manifest import Manifest

PHASES = ("inspect", "build-lm", "filter", "incremental", "prepare", "extend-tokenizer", "upload", "all")
#: Keys that records of one dataset may have.
KEYS = 1_000_000


def _report(spark: SparkSession, path: str, report: dict) -> None:
    write_file(spark, path, json.dumps(report, ensure_ascii=False, indent=2, default=str))


def inspect(spark: SparkSession, cfg: Config, root: str) -> dict:
    rows = files.read_all(spark, root, cfg.text_key, cfg.shard_filter)
    head = inspection.leading(rows, "_file", ["_line_num"])
    report = inspection.summary(head, F.col("text"), "_file").first().asDict()
    report["keys"] = {r["key"]: r["n"] for r in bounded(inspection.key_frequencies(head, F.col("raw")).orderBy(F.desc("n"), "key"), KEYS, "keys")}
    report["files"] = [r.asDict() for r in inspection.record_counts(rows, "_file").orderBy(files.path_order(F.col("file"))).limit(10).collect()]
    report["previews"] = [r[0] for r in inspection.previews(head, F.col("text"), ["_file", "_line_num"]).collect()]
    _report(spark, cfg.output("reports/inspection.json"), report)
    return report


def _said(cfg: Config) -> Column:
    return language.by_function_words(F.col("text"), language.default_lists(cfg.profile))


def build_lm(spark: SparkSession, cfg: Config, root: str) -> lm.Model:
    """Seed corpus of the records that pass the rules and are not of another language, and the model of it."""
    rows = files.read_all(spark, root, cfg.text_key, cfg.shard_filter)
    shards = lm.sampled_shards(rows.select(F.col("_file").alias("shard")), cfg.seed_shards)
    some = featured(rows.join(shards, F.col("_file") == F.col("shard"), "left_semi").where("status = 'ok'"), cfg)
    some = some.withColumn("lang", language.info(_said(cfg), F.col("features"), "function_words"))
    corpus = lm.seed_corpus(some, "text", ["_file", "_line_num"], lm.seed_accepted(F.col("heuristic_reasons"), language.decision(F.col("lang"), cfg)), cfg)
    sinks.write_text(corpus.select(F.array_join("sentence", " ").alias("line")), "line", cfg.output("lm/seed_corpus"))
    model = lm.train(spark.read.text(cfg.output("lm/seed_corpus")).select(F.split("value", " ").alias("sentence")), cfg)
    for name in ("grams", "backoffs", "vocabulary"):
        getattr(model, name).write.mode("overwrite").parquet(cfg.output(f"lm/{name}"))
    return model


def load_lm(spark: SparkSession, cfg: Config) -> lm.Model | None:
    if not exists(spark, cfg.output("lm/vocabulary/_SUCCESS")):
        return None
    return lm.Model(cfg.lm_order, *(spark.read.parquet(cfg.output(f"lm/{n}")) for n in ("grams", "backoffs", "vocabulary")))


def available_lm(spark: SparkSession, cfg: Config, root: str) -> lm.Model:
    """The model of an earlier run, or one that is built now."""
    return load_lm(spark, cfg) or build_lm(spark, cfg, root)


def filter_all(spark: SparkSession, cfg: Config, root: str) -> dict:
    """Decide every record, write kept, rejected and malformed ones, the reports and the audit samples."""
    rows = files.read_all(spark, root, cfg.text_key, cfg.shard_filter)
    # a key of its own for each record, without collisions, that sorts as paths do: component by component, then by line
    rows = rows.withColumn("_row", F.concat_ws("\u0001", files.path_order(F.col("_file")), F.lpad(F.col("_line_num").cast("string"), 19, "0")))
    decided = decide(rows, cfg, lm=available_lm(spark, cfg, root), order=("_row",), row_id="_row")
    decided.write.mode("overwrite").parquet(cfg.output("decided"))
    decided = spark.read.parquet(cfg.output("decided"))
    kept = decided.where("decision = 'keep'")
    sized = kept.select("_row", sinks.kept_json(F.col("raw"), F.col("text"), cfg.text_key).alias("line"))
    sized = sharding.balanced(sized, ["_row"], prepare.line_bytes(F.col("line")), cfg.target_shard_mb << 20)
    manifest = Manifest.load(cfg.output("manifest.json"), spark)
    writers.write_rolled(sized, F.col("line"), "shard_index", ["_row"], cfg.output("kept"), lambda shard: manifest.mark("produced_shards", shard))
    manifest.save(spark)
    sinks.write_json(sinks.rejected(decided).unionByName(sinks.malformed(decided)), cfg.output("rejected"))
    sinks.write_json(reports.counters(decided, ["_shard"]), cfg.output("reports/shards"))
    sinks.write_csv(decided.where("perplexity > 0").select("perplexity").orderBy("perplexity"), cfg.output("reports/perplexity"))
    totals = reports.with_ratios(reports.counters(decided))
    histogram = reports.reason_histogram(decided)
    report = totals.first().asDict()
    report["exact_dedup"] = dedup.exact_stats(decided, F.col("text")).first().asDict()
    if cfg.enable_near_dedup:
        report["near_dedup"] = dedup.near_stats(decided.where("text is not null and not is_exact_dup")).first().asDict()
    report["top_reasons"] = {r["reason"]: r["n"] for r in reports.top(histogram, "reason").collect()}
    report["languages"] = {r["lang"]: r["n"] for r in reports.top(reports.language_histogram(decided.where("status = 'ok'"), F.col("lang.detected_lang")), "lang", 100).collect()}
    report["lengths"] = {r["name"]: r["value"] for r in reports.percentiles(kept, F.length("text"), (0.25, 0.5, 0.75)).collect()}
    report["perplexity"] = {r["name"]: r["value"] for r in reports.percentiles(decided.where("perplexity > 0"), F.col("perplexity"), (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)).collect()}
    for kind in ("accepted", "rejected", "borderline"):
        sinks.write_json(reports.audit(decided, kind, F.col("_row"), cfg.audit_samples), cfg.output(f"audit/{kind}"))
    _report(spark, cfg.output("reports/summary.json"), report)
    lines = [f"{k}: {v}" for k, v in report.items() if not isinstance(v, dict)]
    write_file(spark, cfg.output("reports/summary.txt"), "\n".join(lines) + "\n")
    return report


def prepare_shards(spark: SparkSession, cfg: Config, root: str, n: int | None = None, target_mb: int = 300, recursive: bool = True) -> dict:
    """Training shards: each text ends with one end mark and goes to the shard of its hash; too large ones are split."""
    lines = files.read_lines(spark, root, recursive)
    counts = prepare.counters(lines, key=cfg.text_key).first().asDict()
    texts = files.parsed(lines, cfg.text_key).where("status = 'ok'").select(F.to_json(F.struct(prepare.ensure_eos(F.col("text")).alias("text"))).alias("line"))
    target = target_mb << 20
    if n is None:
        n = texts.agg(F.coalesce(F.sum(prepare.line_bytes(F.col("line"))), F.lit(0)).alias("b")).select(prepare.shard_count(F.col("b"), target)).first()[0]
    made = writers.write_hash_shards(texts.withColumn("shard", prepare.shard_id(F.col("line"), n, str(cfg.seed))), "line", "shard", n, cfg.output("prepared"), target)
    report = counts | {"shards": len(made)}
    _report(spark, cfg.output("prepared/report.json"), report)
    return report


def extend_tokenizer(spark: SparkSession, cfg: Config, root: str, base: str, donor: str, limit: int, max_lines: int | None = None) -> dict:
    """The base tokenizer with the donor's tokens that the corpus, or the first lines of each of its files, needs most."""
    (vocab, merges), (donor_vocab, donor_merges) = tokenizer.load(spark, base), tokenizer.load(spark, donor)
    lines = files.read_lines(spark, root)
    lines = lines if max_lines is None else lines.where(F.col("_line_num") < max_lines)
    texts = lines.select(tokenizer.record_text(F.col("raw")).alias("text"))
    ranked = tokenizer.candidates(donor_vocab, vocab, tokenizer.word_frequency(texts, F.col("text"))).orderBy(F.desc("score"), "token")
    pairs = lambda m: [(r["left"], r["right"]) for r in m.orderBy("index").collect()]
    # two vocabularies, whose size their tokenizers fix
    chosen = tokenizer.select([(r["token"], r["donor_id"]) for r in ranked.collect()], {r[0] for r in vocab.select("token").collect()}, set(pairs(merges)), pairs(donor_merges), limit)
    return tokenizer.write(base, cfg.output("tokenizer"), chosen)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--phase", choices=PHASES, default="all")
    p.add_argument("--input")
    p.add_argument("--input-repo")
    p.add_argument("--output", default="output")
    p.add_argument("--output-repo")
    p.add_argument("--token")
    p.add_argument("--cache-dir")
    p.add_argument("--text-key", default="text")
    p.add_argument("--shard-filter")
    p.add_argument("--near-dedup", action="store_true")
    p.add_argument("--no-exact-dedup", action="store_true")
    p.add_argument("--no-resume", action="store_true")
    p.add_argument("--lm-order", type=int, default=5)
    p.add_argument("--seed-shards", type=int, default=3)
    p.add_argument("--max-perplexity", type=float, default=3000.0)
    p.add_argument("--soft-threshold", type=float, default=0.25)
    p.add_argument("--target-shard-mb", type=int, default=55)
    p.add_argument("--shards", type=int)
    p.add_argument("--shard-mb", type=int, default=300)
    p.add_argument("--base-tokenizer")
    p.add_argument("--donor-tokenizer")
    p.add_argument("--add-tokens", type=int, default=20_000)
    p.add_argument("--max-lines", type=int)
    p.add_argument("--flat", action="store_true")
    p.add_argument("--pattern", action="append")
    p.add_argument("--workers", type=int)
    p.add_argument("--log-file")
    args = p.parse_args(argv)
    upload.log_to(args.log_file)
    cfg = Config(
        input_dir=args.input, input_repo=args.input_repo, output_dir=args.output, output_repo=args.output_repo, token=args.token, cache_dir=args.cache_dir, resume=not args.no_resume,
        text_key=args.text_key, shard_filter=args.shard_filter, enable_near_dedup=args.near_dedup, enable_exact_dedup=not args.no_exact_dedup, lm_order=args.lm_order,
        seed_shards=args.seed_shards, max_perplexity=args.max_perplexity, soft_threshold=args.soft_threshold, target_shard_mb=args.target_shard_mb,
    ).resolved(Path.cwd())
    spark = SparkSession.builder.appName("sieveline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    manifest_at = cfg.output("manifest.json")
    manifest = Manifest.load(manifest_at, spark) if cfg.resume else Manifest(manifest_at)
    if args.phase == "upload":
        sink = sinks.resolve(cfg.output_dir, cfg.output_repo)
        _report(spark, cfg.output("reports/upload.json"), upload.upload(spark, cfg.output("kept"), sink, args.pattern or ("*.jsonl",), args.workers, manifest))
        return
    root = resolver.resolve(cfg.input_dir, cfg.input_repo, cfg.token, cfg.cache_dir).prepare()
    if args.phase in ("inspect", "all"):
        inspect(spark, cfg, root)
    if args.phase == "build-lm":
        build_lm(spark, cfg, root)
    if args.phase in ("filter", "all"):
        filter_all(spark, cfg, root)
    if args.phase == "incremental":
        incremental.run(spark, root, cfg, manifest=manifest).awaitTermination()
    if args.phase == "prepare":
        prepare_shards(spark, cfg, root, args.shards, args.shard_mb, not args.flat)
    if args.phase == "extend-tokenizer":
        extend_tokenizer(spark, cfg, root, args.base_tokenizer, args.donor_tokenizer, args.add_tokens, args.max_lines)


if __name__ == "__main__":
    main()
