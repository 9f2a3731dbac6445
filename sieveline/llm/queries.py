"""The queries of the training-data operators, over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import blocks, confusables, decoding, language, leakage, mixing, repetition, similarity, spans, statistics
from .oracles import oracle_sql

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.near_duplicates(_table(spark, sf, "documents"))


def p1_groups(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.grouped(_table(spark, sf, "documents"))


def _fixed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(_table(spark, sf, t) for t in ("documents", "common_words", "lang_samples"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.mislabelled(language.documents(*_fixed(spark, sf)))


def p2_documents(spark: SparkSession, sf: str) -> DataFrame:
    return language.documents(*_fixed(spark, sf)).select("doc_id", "label", "lang", "confidence")


def p2_passages(spark: SparkSession, sf: str) -> DataFrame:
    return language.passages(*_fixed(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.furniture(*_fixed(spark, sf)).select("doc_id", "line_no")


def p3_content(spark: SparkSession, sf: str) -> DataFrame:
    return blocks.main_content(*_fixed(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.rejected(repetition.ledger(_table(spark, sf, "documents")), "five_word_runs", 1).select("doc_id")


def p4_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.ledger(_table(spark, sf, "documents"))


def p4_ablation(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.ablation(repetition.ledger(_table(spark, sf, "documents")))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_lines(spark, sf).select("doc_id", "line_no")


def p5_lines(spark: SparkSession, sf: str) -> DataFrame:
    return decoding.damaged_lines(_table(spark, sf, "documents"), _table(spark, sf, "lang_samples"))


def p5_restored(spark: SparkSession, sf: str) -> DataFrame:
    return decoding.restored(_table(spark, sf, "documents"), _table(spark, sf, "lang_samples"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_statistics(spark, sf).where("kind <> 'prose'").select("doc_id", "kind")


def p6_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.statistics(*_fixed(spark, sf))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.lookalikes(_table(spark, sf, "documents"))


def p7_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.normalized(_table(spark, sf, "documents"))


def p7_groups(spark: SparkSession, sf: str) -> DataFrame:
    return confusables.groups(_table(spark, sf, "documents"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return p8_passages(spark, sf).select("doc_id", "item_id")


def p8_passages(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.matches(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(p8_passages(spark, sf), _table(spark, sf, "benchmark"))


def p8_clean(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.without_leaks(_table(spark, sf, "documents"), p8_passages(spark, sf))


def p9_selection(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.selection(_table(spark, sf, "documents"), _table(spark, sf, "mix_targets"))


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(p9_selection(spark, sf), _table(spark, sf, "mix_targets"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.shared_spans(_table(spark, sf, "documents"))


def p10_shares(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return spans.shares(docs, spans.shared_spans(docs))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit()}


__all__ = ["oracle_sql", "queries"]
