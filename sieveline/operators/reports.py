"""Counters, histograms, percentiles and samples of a decided corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decision import label


def counters(decided: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines by outcome; malformed lines count as lines but not as rejected ones.

    Needs ``status`` (ok, missing_text or malformed), ``decision`` and the two
    duplicate flags.
    """
    n = lambda c, name: F.count(F.when(c, 1)).alias(name)
    ok = F.col("status") == "ok"
    sums = [
        F.count("*").alias("total_lines"), n(F.col("status") == "malformed", "malformed_json"), n(F.col("status") == "missing_text", "missing_text"),
        n(ok & (F.col("decision") == "keep"), "kept"), n(ok & (F.col("decision") == "reject"), "rejected"),
        n(ok & F.col("is_exact_dup"), "exact_duplicates"), n(ok & F.col("is_near_dup"), "near_duplicates"),
    ]
    return decided.groupBy(*by).agg(*sums) if by else decided.agg(*sums)


def with_ratios(totals: DataFrame) -> DataFrame:
    per = lambda c: F.floor(F.col(c) / F.greatest("total_lines", F.lit(1)) * 1e4 + 0.5) / 1e4
    return totals.select("*", per("kept").alias("keep_ratio"), per("rejected").alias("reject_ratio"))


def reason_histogram(decided: DataFrame, reasons: str = "reasons", by: Sequence[str] = ()) -> DataFrame:
    return decided.select(*by, F.explode(reasons).alias("r")).groupBy(*by, label(F.col("r")).alias("reason")).agg(F.count("*").alias("n"))


def language_histogram(decided: DataFrame, lang: Column) -> DataFrame:
    return decided.groupBy(lang.alias("lang")).agg(F.count("*").alias("n"))


def top(histogram: DataFrame, key: str, k: int = 20) -> DataFrame:
    return histogram.orderBy(F.desc("n"), key).limit(k)


def percentiles(df: DataFrame, value: Column, shares: Sequence[float]) -> DataFrame:
    """The value at index floor(n * share) of the sorted values, with least and greatest, as rows (name, value).

    Values are counted before they are ordered, and the running count is over
    distinct values grouped into ranges, so no task sorts the rows.
    """
    counts = df.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("c"))
    # ranges of the value's own order, by the leading bits of a double
    ranged = counts.withColumn("range", F.floor(F.signum("v") * F.log2(F.abs("v") + 1) * 64).cast("bigint"))
    before = ranged.groupBy("range").agg(F.sum("c").alias("rc"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = before.select("range", F.coalesce(F.sum("rc").over(upto), F.lit(0)).alias("before"), F.sum("rc").over(everything).alias("total"))  # some thousand ranges at most
    inside = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(before), "range").select("v", "c", "total", (F.col("before") + F.sum("c").over(inside)).alias("upto"))
    wanted = [(f"p{share * 100:g}", F.floor(F.col("total") * F.lit(share)).cast("bigint")) for share in shares]
    wanted = [("min", F.lit(0).cast("bigint")), *wanted, ("max", F.col("total") - 1)]
    hits = F.filter(F.array(*(F.struct(F.lit(k).alias("name"), i.alias("at")) for k, i in wanted)), lambda w: (w["at"] < F.col("upto")) & (w["at"] >= F.col("upto") - F.col("c")))
    return placed.select("v", F.explode(hits).alias("w")).select(F.col("w.name").alias("name"), F.col("v").alias("value"))


def bucket(key: Column, seed: str = "") -> Column:
    """0 to 9,999 by a hash of a key; the same in any engine that knows md5."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 15), 16, 10).cast("bigint") % 10_000).cast("bigint")


def bernoulli(df: DataFrame, key: Column, share: float, seed: str = "") -> DataFrame:
    """About a share of the rows, the same ones each time."""
    return df.where(bucket(key, seed) < round(share * 10_000))


def at_most(df: DataFrame, key: Column, k: int, by: Sequence[str] = (), seed: str = "") -> DataFrame:
    """The k rows of least hash, in all or of each group."""
    if not by:
        return df.withColumn("__h", bucket(key, seed)).orderBy("__h", key).limit(k).drop("__h")
    w = Window.partitionBy(*by).orderBy(bucket(key, seed), key)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k).drop("__n")


def audit(decided: DataFrame, kind: str, key: Column, k: int = 200) -> DataFrame:
    """accepted, rejected or borderline records to look at: up to k, with the first 1,000 characters."""
    pick = {"accepted": F.col("decision") == "keep", "rejected": F.col("decision") == "reject", "borderline": F.col("is_borderline")}[kind]
    share = {"accepted": 0.01, "rejected": 0.02, "borderline": 0.05}[kind]
    some = at_most(bernoulli(decided.where(pick), key, share, kind), key, k, seed=kind)
    return some.select(F.lit(kind).alias("audit_set"), F.substring("text", 1, 1000).alias("text"), "quality_score", "perplexity", "lang", "decision", "reasons")
