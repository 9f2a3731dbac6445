"""Extension of a BPE vocabulary by the tokens a corpus needs most."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.profiles import TURKISH, TURKISH_SUFFIXES

LETTERS = "A-Za-zÇĞİÖŞÜçğıöşü"


def record_text(raw: Column) -> Column:
    """The first of text, content and body that is a string and not empty; or the record, if it is a string."""
    variant = F.try_parse_json(raw)

    def field(path: str) -> Column:
        is_string = F.schema_of_variant(F.try_variant_get(variant, path, "variant")) == "STRING"
        return F.when(is_string, F.nullif(F.try_variant_get(variant, path, "string"), F.lit("")))

    return F.coalesce(field("$.text"), field("$.content"), field("$.body"), field("$"))


def word_frequency(texts: DataFrame, text: Column) -> DataFrame:
    """(word, frequency): each word counts as it stands and in lower case, so a lower-case word counts twice."""
    word = F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("w")
    return texts.select(word).groupBy("w").agg(F.count("*").alias("n")).select(F.explode(F.array("w", F.lower("w"))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("frequency"))


def plain(token: Column) -> Column:
    return F.regexp_replace(token, "^▁", "")


def is_relevant(token: Column) -> Column:
    own = plain(token)
    return (F.length(own) >= 3) & token.rlike(f"^▁?[{LETTERS}]+$") & (own.rlike(f"[{TURKISH.special_chars}]") | F.lower(own).isin(*TURKISH_SUFFIXES))


def candidates(donor: DataFrame, base: DataFrame, frequency: DataFrame) -> DataFrame:
    """Donor tokens (token, id) that the base vocabulary lacks, ranked by score."""
    own = donor.join(base.select("token"), "token", "left_anti").where(is_relevant(F.col("token"))).withColumn("plain", plain(F.col("token")))
    f = frequency.select("word", F.col("frequency").alias("f"))
    own = own.join(f.toDF("plain", "f1"), "plain", "left").withColumn("low", F.lower("plain")).join(f.toDF("low", "f2"), "low", "left")
    count = F.coalesce("f1", F.lit(0)) + F.coalesce("f2", F.lit(0))
    when = lambda c, x: F.when(c, x).otherwise(0)
    score = (
        count * 100 + when(F.col("low").isin(*TURKISH_SUFFIXES), 2000) + when(F.col("token").startswith("▁"), 150)
        + F.greatest(F.lit(0), 5000 - F.col("id")) / 10 + when(F.col("plain").rlike(f"[{TURKISH.special_chars}]"), 200)
    )
    return own.select("token", "plain", F.col("id").alias("donor_id"), count.cast("bigint").alias("frequency"), score.cast("double").alias("score"))


def parents(merges: DataFrame) -> DataFrame:
    """(token, left, right, index): the last merge that makes each token."""
    return merges.groupBy(F.concat("left", "right").alias("token")).agg(F.max_by(F.struct("left", "right", "index"), "index").alias("m")).select("token", "m.*")


def _closure(token: str, known: set[str], made_by: dict[str, tuple[str, str, int]]) -> list[str] | None:
    """Tokens to add before and with a token, parts first; None where one cannot be made."""
    done: dict[str, None] = {}
    stack: list[tuple[str, bool]] = [(token, False)]
    open_: set[str] = set()
    while stack:
        t, ready = stack.pop()
        if ready:
            open_.discard(t)
            done[t] = None
            continue
        if t in known or t in done:
            continue
        if t in open_ or t not in made_by:
            return None
        open_.add(t)
        left, right, _ = made_by[t]
        stack += [(t, True), (right, False), (left, False)]
    return list(done)


def select(ranked: Iterable[tuple[str, int]], base_vocab: set[str], base_merges: set[tuple[str, str]], merges: list[tuple[str, str]], limit: int) -> dict[str, list]:
    """Greedy choice of the best candidates that fit, each with all its parts.

    A choice depends on those before it, so this is a fold on the driver; its
    input is two vocabularies, whose size the tokenizers fix.
    """
    made_by = {a + b: (a, b, i) for i, (a, b) in enumerate(merges)}
    known, have = set(base_vocab), set(base_merges)
    out: dict[str, list] = {"tokens": [], "merges": [], "rejected": []}
    for token, _ in ranked:
        if len(out["tokens"]) >= limit:
            break
        need = _closure(token, known, made_by)
        if need is None:
            out["rejected"].append(token)
            continue
        if not need or len(out["tokens"]) + len(need) > limit:
            continue
        for a, b, i in sorted((made_by[t] for t in need), key=lambda m: m[2]):
            if (a, b) not in have:
                have.add((a, b))
                out["merges"].append((a, b, i))
        known.update(need)
        out["tokens"] += need
    return out


def assigned(base: DataFrame, tokens: DataFrame, order: str = "place") -> DataFrame:
    """(token, id) of the extended vocabulary: new tokens follow the base's greatest id in their order."""
    top = base.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]
    w = Window.partitionBy(F.lit(0)).orderBy(order)  # as many rows as tokens are added
    new = tokens.select("token", (F.lit(top) + F.row_number().over(w)).cast("bigint").alias("id"))
    return base.select("token", F.col("id").cast("bigint").alias("id")).unionByName(new)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(token, id) and (left, right, index) of a tokenizer file; merges are pairs or "left right"."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    merges = [(*(m.split(" ", 1) if isinstance(m, str) else m), i) for i, m in enumerate(model["merges"])]
    return spark.createDataFrame(list(model["vocab"].items()), "token string, id bigint"), spark.createDataFrame(merges, "left string, right string, index bigint")


def write(base_path: str, out_dir: str, chosen: dict[str, list], report: dict | None = None) -> dict:
    """The base tokenizer with the chosen tokens and merges, and a report beside it."""
    whole = json.loads(Path(base_path).read_text(encoding="utf-8"))
    vocab = whole["model"]["vocab"]
    start = max(vocab.values(), default=-1) + 1
    before = len(vocab), len(whole["model"]["merges"])
    vocab.update({t: start + i for i, t in enumerate(chosen["tokens"])})
    whole["model"]["merges"] += [[a, b] for a, b, _ in chosen["merges"]]
    out = Path(out_dir)
    out.mkdir(parents=True, exist_ok=True)
    (out / "tokenizer.json").write_text(json.dumps(whole, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    summary = {
        "base_vocab_size": before[0], "base_merges_size": before[1], "new_vocab_size": len(vocab), "new_merges_size": len(whole["model"]["merges"]),
        "added_token_count": len(chosen["tokens"]), "added_merge_count": len(chosen["merges"]),
        "selected_tokens_preview": chosen["tokens"][:200], "selected_merges_preview": chosen["merges"][:200], "rejected_preview": chosen["rejected"][:200],
    } | (report or {})
    (out / "extension_report.json").write_text(json.dumps(summary, ensure_ascii=False, indent=2), encoding="utf-8")
    return summary
