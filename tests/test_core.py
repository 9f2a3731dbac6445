"""The curation engine: unit rows at each boundary, properties, and files end to end."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from sieveline.config import Config
from sieveline.functions import text as tx
from sieveline.functions.profiles import TURKISH
from sieveline.operators import decision, dedup, heuristics, inspection, language, lm, prepare, reports, sharding, tokenizer
from sieveline.plans.pipeline import decide, featured
from sieveline.sources import files, resolver, sinks, upload, writers
from sieveline.streaming import incremental
from sieveline.streaming.manifest import Manifest

CFG = Config()


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a\x00b\x85c\x9fd", "abcd"), ("a​b‍c﻿d", "abcd"), ("a b　c d", "a b c d"), ("a\n\n\nb", "a\n\n\nb"), ("a\n\n\n\n\nb", "a\n\n\nb"),
        ("a   b", "a   b"), ("a    b", "a b"), ("  \n a \t", "a"), ("", ""), ("\t\n\r", ""), (" a ", "a"), (None, None),
    ],
)
def test_normalize(spark, text, want):
    assert one(spark, text, tx.normalize) == want
    if want is not None:
        assert one(spark, want, tx.normalize) == want


def python_features(t):
    import re
    from collections import Counter

    n, w = len(t), t.split()
    if not t:
        return {k: 0 for k in tx.FEATURES}
    low = [x.lower() for x in w]
    lines = [x.strip() for x in t.split("\n") if x.strip()]
    half = lambda x, d: int(x * 10**d + 0.5) / 10**d
    return {
        "char_count": n, "word_count": len(w), "line_count": len(t.split("\n")), "sentence_count": len(re.findall(r"[.!?…]\s", t)) + 1,
        "url_count": len(re.findall(r"https?://\S+", t)), "email_count": len(re.findall(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", t)), "html_tag_count": len(re.findall(r"<[a-zA-Z/][^>]*>", t)),
        "boilerplate_hits": sum(bool(re.search(p, t, re.I)) for p in TURKISH.boilerplate),
        "alpha_ratio": half(sum(map(str.isalpha, t)) / n, 4), "digit_ratio": half(sum(map(str.isdigit, t)) / n, 4), "punctuation_ratio": half(sum(not c.isalnum() and not c.isspace() for c in t) / n, 4),
        "whitespace_ratio": half(sum(map(str.isspace, t)) / n, 4), "turkish_char_ratio": half(sum(c in TURKISH.special_chars for c in t) / n, 4),
        "unique_token_ratio": half(len(set(low)) / max(1, len(w)), 4), "repeated_word_frac": half(max(Counter(low).values(), default=0) / max(1, len(w)), 4),
        "repeated_line_ratio": half(1 - len(set(lines)) / len(lines), 4) if lines else 0, "avg_word_length": half(sum(map(len, w)) / max(1, len(w)), 2),
        "stopword_coverage": half(sum(x in TURKISH.stopwords for x in low) / max(1, len(w)), 4),
    }


def test_features_equal_python(spark):
    texts = [
        "", "Tek", "Bu bir deneme. Ve bu da başka! Öyle mi? evet", "İstanbul ISPARTA ığdır\n\nsatır\nsatır\n satır ", "a@b.co http://x.y/z?q=1 <div class='a'>\n<br/> 12 ³ ½ Ⅷ ①",
        "ÇEREZ POLİTİKASI ve KULLANIM KOŞULLARI; Tüm Hakları Saklıdır. Click here", "é emoji 😀😀 😀", "…\n…\n…", "kelime " * 30,
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tx.features(F.col("t")).alias("f")).orderBy("i").collect()
    for r in rows:
        want = python_features(texts[r["i"]])
        assert {k: pytest.approx(v) for k, v in want.items()} == r["f"].asDict(), texts[r["i"]]


BASE = dict(char_count=500, word_count=80, line_count=5, sentence_count=6, url_count=0, email_count=0, html_tag_count=0, boilerplate_hits=0, alpha_ratio=0.8, digit_ratio=0.0, punctuation_ratio=0.02, whitespace_ratio=0.15, turkish_char_ratio=0.1, unique_token_ratio=0.7, repeated_word_frac=0.05, repeated_line_ratio=0.0, avg_word_length=6.0, stopword_coverage=0.2)
FIELDS = ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'double'}" for k, v in BASE.items())


@pytest.mark.parametrize(
    ("change", "on", "past"),
    [
        ("char_count", 50, 49), ("word_count", 5, 4), ("char_count", 500_000, 500_001), ("alpha_ratio", 0.40, 0.3999), ("digit_ratio", 0.50, 0.5001), ("punctuation_ratio", 0.40, 0.4001), ("url_count", 20, 21), ("email_count", 10, 11),
        ("html_tag_count", 10, 11), ("repeated_line_ratio", 0.70, 0.7001), ("repeated_word_frac", 0.50, 0.5001), ("unique_token_ratio", 0.10, 0.0999), ("avg_word_length", 45.0, 45.01), ("avg_word_length", 1.5, 1.49), ("boilerplate_hits", 5, 6),
    ],
)
def test_rules_at_their_limits(spark, change, on, past):
    names = [c for c in BASE]
    rows = [tuple((BASE | {change: v})[k] for k in names) for v in (on, past)]
    df = spark.createDataFrame(rows, FIELDS).select(F.struct(*names).alias("f"))
    got = [r[0] for r in df.select(heuristics.reasons(F.lit("metin"), F.col("f"), CFG)).collect()]
    assert got[0] == [] and len(got[1]) == 1


def test_a_blank_text_fails_alone(spark):
    df = spark.createDataFrame([("",), (" \n",), (None,)], "text string")
    assert [r[0] for r in featured(df, CFG).select("heuristic_reasons").collect()] == [["empty_text"]] * 3


@pytest.mark.parametrize(
    ("top", "letters", "stop", "want"),
    [
        ([("tr", 0.5)], 0.0, 0.0, "accept"), ([("en", 0.6), ("tr", 0.3)], 0.015, 0.0, "accept"), ([("en", 0.6), ("tr", 0.1)], 0.015, 0.005, "accept"), ([("en", 0.7)], 0.0, 0.0, "reject"),
        ([("en", 0.9)], 0.02, 0.0, "borderline"), ([("en", 0.5)], 0.0, 0.0, "reject"), ([("tr", 0.2)], 0.0, 0.0, "borderline"), ([], 0.0, 0.0, "reject"), ([], 0.02, 0.02, "borderline"), ([("en", 0.5), ("de", 0.2), ("tr", 0.4)], 0.02, 0.0, "borderline"),
    ],
)
def test_language_decision(spark, top, letters, stop, want):
    df = spark.createDataFrame([(top, letters, stop)], f"p {language.PREDICTION}, turkish_char_ratio double, stopword_coverage double")
    info = language.info(F.col("p"), F.struct("turkish_char_ratio", "stopword_coverage"), "t")
    assert df.select(language.decision(info, CFG)).first()[0] == want


def test_function_words_vote(spark):
    lists = {"tr": ["bir", "ve"], "en": ["the", "and"]}
    got = one(spark, "The dog and the cat ve", lambda c: language.by_function_words(c, lists))
    assert [(p["lang"], p["score"]) for p in got] == [("en", 0.6), ("tr", 0.2)] and one(spark, "xyz", lambda c: language.by_function_words(c, lists)) == []


def test_function_words_split_a_text_once(spark):
    said = language.by_function_words(F.col("text"), language.default_lists(TURKISH))
    assert str(language.info(said, F.col("features"), "function_words")).count(f", {language.WINDOW})") == 1


@pytest.mark.parametrize(
    ("ppl", "n", "oov", "want"),
    [(-1.0, 50, 0.0, None), (None, 50, 0.0, None), (3000.0, 50, 0.0, None), (3000.01, 50, 0.0, "high_kenlm_perplexity"), (4500.0, 29, 0.0, None), (4501.0, 29, 0.0, "high_kenlm_perplexity"), (1600.0, 50, 0.51, "high_oov_and_perplexity"), (1500.0, 50, 0.51, None)],
)
def test_lm_verdict(spark, ppl, n, oov, want):
    df = spark.createDataFrame([(ppl, n, oov)], "p double, n int, o double")
    assert df.select(lm.verdict(F.col("p"), F.col("n"), F.col("o"), CFG)).first()[0] == want


def test_quality_score(spark):
    f = F.struct(F.lit(0.7).alias("alpha_ratio"), F.lit(0.5).alias("unique_token_ratio"), F.lit(0.05).alias("stopword_coverage"), F.lit(0.05).alias("turkish_char_ratio"))
    lang = lambda d, c: F.struct(F.lit(d).alias("detected_lang"), F.lit(c).alias("confidence"))
    s = lambda d, c, p: spark.range(1).select(decision.quality_score(f, lang(d, c), F.lit(p).cast("double"), CFG)).first()[0]
    assert s("tr", 0.9, None) == pytest.approx(0.8) and s("tr", 0.5, 1500.0) == pytest.approx(0.2 + 0.21 + 0.3)
    assert s("en", 1.0, 6000.0) == pytest.approx(0.3) and s("unknown", 0.0, 0.0) == pytest.approx(0.2 + 0.15 + 0.3)


def test_decision_layers(spark):
    arr = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    d = lambda h, lang, e, n, r, s: spark.range(1).select(*decision.decided(h, F.lit(lang), F.lit(e), F.lit(n), F.lit(r).cast("string"), F.lit(s), CFG)).first()
    assert list(d(arr("too_short"), "reject", True, True, "high_kenlm_perplexity", 0.1)) == ["reject", ["too_short", "non_turkish", "exact_duplicate", "near_duplicate"], False]
    assert list(d(arr(), "accept", False, False, "high_kenlm_perplexity", 0.2)) == ["reject", ["high_kenlm_perplexity"], True]
    assert list(d(arr(), "accept", False, False, None, 0.2)) == ["reject", ["low_quality_score_0.200"], True]
    assert list(d(arr(), "borderline", False, False, None, 0.25)) == ["keep", [], True]
    assert spark.range(1).select(decision.label(F.lit("low_quality_score_0.123"))).first()[0] == "low_quality_score"


def test_exact_dedup_keeps_the_first(spark):
    rows = [(0, "Hello World"), (1, "Hello World"), (2, "Hello Mars"), (3, "  hello world  "), (4, None), (5, None)]
    df = dedup.mark_exact(spark.createDataFrame(rows, "i int, text string"), F.col("text"), ["i"])
    assert [r["is_exact_dup"] for r in df.orderBy("i").collect()] == [False, True, False, True, False, False]
    s = dedup.exact_stats(df, F.col("text")).first()
    assert (s["total_checked"], s["unique_count"], s["duplicate_count"]) == (4, 2, 2)


def test_a_rejected_original_still_counts(spark):
    df = spark.createDataFrame([("s", 0, "kısa"), ("s", 1, "KISA"), ("s", 2, "kısa")], "_shard string, _line_num bigint, text string")
    got = [r["is_exact_dup"] for r in decide(df, CFG).orderBy("_line_num").collect()]
    assert got == [False, False, True]


def test_near_dedup_is_greedy(spark):
    base = "Bu uzun metin sınamak için yazıldı ve içinde pek çok ayrı sözcük vardır; hiçbiri ötekine benzemez, hepsi kendi başına durur. "
    texts = [base * 2, base * 2 + "son", "tamamen farklı bir içerik olan başka bir metin burada başlar ve burada biter gider", "kısa", "kısa"]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, text string")
    cfg = Config(bands=20, rows=5)
    got = [r["is_near_dup"] for r in dedup.mark_near(df, "text", "i", cfg).orderBy("i").collect()]
    assert got == [False, True, False, False, True]


def test_near_dedup_equals_sequential_lsh(spark):
    import random

    rng = random.Random(4)
    vocabulary = ["ev", "yol", "deniz", "kitap", "araba", "çiçek", "kapı"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, text string")
    cfg = Config(bands=25, rows=2)
    keys = {}
    for r in dedup.band_keys(df, ["i"], "text", cfg).collect():
        keys.setdefault(r["i"], set()).add((r["band"], r["bucket"]))
    seen, want = set(), []
    for i in range(len(texts)):
        dup = bool(keys[i] & seen)
        want.append(dup)
        if not dup:
            seen |= keys[i]
    assert [r["is_near_dup"] for r in dedup.mark_near(df, "text", "i", cfg).orderBy("i").collect()] == want and any(want)


def test_shingles(spark):
    assert one(spark, "abc", dedup.shingles) == ["abc"] and sorted(one(spark, " ABCDEFabcde", dedup.shingles))[:2] == ["abcde", "bcdef"]


def test_lm_window_and_short_texts(spark):
    long = [f"w{i}" for i in range(600)]
    got = one(spark, " ".join(long), lambda c: lm.window(lm.tokens(c), CFG))
    assert got == long[:166] + long[217:383] + long[-166:]
    assert len(one(spark, " ".join(long[:500]), lambda c: lm.window(lm.tokens(c), CFG))) == 500


def test_lm_probabilities_sum_to_one_and_scores(spark):
    corpus = spark.createDataFrame([(s.split(),) for s in ("a b c d e f g h i j", "a b c d x y z h i j", "a b q d e f g h i j", "b c d e f g a h i j") * 3], "sentence array<string>")
    cfg = Config(lm_order=3, min_lm_tokens=3)
    model = lm.train(corpus, cfg)
    unigrams = {r["gram"]: 10 ** r["logp"] for r in model.grams.where("n = 1").collect()}
    assert sum(unigrams.values()) == pytest.approx(1.0)
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "j i h q z x y a b d"), (3, "foo bar baz qux"), (4, "a b"), (5, None), (6, "<unk> a </s> <s> b c"), (7, "a b c " * 300)], "id bigint, text string")
    got = {r["id"]: r for r in lm.score(df, model, "text", "id", cfg).collect()}
    joined = {r["id"]: r for r in lm.score(df, model, "text", "id", cfg, carried=0).collect()}
    for i, r in got.items():
        assert {k: pytest.approx(v) if isinstance(v, float) else v for k, v in r.asDict().items()} == joined[i].asDict(), i
    assert got[1]["perplexity"] < got[2]["perplexity"] < got[3]["perplexity"]
    assert got[3]["oov_ratio"] == 0.8 or got[3]["oov_ratio"] == 1.0
    assert got[4]["perplexity"] == -1 and got[5]["perplexity"] == -1 and got[4]["num_tokens"] == 2


def test_lm_seed_is_cut_into_sentences_by_several_tasks(spark):
    rows = spark.createDataFrame([(i, f"one two three {i}. four five six.") for i in range(50)], "id bigint, text string")
    got = lm.seed_corpus(rows, "text", ["id"], F.lit(True), Config(seed_records=40))
    assert got.rdd.getNumPartitions() > 1 and got.count() == 80


def test_lm_scores_from_several_files(spark, monkeypatch):
    corpus = spark.createDataFrame([(s.split(),) for s in ("a b c d e f g h", "a b c d x y z h", "b c d e f g a") * 3], "sentence array<string>")
    cfg = Config(lm_order=3, min_lm_tokens=3)
    model = lm.train(corpus, cfg)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "h z q a b d"), (3, ""), (4, "a b c " * 300)], "id bigint, text string")
    whole = sorted(lm.score(df, model, "text", "id", cfg).collect())
    monkeypatch.setattr(lm, "PART", 4)
    words = lm.Model(model.order, model.grams, model.backoffs, model.vocabulary)  # as a stored model is read
    assert sorted(lm.score(df, model, "text", "id", cfg).collect()) == whole
    assert sorted(lm.score(df, words, "text", "id", cfg).collect()) == whole
    assert all(len(x) > 1 for x in lm._files(model))


def test_a_decision_scores_texts_once(spark):
    cfg = Config(lm_order=2, min_lm_tokens=3, enable_near_dedup=True)
    model = lm.train(spark.createDataFrame([("a b c d e f".split(),)], "sentence array<string>"), cfg)
    rows = spark.createDataFrame([(i, f"a b c {i} d e f") for i in range(4)], "doc_id bigint, text string")
    got = decide(rows, cfg, None, model, order=("doc_id",), row_id="doc_id")
    assert "MapInArrow" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.where("perplexity > 0").count() == 4


def test_percentiles_pick_by_index(spark):
    values = [5.0, 1.0, 1.0, 9.0, 3.0, -2.0, 700.0, 3.5, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["name"]: r["value"] for r in reports.percentiles(df, F.col("v"), (0.1, 0.5, 0.99)).collect()}
    s = sorted(values)
    assert got == {"min": s[0], "p10": s[int(len(s) * 0.1)], "p50": s[int(len(s) * 0.5)], "p99": s[int(len(s) * 0.99)], "max": s[-1]}


def test_eos_is_idempotent(spark):
    for t in ("metin", "metin  \n", "metin <|endoftext|>", "metin<|endoftext|>  "):
        marked = one(spark, t, prepare.ensure_eos)
        assert marked.count(prepare.EOS) == 1 and marked.endswith(prepare.EOS) and one(spark, marked, prepare.ensure_eos) == marked


def test_shard_ids(spark):
    import hashlib

    assert one(spark, "metin", lambda c: prepare.shard_id(c, 7)) == int(hashlib.md5("42\nmetin".encode()).hexdigest()[:15], 16) % 7
    assert one(spark, "metin", lambda c: prepare.shard_id_blake(c, 7)) == int.from_bytes(hashlib.blake2b("42\nmetin".encode(), digest_size=8).digest(), "big") % 7


def test_rolled_shards(spark):
    sizes = [400, 600, 100, 1024, 5000, 10, 1014, 1]
    df = spark.createDataFrame(list(enumerate(sizes)), "i bigint, n bigint")
    got = [r["shard_index"] for r in sharding.rolled(df, "i", F.col("n"), 1024).orderBy("i").collect()]
    assert got == _roll(sizes, 1024)
    flat = sharding.balanced(df, ["i"], F.col("n"), 1024).groupBy("shard_index").agg(F.sum("n").alias("s"), F.max("n").alias("m")).collect()
    assert all(r["s"] <= 1024 + r["m"] for r in flat)


def _roll(sizes, target):
    out, index, filled = [], 0, 0
    for n in sizes:
        if filled and filled + n > target:
            index, filled = index + 1, 0
        filled += n
        out.append(index)
    return out


def test_source_types(tmp_path):
    assert [resolver.source_type(s) for s in ("owner/name", "my-org/data.v2", "https://huggingface.co/datasets/a/b", "https://github.com/a/b", "http://github.com/a/b.git", str(tmp_path), ".", "github.com/a/b", "missing", "./no/such", "own.er/name")] == ["huggingface"] * 3 + ["github"] * 2 + ["local"] * 5 + ["huggingface"]
    assert resolver.resolve(str(tmp_path)).prepare() == str(tmp_path)
    with pytest.raises(FileNotFoundError):
        resolver.resolve(str(tmp_path / "none")).prepare()
    with pytest.raises(ValueError):
        resolver.resolve()
    assert resolver.resolve(input_repo="a/b").prepare({"huggingface": lambda s: "/x/" + s.where}) == "/x/a/b"


def test_sinks_mark_only_what_succeeded():
    def fails(path):
        raise OSError("offline")

    s = sinks.resolve(output_repo="a/b", upload=fails)
    assert not s.write_shard("x") and s.stats()["failed"] == 1 and sinks.resolve("out").write_shard("y")


def test_manifest_round_trip(tmp_path):
    m = Manifest.load(str(tmp_path / "m.json"))
    m.mark("processed_files", "b")
    m.mark("processed_files", "a")
    m.mark("produced_shards", "s")
    m.record_error("c", "broken")
    m.save()
    assert Manifest.load(m.path).counts() == {"processed_files": 2, "produced_shards": 1, "uploaded_shards": 0, "errors": 1}
    (tmp_path / "m.json").write_text("{")
    assert Manifest.load(m.path).counts()["errors"] == 0


@pytest.fixture
def corpus(tmp_path, spark):
    root = tmp_path / "in"
    (root / "sub" / "deep").mkdir(parents=True)
    lines = ['{"text": "Bir", "n": null}', "", "   ", "{bad", "[1, 2]", '{"text": 5}', '{"other": 1}', '{"text": null}', '{"text": "Son", "a": {"b": [1]}}']
    (root / "data.JSONL").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (root / "sub" / "data.json").write_text('{"text": "ikinci"}\n', encoding="utf-8")
    with gzip.open(root / "sub" / "deep" / "c.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write('{"text": "üçüncü"}\n{"text": "BIR"}\n')
    (root / "ignore.txt").write_text("x")
    spark.createDataFrame([("parke", "s"), (None, "t")], "text string, source string").coalesce(1).write.parquet(str(root / "p"))
    return root


def test_scan(spark, corpus):
    found = {r["name"] for r in files.discover(spark, str(corpus)).collect()}
    assert {n for n in found if not n.startswith("part")} == {"data.JSONL", "data.json", "c.jsonl.gz"} and len(found) == 4
    assert files.discover(spark, str(corpus / "none")).count() == 0
    rows = files.read_json(spark, str(corpus)).where("_shard = 'data.JSONL'").orderBy("_line_num").collect()
    assert [(r["_line_num"], r["status"], r["text"]) for r in rows] == [(0, "ok", "Bir"), (1, "malformed", None), (2, "malformed", None), (3, "ok", "5"), (4, "missing_text", None), (5, "missing_text", None), (6, "ok", "Son")]
    everything = files.read_all(spark, str(corpus))
    assert everything.count() == 7 + 1 + 2 + 2 and everything.where("text = 'parke'").count() == 1
    assert {r[0] for r in files.read_all(spark, str(corpus), shard_filter="data.json,c.jsonl.gz").select("_shard").distinct().collect()} == {"data.json", "c.jsonl.gz"}


def test_kept_json_keeps_other_keys(spark):
    df = spark.createDataFrame([('{"text": "A  ", "n": null, "k": {"b": [1, "ç"]}, "q\\"": 1.5}', "A"), ('{"text":"B","z":true}', "B")], "raw string, text string")
    got = [json.loads(r[0]) for r in df.select(sinks.kept_json(F.col("raw"), F.col("text"))).collect()]
    assert got == [{"text": "A", "n": None, "k": {"b": [1, "ç"]}, 'q"': 1.5}, {"text": "B", "z": True}] and list(got[0]) == ["text", "n", "k", 'q"']


def test_inspection(spark, corpus):
    rows = files.read_json(spark, str(corpus))
    s = inspection.summary(inspection.leading(rows, "_file", ["_line_num"]), F.col("text"), "_file").first()
    assert s["n_records"] == 10 and s["n_files"] == 3 and s["min_length"] == 0
    keys = {r["key"]: r["n"] for r in inspection.key_frequencies(rows, F.col("raw")).collect()}
    assert keys == {"text": 7, "n": 1, "other": 1, "a": 1}


def test_prepare_counters(spark, corpus):
    lines = spark.read.text(str(corpus / "data.JSONL")).withColumnRenamed("value", "raw")
    got = prepare.counters(lines).first().asDict()
    assert got == {"total": 9, "skipped": 2, "invalid_json": 2, "missing_text": 2, "non_string": 1, "written": 3, "eos_added": 3}


def test_command_line(spark, corpus, tmp_path):
    from sieveline import cli

    cfg = Config(output_dir=str(tmp_path / "out"), lm_order=2, min_lm_tokens=2)
    cli.inspect(spark, cfg, str(corpus))
    cli.build_lm(spark, cfg, str(corpus))
    report = cli.filter_all(spark, cfg, str(corpus))
    assert report["total_lines"] == 12 and report["malformed_json"] == 2 and report["missing_text"] == 3 and report["kept"] + report["rejected"] == 7
    assert len(list((tmp_path / "out" / "kept").glob("shard-*.jsonl"))) == len(Manifest.load(cfg.output("manifest.json")).produced_shards) and (tmp_path / "out" / "reports" / "summary.json").exists() and spark.read.json(str(tmp_path / "out" / "rejected")).count() == report["rejected"] + 2


def test_filter_builds_a_missing_model(spark, tmp_path):
    from sieveline import cli

    root = tmp_path / "in"
    root.mkdir()
    rows = [f"Bu köyde {w} bir gün geçti ve herkes bahçede oturdu, sonra yağmur başladı ama kimse gitmek istemedi." for w in ("güzel", "uzun", "sıcak", "soğuk")]
    rows += [rows[0] + "  ", "The village was very old and everyone sat in the garden, then the rain started but nobody wanted to leave."]
    (root / "a.jsonl").write_text("\n".join(json.dumps({"text": t, "n": i}) for i, t in enumerate(rows)) + "\n", encoding="utf-8")
    cfg = Config(output_dir=str(tmp_path / "out"), lm_order=2, min_lm_tokens=2)
    report = cli.filter_all(spark, cfg, str(root))
    assert cli.load_lm(spark, cfg) is not None and report["kept"] == 4 and report["exact_dedup"]["duplicate_count"] == 1
    seed = " ".join((tmp_path / "out" / "lm" / "seed_corpus" / p.name).read_text() for p in (tmp_path / "out" / "lm" / "seed_corpus").glob("part*"))
    assert "village" not in seed and "bahçede" in seed
    kept = [json.loads(x) for x in (tmp_path / "out" / "kept" / "shard-00000.jsonl").read_text().splitlines()]
    assert [r["n"] for r in kept] == [0, 1, 2, 3]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("El alcalde dijo que la calle de la ciudad no se va a cerrar y que los vecinos de los barrios no tienen nada que temer.", "es"), ("The mayor said that the main street of the town is not to be closed and that they have to wait.", "en"),
        ("Der Mann sagte, dass die Straße nicht für den Verkehr ist und dass sich das auch mit dem Bau von einer Halle nicht ändert.", "de"), ("Bu köyde bir gün daha geçti ve herkes çok uzun bir süre bahçede oturdu, ama sonra her şey değişti.", "tr"),
    ],
)
def test_default_language(spark, text, want):
    r = decide(spark.createDataFrame([(text, "s", 0)], "text string, _shard string, _line_num bigint"), CFG).first()
    assert r["lang"]["detected_lang"] == want and (r["lang_decision"] == "accept") == (want == "tr")


def test_prepare_command(spark, corpus, tmp_path):
    from sieveline import cli

    cfg = Config(output_dir=str(tmp_path / "out"))
    report = cli.prepare_shards(spark, cfg, str(corpus), n=6)
    shards = sorted(p.name for p in (tmp_path / "out" / "prepared").glob("shard-*.jsonl"))
    assert shards == [f"shard-{k:05d}.jsonl" for k in range(6)] and report["written"] == 6
    texts = [json.loads(x)["text"] for s in shards for x in (tmp_path / "out" / "prepared" / s).read_text().splitlines()]
    assert sorted(texts) == sorted(t + " " + prepare.EOS for t in ("Bir", "5", "Son", "ikinci", "üçüncü", "BIR"))
    assert cli.prepare_shards(spark, Config(output_dir=str(tmp_path / "flat")), str(corpus), n=2, recursive=False)["written"] == 3


def test_extend_tokenizer_command(spark, tmp_path):
    from sieveline import cli

    model = lambda vocab, merges: json.dumps({"model": {"vocab": {t: i for i, t in enumerate(vocab)}, "merges": merges}}, ensure_ascii=False)
    (tmp_path / "base.json").write_text(model(["a", "ğ", "aç"], ["a ç"]), encoding="utf-8")
    (tmp_path / "donor.json").write_text(model(["a", "ğ", "aç", "ağ", "ağa", "ağaç"], ["a ğ", "ağ a", "ağ aç"]), encoding="utf-8")
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.jsonl").write_text('{"text": "ağaç ağaç"}\n{"text": "ağa"}\n', encoding="utf-8")
    cfg = Config(output_dir=str(tmp_path / "out"))
    got = cli.extend_tokenizer(spark, cfg, str(root), str(tmp_path / "base.json"), str(tmp_path / "donor.json"), 2)
    assert got["selected_tokens_preview"] == ["ağ", "ağaç"] and got["selected_merges_preview"] == [("a", "ğ", 0), ("ağ", "aç", 2)]
    whole = json.loads((tmp_path / "out" / "tokenizer" / "tokenizer.json").read_text(encoding="utf-8"))
    assert whole["model"]["vocab"]["ağaç"] == 4 and len(whole["model"]["merges"]) == 3


def test_oversized_shards_are_split_into_files(spark, tmp_path):
    df = spark.createDataFrame([(f"satır {i}", 0 if i < 90 else 2) for i in range(100)], "line string, shard int")
    done = writers.write_hash_shards(df, "line", "shard", 3, str(tmp_path / "s"), 300)
    names = [d.rsplit("/", 1)[1] for d in done]
    assert "shard-00001.jsonl" in names and "shard-00002.jsonl" in names and sum(n.startswith("shard-00000-") for n in names) >= 2
    assert sum(len((tmp_path / "s" / n).read_text().splitlines()) for n in names) == 100


def test_rolled_shards_are_written_in_order(spark, tmp_path):
    df = spark.createDataFrame([(i, "Bu cümle bir kayıttır. " * 3) for i in range(50)], "id bigint, text string")
    seen = []
    rolled = sharding.rolled(df, "id", prepare.line_bytes(F.to_json(F.struct("id", "text"))), 1024)
    done = writers.write_rolled(rolled, F.to_json(F.struct("id", "text")), "shard_index", ["id"], str(tmp_path / "r"), seen.append)
    assert len(done) >= 2 and seen == done
    ids = [json.loads(x)["id"] for d in done for x in (tmp_path / "r" / d.rsplit("/", 1)[1]).read_text().splitlines()]
    assert ids == list(range(50))


def test_upload(spark, tmp_path):
    for n in ("a.jsonl", "b.jsonl", "c.txt"):
        (tmp_path / n).write_text("x" * 600)
    assert upload.collect_stats(spark, str(tmp_path)) == (2, 1200) and upload.collect_stats(spark, str(tmp_path), ("*.txt", "c*")) == (1, 600)
    assert [upload.format_size(n) for n in (0, 600, 1200, 3 << 40)] == ["0 B", "600.00 B", "1.17 KB", "3.00 TB"] and 8 <= upload.default_workers() <= 64
    sent = []
    m = Manifest(str(tmp_path / "m" / "manifest.json"))
    got = upload.upload(spark, str(tmp_path), sinks.resolve(output_repo="a/b", upload=sent.append), workers=2, manifest=m)
    assert got["sent"] == 2 and len(sent) == 2 and len(Manifest.load(m.path).uploaded_shards) == 2
    assert upload.upload(spark, str(tmp_path), sinks.resolve(output_repo="a/b", upload=sent.append), manifest=m)["sent"] == 0
    assert upload.progress(5, 20, 10.0) == {"share": 0.25, "seconds_each": 2.0, "eta": 30.0}


def test_incremental_runs_resume(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    cfg = Config(output_dir=str(tmp_path / "out"))
    (root / "a.jsonl").write_text('{"text": "aynı metin"}\n{"text": "ilk"}\n{"text": "Aynı metin "}\n', encoding="utf-8")
    incremental.run(spark, str(root), cfg).awaitTermination()
    (root / "b.jsonl").write_text('{"text": "aynı metin"}\n{"text": "yeni"}\n', encoding="utf-8")
    incremental.run(spark, str(root), cfg).awaitTermination()
    incremental.run(spark, str(root), cfg).awaitTermination()
    m = Manifest(cfg.output("manifest.json"))
    (root / "c.jsonl").write_text("", encoding="utf-8")
    (root / "d.parquet").write_text("no stream reads this")
    (root / "e.jsonl").write_text('{"text": "Yeni"}\n', encoding="utf-8")
    incremental.run(spark, str(root), cfg, manifest=m).awaitTermination()
    assert Manifest.load(m.path).processed_files == ["e.jsonl"]
    rows = [r for r in spark.read.parquet(cfg.output("decided")).collect() if r["_shard"] != "e.jsonl"]
    assert len(rows) == 5 and sorted(r["text"] for r in rows if r["is_exact_dup"]) == ["Aynı metin", "aynı metin"]


def test_tokenizer_extension(spark, tmp_path):
    merges = [("ç", "a"), ("ça", "y"), ("▁", "çay"), ("l", "ı"), ("lı", "k"), ("x", "q")]
    base = {"▁": 0, "ç": 1, "a": 2, "y": 3, "l": 4, "ı": 5, "k": 6}
    chosen = tokenizer.select([("▁çay", 1), ("zzz", 2), ("lık", 3)], set(base), {("l", "ı")}, merges, 5)
    assert chosen["tokens"] == ["ça", "çay", "▁çay", "lı", "lık"] and chosen["merges"] == [("ç", "a", 0), ("ça", "y", 1), ("▁", "çay", 2), ("lı", "k", 4)] and chosen["rejected"] == ["zzz"]
    assert tokenizer.select([("▁çay", 1), ("lık", 3)], set(base), set(), merges, 4)["tokens"] == ["ça", "çay", "▁çay"]
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"model": {"vocab": base, "merges": ["l ı", ["ç", "a"]]}}), encoding="utf-8")
    vocab, m = tokenizer.load(spark, str(path))
    assert vocab.count() == 7 and m.count() == 2
    report = tokenizer.write(str(path), str(tmp_path / "out"), chosen)
    assert report["new_vocab_size"] == 12 and json.loads((tmp_path / "out" / "tokenizer.json").read_text())["model"]["vocab"]["ça"] == 7
    raw = spark.createDataFrame([('{"text": "", "content": "içerik"}',), ('"düz"',), ('{"text": 5, "body": "gövde"}',), ("{bad",)], "raw string")
    assert [r[0] for r in raw.select(tokenizer.record_text(F.col("raw"))).collect()] == ["içerik", "düz", "gövde", None]
    f = {r["word"]: r["frequency"] for r in tokenizer.word_frequency(raw.limit(0).union(spark.createDataFrame([("Çay çay su",)], "raw string")), F.col("raw")).collect()}
    assert f == {"Çay": 1, "çay": 3, "su": 2}


def test_config_paths():
    cfg = Config(input_dir="a", output_dir="/b").resolved("/root")
    assert (cfg.input_dir, cfg.output_dir) == ("/root/a", "/b")
