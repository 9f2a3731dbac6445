"""Every training-data operator against brute force and on odd tables."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import blocks, confusables, decoding, labels, language, leakage, mixing, repetition, similarity, spans, statistics
from sieveline.llm.textvec import Block

DOCS = "doc_id bigint, text string, lang string, source string, line_no int, kind string"


def docs(spark, texts, ids=None, lang=None, source=None):
    rows = [(i if ids is None else ids[i], t, lang, source, 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="session")
def real(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").cache()


@pytest.fixture(scope="session")
def fixed(spark, tables):
    return [spark.read.parquet(f"{tables}/{t}.parquet").cache() for t in ("common_words", "lang_samples")]


def words(text):
    return re.findall(r"[^\W_]+", text.translate({ord(c): "i" for c in "Iıİ"}).lower())


ODD = [None, "", "   ", "\n\t", "a", "ab", " ", "\x00", "a\x00b", "😀" * 3, "!?.", "İ", "x" * 300, "\n".join("y" * 3 for _ in range(200))]


# --- near duplicates ----------------------------------------------------------------


def shingles(text):
    t = text.strip().lower()
    return {t[i : i + 5] for i in range(len(t) - 4)} or {t}


def brute_pairs(rows):
    own = [(i, shingles(t)) for i, t in rows if t and t.strip()]
    out = []
    for (i, a), (j, b) in itertools.combinations(own, 2):
        if 5 * len(a & b) >= 4 * len(a | b):
            out.append((min(i, j), max(i, j)))
    return sorted(out)


def test_near_duplicates_equal_brute_force(spark, real):
    rng = random.Random(3)
    base = [r[0] for r in real.where("length(text) between 100 and 900").select("text").limit(12).collect()]
    texts = list(ODD)
    for t in base:
        texts += [t, t.upper(), "  " + t + "\n"]
        for cut in (0.02, 0.08, 0.15, 0.3):
            chars = list(t)
            for _ in range(max(1, int(len(t) * cut / 6))):
                k = rng.randrange(len(chars))
                chars[k : k + 3] = rng.choice(["", "qq", "zzz"])
            texts.append("".join(chars))
    texts += ["abcdefgh", "abcdefg", "abcdefghi", "abcdefghij", "bcdefghi", "kisa", "kısa", "kisa"]
    want = brute_pairs(enumerate(texts))
    assert pairs(similarity.near_duplicates(docs(spark, texts))) == want
    assert pairs(similarity.near_duplicates(docs(spark, texts), lists="elements")) == want


def test_small_sets_find_every_pair(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 20))) for _ in range(150)]
    assert pairs(similarity.near_duplicates(docs(spark, texts))) == brute_pairs(enumerate(texts))


def test_many_short_texts_of_a_batch(spark):
    """More texts than a packed key of one block could number."""
    rng = random.Random(7)
    texts = [f"{i:05d} " + "".join(rng.choice("abcdefgh") for _ in range(24)) for i in range(12_000)]
    texts += [t + "." for t in texts[::40]]
    df = docs(spark, texts).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    try:
        got = pairs(similarity.near_duplicates(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) >= {(40 * k, 12_000 + k) for k in range(300)}


def test_boundary_follows_the_sizes():
    assert similarity.boundary({}) == 1
    assert similarity.boundary({200: 50}) == 1
    assert 8 < similarity.boundary({n: 10 for n in range(1, 40)}) < similarity.SMALL


def test_subsets_cover_every_joined_pair():
    limit = 12
    for a in range(1, limit):
        for b in range(a, int(a / 0.8) + 1):
            c = similarity.needed(a, b)
            assert c in similarity.subset_sizes(a, limit) and c in similarity.subset_sizes(b, limit)


def test_long_lists_are_scanned_in_blocks(spark, monkeypatch):
    texts = [f"ortak bir cümle hep aynı kalır ve uzar gider {i:03d}" for i in range(60)]
    whole = pairs(similarity.near_duplicates(docs(spark, texts)))
    for rows in (7, 1):
        monkeypatch.setattr(similarity, "LIST_ROWS", rows)
        assert pairs(similarity.near_duplicates(docs(spark, texts))) == whole == brute_pairs(enumerate(texts))
    assert pairs(similarity.near_duplicates(docs(spark, texts), lists="elements")) == whole


def test_a_list_streams_by_in_parts(monkeypatch):
    monkeypatch.setattr(similarity, "LIST_ROWS", 3)
    name = np.repeat([1, 2, 3, 4], [2, 11, 3, 5])
    rows = {"name": name, "doc_id": np.arange(len(name)), "size": np.full(len(name), 9), "place": np.full(len(name), -1)}
    for cut in (1, 2, 4, 30):
        batches = [similarity.arrow({k: v[i : i + cut] for k, v in rows.items()}) for i in range(0, len(name), cut)]
        out = [r for b in similarity._lists(batches) for r in b.to_pylist()]
        assert sorted((r["a"], r["b"]) for r in out if r["name"] is None) == [(0, 1), (13, 14), (13, 15), (14, 15)]
        assert [(r["a"], r["part"]) for r in out if r["name"] is not None] == [(2 + k, k // 3) for k in range(11)] + [(16 + k, k // 3) for k in range(5)]


def test_many_copies_keep_every_link(spark, monkeypatch):
    copy = "aynı metin birçok kez durur ve hiç değişmez"
    texts = [copy] * 9 + [copy + "!"] * 7
    assert pairs(similarity.near_duplicates(docs(spark, texts))) == brute_pairs(enumerate(texts))
    monkeypatch.setattr(similarity, "COPIES", 4)
    place = [*range(9), *range(7)]
    want = [(i, j) for i, j in itertools.combinations(range(16), 2) if abs(place[i] - place[j]) <= 4 or not place[i] or not place[j]]
    assert pairs(similarity.near_duplicates(docs(spark, texts))) == want


def test_groups_follow_links(spark):
    base = "Uzun bir metin ki içinde pek çok farklı sözcük vardır ve hepsi birbirinden ayrıdır, o nedenle benzerlik ölçülebilir."
    texts = [base, base + " Ek.", base + " Ek. Son.", "bambaşka bir içerik burada durur", base]
    got = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in similarity.grouped(docs(spark, texts)).collect()}
    assert {got[i][0] for i in (0, 1, 2, 4)} == {0} and got[3] == (3, 0) and got[1][1] == 2


# --- language -------------------------------------------------------------------------

TR = "Bu köy çok eski bir yerdir. Dün akşam herkes bahçede oturdu ve uzun uzun konuştu. Sonra yağmur başladı ama kimse gitmek istemedi."
EN = "The village was very old and quiet. Yesterday everyone sat in the garden and they talked for a long time. Then the rain started but nobody wanted to leave."


def test_language_of_held_out_passages(spark, fixed):
    rows = fixed[1].select("lang", "text").orderBy("sample_id").collect()
    train, test = rows[::2], rows[1::2]
    texts = {}
    for lang, t in train:
        texts.setdefault(lang, []).append(t)
    model = language.Model(texts)
    main, _, _ = language.judged(Block([t for _, t in test], 0), model)
    assert np.mean([model.langs[m] == lang for m, (lang, _) in zip(main, test, strict=True)]) >= 0.98


def test_language_labels_and_passages(spark, real, fixed):
    rows = [(1, TR, "tr-TR"), (2, TR, "Turkish"), (3, TR, "en"), (4, TR, None), (5, TR + "\n" + EN + "\n" + TR, "TUR"), (6, TR + ' Adam "The village was very old and quiet." dedi.', "tr"), (7, EN, "xx"), (8, None, "tr"), (9, " ", None), (10, "q8#~ 00f3 9d2 x7c !! 5b1e", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").union(real.select("doc_id", "text", "lang").where("doc_id > 1000").limit(150))
    found = language.documents(df, *fixed)
    got = {(r[0], r[1]) for r in language.mislabelled(found).where("doc_id <= 10").collect()}
    assert got == {(3, "tr"), (4, "tr"), (5, "tr"), (5, "en"), (7, "en")}
    text = TR + "\n" + EN + "\n" + TR
    segments = [(r["lang"], text[r["start"] : r["end"]].strip(), r["other"]) for r in language.passages(df, *fixed).where("doc_id = 5").orderBy("start").collect()]
    assert segments == [("tr", TR, False), ("en", EN, True), ("tr", TR, False)]
    assert found.where("confidence is null or confidence < 0 or confidence > 1").isEmpty()
    assert pairs(found.where("doc_id in (8, 9, 10)").select("doc_id", "lang")) == [(10, None)]


#: Clean texts in languages that the labelled passages do not have.
FOREIGN = {
    "pl": "Burmistrz oświadczył, że główna ulica miasta zostanie zamknięta. Mieszkańcy są bardzo źli, ponieważ muszą jeździć dłuższą drogą do pracy. Żółta tablica stoi już na skrzyżowaniu.",
    "cs": "Starosta řekl, že hlavní ulice bude uzavřena. Příliš žluťoučký kůň úpěl ďábelské ódy. Včera večer všichni seděli na zahradě a dlouho si povídali.\nŠÉF ÚŘADU NÍŽE PODEPSANÝ",
    "pt": "O prefeito disse que a rua principal não será fechada. As crianças estão na escola e os pais vão às reuniões.\nINFORMAÇÕES SÃO PÚBLICAS",
    "ro": "Primarul a spus că strada principală va fi închisă și că locuitorii trebuie să aștepte. Aseară toți au stat în grădină.\nŢara noastră şi oraşul",
    "el": "Ο δήμαρχος είπε ότι ο κεντρικός δρόμος θα κλείσει. Χθες το βράδυ όλοι κάθισαν στον κήπο.\nΆνθρωποι και Ήλιος, ΕΛΛΗΝΙΚΉ ΔΗΜΟΚΡΑΤΊΑ",
    "uk": "Міський голова сказав, що головна вулиця буде зачинена. Учора ввечері всі сиділи в саду, їхні діти ґречно гралися.\nУкраїнська мова є гарною",
    "it": "Il sindaco ha detto che la strada principale sarà chiusa perché è vecchia. Così lunedì nessuno potrà più andare in città. Però la società è già pronta.",
    "sv": "Borgmästaren sade att huvudgatan skall stängas. I går kväll satt alla i trädgården och pratade länge. Åsa gick över ån.",
    "vi": "Thị trưởng nói rằng con đường chính sẽ bị đóng cửa. Tối qua mọi người ngồi trong vườn và nói chuyện rất lâu.",
    "ar": "قال رئيس البلدية إن الشارع الرئيسي سيغلق غدا. جلس الجميع مساء أمس في الحديقة وتحدثوا طويلا.",
    "sr": "Градоначелник је рекао да ће главна улица бити затворена. Људи су дуго разговарали у башти.",
    "hu": "A polgármester azt mondta, hogy a főutcát lezárják. Tegnap este mindenki a kertben ült. Őszintén szólva, fűszer.",
    "is": "Bæjarstjórinn sagði að aðalgötunni yrði lokað. Í gærkvöldi sátu allir í garðinum og töluðu lengi saman. Það þarf þó.",
}


def test_languages_beyond_the_passages(spark, real, fixed):
    df = docs(spark, list(FOREIGN.values())).select("doc_id", "text", "lang").union(real.select("doc_id", "text", "lang").where("doc_id > 1000").limit(150))
    got = {r["doc_id"]: r["lang"] for r in language.documents(df, *fixed).where(F.col("doc_id") < len(FOREIGN)).collect()}
    assert got == dict.fromkeys(range(len(FOREIGN)))
    more = fixed[1].select("sample_id", "lang", "text").union(spark.createDataFrame([(900 + i, "pl", FOREIGN["pl"]) for i in range(20)], "sample_id bigint, lang string, text string"))
    assert language.documents(df, fixed[0], more).where("doc_id = 0").first()["lang"] == "pl"


def test_clean_texts_of_other_languages_stay(spark, fixed, real):
    texts = list(FOREIGN.values()) + ["\n".join([t] * 5) for t in FOREIGN.values()]
    df = docs(spark, texts).unionByName(real.select("doc_id", "text", "lang", "source", F.lit(1).alias("line_no"), F.lit("").alias("kind")).where("doc_id > 1000").limit(60))
    small = F.col("doc_id") < len(texts)
    assert decoding.damaged_lines(df, fixed[1]).where(small).count() == 0
    assert {r["doc_id"]: r["text"] for r in decoding.restored(df, fixed[1]).where(small).collect()} == dict(enumerate(texts))


def test_exhaustive_search_finds_what_the_beam_finds(spark, fixed):
    texts = [TR.encode().decode("latin-1"), TR.encode().decode("cp1252", "replace").encode().decode("latin-1"), TR]
    every = decoding.Search(depth=2, beam=None)
    assert pairs(decoding.damaged_lines(docs(spark, texts), fixed[1], search=every).select("doc_id", "line_no").distinct()) == [(0, 0), (1, 0)]


def test_no_chain_is_left_out(spark, fixed):
    # a chain that three candidates of a length miss: the first step spoils the words that were right, the second mends them
    long = TR + " Küçük çocuklar yağmurda ıslandı, büyükler ise şehre döndü ve ışıkları söndürdü."
    texts = [long.encode("cp1254").decode(wrong) + " Çok yabancı bir gün götürmedi." for wrong in ("cp850", "cp437")]
    want = [long + t[len(long) :] for t in texts]
    assert pairs(decoding.damaged_lines(docs(spark, texts), fixed[1]).select("doc_id", "line_no", "repaired")) == [(i, 0, t) for i, t in enumerate(want)]
    # the same as trying every chain one after the other
    coder = decoding.Coder(decoding.dictionaries(*labels.sample(docs(spark, texts), fixed[1])), decoding.Search(depth=2))
    cost = lambda t, n: coder.size(t) + decoding.ODD * len(decoding._odd().findall(t)) + decoding.STEP * n
    for text in (texts[0][-90:], TR[:60].encode().decode("latin-1"), "Açık\xa0köy yolu".encode("cp1254").decode("cp850"), FOREIGN["is"]):
        best, chain, level, seen = cost(text, 0), (), [((), text)], {text}
        for n in (1, 2):
            made = [((*c, s), new) for c, t in level for s in decoding.STEPS if (new := decoding.undo(t, *s)) not in seen and not seen.add(new)]
            least = min(((cost(t, n), c) for c, t in made if cost(t, n) < best and decoding._supported(text, t, c, coder)), default=None)
            best, chain, level = (*least, made) if least else (best, chain, made)
        assert decoding.best_chain(text, coder, False) == chain, text


def test_texts_without_evidence_are_dropped_early(spark, fixed, monkeypatch):
    # most of the signs are those of a few words, which tell of nearly every chain that the rest need not be looked at
    line = "Это был старый город, который очень долго строил новый мост через широкую реку."
    texts = ["\n".join([line[:22]] * 12 + [line]).encode(right).decode(wrong) for right, wrong in (("utf-8", "cp866"), ("koi8-r", "cp437"))]
    coder = decoding.Coder(decoding.dictionaries(*labels.sample(docs(spark, texts), fixed[1])), decoding.Search())
    looked, stands = [0], decoding.Coder.stands
    monkeypatch.setattr(decoding.Coder, "stands", lambda self, tokens: looked.__setitem__(0, looked[0] + len(tokens)) or stands(self, tokens))
    chains = [decoding.best_chain(t, coder, False) for t in texts]
    assert chains == [(("cp866", "utf-8"),), (("cp437", "koi8-r"),)]
    assert looked[0] < 110_000  # 176,000 before
    # what is dropped would not have been evident
    rows = []
    for text in (*texts, "Açık\xa0köy yolu köy kız yolu çok".encode("cp1254").decode("cp850")):
        made = decoding.Chains(text, coder, coder.readings)
        level, *_, seen = made.level(made.first, made.seen())
        rows.append((made, made.level(level, seen)[0]))
    early = [made.evident(r).tolist() for made, r in rows]
    monkeypatch.setattr(decoding.Chains, "_may_be_evident", lambda self, total, left: np.full(len(total), True))
    assert early == [made.evident(r).tolist() for made, r in rows] and any(early)


# --- page furniture ---------------------------------------------------------------------


def test_furniture_of_a_page(spark, fixed):
    page = "Anasayfa\nEkonomi\nSpor\nKültür\nGörüntülenme: 123\nKöyün sessiz yanı\n\n" + TR + "\n" + TR + "\nBenzer haberler\nIrmağın derin yanı\nDenizin mavi yanı\nGizlilik politikası\nKullanım koşulları\nRSS"
    about = TR + " Yazar, çerez politikası metninin neden okunmadığını tartışıyor. " + TR
    df = docs(spark, [page, about, None, "", "tek satır"])
    got = pairs(blocks.furniture(df, *fixed).select("doc_id", "line_no"))
    assert got == [(0, k) for k in (0, 1, 2, 3, 4, 9, 10, 11, 12, 13, 14)]
    body = {r["doc_id"]: r["text"] for r in blocks.main_content(df, *fixed).collect()}
    assert body[0] == "Köyün sessiz yanı\n\n" + TR + "\n" + TR and body[1] == about


def test_fitting_and_its_teacher(real):
    from sieveline.llm import fit_blocks

    texts = [r[0] for r in real.where("text is not null").select("text").collect() if r[0].strip()]
    y = [[0] * sum(bool(x.strip()) for x in t.split("\n")) for t in texts]
    cut = [[int("RSS" in x) for x in t.split("\n") if x.strip()] for t in texts]
    assert [len(a) for a in y] == [len(a) for a in cut]
    w = fit_blocks.fit(texts[:60], cut[:60], epochs=3)
    assert all(np.isfinite(v).all() for v in w.values())
    rng = random.Random(1)
    menu = ["Anasayfa", "RSS", "Künye", "Abone ol", "Spor", "Arşiv"]
    page = lambda i: "\n".join([*rng.sample(menu, 6), f"başlık {chr(97 + i % 26)}{i}", f"Cümle {chr(98 + i % 25)} burada {i} kez biter.", *rng.sample(menu, 3)])
    teacher = fit_blocks.Teacher([page(i) for i in range(60)])
    labels_ = teacher.labels("Anasayfa\nRSS\nKünye\nyeni başlık\nBu cümle burada biter.\nAbone ol")
    assert labels_ == [1, 1, 1, 0, 0, 1]


# --- repetition ---------------------------------------------------------------------------


def brute_repeated(text):
    w = words(text)
    seen, hit = set(), [0] * len(w)
    for i in range(len(w) - 4):
        g = tuple(w[i : i + 5])
        if g in seen:
            hit[i : i + 5] = [1] * 5
        seen.add(g)
    return sum(hit) / max(1, len(w))


def test_repetition_equals_brute_force(spark, real):
    texts = [r[0] for r in real.select("text").collect()] + ODD + ["bir iki üç dört beş altı " * 40, "Isı ısı İSİ isi ISI " * 9]
    got = {r["doc_id"]: r for r in repetition.ledger(docs(spark, texts)).collect()}
    live = {i: t for i, t in enumerate(texts) if t and t.strip()}
    assert set(got) == set(live)
    for i, t in live.items():
        assert got[i]["repeated_word_share"] == pytest.approx(brute_repeated(t)), t[:50]
        assert bool(got[i]["fail_bits"] & 1) == (brute_repeated(t) >= 0.3 and bool(words(t)))
        own = [x for x in t.split("\n") if x.strip()]
        if t.isprintable() or "\n" in t and " " not in t:
            assert got[i]["repeated_line_share"] == pytest.approx(1 - len(set(own)) / len(own)) or "\x00" in t


def test_ablation_counts_bits(spark):
    book = spark.createDataFrame([(1, 0b000001), (2, 0b000010), (3, 0b001011), (4, 0)], "doc_id bigint, fail_bits bigint")
    got = {(r["policy"], r["version"], r["rule"]): (r["rejected_by_policy"], r["failed_rule"], r["rejected_by_rule_alone"]) for r in repetition.ablation(book).collect()}
    assert got["five_word_runs", 1, "repeated_words"] == (2, 2, 2)
    assert got["strict", 1, "repeated_lines"] == (3, 2, 1)
    assert pairs(repetition.rejected(book, "strict", 1).select("doc_id")) == [(1,), (2,), (3,)]


# --- wrong decodings -----------------------------------------------------------------------


def test_decoding_round_trips(spark, fixed, real):
    russian = "Это был старый город, который очень долго строил новый мост через широкую реку."
    cases = [
        (TR.encode().decode("cp1252", "replace"), None), (TR.encode("cp1254").decode("cp1252"), TR), (TR.encode().decode("latin-1"), TR), (TR.encode().decode("cp437"), TR),
        (TR.encode().decode("latin-1").encode().decode("latin-1"), TR), (russian.encode().decode("cp866"), russian), (russian.encode("koi8-r").decode("cp1251"), russian), (TR, "clean"), (EN, "clean"), (russian, "clean"),
        ("Açık k�y yolu", None),
    ]
    df = docs(spark, [c for c, _ in cases] + ODD).unionByName(real.select("doc_id", "text", "lang", "source", F.lit(1).alias("line_no"), F.lit("").alias("kind")).where("doc_id > 1000").limit(60))
    got = {r["doc_id"]: r["repaired"] for r in decoding.damaged_lines(df, fixed[1]).where(F.col("doc_id") < len(cases)).collect()}
    for i, (_, want) in enumerate(cases):
        if want == "clean":
            assert i not in got
        else:
            assert i in got and (want is None or got[i] == want), i
    back = {r["doc_id"]: r["text"] for r in decoding.restored(df, fixed[1]).where("doc_id < 3").collect()}
    assert back[1] == TR and back[2] == TR


def test_a_damaged_cyrillic_line_in_a_long_document(spark, fixed):
    clean = "Это был старый город, который очень долго строил новый мост через широкую реку."
    heads = ["НОВОСТИ ДНЯ", "ГЛАВНЫЕ СОБЫТИЯ НЕДЕЛИ", "СОВЕТ МИНИСТРОВ ПРИНЯЛ ПОСТАНОВЛЕНИЕ О РАЗВИТИИ ГОРОДА"]
    bad = "Вчера вечером школьники помогли соседям убрать снег во дворе."
    lines = [*heads, *[clean] * 20, bad.encode("koi8-r").decode("cp1251"), *[clean] * 20]
    df = docs(spark, ["\n".join(lines), "\n".join([*heads, *[clean] * 20]), *heads])
    assert pairs(decoding.damaged_lines(df, fixed[1]).select("doc_id", "line_no", "repaired")) == [(0, 23, bad)]


def test_damage_in_usual_characters_only(spark, fixed):
    az = "Bu şəhər çox qədim və gözəl bir yerdir."
    cases = [
        ("It’s a very old town and the people of the village didn’t want to leave.", "cp1252"), ("The garden was quiet – nobody talked for a long time.", "cp1252"), ("He said “the rain has started", "cp1252"),
        ("The garden was quiet — nobody talked for a long time.", "cp850"), ("It’s a very old town and nobody wanted to leave.", "cp866"), ("İstanbul eski bir şehir".replace("ş", "s"), "cp1252"), ("Onlar və biz burada idik.", "cp1252"),
    ]
    clean = [TR, EN, az, "“ULUDAĞ” çok yüksek bir dağdır.", "CAFÉ™ ve “KİTAP” – eski bir yer…", "Газета «ПЕТЕРБУРГ», школа «В», класс «Г» и дом.", "НОВЫЙ МИР» и другие", "50°C, §4, l’été – « à Paris »"]
    texts = [t.encode().decode(wrong) for t, wrong in cases]
    assert not any(decoding.odd_table()[ord(c)] for t in texts for c in t)
    df = docs(spark, texts + clean)
    got = pairs(decoding.damaged_lines(df, fixed[1]).select("doc_id", "line_no", "repaired"))
    assert got == [(i, 0, t) for i, (t, _) in enumerate(cases)]


# --- statistics ---------------------------------------------------------------------------------


def test_kinds(spark, fixed):
    items = "Bahçedeki ağaçlar:\n" + "\n".join(f"- {a} {b}" for a, b in itertools.product(("büyük", "küçük", "eski"), ("elma", "armut", "incir", "ceviz")))
    rows = "ağaç;renk;boy\n" + "\n".join(f"elma {i};kırmızı;{i * 7}" for i in range(12))
    junk = "\n".join("".join(random.Random(i).choice("!#$%&*+/<=>?@^0123456789") for _ in range(60)) for i in range(6))
    lines = "\n".join(s + "." for s in TR.split(".") if s.strip())
    short = TR + "\n- elma\n- armut\n" + TR
    mojibake = "Мы знаем, что город очень старый. Этот мост построил хороший мастер.".encode().decode("cp1251", "replace")
    df = docs(spark, [items, rows, junk, lines, short, TR, TR.encode().decode("latin-1"), mojibake, None, " "])
    got = {r["doc_id"]: r["kind"] for r in statistics.statistics(df, *fixed).collect()}
    assert got == {0: "list", 1: "table", 2: "junk", 3: "prose", 4: "prose", 5: "prose", 6: "prose", 7: got[7]}


@pytest.mark.parametrize("chunk", [40, 97, 1000])
def test_chunks_merge_to_the_whole(spark, real, fixed, chunk):
    texts = [r[0] for r in real.where("length(text) between 300 and 3000").select("text").limit(25).collect()] + ["kelime" * 60, "a b " * 90, "x\n" * 120, TR]
    whole = {r["doc_id"]: r.asDict() for r in statistics.statistics(docs(spark, texts), *fixed).collect()}
    cut = {r["doc_id"]: r.asDict() for r in statistics.statistics(docs(spark, texts), *fixed, chunk=chunk).collect()}
    assert set(whole) == set(cut)
    for i in whole:
        for k, v in whole[i].items():
            if k != "kind":
                assert cut[i][k] == pytest.approx(v, abs=1e-9), (i, k, texts[i][:60])


def test_kind_of_damaged_documents_beyond_a_chunk(spark, fixed):
    russian = "Это был старый город, который очень долго строил новый мост через широкую реку. Вчера вечером школьники помогли соседям убрать снег во дворе."
    junk = "\n".join("".join(random.Random(i).choice("!#$%&*+/<=>?@^0123456789") for _ in range(60)) for i in range(40))
    damaged = "\n".join([russian.encode().decode("latin-1")] * 12)
    df = docs(spark, [damaged, junk, "\n".join([TR] * 12)])
    for chunk in (1000, statistics.CHUNK):
        got = {r["doc_id"]: r["kind"] for r in statistics.statistics(df, *fixed, chunk=chunk).collect()}
        assert got == {0: "prose", 1: "junk", 2: "prose"}, chunk


def test_statistics_are_the_same_at_every_length(spark, fixed):
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in EN)
    forms = [wide, TR.encode().decode("latin-1"), TR, " \n "]
    texts = forms + ["\n".join([t] * ((1 << 21) // len(t))) for t in forms]
    assert len(texts[4]) > 200 * statistics.CHUNK
    df = docs(spark, texts, ids=[*range(7), 3])
    got = sorted((r["doc_id"], r["kind"], round(r["alpha_ratio"], 2)) for r in statistics.statistics(df.union(df), *fixed).collect())
    assert [g[0] for g in got] == [0, 0, 1, 1, 2, 2, 4, 4, 5, 5, 6, 6]
    assert {g[1] for g in got} == {"prose"} and [g[2] for g in got[:6]] == pytest.approx([g[2] for g in got[6:]], abs=0.02)


def test_word_counts(spark, fixed):
    got = {r["doc_id"]: r for r in statistics.statistics(docs(spark, ["Bir iki, üç!\nDört. ", "ve da 12"]), *fixed).collect()}
    assert (got[0]["n_words"], got[0]["n_lines"], got[0]["n_chars"]) == (4, 2, 19)
    assert got[0]["avg_word_length"] == pytest.approx((3 + 3 + 2 + 4) / 4) and got[1]["stopword_coverage"] == pytest.approx(2 / 3)


# --- look-alikes -----------------------------------------------------------------------------------


def test_lookalikes(spark):
    base = "Açık bir deney: ﬁyat ve çorba"
    same = ["Açık bir deney: fiyat ve çorba", "Açık bir dеney: fiyat ve çоrba", "Açık bir deney: fiyat ve çorba", "Açık bi​r deney: fiyat ve çorba", "Ａçık bir deney: fiyat ve çorba"]
    other = ["AÇIK bir deney: fiyat ve çorba", "Açik bir deney: fiyat ve çorba", "Açık bir deney: fiyat ve corba"]
    texts = [base, *same, *other, same[0], None, "", " ", "Это сервер", "Это cepвep"]
    got = pairs(confusables.lookalikes(docs(spark, texts)))
    group = list(range(6)) + [9]
    want = [(a, b) for a, b in itertools.combinations(group, 2) if texts[a] != texts[b]] + [(13, 14)]
    assert got == sorted(want)
    forms = {r["doc_id"]: r["text"] for r in confusables.normalized(docs(spark, texts)).collect()}
    assert len({forms[i] for i in group}) == 1 and forms[14] == "Это сервер" and forms[6] == texts[6]
    assert {r["class_id"] for r in confusables.groups(docs(spark, texts)).collect()} == {0, 13}


# --- leaked evaluation texts ---------------------------------------------------------------------------


def brute_leaks(rows, items):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 9):
            grams.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = set()
    for d, t in rows:
        w = words(t)
        for k in range(len(w) - 9):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + 10]), ())}
    return sorted(out)


def test_leaks_equal_brute_force(spark, real, tables, monkeypatch):
    items = spark.read.parquet(f"{tables}/benchmark.parquet")
    own = [(r["item_id"], r["text"]) for r in items.collect() if r["text"]]
    w = own[0][1].split()
    extra = [" ".join(w[:10]).upper(), "önce " + ",\n".join(w[3:13]) + " sonra", " ".join(w[:9]), None, "", "  "]
    df = real.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    rows = [(r[0], r[1]) for r in df.collect() if r[1]]
    found = leakage.matches(df, items)
    assert pairs(found.select("doc_id", "item_id")) == brute_leaks(rows, own)
    monkeypatch.setattr(leakage, "GROUP_CHARS", 20_000)
    assert pairs(leakage.matches(df, items).select("doc_id", "item_id")) == brute_leaks(rows, own)
    assert leakage.without_leaks(df, found).count() == df.count() - found.select("doc_id").distinct().count()
    assert leakage.leaked_items(found, items).count() == items.select("item_id").distinct().count()


def test_match_is_the_longest(spark):
    item = " ".join(f"k{i}" for i in range(40))
    text = "x y " + " ".join(f"k{i}" for i in range(5, 32)) + " z " + " ".join(f"k{i}" for i in range(0, 12))
    items = spark.createDataFrame([(1, item), (2, "kısa madde"), (3, None)], "item_id bigint, text string")
    r = leakage.matches(docs(spark, [text]), items).collect()
    assert [(x["item_id"], x["n_words"], x["item_word"], x["start"]) for x in r] == [(1, 27, 5, 4)]


# --- mixing ---------------------------------------------------------------------------------------------


def test_mixture_reaches_its_shares(spark, real, tables):
    targets = spark.read.parquet(f"{tables}/mix_targets.parquet")
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(("ev", "yol", "deniz")) for _ in range(rng.randrange(5, 60))), s) for i, s in enumerate(["Gezgin-Tarama"] * 150 + [" haber_arsivi"] * 400 + ["haber-arsivi"] * 200 + ["ozel"] * 20 + [None] * 5)]
    df = spark.createDataFrame([*rows, (9000, None, "ozel"), (9001, " ", "ozel")], "doc_id bigint, text string, source string")
    wanted = spark.createDataFrame([("gezgin_tarama", 0.5, 1), ("haber_arsivi", 0.4, 2), ("OZEL", 0.1, 4), ("yok", 0.0, 2)], "source string, target_share double, max_repeats int")
    chosen = mixing.selection(df, wanted)
    out = {r["source"]: r for r in mixing.report(chosen, wanted).collect()}
    for s, share in (("gezgin_tarama", 0.5), ("haber_arsivi", 0.4), ("ozel", 0.1)):
        assert out[s]["share"] == pytest.approx(share, abs=0.03)
        assert out[s]["most_copies"] <= out[s]["max_repeats"]
    assert out["yok"]["n_docs"] == 0
    chosen = mixing.selection(df, wanted, once_per_text=True)
    assert pairs(chosen) == pairs(mixing.selection(df, wanted, once_per_text=True)) and chosen.groupBy("doc_id").count().where("count > 1").isEmpty()
    assert targets.count() and mixing.selection(df.limit(0), wanted).isEmpty()


def test_pieces_of_a_long_text_have_its_tokens(monkeypatch):
    rng = random.Random(4)
    encoding = mixing._encoding(mixing.RANKS)
    texts = ["".join(rng.choice(("ev", "yol'", "  ", " ", "\n", " \n", "\t", "123", "!?", "\u00a0", "ş", "😀", "'s", "\x1c")) for _ in range(400)) for _ in range(40)]
    whole = [len(encoding.encode_ordinary(t)) for t in texts]
    for longest in (3, 50):
        monkeypatch.setattr(mixing, "LONGEST", longest)
        assert [mixing._count(encoding, t) for t in texts] == whole


def test_factor_meets_the_wanted_tokens():
    levels = [(1.0, 100), (0.5, 60), (0.25, 40)]
    for wanted in (30, 90, 150, 320):
        c = mixing._factor(levels, wanted, 2)
        assert sum(min(c * w, 2) * t for w, t in levels) == pytest.approx(wanted)


# --- shared spans --------------------------------------------------------------------------------------------


def brute_spans(rows, window):
    at = {}
    for d, t in rows:
        for i in range(len(t) - window + 1):
            at.setdefault(t[i : i + window], []).append((d, i))
    shared = {}
    for places in at.values():
        if len({d for d, _ in places}) > 1:
            for d, i in places:
                shared.setdefault(d, set()).update(range(i, i + window))
    out = []
    for d, chars in shared.items():
        run = sorted(chars)
        start = prev = run[0]
        for c in run[1:]:
            if c != prev + 1:
                out.append((d, start, prev + 1))
                start = c
            prev = c
        out.append((d, start, prev + 1))
    return sorted(out)


def _span_texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcçdeğıöş") for _ in range(rng.randrange(2, 8)))
    passage = lambda n: " ".join(word() for _ in range(n))
    a, b, c = passage(120), passage(60), passage(200)
    texts = [a, passage(20) + a[100:500] + passage(10), b + c, c[50:700], a + " " + a, passage(30), c, c, "x" * 900, "x" * 400, a[:249], a[:250], passage(5) + a[-260:]]
    for k in range(6):
        cut = rng.randrange(200, 600)
        texts.append(c[:cut] + "#" + c[cut + 1 :])
    return texts + [t for t in ODD if t is None or len(t) < 400]


@pytest.mark.parametrize("window", [250, 40])
def test_spans_equal_brute_force(spark, window):
    texts = _span_texts()
    rows = [(i, t) for i, t in enumerate(texts) if t and t.strip()]
    got = pairs(spans.shared_spans(docs(spark, texts), window=window).select("doc_id", "span_start", "span_end"))
    assert got == brute_spans(rows, window)


def _twice_texts():
    """A paragraph twice in one document and once in another."""
    rng = random.Random(17)
    passage = lambda n: "".join(rng.choice("abcçdefgğhıijklmnoöprsştuüvyz ") for _ in range(n))
    texts = []
    for _ in range(20):
        p, z = passage(700), passage(300)
        pages = [p + z + passage(200) + p + passage(300), passage(90) + p + z]
        texts += pages if rng.random() < 0.5 else pages[::-1]
    return texts


def test_spans_repeated_in_their_own_document(spark, monkeypatch):
    texts = _twice_texts()
    want = brute_spans(list(enumerate(texts)), 250)
    found = lambda: pairs(spans.shared_spans(docs(spark, texts)).select("doc_id", "span_start", "span_end"))
    assert found() == want
    monkeypatch.setattr(spans, "GROUP_ROWS", 2)  # the way of large groups
    assert found() == want


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_index_is_the_same_in_any_batches_and_reopened(spark, batches):
    texts = _span_texts() + _twice_texts()[:8]
    df = docs(spark, texts)
    want = brute_spans([(i, t) for i, t in enumerate(texts) if t and t.strip()], 250)
    index = spans.SpanIndex(spark)
    for k in range(batches):
        index.add(df.where(F.col("doc_id") % batches == k))
        index = spans.SpanIndex(spark, index.path)  # as another session opens it
    assert len(index.runs) <= 2 and pairs(index.spans().select("doc_id", "span_start", "span_end")) == want
    index.compact()
    again = spans.SpanIndex(spark, index.path)
    assert len(again.runs) == 1 and pairs(again.spans().select("doc_id", "span_start", "span_end")) == want
    with pytest.raises(ValueError):
        spans.SpanIndex(spark, index.path, window=99)


def test_hot_fingerprints_are_spread(spark, monkeypatch):
    texts = _span_texts() + _twice_texts()
    df = docs(spark, texts)
    want = brute_spans([(i, t) for i, t in enumerate(texts) if t and t.strip()], 250)
    for name, value in (("GROUP_ROWS", 2), ("SAMPLE", 1)):
        monkeypatch.setattr(spans, name, value)
    assert pairs(spans.shared_spans(df).select("doc_id", "span_start", "span_end")) == want


def test_a_merge_reads_no_run_twice_over_the_network(spark):
    index = spans.SpanIndex(spark)
    df = docs(spark, _span_texts())
    index.add(df.where("doc_id < 9"))
    a = spark.table(index.runs[0].table)
    plan = a.join(a.toDF("k", *[f"{c}2" for c in a.columns[1:]]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_shares(spark):
    texts = _span_texts()
    df = docs(spark, texts)
    got = {r["doc_id"]: r for r in spans.shares(df, spans.shared_spans(df)).collect()}
    assert got[6]["shared_share"] == 1.0 and got[5]["shared_chars"] == 0


# --- all of them on odd tables -----------------------------------------------------------------------------------


def _operators(fixed, items, targets):
    return {
        "near": similarity.near_duplicates, "groups": similarity.grouped, "lang": lambda d: language.documents(d, *fixed), "passages": lambda d: language.passages(d, *fixed),
        "furniture": lambda d: blocks.furniture(d, *fixed), "content": lambda d: blocks.main_content(d, *fixed), "ledger": repetition.ledger, "lines": lambda d: decoding.damaged_lines(d, fixed[1]),
        "restored": lambda d: decoding.restored(d, fixed[1]), "statistics": lambda d: statistics.statistics(d, *fixed), "lookalikes": confusables.lookalikes, "normalized": confusables.normalized,
        "leaks": lambda d: leakage.matches(d, items), "mix": lambda d: mixing.selection(d, targets), "spans": spans.shared_spans,
    }


def test_odd_tables(spark, fixed, tables):
    items, targets = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("benchmark", "mix_targets"))
    empty = docs(spark, []).limit(0)
    odd = docs(spark, ODD * 2).unionByName(docs(spark, ["metin"], ids=[None])).withColumn("score", F.lit(1)).withColumn("size", F.lit(2)).withColumn("h", F.lit(3))
    repeated = odd.union(odd)
    for name, op in _operators(fixed, items, targets).items():
        assert op(empty).count() == 0, name
        first = op(odd).collect()
        assert all(r["doc_id"] is not None for r in first if "doc_id" in r), name
        op(repeated).count()


def test_very_long_text(spark, fixed):
    rng = random.Random(1)
    long = " ".join("".join(rng.choice("abcçdefgğhıijklmnoöprsştuüvyz") for _ in range(5)) for _ in range(120_000))
    df = docs(spark, [long, long[: 300_000] + "son", "kısa"])
    assert (0, 1) not in pairs(similarity.near_duplicates(df))
    assert pairs(spans.shared_spans(df).select("doc_id", "span_start", "span_end")) == [(0, 0, 300_000), (1, 0, 300_000)]
    assert repetition.ledger(df).count() == 3 and statistics.statistics(df, *fixed).count() == 3


def test_label_spellings(spark):
    df = spark.createDataFrame([(x,) for x in ("tr", "TR", "tur", "Turkish", "tr_TR", "tr-TR", " az-AZ", "und", "", "xx", None, "kk")], "l string")
    got = [r[0] for r in df.select(labels.canonical(F.col("l"))).collect()]
    assert got == ["tr"] * 6 + ["az", None, None, None, None, "kk"]
