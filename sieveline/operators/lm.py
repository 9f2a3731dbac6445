"""N-gram language model: seed corpus, modified Kneser-Ney training, scoring, verdict.

A model is three DataFrames: ``grams(n, gram, logp)``, ``backoffs(n, gram,
backoff)`` and ``vocabulary(word)``. Training is a chain of aggregations over
64-bit keys of the n-grams, whose words are looked up only where a model is
kept. Scoring reads a model from files in parts of bounded size and joins one
that is too large for a machine's disk, so neither is bound by a worker's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import SPACE, round_half_up, words
from ..plans.storage import discarded, listed, stored

BOS, EOS, UNK = "<s>", "</s>", "<unk>"
#: Discounts where the counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)
#: N-grams of a model that goes to every machine as files, at 16 bytes each.
CARRIED = 100_000_000
#: N-grams of a file, of which a task holds one at a time, and of a model that it holds as a whole.
PART, HELD = 2_000_000, 6_000_000
#: Tokens that are counted or scored at a time.
TOKENS = 400_000


def tokens(text: Column) -> Column:
    return words(F.lower(F.regexp_replace(text, "\n", " ")))


def window(own: Column, cfg: Config) -> Column:
    """Head, middle and tail of a text beyond the window; the whole of a shorter one."""
    third = cfg.lm_window // 3
    n = F.size(own)
    middle = F.slice(own, F.floor((n - third) / 2).cast("int") + 1, third)
    return F.when(n > cfg.lm_window, F.concat(F.slice(own, 1, third), middle, F.slice(own, -third, third))).otherwise(own)


def sentences(text: Column) -> Column:
    """Sentences of at least three tokens, as arrays of lower-case tokens."""
    parts = F.split(text, rf"(?<=[.!?\x{{2026}}])[{SPACE}]+")
    return F.filter(F.transform(parts, lambda s: words(F.lower(s))), lambda w: F.size(w) >= 3)


def seed_accepted(reasons: Column, lang_decision: Column) -> Column:
    """A record that breaks no rule and is not of another language."""
    return (F.size(reasons) == 0) & (lang_decision != "reject")


def seed_corpus(df: DataFrame, text_col: str, order: Sequence[str], accepted: Column, cfg: Config) -> DataFrame:
    """(sentence) of the first ``seed_records`` accepted records."""
    some = df.where(accepted & (F.coalesce(F.col(text_col), F.lit("")) != "")).orderBy(*order).limit(cfg.seed_records)
    # the limit leaves one task; its records are spread before they are cut into sentences
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    return some.select(F.col(text_col).alias("text")).repartition(parts).select(F.explode(sentences(F.col("text"))).alias("sentence"))


def seed_stats(df: DataFrame, text_col: str, accepted: Column) -> DataFrame:
    is_in = F.coalesce(accepted, F.lit(False))
    return df.agg(F.count("*").alias("scanned"), F.count(F.when(is_in, 1)).alias("accepted"), F.coalesce(F.sum(F.when(is_in, F.size(sentences(F.col(text_col))))), F.lit(0)).alias("sentences"))


def sampled_shards(shards: DataFrame, k: int) -> DataFrame:
    """At most k of the shards, at an even stride over their order; column ``shard``."""
    ranked = shards.select("shard").distinct().withColumn("r", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("shard")) - 1)
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    stride = F.greatest(F.floor(F.col("n") / k), F.lit(1))
    return ranked.withColumn("n", n).where((F.col("n") <= k) | ((F.col("r") % stride == 0) & (F.floor(F.col("r") / stride) < k))).select("shard")


def _explode(df: DataFrame, own: Column, n: int) -> DataFrame:
    at = F.sequence(F.lit(1), F.size("own") - n + 1)
    return df.select(own.alias("own")).where(F.size("own") >= n).select(F.explode(F.transform(at, lambda i: F.array_join(F.slice("own", i, n), " "))).alias("gram"))


def ngram_counts(corpus: DataFrame, n: int, padded: bool = True) -> DataFrame:
    """(gram, n) over the sentences, which begin with one start and end with one end mark."""
    own = F.concat(F.array(F.lit(BOS)), F.col("sentence"), F.array(F.lit(EOS))) if padded else F.col("sentence")
    return _explode(corpus, own, n).groupBy("gram").agg(F.count("*").alias("n"))


@dataclass
class Model:
    order: int
    grams: DataFrame
    backoffs: DataFrame
    vocabulary: DataFrame
    #: (key, logp) and (key, backoff), where training has left them
    keyed: tuple[DataFrame, DataFrame] | None = None


def discounts(counts: DataFrame, *by: str) -> DataFrame:
    """(d1, d2, d3) of modified Kneser-Ney from the counts of counts; a row, or one for each value of ``by``."""
    of = lambda k: F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}")
    c = counts.groupBy(*by).agg(*(of(k) for k in (1, 2, 3, 4)))
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    d = [k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    good = F.greatest(*(F.coalesce((x.isNull() | (x < 0) | (x > k)).cast("int"), F.lit(1)) for k, x in zip((1, 2, 3), d, strict=True))) == 0
    return c.select(*by, *(F.when(good, x).otherwise(F.lit(f)).alias(f"d{k}") for k, x, f in zip((1, 2, 3), d, FALLBACK, strict=True)))


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _hashed(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    coded = words.dictionary_encode()
    own = (hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in coded.dictionary.to_pylist())
    return np.frombuffer(b"".join(own), np.uint64)[coded.indices.to_numpy()]


def _joint(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return context * np.uint64(0x9E3779B97F4A7C15) + word


def _keys(h: np.ndarray, order: int) -> list[np.ndarray]:
    """Of each n up to the order, the keys of the n-grams that begin at each place; the key of a context is that of its n-gram."""
    out = [_mixed(h)]
    for n in range(2, min(order, len(h)) + 1):
        out.append(_mixed(_joint(out[-1][:-1], h[n - 1 :])))
    return out


def _slices(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their lists have more than TOKENS items."""
    for batch in batches:
        sizes = batch.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // TOKENS
        at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(at, at[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def _padded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes, each list between a start and an end mark; the places of the words, and the length of each list with its marks."""
    n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    h = np.empty(n.sum(), np.uint64)
    last = np.cumsum(n) - 1
    inner = np.ones(len(h), bool)
    inner[last], inner[last - n + 1] = False, False
    h[last - n + 1], h[last] = _hashed(pa.array([BOS, EOS]))
    at = np.flatnonzero(inner)
    h[at] = _hashed(lists.flatten())
    return h, at, n


def _counted(order: int, named: bool):
    """(size, key, context, suffix, begins, n) of the n-grams of a task's sentences, summed in pieces; their words too where asked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = _hashed(pa.array([BOS]))[0]
        for batch in _slices(batches, 0):
            lists = batch.column(0)
            h, at, n = _padded(lists)
            left = np.repeat(np.cumsum(n), n) - np.arange(len(h))  # words from here to the end of the sentence
            keys = _keys(h, order)
            words = None
            if named:
                words = np.empty(len(h), object)
                words[np.cumsum(n) - n], words[np.cumsum(n) - 1] = BOS, EOS
                words[at] = lists.flatten().to_pylist()
            for size, own in enumerate(keys, 1):
                own = own[left[: len(own)] >= size]
                where = np.flatnonzero(left[: len(keys[size - 1])] >= size)
                key, first, counts = np.unique(own, return_index=True, return_counts=True)
                where = where[first]
                none = np.zeros(len(key), np.uint64)
                context, suffix = (keys[size - 2][where], keys[size - 2][where + 1]) if size > 1 else (none, none)
                columns = {"size": np.full(len(key), size, np.int32), "key": key.view(np.int64), "context": context.view(np.int64), "suffix": suffix.view(np.int64), "begins": h[where] == start, "n": counts}
                if named:
                    columns["gram"] = pa.array([" ".join(words[i : i + size]) for i in where.tolist()], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return run


COUNTED = "size int, key bigint, context bigint, suffix bigint, begins boolean, n bigint"


def train(corpus: DataFrame, cfg: Config) -> Model:
    """Interpolated modified Kneser-Ney of ``lm_order``; n-grams of order 3 and more that occur once are pruned."""
    order = cfg.lm_order
    corpus = stored(corpus.select("sentence"), "seed")
    rows = corpus.mapInArrow(_counted(order, False), COUNTED)
    raw = stored(rows.groupBy("size", "key").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.first("begins").alias("begins"), F.sum("n").alias("n")), "counts")
    # how many different words come before; what begins a sentence keeps its own count
    left = raw.where("size > 1").groupBy((F.col("size") - 1).alias("size"), F.col("suffix").alias("key")).agg(F.count("*").alias("before"))
    own = raw.join(left, ["size", "key"], "left").where("not (size = 1 and begins)")
    own = own.select("size", "key", "context", "suffix", F.when((F.col("size") == order) | F.col("begins"), F.col("n")).otherwise(F.col("before")).alias("n"))
    own = stored(own, "adjusted")
    size = raw.where("size = 1 and not begins").count() + 1
    unknown = int(_mixed(_hashed(pa.array([UNK]))).view(np.int64)[0])
    spoken = not raw.where((F.col("size") == 1) & (F.col("key") == unknown)).isEmpty()  # a word of the corpus is written like the unknown one
    discarded(raw)
    spark = corpus.sparkSession
    d = {r["size"]: (r["d1"], r["d2"], r["d3"]) for r in discounts(own, "size").collect()}
    d = {n: d.get(n, FALLBACK) for n in range(1, order + 1)}
    discount = lambda n: F.when(F.col("n") == 1, d[n][0]).when(F.col("n") == 2, d[n][1]).otherwise(d[n][2])
    few = [F.count(F.when(F.col("n") == k, 1)).alias(f"c{k}") for k in (1, 2)]
    sums = own.groupBy("size", "context").agg(F.sum("n").alias("total"), *few, F.count(F.when(F.col("n") > 2, 1)).alias("c3"))
    mass = sum((F.when(F.col("size") == n, sum((F.col(f"c{k}") * F.lit(d[n][k - 1]) for k in (1, 2, 3)), F.lit(0.0))).otherwise(0.0) for n in range(1, order + 1)), F.lit(0.0))
    gamma = stored(sums.select("size", "context", "total", (mass / F.col("total")).alias("gamma")), "backoffs")
    probs: list[DataFrame] = []
    for n in range(1, order + 1):
        kept = own.where((F.col("size") == n) & ((F.col("n") > 1) | F.lit(n < 3)))
        if n == 1:
            g = gamma.where("size = 1").first()
            total, weight = (g["total"], g["gamma"]) if g else (1, 1.0)
            p = kept.select("size", "key", ((F.col("n") - discount(1)) / float(total) + weight / size).alias("p"))
            p = p.union(spark.createDataFrame([(1, unknown, weight / size)], "size int, key bigint, p double"))
        else:
            joined = kept.join(gamma.where(F.col("size") == n).select("context", "total", "gamma"), "context").join(probs[-1].select(F.col("key").alias("suffix"), F.col("p").alias("lower")), "suffix", "left")
            p = joined.select("size", "key", ((F.col("n") - discount(n)) / F.col("total") + F.col("gamma") * F.coalesce("lower", F.lit(0.0))).alias("p"))
        probs.append(stored(p, f"probs{n}"))
    discarded(own)
    known = _all(probs).select("size", "key", F.log10("p").alias("logp"))
    backoffs = gamma.where("size > 1").select((F.col("size") - 1).alias("size"), F.col("context").alias("key"), F.log10("gamma").alias("backoff"))
    # words of the keys, for those who keep a model; scoring reads keys only
    names = corpus.mapInArrow(_counted(order, True), COUNTED + ", gram string").groupBy("size", "key").agg(F.first("gram").alias("gram"))
    names = names.union(spark.createDataFrame([(1, unknown, UNK)], "size int, key bigint, gram string")).dropDuplicates(["size", "key"])
    worded = lambda df, value: df.join(names, ["size", "key"]).select(F.col("size").alias("n"), "gram", value)
    vocabulary = names.where((F.col("size") == 1) & ~F.col("gram").isin(BOS)).select(F.col("gram").alias("word"))
    if not spoken:
        vocabulary = vocabulary.where(F.col("word") != UNK)
    return Model(order, worded(known, "logp"), worded(backoffs, "backoff"), vocabulary, (known.select("key", "logp"), backoffs.select("key", "backoff")))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def score(df: DataFrame, model: Model, text_col: str, id_col: str, cfg: Config, carried: int = CARRIED) -> DataFrame:
    """(id, num_tokens, log10, perplexity, oov_ratio) of each text.

    The longest known n-gram that ends at a token gives its probability, and
    the longer contexts that were tried before it their backoffs. Texts under
    ``min_lm_tokens`` tokens have a perplexity of -1.

    A model of at most ``carried`` n-grams, which the bound on its seed corpus
    makes the usual case, goes to every machine as files and texts stay where
    they are; a larger one is joined with the texts' n-grams. Both give the
    same scores.
    """
    own = df.select(F.col(id_col).alias("id"), tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("all"))
    own = own.select("id", F.size("all").alias("num_tokens"), window(F.col("all"), cfg).alias("own"))
    small = carried > 0 and sum(x.count() for x in model.keyed or (model.grams, model.backoffs)) <= carried
    long = own.where(F.col("num_tokens") >= cfg.min_lm_tokens)
    if small:
        kind = dict(own.dtypes)["id"]
        scored = own.select("id", "num_tokens", F.when(F.col("num_tokens") >= cfg.min_lm_tokens, F.col("own")).alias("own"))
        scored = scored.mapInArrow(_scorer(_files(model), model.order), f"id {kind}, num_tokens int, n int, oov int, log10 double")
    else:
        scored = own.select("id", "num_tokens").join(_joined(long, model), "id", "left")
    ppl = F.pow(F.lit(10.0), -F.col("log10") / F.col("n"))
    return scored.select(
        F.col("id").alias(id_col), F.col("num_tokens").cast("bigint").alias("num_tokens"), "log10",
        F.coalesce(round_half_up(ppl, 2), F.lit(-1.0)).alias("perplexity"), F.coalesce(round_half_up(F.col("oov") / F.col("n"), 4), F.lit(0.0)).alias("oov_ratio"),
    )


def _joined(long: DataFrame, model: Model) -> DataFrame:
    """(id, n, oov, log10) by joins with the model."""
    placed = long.select("id", F.posexplode(F.concat("own", F.array(F.lit(EOS)))).alias("pos", "word"))
    known = model.vocabulary.select("word", F.lit(True).alias("known"))
    placed = placed.join(known, "word", "left").select("id", "pos", F.when(F.col("known"), F.col("word")).otherwise(UNK).alias("word"), ((F.col("known").isNull()) & (F.col("word") != EOS)).cast("int").alias("oov"))
    seen = placed.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"), F.sum("oov").alias("oov"), F.count("*").alias("n"))
    padded = F.concat(F.array(F.lit(BOS)), F.transform("w", lambda x: x["word"]))
    at = seen.select("id", padded.alias("w")).select("id", "w", F.explode(F.sequence(F.lit(2), F.size("w"))).alias("end"))
    at = at.select("id", "w", "end", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.order), F.col("end")))).alias("n"))
    at = at.select("id", "end", "n", F.array_join(F.slice("w", F.col("end") - F.col("n") + 1, F.col("n")), " ").alias("gram"), F.array_join(F.slice("w", F.col("end") - F.col("n") + 1, F.col("n") - 1), " ").alias("context"))
    joined = at.join(model.grams, ["n", "gram"], "left").join(model.backoffs.select((F.col("n") + 1).alias("n"), F.col("gram").alias("context"), "backoff"), ["n", "context"], "left")
    # at most ``order`` rows for each place
    per = joined.groupBy("id", "end").agg(F.collect_list(F.struct("n", "logp", F.coalesce("backoff", F.lit(0.0)).alias("backoff"))).alias("rows"))
    longest = F.array_max(F.transform(F.filter("rows", lambda r: r["logp"].isNotNull()), lambda r: r["n"]))
    logp = F.aggregate(
        "rows", F.lit(0.0),
        lambda a, r: a + F.when(r["n"] == F.col("m"), F.coalesce(r["logp"], F.lit(0.0))).when(r["n"] > F.col("m"), r["backoff"]).otherwise(0.0),
    )
    scores = per.withColumn("m", longest).select("id", logp.alias("logp")).groupBy("id").agg(F.sum("logp").alias("log10"))
    return seen.select("id", "oov", (F.col("n") - 1).alias("n")).join(scores, "id")


def _rekeyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of each n-gram that is given by its words."""
    for batch in batches:
        lists = pa.compute.split_pattern(batch.column(0), " ")
        h, n = _hashed(lists.flatten()), lists.value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(n) - n
        key = _mixed(h[first])
        for i in range(1, n.max(initial=1)):
            on = np.flatnonzero(n > i)
            key[on] = _mixed(_joint(key[on], h[first[on] + i]))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(1)], ["key", batch.schema.names[1]])


def _files(model: Model) -> list[list[str]]:
    """Names of files with the n-grams' log probabilities and with the backoffs, by key, which Spark copies to every machine."""
    spark = model.grams.sparkSession
    tables = model.keyed or tuple(df.select("gram", c).mapInArrow(_rekeyed, f"key bigint, {c} double") for df, c in ((model.grams, "logp"), (model.backoffs, "backoff")))
    out = []
    for table in tables:
        parts = table.count() // PART + 1
        # a key of two sizes, if any, would be a collision of 64 bits
        table = stored(table.repartition(parts, F.pmod("key", F.lit(parts))).sortWithinPartitions("key") if parts == 1 else table.repartitionByRange(parts, "key").sortWithinPartitions("key"), "lm")
        names = [n for n in listed(spark, table.stored_at) if n.endswith(".parquet")]
        for name in names:
            spark.sparkContext.addFile(f"{table.stored_at}/{name}")
        out.append(names)
    return out


class _Table:
    """Sorted keys and their values in files, held in memory where they are few and else read one file at a time."""

    def __init__(self, names: Sequence[str]) -> None:
        import pyarrow.parquet as pq

        self.paths = [SparkFiles.get(n) for n in names]
        rows = sum(pq.read_metadata(p).num_rows for p in self.paths)
        self.held = [self._read(p) for p in self.paths] if rows <= HELD else None

    @staticmethod
    def _read(path: str) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow.parquet as pq

        part = pq.read_table(path, use_threads=False)
        return part.column(0).to_numpy(), part.column(1).to_numpy()

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The value of each of the sorted keys, or NaN."""
        out = np.full(len(wanted), np.nan)
        for key, value in self.held or map(self._read, self.paths):
            if len(key):
                a, b = np.searchsorted(wanted, key[0]), np.searchsorted(wanted, key[-1], side="right")
                at = np.searchsorted(key, wanted[a:b])
                out[a:b] = np.where(key[at] == wanted[a:b], value[at], out[a:b])
        return out


def _scored(lists: pa.Array, logs: _Table, backoffs: _Table, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each list of words, their number, those that the model does not know, and the log probability."""
    h, at, n = _padded(lists)
    unknown, end = _hashed(pa.array([UNK, EOS]))
    words, where = np.unique(h[at], return_inverse=True)
    sought = _mixed(words).view(np.int64)
    rank = np.argsort(sought)
    held = np.empty(len(words), bool)
    held[rank] = ~np.isnan(logs.find(sought[rank]))
    known = (held & (words != unknown))[where]
    doc = np.repeat(np.arange(len(n)), n)
    oov = np.bincount(doc[at], ~known & (h[at] != end), len(n)).astype(np.int64)
    h[at[~known]] = unknown
    keys = [k.view(np.int64) for k in _keys(h, order)]
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    valid = [np.flatnonzero(place[: len(k)] + size <= n[doc[: len(k)]]) for size, k in enumerate(keys, 1)]
    wanted, back = np.unique(np.concatenate([k[v] for k, v in zip(keys, valid, strict=True)]), return_inverse=True)
    found = [logs.find(wanted)[back], np.nan_to_num(backoffs.find(wanted)[back])]
    cuts = np.cumsum([len(v) for v in valid])[:-1]
    logp, backoff = ([np.full(len(h), np.nan) for _ in keys] for _ in range(2))
    for values, columns in zip(found, (logp, backoff), strict=True):
        for column, v, x in zip(columns, valid, np.split(values, cuts), strict=True):
            column[v] = x
    total = np.zeros(len(h))
    open_ = place > 0  # every word and end mark is predicted
    for size in range(len(keys), 0, -1):
        ends = np.flatnonzero(open_ & (place >= size - 1))
        first = ends - size + 1
        said = logp[size - 1][first]
        take = ~np.isnan(said)
        total[ends[take]] += said[take]
        open_[ends[take]] = False
        if size > 1:
            total[ends[~take]] += backoff[size - 2][first[~take]]
    return n - 2, oov, np.bincount(doc, total, len(n))


def _scorer(names: list[list[str]], order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, backoffs = map(_Table, names)
        for batch in _slices(batches, 2):
            lists = batch.column(2)
            none = ~lists.is_valid().to_numpy(zero_copy_only=False)
            column = lambda x, kind: pa.array(x, kind, mask=none)  # noqa: B023,E731
            size, oov, log10 = _scored(lists, logs, backoffs, order)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column(size, pa.int32()), column(oov, pa.int32()), column(log10, pa.float64())], ["id", "num_tokens", "n", "oov", "log10"])

    return run


def verdict(perplexity: Column, num_tokens: Column, oov: Column, cfg: Config) -> Column:
    """The reason to reject a text for its language model score; null to keep it."""
    limit = F.when(num_tokens < cfg.short_text_tokens, cfg.max_perplexity * cfg.short_text_factor).otherwise(cfg.max_perplexity)
    return (
        F.when(perplexity.isNull() | (perplexity < 0), F.lit(None).cast("string"))
        .when(perplexity > limit, "high_kenlm_perplexity")
        .when((oov > 0.5) & (perplexity > limit * 0.5), "high_oov_and_perplexity")
    )
