"""Long verbatim spans shared between documents, over a log-structured fingerprint index.

Of every run of ``WINDOW`` characters the index keeps the least hash of its
``GRAM``-character substrings, at the place where it stands. That choice
depends on the run alone, so two documents that share a run share its
fingerprint; about one character in sixty leaves a row. A row carries the
bounds of the text whose windows chose it, and a hash of all of that text.

*Adding a batch.* Its rows become an immutable run: a table bucketed and sorted
by fingerprint, whose rows are settled where their whole text stands in another
document of the batch. The run is then merge-joined, bucket by bucket and
without a shuffle, with the runs of all earlier batches. Rows of fingerprints
that occur in several documents are compared: those whose whole text stands in
another document settle all their windows at once; the rest, which lie at the
ends of shared spans, are verified character by character against the other
texts of their fingerprint. What a batch adds to the spans, of its own
documents and of earlier ones, is written beside the runs.

*Compaction* is by size tiers: ``FAN`` runs of a tier become one of the next,
which keeps of each settled text two rows, in different documents. A folder can
be opened again by another session: runs, texts and spans are listed from it.

Fingerprints that a sample shows in more than ``GROUP_ROWS`` rows are hot: their
rows are spread over all buckets by document, and verified by a shuffle of
their windows. Neither the sample nor the spreading changes a result.

Defined results: null, empty and blank texts and texts shorter than the window
share nothing; rows that repeat an id count as one document, so they do not
share with each other; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..plans.storage import discarded, fresh_path, listed, removed, stored
from .textvec import U64, Block, arrow, blocks, docs_in, first_of_runs, mix, read, signed, sliding_min

WINDOW = 250
GRAM = WINDOW // 2
#: Texts of one fingerprint that a task verifies in memory; larger groups are verified by a shuffle of their windows.
GROUP_ROWS = 20_000
#: One document in so many is looked at to find hot fingerprints.
SAMPLE = 64
#: Hot fingerprints up to which they are broadcast.
HOT_ROWS = 1_000_000
#: Runs of a tier that are compacted into one of the next.
FAN = 2
_PLACE = U64((1 << 21) - 1)

ROWS = "h bigint, c bigint, doc_id bigint, s bigint, e bigint"
RUN = f"k bigint, {ROWS}, settled boolean, pair boolean"


def fingerprints(block: Block, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Fingerprint, text hash, document and bounds (in the document) of each row."""
    gram = window // 2
    n = len(block.cp)
    none = {k: np.zeros(0, np.int64) for k in ("h", "c", "doc", "s", "e")}
    if n < window:
        return none
    prefix = block.prefix(mix(block.cp))
    at = np.arange(n - gram + 1)
    g = Block.span_hash(prefix, at, at + gram)
    if n <= int(_PLACE):
        least = (sliding_min((g & ~_PLACE) | at.astype(U64), window - gram + 1) & _PLACE).astype(np.int64)
    else:  # a document beyond the packed places: the same choice, by value and then by place
        low = sliding_min(g & ~_PLACE, window - gram + 1)
        least = np.empty(len(low), np.int64)
        for i in range(0, len(low), 1 << 20):
            j = min(i + (1 << 20), len(low))
            part = (g[i : j + window - gram] & ~_PLACE) | np.arange(j - i + window - gram, dtype=U64)
            least[i:j] = (sliding_min(part, window - gram + 1) & _PLACE).astype(np.int64) + i
    s = np.arange(len(least))
    doc = np.searchsorted(block.end, s, side="left")
    keep = s + window <= block.end[doc]
    s, least, doc = s[keep], least[keep], doc[keep]
    if not len(s):
        return none
    first = np.flatnonzero(first_of_runs(least) | first_of_runs(doc))
    last = np.append(first[1:], len(s)) - 1
    b, e, doc = s[first], s[last] + window, doc[first]
    return {"h": signed(g[least[first]]), "c": signed(Block.span_hash(prefix, b, e)), "doc": doc, "s": b - block.start[doc], "e": e - block.start[doc]}


def _indexed(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in read(batches):
            f = fingerprints(block, window)
            doc = f.pop("doc")
            yield arrow({"h": f["h"], "c": f["c"], "doc_id": ids[doc], "s": f["s"], "e": f["e"]})

    return run


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition sorted by (h, c, doc_id): which texts stand in two documents, and two rows of each such text.

    Only rows of one text in one document wait for the next batch.
    """
    kept: list[np.ndarray] = []
    known: tuple[int, int] | None = None  # a settled text that goes on
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if kept:
            rows = [np.concatenate(x) for x in zip(kept, rows, strict=True)]
        out, kept, known = _marked(rows, known, False)
        yield out
    if kept:
        yield _marked(kept, known, True)[0]


def _marked(rows: list[np.ndarray], known: tuple[int, int] | None, last: bool) -> tuple[pa.RecordBatch, list[np.ndarray], tuple[int, int] | None]:
    h, c, doc, s, e, before, _ = rows
    new = first_of_runs(h) | first_of_runs(c)
    first = np.flatnonzero(new)
    text = np.cumsum(new) - 1
    several = np.maximum.reduceat(doc, first) != doc[first]
    several |= np.bincount(text, before, minlength=len(first)) > 0
    goes_on = known is not None and (h[0], c[0]) == known
    several[0] |= goes_on
    # two rows of a text: its first, and the first of another document
    changed = new | first_of_runs(doc)
    nth = np.cumsum(changed) - np.cumsum(changed)[first][text]
    chosen = several[text] & changed & (nth < 2) & ~(goes_on & (text == 0))
    n = len(h) if last or several[-1] else first[-1]
    columns = {"h": h, "c": c, "doc_id": doc, "s": s, "e": e, "settled": several[text], "pair": chosen}
    state = (int(h[-1]), int(c[-1])) if several[-1] else None
    return arrow({k: v[:n] for k, v in columns.items()}), [x[n:] for x in rows] if n < len(h) else [], state


@dataclass(frozen=True)
class Run:
    path: str
    number: int
    tier: int
    table: str


class SpanIndex:
    """Immutable sorted runs of fingerprints under one folder.

    ``corpus`` holds the texts of all documents that are ever indexed; without
    it the index keeps a copy of its own.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, window: int = WINDOW, corpus: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> None:
        self.spark, self.window, self.ids = spark, window, (id_col, text_col)
        self.path = path or fresh_path(spark, "spans")
        self.corpus = None if corpus is None else docs_in(corpus, id_col, text_col)
        self.runs: list[Run] = []
        self._n_hot: int | None = None
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        old = []
        for name in listed(spark, self.path):
            m = re.fullmatch(r"run-(\d+)-t(\d+)-b(\d+)-w(\d+)", name)
            if m:
                number, tier, self.buckets, width = map(int, m.groups())
                if width != window:
                    raise ValueError(f"the index has windows of {width} characters")
                run = Run(f"{self.path}/{name}", number, tier, f"spans_{uuid.uuid4().hex}")
                if "_SUCCESS" in listed(spark, run.path):
                    spark.sql(f"create table {run.table} ({RUN}) using parquet clustered by (k) sorted by (k, h, c) into {self.buckets} buckets location '{run.path}'")
                    old.append(run)
                else:
                    removed(spark, run.path)  # a run that was never whole
        self.runs = sorted(old, key=lambda r: r.number)

    def _next(self, kind: str) -> int:
        numbers = [int(m[1]) for n in listed(self.spark, self.path) if (m := re.match(rf"{kind}-(\d+)", n))]
        return max(numbers, default=-1) + 1

    def _kept(self, kind: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.path}/{kind}-{self._next(kind):05d}")

    def _of(self, kind: str, schema: str) -> DataFrame:
        parts = [f"{self.path}/{n}" for n in listed(self.spark, self.path) if n.startswith(f"{kind}-") and "_SUCCESS" in listed(self.spark, f"{self.path}/{n}")]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def add(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Index a batch of documents: a run, merge-joined with the earlier ones, then compacted with those of its size."""
        docs = docs_in(df, id_col, text_col)
        if self.corpus is None:
            self._kept("texts", docs)
        fingerprint = lambda d: d.mapInArrow(_indexed(self.window), ROWS)
        some = fingerprint(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0))
        self._kept("hot", some.groupBy("h").count().where(F.col("count") * SAMPLE > GROUP_ROWS).select("h").coalesce(1))
        self._n_hot = None
        self._write(fingerprint(docs).select("*", F.lit(False).alias("settled"), F.lit(False).alias("pair")), 0)
        found, rows = self._matched(self.runs[-1], self.runs[:-1])
        self._kept("spans", found)
        discarded(rows)
        for tier in range(64):
            same = [r for r in self.runs if r.tier == tier]
            if len(same) < FAN:
                break
            self._compact(same, tier + 1)

    def _write(self, rows: DataFrame, tier: int) -> None:
        number = self._next("run")
        run = Run(f"{self.path}/run-{number:05d}-t{tier}-b{self.buckets}-w{self.window}", number, tier, f"spans_{uuid.uuid4().hex}")
        hot = self._hot().withColumn("hot", F.lit(True))
        spread = lambda d: d.join(hot, "h", "left").withColumn("k", F.when(F.col("hot"), F.xxhash64("h", "doc_id")).otherwise(F.col("h"))).drop("hot")
        rows = spread(rows).repartition(self.buckets, "k").sortWithinPartitions("h", "c", "doc_id", "s")
        marked = rows.drop("k").select("h", "c", "doc_id", "s", "e", "settled", "pair").mapInArrow(_settled, f"{ROWS}, settled boolean, pair boolean")
        spread(marked).select("k", "h", "c", "doc_id", "s", "e", "settled", "pair").write.format("parquet").bucketBy(self.buckets, "k").sortBy("k", "h", "c").option("path", run.path).saveAsTable(run.table)
        self.runs.append(run)

    def _hot(self) -> DataFrame:
        """Hot fingerprints: at most one for GROUP_ROWS rows of the index, broadcast up to a size."""
        if self._n_hot is None:
            self._n_hot = self._of("hot", "h bigint").distinct().count()
        rows = self._of("hot", "h bigint").distinct()
        return F.broadcast(rows) if self._n_hot <= HOT_ROWS else rows

    def _compact(self, runs: list[Run], tier: int) -> None:
        """Merge runs into one; the old ones go once the new one is whole, and their settled spans stand beside it."""
        rows = reduce(DataFrame.union, (self.spark.table(r.table).drop("k") for r in runs))
        self._kept("spans", rows.where("settled and not pair").select("doc_id", "s", "e"))
        self._write(rows.where("not settled or pair"), tier)
        self.runs = [r for r in self.runs if r not in runs]
        for run in runs:
            self.spark.sql(f"drop table {run.table}")
            removed(self.spark, run.path)

    def compact(self) -> None:
        """Merge all runs into one."""
        if len(self.runs) > 1:
            self._compact(list(self.runs), max(r.tier for r in self.runs) + 1)

    def spans(self) -> DataFrame:
        """Maximal shared spans of all indexed documents."""
        settled = [self.spark.table(r.table).where("settled").select("doc_id", "s", "e") for r in self.runs]
        return merged(reduce(DataFrame.union, settled, self._of("spans", "doc_id bigint, s bigint, e bigint")))

    def _matched(self, new: Run, old: list[Run]) -> tuple[DataFrame, DataFrame]:
        """What a new run adds to the spans beside its own settled rows, and the stored rows that it is read from."""
        hot = self._hot()
        live = lambda r: self.spark.table(r.table).where("not settled or pair")
        cold = lambda r: live(r).where("k = h")
        docs_of = lambda rows, a: rows.groupBy("k").agg(F.min("doc_id").alias(f"least{a}"), F.max("doc_id").alias(f"most{a}"), F.count(F.when(~F.col("settled"), 1)).alias(f"open{a}"))
        # runs are bucketed by k, so these joins and counts need no exchange
        by = docs_of(cold(new), "")
        for i, r in enumerate(old):
            by = by.join(docs_of(cold(r), i), "k", "left")
        every = lambda f, c: f(*(F.col(f"{c}{i}") for i in ["", *range(len(old))])) if old else F.col(c)
        n_open = sum((F.coalesce(F.col(f"open{i}"), F.lit(0)) for i in range(len(old))), F.col("open"))
        shared = by.where((every(F.least, "least") != every(F.greatest, "most")) & (n_open > 0)).select("k")
        columns = ["h", "c", "doc_id", "s", "e", "settled"]
        rows = reduce(DataFrame.union, (cold(r).join(shared, "k", "left_semi").select(columns) for r in [new, *old]))
        by_h, by_text = Window.partitionBy("h"), Window.partitionBy("h", "c")
        settled = F.col("c_least") != F.col("c_most")
        rows = rows.select("*", F.min("doc_id").over(by_text).alias("c_least"), F.max("doc_id").over(by_text).alias("c_most"), F.min(F.struct("doc_id", "s")).over(by_text).alias("one"), F.max(F.struct("doc_id", "s")).over(by_text).alias("other"))
        rows = rows.select("h", "doc_id", "s", "e", (settled & ~F.col("settled")).alias("new"), (~settled).alias("open"), F.struct("doc_id", "s").isin(F.col("one"), F.col("other")).alias("kept"), F.count(F.when(~settled, 1)).over(by_h).alias("n_open"))
        rows = rows.withColumn("verify", F.expr("n_open > 0 and (open or kept)"))
        rows = stored(rows.withColumn("n", F.count(F.when(F.col("verify"), 1)).over(by_h)).where("new or verify").select("h", "doc_id", "s", "e", "new", "open", "verify", "n"), "matched")
        texts = self._texts(rows.where(F.col("verify") & (F.col("n") <= GROUP_ROWS)).select("h", "doc_id", "s", "e", "open"))
        found = rows.where("new").select("doc_id", "s", "e").union(texts.repartition("h").sortWithinPartitions("h").mapInArrow(_verify(self.window), "doc_id bigint, s bigint, e bigint"))
        large = rows.where(F.col("verify") & (F.col("n") > GROUP_ROWS)).select("h", "doc_id", "s", "e", "open")
        if not large.isEmpty():
            found = found.union(self._by_windows(self._texts(large)))
        if not self._n_hot:
            return found, rows
        hot_rows = reduce(DataFrame.union, (live(r).join(hot, "h", "left_semi").select("h", "doc_id", "s", "e", (~F.col("settled")).alias("open")) for r in [new, *old]))
        return found.union(self._by_windows(self._texts(hot_rows))), rows

    def _texts(self, rows: DataFrame) -> DataFrame:
        docs = self._of("texts", "doc_id bigint, text string") if self.corpus is None else self.corpus
        own = docs.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])  # whole texts move only where they are wanted
        return rows.join(own, "doc_id").select("h", "doc_id", "s", "open", F.expr("substring(text, cast(s + 1 as int), cast(e - s as int))").alias("text"))

    def _by_windows(self, texts: DataFrame) -> DataFrame:
        """Verification of large groups: their windows meet by hash, of 64 bits and of another 64, whatever their fingerprint's rows."""
        windows = texts.mapInArrow(_windows(self.window), "w bigint, v bigint, doc_id bigint, s bigint, open boolean")
        twice = windows.groupBy("w", "v").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least <> most").select("w", "v")
        return windows.where("open").join(twice, ["w", "v"], "left_semi").select("doc_id", "s", (F.col("s") + self.window).alias("e"))


def _hashes(h: np.ndarray, texts: list[str], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window hash with its fingerprint's, row, offset) of each window of each text."""
    out = []
    for block in blocks(texts):
        prefix = block.prefix(mix(block.cp))
        n = np.maximum(block.end - block.start - window + 1, 0)
        row = np.repeat(np.arange(block.n), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = block.start[row] + offset
        w = Block.span_hash(prefix, at, at + window)
        out.append((mix(w ^ mix(h[block.first + row].view(U64))), block.first + row, offset))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _shared(h: np.ndarray, doc: np.ndarray, s: np.ndarray, is_open: np.ndarray, texts: list[str], window: int) -> pa.RecordBatch:
    """Runs of windows that stand in a text of the same fingerprint in another document."""
    w, row, offset = _hashes(h, texts, window)
    if not len(w):
        return arrow({"doc_id": doc[:0], "s": s[:0], "e": s[:0]})
    order = np.lexsort((doc[row], w))
    at = np.flatnonzero(first_of_runs(w[order]))
    n = np.diff(np.append(at, len(w)))
    least, most = (np.empty(len(w), np.int64) for _ in range(2))  # a place of the window in its first and in its last document
    least[order], most[order] = np.repeat(order[at], n), np.repeat(order[at + n - 1], n)
    partner = np.where(doc[row[least]] != doc[row], least, most)
    i = np.flatnonzero((doc[row[partner]] != doc[row]) & is_open[row])
    if not len(i):
        return arrow({"doc_id": doc[:0], "s": s[:0], "e": s[:0]})
    p = partner[i]
    new = (np.diff(i, prepend=-2) > 1) | first_of_runs(row[i]) | (np.diff(p, prepend=-2) != 1) | first_of_runs(row[p])
    f = np.flatnonzero(new)
    last = np.append(f[1:], len(i)) - 1
    # the hashes agree; the characters decide
    same = [texts[row[a]][offset[a] : offset[b] + window] == texts[row[x]][offset[x] : offset[x] + offset[b] - offset[a] + window] for a, b, x in zip(i[f].tolist(), i[last].tolist(), p[f].tolist(), strict=True)]
    f, last = f[same], last[same]
    r = row[i[f]]
    return arrow({"doc_id": doc[r], "s": s[r] + offset[i[f]], "e": s[r] + offset[i[last]] + window})


def _columns(table: pa.Table | pa.RecordBatch):
    get = lambda k: table.column(k).to_numpy() if isinstance(table, pa.Table) else table.column(k).to_numpy(zero_copy_only=False)
    return get("h"), get("doc_id"), get("s"), get("open"), table.column("text").to_pylist()


def _verify(window: int):
    """Verify groups of a partition sorted by fingerprint, some thousand texts at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(h, h[-1], side="left"))  # the last group may go on in the next batch
            if cut or (kept and kept[-1].column(0)[-1].as_py() != h[0]):
                done = [*kept, batch.slice(0, cut)]
                kept = []
                table = pa.Table.from_batches(done)
                if table.num_rows:
                    yield _shared(*_columns(table), window)
            kept.append(batch.slice(cut))
        if kept:
            yield _shared(*_columns(pa.Table.from_batches(kept)), window)

    return run


def _windows(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, s, is_open, texts = _columns(batch)
            w, row, offset = _hashes(h, texts, window)
            v = _hashes(h, [t[::-1] for t in texts], window)[0]  # of the text read backwards, whose windows stand in the opposite order
            n = np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(0, np.int64)
            turned = (np.cumsum(n) - n)[row] + n[row] - 1 - offset if len(row) else row
            yield arrow({"w": signed(w), "v": signed(v[turned]), "doc_id": doc[row], "s": s[row] + offset, "open": is_open[row]})

    return run


def merged(spans: DataFrame) -> DataFrame:
    """Spans of each document that touch or overlap, as one."""
    order = Window.partitionBy("doc_id").orderBy("s", "e")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        spans.select("doc_id", "s", "e", F.coalesce(F.col("s") > F.max("e").over(before), F.lit(True)).alias("new"))
        .select("doc_id", "s", "e", F.sum(F.col("new").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
        .groupBy("doc_id", "run")
        .agg(F.min("s").alias("span_start"), F.max("e").alias("span_end"))
        .drop("run")
    )


def shared_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 3, window: int = WINDOW) -> DataFrame:
    """Index a whole table in batches, then its spans."""
    index = SpanIndex(df.sparkSession, window=window, corpus=df, id_col=id_col, text_col=text_col)
    for i in range(batches):
        index.add(df.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)) == i), id_col, text_col)
    return index.spans()


def shares(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each document with a text, how many of its characters are shared."""
    filled = docs_in(df, id_col, text_col).where(F.regexp_replace("text", f"[{SPACE}]+", "") != "")
    own = filled.select("doc_id", F.length("text").cast("bigint").alias("n_chars"))
    n = spans.groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared"))
    return own.join(n, "doc_id", "left").select("doc_id", "n_chars", F.coalesce("shared", F.lit(0)).alias("shared_chars"), (F.coalesce("shared", F.lit(0)) / F.col("n_chars")).alias("shared_share"))
