"""Discovery and scans of JSON Lines (plain or gzipped) and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE

SUFFIXES = (".json", ".jsonl", ".json.gz", ".jsonl.gz", ".parquet")
JSON_GLOB = "*.{[jJ][sS][oO][nN],[jJ][sS][oO][nN][lL],[jJ][sS][oO][nN].[gG][zZ],[jJ][sS][oO][nN][lL].[gG][zZ]}"
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
#: Characters of a malformed line that are kept.
MALFORMED_CHARS = 500


def suffix(name: Column) -> Column:
    """The supported suffix of a file name in lower case; empty for other files."""
    return F.regexp_extract(F.lower(name), r"(\.jsonl?(?:\.gz)?|\.parquet)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)\.(jsonl\.gz|json\.gz|jsonl|json|parquet)$", "")


def path_order(path: Column) -> Column:
    """Sorts paths component by component."""
    return F.split(F.url_decode(path), "/")


def files_under(spark: SparkSession, root: str, endings: tuple[str, ...] = ("",), recursive: bool = True) -> list[tuple[str, int]]:
    """Paths and sizes of the files under a folder, by the file system; file names only reach the driver."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    out, it = [], fs.listFiles(at, recursive)
    while it.hasNext():
        f = it.next()
        name = f.getPath().getName().lower()
        if name.endswith(endings):
            out.append((f.getPath().toString(), f.getLen()))
    return sorted(out, key=lambda x: x[0].split("/"))


def discover(spark: SparkSession, root: str, suffixes: Sequence[str] = SUFFIXES, recursive: bool = True, shard_filter: str | None = None) -> DataFrame:
    """(path, name, suffix, stem, size) of the supported files, whatever the case of their suffix; empty for no folder.

    ``shard_filter`` is a part of the name, or several whole names with commas.
    """
    files = spark.createDataFrame(files_under(spark, root, tuple(suffixes), recursive), "path string, size bigint")
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select("path", name.alias("name"), suffix(name).alias("suffix"), stem(name).alias("stem"), "size")
    return files if not shard_filter else files.where(filtered(F.col("name"), shard_filter))


def filtered(name: Column, shard_filter: str) -> Column:
    if "," in shard_filter:
        return name.isin(*(s.strip() for s in shard_filter.split(",") if s.strip()))
    return name.contains(shard_filter)


def read_lines(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """(raw, _shard, _file, _line_num) of the lines that are not blank, numbered from 0 within their file.

    A line's number is its place among the file's lines: that within its split
    plus the lines of the splits before it, of which there are a few per file.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    reader = reader.option("pathGlobFilter", JSON_GLOB) if isinstance(paths, str) else reader
    lines = reader.text([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("_shard"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"),
    )
    lines = lines.where(F.regexp_replace("raw", f"[{SPACE}]+", "") != "")
    within = Window.partitionBy("_file", "__block").orderBy("__at")
    placed = lines.withColumn("__n", F.row_number().over(within) - 1)
    counts = lines.groupBy("_file", "__block").agg(F.count("*").alias("__c"))
    before = Window.partitionBy("_file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", "__block", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    return placed.join(starts, ["_file", "__block"]).select("raw", "_shard", "_file", (F.col("__before") + F.col("__n")).alias("_line_num"))


def parsed(lines: DataFrame, text_key: str = "text", raw: str = "raw") -> DataFrame:
    """Adds ``text`` and ``status``: ok, missing_text, or malformed for what is not a JSON object."""
    record = F.try_parse_json(raw)
    is_object = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    text = F.try_variant_get(record, f"$.{text_key}", "string")
    status = F.when(~is_object, "malformed").when(text.isNull(), "missing_text").otherwise("ok")
    return lines.select("*", F.when(is_object, text).alias("text"), status.alias("status"))


def read_json(spark: SparkSession, paths: str | Sequence[str], text_key: str = "text") -> DataFrame:
    return parsed(read_lines(spark, paths), text_key)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], text_key: str = "text") -> DataFrame:
    """All columns of Parquet files beside ``text``, ``status``, ``_shard``, ``_file`` and ``_line_num``; only what is used is read."""
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", PARQUET_GLOB) if isinstance(paths, str) else reader
    rows = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    text = F.col(text_key).cast("string") if text_key in rows.columns else F.lit(None).cast("string")
    return rows.select(
        *(c for c in rows.columns if c not in ("text", "status", "_shard", "_file", "_line_num")), text.alias("text"), F.when(text.isNull(), "missing_text").otherwise("ok").alias("status"),
        F.col("_metadata.file_name").alias("_shard"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line_num"),
    )


def read_all(spark: SparkSession, root: str, text_key: str = "text", shard_filter: str | None = None) -> DataFrame:
    """(text, status, raw, _shard, _file, _line_num) of every record under a folder, of either format."""
    files = discover(spark, root, shard_filter=shard_filter).select("path", "suffix").collect()
    json = [r.path for r in files if r.suffix != ".parquet"]
    parquet = [r.path for r in files if r.suffix == ".parquet"]
    common = ("text", "status", "raw", "_shard", "_file", "_line_num")
    parts = []
    if json:
        parts.append(read_json(spark, json, text_key).select(*common))
    if parquet:
        rows = read_parquet(spark, parquet, text_key)
        inner = [c for c in rows.columns if c not in common]
        parts.append(rows.withColumn("raw", F.to_json(F.struct(*inner, F.col("text").alias(text_key)), {"ignoreNullFields": "false"})).select(*common))
    if not parts:
        return spark.createDataFrame([], "text string, status string, raw string, _shard string, _file string, _line_num bigint")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
