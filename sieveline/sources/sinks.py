"""Writers of kept, rejected and malformed records, reports, and finished shards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON = {"ignoreNullFields": "false"}


def kept_json(raw: Column, text: Column, text_key: str = "text") -> Column:
    """The record's JSON with its text replaced; other keys stay where they are, nulls included. A record is parsed once."""
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    value = lambda e: F.when(e["key"] == text_key, quoted(text)).otherwise(F.coalesce(F.to_json(e["value"]), F.lit("null")))
    members = F.transform(F.map_entries(F.from_json(raw, "map<string,variant>")), lambda e: F.concat(quoted(e["key"]), F.lit(":"), value(e)))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def rejected(decided: DataFrame) -> DataFrame:
    return decided.where("decision = 'reject' and status = 'ok'").select(
        F.substring("text", 1, 500).alias("text"), F.col("reasons").alias("_rejection_reasons"), F.col("quality_score").alias("_quality_score"), "_shard", "_line_num"
    )


def malformed(decided: DataFrame) -> DataFrame:
    return decided.where("status = 'malformed'").select(
        F.substring("raw", 1, 500).alias("text"), F.array(F.lit("malformed_json")).alias("_rejection_reasons"), F.lit(None).cast("double").alias("_quality_score"),
        F.lit(None).cast("string").alias("_shard"), "_line_num",
    )


def write_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**JSON).partitionBy(*partition_by).json(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


Upload = Callable[[str], None]


@dataclass
class Sink:
    """Where finished shards go: they stay in a folder, or an uploader that is plugged in takes each.

    A shard counts as done only once its upload has returned.
    """

    kind: str
    where: str
    upload: Upload | None = None
    done: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)

    def write_shard(self, path: str) -> bool:
        if self.kind != "local":
            if self.upload is None:
                raise NotImplementedError(f"no uploader for {self.kind} sinks is plugged in")
            try:
                self.upload(path)
            except Exception:  # noqa: BLE001 - whatever the uploader raises, the shard is not done
                self.failed.append(path)
                return False
        self.done.append(path)
        return True

    def stats(self) -> dict[str, object]:
        return {"type": self.kind, "where": self.where, "shards": len(self.done), "failed": len(self.failed)}


def resolve(output_dir: str | None = None, output_repo: str | None = None, upload: Upload | None = None) -> Sink:
    if output_repo:
        return Sink("huggingface", output_repo, upload)
    if output_dir:
        return Sink("local", output_dir)
    raise ValueError("neither an output folder nor a repository is named")
