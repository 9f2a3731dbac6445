"""The record of a run's files and shards, as one small JSON file that is replaced whole."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession

from ..plans import storage


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass
class Manifest:
    path: str
    processed_files: list[str] = field(default_factory=list)
    produced_shards: list[str] = field(default_factory=list)
    uploaded_shards: list[str] = field(default_factory=list)
    errors: list[dict[str, str]] = field(default_factory=list)
    version: int = 1
    created_at: str = field(default_factory=_now)
    updated_at: str = field(default_factory=_now)

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> Manifest:
        """What the file holds; a fresh one if there is none or it is broken. With a session, on any file system."""
        try:
            if spark is not None and not storage.exists(spark, path):
                return cls(path)
            held = json.loads(Path(path).read_text(encoding="utf-8") if spark is None else storage.read_file(spark, path))
            return cls(path, **{k: held[k] for k in ("processed_files", "produced_shards", "uploaded_shards", "errors", "version", "created_at", "updated_at") if k in held})
        except (OSError, ValueError, TypeError):
            return cls(path)

    def save(self, spark: SparkSession | None = None) -> None:
        self.updated_at = _now()
        held = asdict(self)
        for k in ("processed_files", "produced_shards", "uploaded_shards"):
            held[k] = sorted(set(held[k]))
        del held["path"]
        text = json.dumps(held, ensure_ascii=False, indent=2)
        if spark is not None:
            storage.write_file(spark, self.path, text)
            return
        at = Path(self.path)
        at.parent.mkdir(parents=True, exist_ok=True)
        new = at.with_suffix(at.suffix + ".tmp")
        new.write_text(text, encoding="utf-8")
        new.replace(at)

    def mark(self, state: str, name: str) -> None:
        """state: processed_files, produced_shards or uploaded_shards."""
        if name not in getattr(self, state):
            getattr(self, state).append(name)

    def record_error(self, file: str, error: str) -> None:
        self.errors.append({"file": file, "error": error, "timestamp": _now()})

    def counts(self) -> dict[str, int]:
        return {k: len(getattr(self, k)) for k in ("processed_files", "produced_shards", "uploaded_shards", "errors")}
