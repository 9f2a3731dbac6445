"""Bulk upload of finished files through a sink, and what is told of it."""

from __future__ import annotations

import fnmatch
import logging
import math
import os
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from ..streaming.manifest import Manifest
from .files import files_under
from .sinks import Sink

log = logging.getLogger("sieveline")


def log_to(path: str | None = None, level: int = logging.INFO) -> None:
    """Log lines to the terminal and, if one is named, to a file."""
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if path:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    log.setLevel(level)
    log.handlers.clear()
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)


def format_size(n: int) -> str:
    if n <= 0:
        return "0 B"
    power = min(int(math.log(n, 1024)), 4)
    return f"{n / 1024**power:.2f} {('B', 'KB', 'MB', 'GB', 'TB')[power]}"


def default_workers() -> int:
    """As many as there are cores, from 8 to 64."""
    return min(64, max(8, os.cpu_count() or 8))


def matching(spark: SparkSession, root: str, patterns: Sequence[str] = ("*.jsonl",)) -> list[tuple[str, int]]:
    """(path, size) of the files under a folder whose name fits one of the patterns; a file counts once."""
    return [(path, size) for path, size in files_under(spark, root) if any(fnmatch.fnmatch(path.rsplit("/", 1)[-1], p) for p in patterns)]


def collect_stats(spark: SparkSession, root: str, patterns: Sequence[str] = ("*.jsonl",)) -> tuple[int, int]:
    """How many files there are, and their bytes."""
    found = matching(spark, root, patterns)
    return len(found), sum(size for _, size in found)


def progress(done: int, total: int, elapsed: float) -> dict[str, float]:
    """Share done, seconds for one and seconds to go."""
    rate = done / elapsed if elapsed > 0 else 0.0
    return {"share": done / total if total else 1.0, "seconds_each": 1 / rate if rate else 0.0, "eta": (total - done) / rate if rate else 0.0}


def upload(spark: SparkSession, root: str, sink: Sink, patterns: Sequence[str] = ("*.jsonl",), workers: int | None = None, manifest: Manifest | None = None) -> dict[str, object]:
    """Give every file that the manifest does not call uploaded to the sink, several at a time."""
    found = matching(spark, root, patterns)
    rest = [p for p, _ in found if manifest is None or p not in manifest.uploaded_shards]
    began = time.time()

    def done() -> Iterator[tuple[str, bool]]:
        with ThreadPoolExecutor(workers or default_workers()) as pool:
            yield from zip(rest, pool.map(sink.write_shard, rest), strict=True)

    for i, (path, ok) in enumerate(done(), 1):
        if manifest is not None:
            if ok:
                manifest.mark("uploaded_shards", path)
            else:
                manifest.record_error(path, "upload failed")
        p = progress(i, len(rest), time.time() - began)
        log.info("%d/%d files (%.1f%%), %.1f s each, %.0f s to go", i, len(rest), 100 * p["share"], p["seconds_each"], p["eta"])
    if manifest is not None:
        manifest.save(spark)
    return {"files": len(found), "size": format_size(sum(n for _, n in found)), "sent": len(rest)} | sink.stats()
