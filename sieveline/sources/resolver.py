"""Which kind of source a string names, and how to get at it.

Hubs and code hosts are fetched by what the caller plugs in: a fetcher takes
the source and returns a folder. None is built in, so nothing here needs a
network.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forms of names that repositories have.
CODE_HOST = r"^https?://github\.com/[^/]+/[^/]+"
HUB_NAME = r"^(https?://huggingface\.co/(datasets/)?)?[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+$"


def source_type(source: str) -> str:
    """local, huggingface or github."""
    if re.match(CODE_HOST, source):
        return "github"
    if Path(source).exists():
        return "local"
    is_hub = re.match(HUB_NAME, source) or "/" in source and source.startswith("http")
    return "huggingface" if is_hub else "local"


def source_type_of(source: Column) -> Column:
    """The same for a column, for strings that name no local path."""
    is_hub = source.rlike(HUB_NAME) | source.contains("/") & source.startswith("http")
    return F.when(source.rlike(CODE_HOST), "github").when(is_hub, "huggingface").otherwise("local")


Fetcher = Callable[["Source"], str]


@dataclass(frozen=True)
class Source:
    kind: str
    where: str
    token: str | None = None
    cache_dir: str | None = None

    def prepare(self, fetchers: dict[str, Fetcher] | None = None) -> str:
        """The local folder of the source's files."""
        if self.kind == "local":
            path = Path(self.where)
            if not path.exists():
                raise FileNotFoundError(self.where)
            if not path.is_dir():
                raise NotADirectoryError(self.where)
            return str(path)
        fetch = (fetchers or {}).get(self.kind)
        if fetch is None:
            raise NotImplementedError(f"no fetcher for {self.kind} sources is plugged in")
        return fetch(self)


def resolve(input_dir: str | None = None, input_repo: str | None = None, token: str | None = None, cache_dir: str | None = None) -> Source:
    """The repository if one is named, else the folder."""
    if input_repo:
        return Source(source_type(input_repo), input_repo, token, cache_dir)
    if input_dir:
        return Source("local", input_dir)
    raise ValueError("neither an input folder nor a repository is named")
