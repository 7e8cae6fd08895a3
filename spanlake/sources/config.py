"""Settings from the environment and .env files, paths named in prompts, and liveness of services."""

from __future__ import annotations

import os
import re
import urllib.request
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import chunks

#: Replies of a living service, characters of a sample.
ALIVE = {"true", "1", "alive", ""}
SAMPLE_CHARS = 2000
_PATH = re.compile(r"(?<![\w/])(?:~|\.{1,2})?/?(?:[\w.\-]+/)+[\w.\-]*|(?<!\S)[\w\-]+\.(?:pdf|txt|md|json)\b")


def load_env(path: str | Path = ".env") -> dict[str, str]:
    """NAME=value lines of a file into the environment, without overriding what is set; what was added."""
    added = {}
    if Path(path).is_file():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, eq, value = line.strip().removeprefix("export ").partition("=")
            name = name.strip()
            if eq and name and not name.startswith("#") and name not in os.environ:
                os.environ[name] = added[name] = value.strip().strip("'\"")
    return added


def env_int(name: str, default: int) -> int:
    """A number from the environment; the default where it is missing or no number."""
    try:
        return int(os.environ.get(name, ""))
    except ValueError:
        return default


def path_in(prompt: str) -> str:
    """The first existing path that a prompt names; fails with the first one named if none exists."""
    named = [os.path.expanduser(m.group()) for m in _PATH.finditer(prompt)]
    for p in named:
        if os.path.exists(p):
            return os.path.abspath(p)
    if named:
        raise FileNotFoundError(named[0])
    raise ValueError("the prompt names no path")


def sample(spark: SparkSession, path: str, chars: int = SAMPLE_CHARS, parser: Callable[[bytes], str] | None = None) -> tuple[str, str]:
    """(path, text) of the first chunk or text file under a path, without header, cut to `chars`; where there are only PDFs, of the first of them by a parser, without which it fails."""
    from ..functions import text as tx

    try:
        first = chunks.discover(spark, path).select("path", F.substring(tx.strip(chunks.body(F.col("value"))), 1, chars).alias("text")).orderBy("path").first()
        return first.path, first.text
    except FileNotFoundError:
        place = chunks.pdfs(spark, path).agg(F.min("path").alias("path")).first().path
        pdf = chunks.pdfs(spark, path).where(F.col("path") == place).first()
    if parser is None:
        raise ValueError(f"{pdf.path} is a PDF: chunk it first, or name a parser")
    return pdf.path, parser(bytes(pdf.content)).strip()[:chars]


def service_alive(url: str, timeout: float = 5.0, any_body: bool = False) -> bool:
    """Whether a service answers 200 with a body that says it lives; with `any_body`, whatever it says."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.status == 200 and (any_body or r.read(64).decode("utf-8", "replace").strip().lower() in ALIVE)
    except (OSError, ValueError):
        return False
