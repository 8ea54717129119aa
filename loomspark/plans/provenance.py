"""Where a result comes from: digests of tables, files and settings, versions and the state of the code."""

from __future__ import annotations

import hashlib
import json
import platform
import subprocess
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E

RECORDED = ("spark.sql.ansi.enabled", "spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")


def frame_digest(df: DataFrame) -> str:
    """The same for the same rows in any order: count and sums of two hashes of each row, over columns by name."""
    row = [E.c(c) for c in sorted(df.columns)]
    found = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*row).cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(1), *row).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((sorted(df.dtypes), tuple(map(str, found)))).encode()).hexdigest()


def file_sha256(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def config_digest(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def environment(spark: SparkSession | None = None) -> dict:
    found = {"python": platform.python_version(), "pyspark": pyspark.__version__, "platform": platform.platform()}
    if spark:
        found |= {k: spark.conf.get(k, None) for k in RECORDED}
    return found


def commit(folder: str | Path = ".") -> dict:
    """The code's commit and whether it has changes; unknown without git or a repository."""
    def git(*args: str) -> str | None:
        try:
            done = subprocess.run(["git", "-C", str(folder), *args], capture_output=True, text=True, timeout=5)
        except (OSError, subprocess.TimeoutExpired):
            return None
        return done.stdout.strip() if done.returncode == 0 else None

    head, status = git("rev-parse", "HEAD"), git("status", "--porcelain")
    return {"commit": head, "changed": None if status is None else bool(status)}


def capture(spark: SparkSession, sources: list[dict], config: dict, seed: int = 0, folder: str | Path = ".") -> dict:
    return {"sources": sources, "config_digest": config_digest(config), "seed": seed, "environment": environment(spark), "code": commit(folder)}
