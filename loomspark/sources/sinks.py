"""Writers: everything is first written beside its place and then moved there, the manifest last."""

from __future__ import annotations

import csv
import json
import os
import re
import secrets
import shutil
import time
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions import exprs as E
from ..operators import screening


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """A table; partition_by lets later reads skip whole sites."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """By the path's ending: CSV with a header, JSON lines, ORC or Parquet; always a folder of part files."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    writer = df.write.mode(mode)
    {"csv": lambda: writer.csv(path, header=True, escape='"'), "json": lambda: writer.json(path), "orc": lambda: writer.orc(path)}.get(kind, lambda: writer.parquet(path))()


def write_register(spark: SparkSession, log: Sequence[screening.Decision], path: str) -> str:
    """The whole log, and its digest beside it."""
    screening.frame(spark, log).coalesce(1).write.mode("overwrite").parquet(path)
    digest = screening.digest(log)
    spark.createDataFrame([(len(log), log[-1].id if log else "", digest)], "rows long, last_id string, digest string").coalesce(1).write.mode("overwrite").json(path.rstrip("/") + ".digest.json")
    return digest


def write_names(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """A list of new parameters, for whoever keeps the catalog."""
    spark.createDataFrame([(n,) for n in sorted(set(names))], "Parameter string").coalesce(1).write.mode("overwrite").csv(path, header=True)


def run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now(UTC)):%Y%m%dT%H%M%S}-{secrets.token_hex(3)}"


def promote(staging: Path, destination: Path, tries: int = 10, wait: float = 0.5) -> None:
    """Renames a finished folder into place; a lock that passes is waited for."""
    if destination.exists():
        raise FileExistsError(f"{destination} is there already")
    for k in range(tries):
        try:
            os.replace(staging, destination)
            return
        except PermissionError:
            if k + 1 == tries:
                raise
            time.sleep(wait)


class Package:
    """A run's folder on the driver: small tables, JSON and text. Large tables go by write_table to where all can read."""

    def __init__(self, root: str | Path, name: str, identifier: str | None = None) -> None:
        self.id = identifier or run_id()
        self.destination = Path(root) / name / self.id
        self.staging = self.destination.with_name(f".{self.id}.staging")
        self.staging.mkdir(parents=True)
        self.written: list[str] = []

    def path(self, name: str) -> Path:
        """Within the package, whatever the name says."""
        found = (self.staging / name).resolve()
        if not found.is_relative_to(self.staging.resolve()):
            raise ValueError(f"{name}: outside the package")
        found.parent.mkdir(parents=True, exist_ok=True)
        if name not in self.written:
            self.written.append(name)
        return found

    def text(self, name: str, text: str) -> None:
        self.path(name).write_text(text, encoding="utf-8")

    def json(self, name: str, value: object) -> None:
        self.text(name, json.dumps(value, indent=2, sort_keys=True, allow_nan=False, default=str) + "\n")

    def rows(self, name: str, rows: Sequence[dict], columns: Sequence[str] | None = None) -> None:
        columns = list(columns or (rows[0] if rows else ()))
        with self.path(name).open("w", newline="", encoding="utf-8") as f:
            out = csv.DictWriter(f, columns, extrasaction="ignore")
            out.writeheader()
            out.writerows(rows)

    def frame(self, name: str, df: DataFrame, order: Sequence[str] = (), most_rows: int = 1_000_000) -> int:
        """One CSV file of a task's table, streamed row by row; a table beyond most_rows belongs in write_table."""
        rows = 0
        with self.path(name).open("w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(df.columns)
            for r in (df.orderBy(*map(E.c, order)) if order else df).toLocalIterator():
                rows += 1
                if rows > most_rows:
                    raise ValueError(f"{name}: more than {most_rows} rows; write it as a table")
                out.writerow(["" if v is None else v for v in r])
        return rows

    def complete(self) -> Path:
        promote(self.staging, self.destination)
        return self.destination

    def fail(self) -> Path:
        """The unfinished folder stays for inspection."""
        kept = self.destination.with_name(f"{self.id}.failed")
        shutil.move(self.staging, kept)
        return kept


@contextmanager
def package(root: str | Path, name: str, identifier: str | None = None):
    found = Package(root, name, identifier)
    try:
        yield found
    except BaseException:
        found.fail()
        raise
    found.complete()


def upload(files: dict[str, Path], folder: Path) -> list[Path]:
    """All files or none: copied beside their places first, then renamed."""
    folder.mkdir(parents=True, exist_ok=True)
    stage = folder / f".staging-{secrets.token_hex(4)}"
    stage.mkdir()
    try:
        for name, source in files.items():
            if not re.fullmatch(r"[\w .()-]+", name):
                raise ValueError(f"{name!r} isn't a file name")
            shutil.copyfile(source, stage / name)
        for name in files:
            os.replace(stage / name, folder / name)
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return [folder / n for n in files]


def page(payload: dict, title: str = "Report") -> str:
    """A report's payload in a page of its own, which shows its blocks without any other file."""
    data = json.dumps(payload, allow_nan=False, default=str).replace("</", "<\\/")
    script = "const d=JSON.parse(document.getElementById('payload').textContent);const draw=(b,e)=>{for(const x of b){const n=document.createElement(x.kind==='table'?'table':x.kind==='code'?'pre':x.kind==='heading'?'h2':'p');if(x.kind==='table'){for(const r of [x.headers,...x.rows]){const t=n.insertRow();for(const c of r)t.insertCell().textContent=c??''}}else n.textContent=x.text??'';e.append(n);if(x.children)draw(x.children,e)}};draw(d.blocks,document.body);"
    return f'<!doctype html><meta charset="utf-8"><title>{title}</title><script type="application/json" id="payload">{data}</script><body><script>{script}</script></body>'


def payload_of(html: str) -> dict:
    return json.loads(re.search(r'id="payload">(.*?)</script>', html, re.DOTALL)[1])
