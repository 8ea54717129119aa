"""Holds a query's rows against its SQL's, as sets of rows by column name."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def expected(sql: str, sf: str) -> tuple[list[str], Counter]:
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = c.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), Counter(_row(dict(zip(names, r))) for r in found.fetchall())


def got(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), Counter(_row(r.asDict()) for r in df.collect())


def _row(r: dict) -> tuple:
    return tuple((k, float(v) + 0.0 if isinstance(v, float) else int(v) if isinstance(v, bool) else v) for k, v in sorted(r.items()))
