"""Runs a query's SQL in DuckDB over the same tables and compares rows as multisets."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(v)
    return v


def compared(df, sql: str, sf_dir: str) -> tuple[list, list]:
    names, rows = rows_of(sql, sf_dir)
    order = sorted(names)
    assert sorted(df.columns) == order, (sorted(df.columns), order)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=key)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rows), key=key)
    return mine, theirs
