"""Run a query and its oracle over the same tables and compare the rows, whatever their order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 4) + 0.0
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple((v is None, str(type(v).__name__ in ("int", "float")), str(v)) for v in r))


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def difference(df, sf_dir: str, sql: str) -> str:
    names, data = oracle(sf_dir, sql)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got, want = rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, data)
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; first {got[:1]} {want[:1]}"
    odd = [(a, b) for a, b in zip(got, want, strict=True) if any(x != y and not (isinstance(x, (int, float)) and isinstance(y, (int, float)) and abs(x - y) <= 1.5e-4 * max(1, abs(y))) for x, y in zip(a, b, strict=True))]
    return f"{len(odd)} of {len(got)} rows differ: {sorted(df.columns)} {odd[:2]}" if odd else ""
