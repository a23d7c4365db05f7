"""Compare a query's rows with those of its SQL, as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    """Values as they are; only NaN needs a form that equals itself."""
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = _bag(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = _bag(df.columns, [tuple(r) for r in df.collect()])
    return [f"{n}x spark only {r}" for r, n in list((actual - expected).items())[:4]] + [
        f"{n}x sql only {r}" for r, n in list((expected - actual).items())[:4]]
