"""Compare a Spark result with its DuckDB oracle: names, row count, values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(int(v)) if v.is_integer() and abs(v) < 1e15 else repr(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got_names = df.columns
    got = _rows(got_names, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = _rows(want_names, cur.fetchall())
    types = {d[0]: str(d[1]) for d in cur.description}
    bad = {n: t for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t or "[]" in t}
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if bad:
        return f"oracle types {bad}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only spark {[r for r in got if r not in set(want)][:2]}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(pairs)} rows differ on {sorted(got_names)}: {str(pairs[0])[:1500]}"
    return None
