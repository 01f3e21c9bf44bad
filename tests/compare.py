"""Compare a Spark result with DuckDB's, rows as a multiset, columns by name."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def norm(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("+00:00", "")[:26]
    if isinstance(v, bool):
        return int(v)
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def same(df, con, sql: str) -> tuple[bool, str]:
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3]
        return False, f"rows {sum(got[1].values())} vs {sum(want[1].values())}; only ours {a}; only oracle {b}"
    return True, f"{sum(got[1].values())} rows"
