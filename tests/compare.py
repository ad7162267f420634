"""Run registered queries and their SQL side by side: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tzinfo"):
        return str(v.replace(tzinfo=None))
    if v is not None and type(v).__name__ == "Decimal":
        return float(round(v, 6))
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    ours, theirs = _bag(df.columns, df.collect()), _bag(rel.columns, rel.fetchall())
    if ours == theirs:
        return None
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}\n   only ours: "
        f"{list((ours - theirs).items())[:3]}\n   only sql:  {list((theirs - ours).items())[:3]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from tessera.session import build

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = build("compare"), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = f"rows only: {df.count()}" if sql is None else difference(df, con, sql)
        except Exception as err:  # noqa: BLE001
            problem = f"{type(err).__name__}: {str(err)[:1500]}"
        bad += bool(problem) and sql is not None
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}")
    print(f"{bad} of {len(names)} differ")


if __name__ == "__main__":
    main()
