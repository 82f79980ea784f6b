"""Compare registered queries with their SQL counterparts in DuckDB.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    names, rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    want_names, want = [d[0] for d in rel.description], rel.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    a, b = canonical_rows(names, rows), canonical_rows(want_names, want)
    if a == b:
        return None
    left, right = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
    return f"{len(a)} rows vs {len(b)}; {sorted(names)}\n   spark: {left}\n   duck:  {right}"


def main(argv: list[str]) -> int:
    from firmloom.session import local_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf_dir, argv = argv[1], argv[2:]
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if argv and name not in argv:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                problem = differences(df, con, sql[name])
            else:
                problem = None if df.collect() is not None else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:32s} {time.time() - start:6.2f}s {'' if name in sql else '(rows only) '}{problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
