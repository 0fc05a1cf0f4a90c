"""Compare registered queries with their SQL in DuckDB, as sorted rows of equal columns."""

from __future__ import annotations

import datetime
import decimal
import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, db, sf_dir, query, sql) -> str:
    """'' when equal, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(got_columns, a, b) if x != y]
            return f"first difference {cells[:4]} in {a[:6]}"
    return ""


def main() -> None:
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from hindsight.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, db = local_session(8), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name, query in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            verdict = compare(spark, db, sf_dir, query, sql[name]) if name in sql else f"rows {query(spark, sf_dir).count()}"
        except Exception as error:  # report all of them
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:38} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
