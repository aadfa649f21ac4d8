"""Runs registered queries and their statements side by side: `python -m checks.compare SF_DIR [name part ...]`."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(value):
    if isinstance(value, float):
        return None if value != value else ("f", round(value, 9) + 0.0)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (datetime.date, datetime.datetime, decimal.Decimal)):
        return ("other", str(value))
    return value


def compare(spark, con, name, fn, sql, sf):
    df = fn(spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    if sql is None:
        return f"rows only {len(got)}", True
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != cols:
        return f"columns differ: spark {sorted(set(cols) - set(names))} sql {sorted(set(names) - set(cols))}", False
    at = [names.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in at) for r in res.fetchall()), key=repr)
    if got == want:
        return f"ok {len(got)}", True
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b]
            return f"differ: rows {len(got)} / {len(want)}; first {bad[:4]}", False
    return f"differ: rows {len(got)} / {len(want)}", False


def main() -> int:
    from matchloom.session import local_session

    from .all import QUERIES, SQL

    sf, parts = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            note, good = compare(spark, con, name, fn, SQL.get(name), sf)
        except Exception as error:  # noqa: BLE001 - report and go on
            note, good = f"error {type(error).__name__}: {str(error)[:400]}", False
        failed += not good
        if not good or "-v" in parts or time.time() - start > 8:
            print(f"{'ok ' if good else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("queries", len(QUERIES), "with SQL", len(SQL), "failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
