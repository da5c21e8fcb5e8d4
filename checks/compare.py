"""Run registered queries against their SQL: ``python -m checks.compare DIR [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, query, sql, sf_dir) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    start = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    note = f"{len(mine[1])} rows, spark {took:.2f}s, sql {time.time() - start:.2f}s"
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} != {theirs[0]}"
    if mine[1] != theirs[1]:
        extra = [r for r in mine[1] if r not in set(theirs[1])][:2]
        missing = [r for r in theirs[1] if r not in set(mine[1])][:2]
        return False, f"{note}; {len(theirs[1])} expected\n  only spark: {extra}\n  only sql: {missing}"
    return True, note


def main() -> None:
    from checks.oracle import statements
    from checks.queries import registered
    from checks.sessions import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare"), connect(sf_dir)
    failed = []
    for name, query in registered().items():
        if wanted and name not in wanted:
            continue
        sql = statements().get(name)
        if sql is None:
            print(f"{name}: no sql, {len(query(spark, sf_dir).collect())} rows", flush=True)
            continue
        try:
            ok, note = compare(spark, con, query, sql, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += [] if ok else [name]
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print("failed:", failed or "none")


if __name__ == "__main__":
    main()
