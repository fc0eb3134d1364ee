"""Run registered queries on Spark and DuckDB and compare them.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from checks.registry import ORACLES, QUERIES


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def duck_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def differences(spark, sf_dir: str, name: str) -> list[str]:
    """What the two engines disagree on; empty when they agree."""
    df = QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    spark_rows = sorted((tuple(r) for r in df.select(*order).collect()), key=_sortable)
    names, rows = duck_rows(sf_dir, ORACLES[name])
    if sorted(names) != order:
        return [f"columns {order} against {sorted(names)}"]
    at = [names.index(c) for c in order]
    expected = sorted((tuple(r[i] for i in at) for r in rows), key=_sortable)
    found = []
    if len(spark_rows) != len(expected):
        found.append(f"{len(spark_rows)} rows against {len(expected)}")
    for mine, theirs in zip(spark_rows, expected):
        if mine != theirs:
            found += [f"{c}: {a!r} against {b!r}" for c, a, b in zip(order, mine, theirs) if a != b]
            break
    return found


def main(args: list[str]) -> int:
    from lumentide.session import build_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("compare", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'differs' if found else 'ok':8}{name} {time.time() - start:.1f}s", *found,
              sep="\n    " if found else "", flush=True)
    print(f"{bad} of {len(args[1:] or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
