"""Run the queries and their SQL side by side: ``python -m checks.compare SF_DIR [names...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, Decimal):
        return str(value)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, fn, sql):
    """None where both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if ours[1] else "no rows"
    con.execute(sql)
    theirs = sorted_rows([d[0] for d in con.description], con.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    if ours[1] != theirs[1]:
        first = next((a, b) for a, b in zip(ours[1], theirs[1]) if a != b)
        return f"values, for instance {first}"
    return None


def main(sf_dir, *names):
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from strata.scratch import drop_scratch
    from strata.session import build_session

    spark = build_session("compare", "local[8]", 8, **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            found = compare(spark, con, sf_dir, QUERIES[name], ORACLE.get(name))
        except Exception as error:  # report it and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:34s} {time.time() - began:6.2f}s  {found or 'ok'}", flush=True)
    drop_scratch(spark)
    missing = set(QUERIES) - set(ORACLE), set(ORACLE) - set(QUERIES)
    print(f"{bad} differ; without SQL: {sorted(missing[0])}; without query: {sorted(missing[1])}")


if __name__ == "__main__":
    main(*sys.argv[1:])
