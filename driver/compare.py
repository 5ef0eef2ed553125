"""Run registered queries next to their oracles and report where the rows differ."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
        result = connection.execute(sql)
        return _normal([column[0] for column in result.description], result.fetchall())


def query_rows(spark: SparkSession, sf_dir: str, query) -> tuple[list[str], Counter]:
    df = query(spark, sf_dir)
    return _normal(df.columns, [tuple(row) for row in df.collect()])


def _normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> tuple[str, int]:
    """An empty text when both sides agree, and the number of rows."""
    columns, got = query_rows(spark, sf_dir, query)
    oracle_columns, expected = oracle_rows(sf_dir, sql)
    if columns != oracle_columns:
        return f"columns {columns} against {oracle_columns}", got.total()
    extra, missing = got - expected, expected - got
    if not extra and not missing:
        # Equal as Python values; equal text makes sure that decimals have the same scale too.
        scales = {str(row) for row in got} ^ {str(row) for row in expected}
        return (f"same values, other scale or type: {sorted(scales)[:2]}" if scales else ""), got.total()
    return (f"{extra.total()} extra, {missing.total()} missing of {expected.total()}; "
            f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"), got.total()


def main(sf_dir: str, *names: str) -> int:
    from driver.registry import ORACLES, QUERIES
    from tallyweave.session import local_session

    spark = local_session(8)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            if name in ORACLES:
                problem, rows = differences(spark, sf_dir, QUERIES[name], ORACLES[name])
            else:
                problem, rows = "", QUERIES[name](spark, sf_dir).count()
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {rows:>9} rows {time.time() - started:6.2f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
