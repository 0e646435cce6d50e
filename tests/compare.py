"""Run queries next to their DuckDB SQL and compare whole results.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return db


def _rows(table) -> tuple[list[tuple[str, str]], Counter]:
    """Columns with types, sorted by name, and the rows as a multiset."""
    names = sorted(table.column_names)
    kinds = []
    for name in names:
        kind = str(table.schema.field(name).type)
        kinds.append((name, kind.replace("large_string", "string")))
    columns = [table.column(name).to_pylist() for name in names]
    return kinds, Counter(zip(*columns))


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when schema, row count and values are equal."""
    spark_kinds, spark_rows = _rows(result.toArrow())
    duck_kinds, duck_rows = _rows(db.sql(sql).to_arrow_table())
    if spark_kinds != duck_kinds:
        return f"schema: {spark_kinds} != {duck_kinds}"
    if spark_rows != duck_rows:
        only_spark = list((spark_rows - duck_rows).items())[:3]
        only_duck = list((duck_rows - spark_rows).items())[:3]
        return (
            f"rows: {spark_rows.total()} vs {duck_rows.total()},"
            f" spark only {only_spark}, duckdb only {only_duck}"
        )
    return "" if spark_rows else "both results are empty"


def main(sf_dir: str, wanted: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracle, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            if name in oracle:
                problem = differences(result, db, oracle[name])
            else:
                problem = "" if result.count() else "empty"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
