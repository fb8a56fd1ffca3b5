"""Compare registered queries with their SQL statements. ``python tests/oracle.py SF [name...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def compare(spark, con, folder: str, query, statement: str) -> str:
    """Empty if both sides agree, else what differs."""
    df = query(spark, folder)
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(statement)
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}
    for name, kind in df.dtypes:
        if names.get(types[name]) != kind:
            return f"type of {name}: {kind} != {types[name]}"
    if mine[1] != theirs[1]:
        only = [r for r in mine[1] if r not in set(theirs[1])][:3]
        other = [r for r in theirs[1] if r not in set(mine[1])][:3]
        return f"{len(mine[1])} rows, {len(theirs[1])} expected; ours only {only}; expected only {other}"
    return ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    data = f"/root/testdata/sf{sys.argv[1]}"
    con = connect(data)
    statements = oracle_sql()
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        started = time.time()
        try:
            problem = compare(spark, con, data, queries()[name], statements[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - started:.1f}s {problem}", flush=True)
