"""Compare registered queries with their SQL: ``python -m tests.oracle_check [sf] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TESTDATA = Path("/root/testdata")


TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the query's rows and the SQL's; empty if nothing does."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} != {sorted(relation.columns)}"]
    theirs_type = dict(zip(relation.columns, map(str, relation.types)))
    types = [f"{n}: {t} is {theirs_type[n]}" for n, t in df.dtypes if TYPES.get(t) != theirs_type[n]]
    if types:
        return types
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if not ours:
        return ["no rows"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    return [f"{a} != {b}" for a, b in zip(ours, theirs) if repr(a) != repr(b)][:3]


def main(sf: str = "0.01", names: list[str] | None = None) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{sf}"
    con, sql, failed = connection(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, con, sql[name]) if name in sql else []
            kind = "sql" if name in sql else f"{df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found, kind = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name:22} {kind:9} {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("     ", line[:700], flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:2], names=sys.argv[2:]))
