"""Compare registered queries with their SQL in DuckDB: `python -m headway.catalog.check DIR [KEY...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(kind: pa.DataType) -> str:
    return "string" if str(kind) in ("string", "large_string", "string_view") else str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    blank = (1, "")
    return sorted(
        zip(*columns),
        key=lambda row: [blank if v is None else (0, f"{v!r}") for v in row],
    )


def _same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(ours: pa.Table, theirs: pa.Table) -> str:
    """Empty when equal, else the first difference."""
    left = {n: _plain(t) for n, t in zip(ours.column_names, ours.schema.types)}
    right = {n: _plain(t) for n, t in zip(theirs.column_names, theirs.schema.types)}
    if left != right:
        return f"schema: {sorted(set(left.items()) ^ set(right.items()))}"
    if ours.num_rows != theirs.num_rows:
        return f"rows: {ours.num_rows} != {theirs.num_rows}"
    names = sorted(left)
    bad, first = 0, ""
    for one, other in zip(_rows(ours), _rows(theirs)):
        if not all(map(_same, one, other)):
            bad += 1
            first = first or str([(n, x, y) for n, x, y in zip(names, one, other) if not _same(x, y)][:4])
    return f"{bad} of {ours.num_rows} rows differ, first: {first}" if bad else ""


def check(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> dict[str, str]:
    from headway.catalog import QUERIES, SQL

    con = connect(sf_dir)
    failures = {}
    for key in keys or QUERIES:
        start = time.time()
        try:
            ours = QUERIES[key](spark, sf_dir).toArrow()
            took = time.time() - start
            verdict = ""
            if key in SQL:
                theirs = con.sql(SQL[key]).to_arrow_table()
                verdict = compare(ours, theirs)
            elif ours.num_rows == 0:
                verdict = "no rows"
        except Exception as error:  # report every failing key, not just the first
            took, verdict, ours = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", None
        state = "FAIL" if verdict else ("ok" if key in SQL else "rows")
        count = "-" if ours is None else ours.num_rows
        print(f"{state:5} {key:28} {count:>8} rows {took:7.2f}s  {verdict}", flush=True)
        if verdict:
            failures[key] = verdict
    return failures


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.exit(1 if check(session(), sys.argv[1], sys.argv[2:]) else 0)
