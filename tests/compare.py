"""Runs registered queries next to their SQL and compares schemas and row multisets.

    python -m tests.compare 0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def _rows(table: pa.Table) -> Counter:
    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return Counter(zip(*(map(repr, column) for column in columns)))


def difference(actual: pa.Table, expected: pa.Table) -> str | None:
    """What tells the two results apart, or None."""
    kinds = [{f.name: _kind(f.type) for f in table.schema} for table in (actual, expected)]
    if kinds[0] != kinds[1]:
        odd = {name: (kinds[0].get(name), kinds[1].get(name)) for name in kinds[0].keys() | kinds[1].keys()}
        return f"schema {({name: pair for name, pair in odd.items() if pair[0] != pair[1]})}"
    if actual.num_rows != expected.num_rows:
        return f"rows {actual.num_rows} != {expected.num_rows}"
    left, right = _rows(actual), _rows(expected)
    if left != right:
        extra, missing = left - right, right - left
        return f"{sum(extra.values())} rows differ, {list(extra)[:2]} instead of {list(missing)[:2]}"
    return None


def main() -> None:
    import __spark_entry__ as driver
    from tripmart.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    connection, oracles = connect(sf_dir), driver.oracle_sql()
    for name, make in driver.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            actual = make(spark, sf_dir).toArrow()
            took = time.time() - started
            found = "no oracle" if name not in oracles else difference(
                actual, connection.sql(oracles[name]).to_arrow_table()
            )
        except Exception as error:  # noqa: BLE001
            took, found = time.time() - started, f"failed: {str(error)[:700]}"
        print(f"{name:28s} {took:7.2f}s  {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
