"""Run the registered queries and their SQL side by side: ``compare_with_sql.py SF_DIR [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def compare(spark, con, sf_dir: str, name: str) -> str:
    started = time.time()
    result = contract.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in result.collect()]
    took = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return f"rows  {name}: {len(got)} rows, no SQL ({took:.1f}s)"
    answer = con.execute(sql)
    columns = [c[0] for c in answer.description]
    want = answer.fetchall()
    if sorted(columns) != sorted(result.columns):
        return f"FAIL  {name}: columns {sorted(result.columns)} instead of {sorted(columns)}"
    left, right = rows_of(result.columns, got), rows_of(columns, want)
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        return (
            f"FAIL  {name}: {len(left)} rows, SQL {len(right)}; {sorted(columns)}\n"
            f"    spark {str(only_left)[:900]}\n    sql   {str(only_right)[:900]}"
        )
    return f"ok    {name}: {len(left)} rows ({took:.1f}s)"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    failed = 0
    for name in names or contract.queries():
        try:
            line = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            line = f"FAIL  {name}: {type(error).__name__} {str(error)[:700]}"
        failed += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
