"""Run every query against its SQL and compare rows, schema and values.

    python tests/parity.py /root/testdata/sf0.01 [query …]
"""

from __future__ import annotations

import hashlib
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Column types that count as equal across the engines.
KINDS = {
    "int8": "int", "int16": "int", "int32": "int", "int64": "int",
    "float": "float", "double": "float", "string": "text", "large_string": "text", "bool": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    return repr(v)


def digest(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    return Counter(
        hashlib.md5("\x1f".join(_value(v) for v in row).encode()).hexdigest() for row in zip(*columns)
    )


def compare(spark_table, sql_table) -> list[str]:
    problems = []
    if sorted(spark_table.column_names) != sorted(sql_table.column_names):
        return [f"columns {sorted(spark_table.column_names)} / {sorted(sql_table.column_names)}"]
    for name in spark_table.column_names:
        a, b = str(spark_table.schema.field(name).type), str(sql_table.schema.field(name).type)
        if a != b:
            level = "type" if KINDS.get(a, a) != KINDS.get(b, b) else "note: type"
            problems.append(f"{level} {name}: {a} / {b}")
    if spark_table.num_rows != sql_table.num_rows:
        problems.append(f"rows {spark_table.num_rows} / {sql_table.num_rows}")
    left, right = digest(spark_table), digest(sql_table)
    if left != right:
        problems.append(f"values: {sum((left - right).values())} rows differ")
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from corpusq.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        result = query(spark, sf_dir).toArrow()
        took = time.time() - start
        if name not in oracles:
            print(f"{name:28s} {result.num_rows:7d} rows only {took:6.2f}s", flush=True)
            continue
        start = time.time()
        try:
            problems = compare(result, con.execute(oracles[name]).to_arrow_table())
        except duckdb.Error as error:
            problems = [f"sql: {str(error)[:400]}"]
        bad = [p for p in problems if not p.startswith("note")]
        failed += bool(bad)
        print(f"{name:28s} {result.num_rows:7d} {took:6.2f}s sql {time.time() - start:6.2f}s "
              f"{'FAIL' if bad else 'ok'} {'; '.join(problems)}", flush=True)  # fmt: skip
    print(f"{failed} failed; queries without SQL: {sorted(set(entry.queries()) - set(oracles))}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
