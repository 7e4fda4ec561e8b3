"""Run registered queries next to their SQL on DuckDB and compare whole results.

    python -m tests.oracle [--sf DIR] [name ...]
"""

import argparse
import math
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _kind(type_name: str) -> str:
    name = type_name.lower()
    for kind, words in {
        "int": ("bigint", "int", "hugeint", "smallint"),
        "float": ("double", "float", "decimal"),
        "text": ("varchar", "string"),
    }.items():
        if name.split("(")[0] in words:
            return name if kind == "int" else kind
    return name.split("(")[0]


def compare(spark, sf: str, name: str, run, sql: str | None) -> tuple[int, str | None]:
    """Row count and, on a difference, what differs."""
    df = run(spark, sf)
    columns = df.columns
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got), None
    cursor = connect(sf).execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted_types = {d[0]: str(d[1]) for d in cursor.description}
    wanted = cursor.fetchall()
    if sorted(columns) != sorted(wanted_columns):
        return len(got), f"columns {sorted(columns)} != {sorted(wanted_columns)}"
    for field in df.schema.fields:
        ours, theirs = _kind(field.dataType.simpleString()), _kind(wanted_types[field.name])
        integers = {"int": "integer", "bigint": "bigint"}
        if integers.get(ours, ours) != theirs and {ours, theirs} & {"int", "bigint", "integer", "hugeint"}:
            return len(got), f"type of {field.name}: {ours} != {theirs}"
    a, b = _bag(columns, got), _bag(wanted_columns, wanted)
    if a != b:
        return len(got), (
            f"rows {sum(a.values())} vs {sum(b.values())}; columns {sorted(columns)}; "
            f"only Spark {list((a - b).items())[:4]}; only SQL {list((b - a).items())[:4]}"
        )
    return len(got), None


def main() -> None:
    import __spark_entry__ as entry
    from cellshift.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        started = time.time()
        try:
            rows, problem = compare(spark, args.sf, name, queries[name], oracles.get(name))
        except Exception as error:  # report and go on with the next query
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        state = "FAIL" if problem else ("ok" if name in oracles else "rows-only")
        bad += bool(problem)
        print(f"{state:9} {name:40} rows={rows:<8} {time.time() - started:6.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
