"""Run a registered query and its SQL twin on the same tables and list the differences."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _bag(names, result.fetchall())
    found = _bag(df.columns, df.collect())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    for f in df.schema.fields:
        want = TYPES.get(f.dataType.simpleString())
        if f.name in types and want != types[f.name]:
            problems.append(f"{f.name}: {f.dataType.simpleString()} against {types[f.name]}")
    missing, extra = expected - found, found - expected
    if missing or extra:
        problems.append(
            f"{sum(missing.values())} rows missing, {sum(extra.values())} extra; "
            f"e.g. missing {list(missing)[:2]}, extra {list(extra)[:2]}"
        )
    return problems


def main() -> None:
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    from eventmarts.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark: SparkSession = local_session("compare", 8)
    con = connect(sf_dir)
    oracles = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = differences(df, con, oracles[name]) if name in oracles else ["no SQL"]
        except Exception as e:  # noqa: BLE001 - report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - began:.1f}s", *problems, sep="\n    ")
    print("bad:", bad)


if __name__ == "__main__":
    main()
