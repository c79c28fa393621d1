"""Compare a Spark result with a SQL result: names, types and the multiset of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs, as short texts; empty if the results are the same."""
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    out = []
    if sorted(sql_types) != sorted(spark_types):
        return [f"columns {sorted(spark_types)} != {sorted(sql_types)}"]
    for name, t in spark_types.items():
        if SPARK_TO_SQL.get(t, t) != sql_types[name]:
            out.append(f"type of {name}: {t} != {sql_types[name]}")
    want = _rows(list(sql_types), result.fetchall())
    got = _rows(list(spark_types), [tuple(r) for r in df.collect()])
    if sum(got.values()) != sum(want.values()):
        out.append(f"rows {sum(got.values())} != {sum(want.values())}")
    if got != want:
        out.append(f"only Spark: {list((got - want).items())[:2]}; only SQL: {list((want - got).items())[:2]}")
    return out
