"""Run a registered query and its SQL twin and compare types and values, order aside."""

from __future__ import annotations

import datetime
import glob
import os
from decimal import Decimal

import duckdb

# DuckDB type -> Spark types that hold the same values.
SAME_TYPE = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"}, "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"}, "DATE": {"date"}, "TIMESTAMP": {"timestamp_ntz"}, "FLOAT": {"float"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark frame and a SQL result; empty when nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, spark_type in df.dtypes:
        if spark_type not in SAME_TYPE.get(types[name], set()):
            found.append(f"type of {name}: {spark_type} against {types[name]}")
    ours = _rows([tuple(r) for r in df.collect()], df.columns)
    theirs = _rows(result.fetchall(), names)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} against {len(theirs)}")
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        found.append(f"values, first: {pairs!r:.600}")
    return found
