"""Value comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb

INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
DUCK_TYPES = {
    "TINYINT": "tinyint",
    "SMALLINT": "smallint",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    duck = con.sql(sql)
    spark_types = dict(spark_df.dtypes)
    duck_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(duck.columns, duck.types)}
    found = []
    if spark_types != duck_types:
        odd = {
            c: (spark_types.get(c), duck_types.get(c))
            for c in {*spark_types, *duck_types}
            if spark_types.get(c) != duck_types.get(c)
        }
        found.append(f"types (spark, sql): {odd}")
    if sorted(spark_types) == sorted(duck_types):
        ours = _rows(spark_df.columns, spark_df.collect())
        theirs = _rows(duck.columns, duck.fetchall())
        if len(ours) != len(theirs):
            found.append(f"rows: {len(ours)} against {len(theirs)}")
        for a, b in zip(ours, theirs):
            if a != b:
                found.append(f"first difference: {a} against {b}")
                break
    return found
