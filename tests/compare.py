"""Compare a Spark result with a DuckDB result the way the driver does, and say where they differ."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~null"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return f"{type(value).__name__}:{value}"


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
          "date": "DATE", "boolean": "BOOLEAN"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and all rows agree, rows in any order."""
    oracle = con.execute(sql)
    oracle_types = {c[0]: str(c[1]) for c in oracle.description}
    oracle_names = [c[0] for c in oracle.description]
    oracle_rows = oracle.fetchall()
    spark_types = dict(df.dtypes)
    if sorted(oracle_types) != sorted(spark_types):
        return [f"columns {sorted(spark_types)} vs {sorted(oracle_types)}"]
    problems = [f"type of {name}: {kind} vs {oracle_types[name]}" for name, kind in spark_types.items()
                if _TYPES.get(kind, kind) != oracle_types[name]]
    names = sorted(spark_types)
    order = [oracle_names.index(name) for name in names]
    theirs = sorted(tuple(_cell(row[i]) for i in order) for row in oracle_rows)
    ours = sorted(tuple(_cell(row[name]) for name in names) for row in df.collect())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    if ours != theirs:
        extra, missing = set(ours) - set(theirs), set(theirs) - set(ours)
        problems.append(f"values: {len(extra)} only in Spark, e.g. {sorted(extra)[:2]}; "
                        f"{len(missing)} only in SQL, e.g. {sorted(missing)[:2]}")
    return problems
