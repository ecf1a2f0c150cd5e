"""Side-by-side run of a registered query in Spark and its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    """Rows with columns in name order, values as comparable text, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if v is None or v is pd.NaT:
            return "~"
        if isinstance(v, (float, np.floating)):
            return "~nan" if np.isnan(v) else repr(float(v) + 0.0)
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, np.integer)):
            return str(int(v))
        return str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


TYPE_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "boolean": "BOOLEAN",
}


def differences(df, sql: str, con) -> list[str]:
    """What differs between a Spark frame and the SQL; nothing when they agree."""
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_rows = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    for field in df.schema.fields:
        want = TYPE_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if want != duck_types[field.name]:
            found.append(f"type of {field.name}: {want} against {duck_types[field.name]}")
    if len(spark_rows) != len(duck_rows):
        return found + [f"rows {len(spark_rows)} against {len(duck_rows)}"]
    a, b = canonical(spark_rows, df.columns), canonical(duck_rows, names)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        cols = sorted(names)
        x, y = wrong[0]
        found.append(f"{len(wrong)} rows differ, first: {[(n, p, r) for n, p, r in zip(cols, x, y) if p != r]}")
    return found
