"""Comparison of a Spark result with an SQL result, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


# Names of the same type in both engines.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_types(df):
    return {f.name: SAME_TYPE[f.dataType.simpleString()] for f in df.schema}


def sql_rows(sf_dir, sql):
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        types = {d[0]: str(d[1]) for d in cur.description}
        return types, rows_of(names, cur.fetchall())
