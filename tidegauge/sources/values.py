"""Small tables given as rows in the program."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def value_table(spark: SparkSession, columns: dict[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A table of given rows, `columns` by type.

    Catalyst holds it as values and knows how many there are, so a join decides by that whether to
    broadcast it; rows passed through a local collection would count as unknown and be shuffled, and
    an array of literals would count as one row, however long.
    """
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in columns.items()))
    given = {f"v{i}_{name}": v for i, row in enumerate(rows) for name, v in zip(columns, row)}
    casts = [", ".join(f"CAST(:v{i}_{n} AS {t})" for n, t in columns.items()) for i in range(len(rows))]
    values = ", ".join(f"({row})" for row in casts)
    return spark.sql(f"SELECT * FROM VALUES {values} AS given({', '.join(columns)})", args=given)
