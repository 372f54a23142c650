"""The indicator catalogue: code, display name, base value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.settings import CATALOGUE
from tidegauge.sources.values import value_table


def catalogue(
    spark: SparkSession, entries: list[tuple[str, str, float]] = CATALOGUE
) -> DataFrame:
    """The entries as a table of values, whose size Catalyst knows: it decides whether to broadcast."""
    if not entries:
        raise ValueError("an empty catalogue")
    return value_table(spark, {"indicator": "string", "name": "string", "base": "double"}, entries)
