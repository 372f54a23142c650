"""Several providers in one feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(feeds: dict[str, DataFrame]) -> DataFrame:
    """All feeds in one table, `source` telling the provider of each row. Batch or streaming.

    Columns are matched by name. Duplicates stay: a provider's own repeats are its own business.
    """
    if not feeds:
        raise ValueError("no provider given")
    marked = [df.withColumn("source", F.lit(name)) for name, df in feeds.items()]
    return reduce(DataFrame.unionByName, marked)
