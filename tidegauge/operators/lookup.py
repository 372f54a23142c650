"""Display names for indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_name(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """`name` from the catalogue; NULL for an indicator it does not list. One row in, one row out,
    as long as the catalogue lists a code once.

    No broadcast hint: Catalyst broadcasts a catalogue whose known size is under
    `spark.sql.autoBroadcastJoinThreshold`. A larger one is joined by a shuffle, where adaptive
    execution splits a hot indicator.
    """
    names = catalogue.select("indicator", "name")
    return df.drop("name").join(names, "indicator", "left")
