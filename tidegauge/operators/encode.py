"""Readings to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.event_time import stamp_now, time_to_millis
from tidegauge.functions.rounding import round_binary
from tidegauge.schema import EVENT_SCHEMA
from tidegauge.settings import DIGITS


def to_event(
    df: DataFrame,
    indicator: Column,
    name: Column,
    value: Column,
    at: Column | None = None,
    source: str = "mock",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The five fields of an event; without a time `at` it is stamped with the current one."""
    return df.select(
        *keep,
        indicator.alias("indicator"),
        name.alias("name"),
        round_binary(value, DIGITS).alias("value"),
        (stamp_now() if at is None else time_to_millis(at)).alias("ts"),
        F.lit(source).alias("source"),
    )


def encode_event(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`key` and JSON `value` of each event.

    The key is the indicator, so the messages of one indicator stay in one topic partition, in
    order. Text outside ASCII is written as it is; a NULL field is written as null.
    """
    event = F.struct(*EVENT_SCHEMA.fieldNames())
    return df.select(
        *keep,
        F.col("indicator").alias("key"),
        F.to_json(event, {"ignoreNullFields": "false"}).alias("value"),
    )
