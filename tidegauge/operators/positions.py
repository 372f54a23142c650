"""Log positions: lines of consumed messages, committed offsets, lag, delivery counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegauge.settings import CONSUMER_GROUP


# Between these a number is printed without an exponent.
PLAIN_FROM, PLAIN_BELOW = 1e-4, 1e16


def number_text(name: str) -> Column:
    """A number as consumers written in Python print it: 12345678.9, 3.5, and 3 only where it was
    sent as a whole number, which text read from the message still tells and a double no more."""
    number = F.col(name).cast("string")
    size = F.abs(number.try_cast("double"))
    digits = F.regexp_replace(number.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    # Most are whole, or end in a digit that counts: nothing to convert.
    as_sent = number.rlike(r"^-?[0-9]+([.]([0-9]*[1-9]|0))?$")
    small = (size == 0) | ((size >= PLAIN_FROM) & (size < PLAIN_BELOW))
    return F.when(as_sent, number).when(small, F.coalesce(plain, number)).otherwise(number)


def format_line(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`[partition@offset] name=value` per message, as column `line`; an absent part reads None.
    `value` is a number, or its text as it was sent."""

    def text(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit("None"))

    where = [F.lit("["), text(F.col("partition")), F.lit("@"), text(F.col("offset")), F.lit("] ")]
    line = F.concat(*where, text(F.col("name")), F.lit("="), text(number_text("value")))
    return df.select(*keep, line.alias("line"))


def commit_progress(df: DataFrame, group: str = CONSUMER_GROUP) -> DataFrame:
    """Position of a consumer group per topic partition after it handled the messages in `df`:
    the offset it would read next."""
    return df.groupBy(F.lit(group).alias("group"), "topic", "partition").agg(
        (F.max("offset") + 1).alias("offset")
    )


def log_bounds(df: DataFrame) -> DataFrame:
    """First offset and end (last offset + 1) of each topic partition."""
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def lag_report(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """How far one consumer group is behind the end of each topic partition.

    A partition without a commit lags by its whole content. Both sides hold one row per topic
    partition, so the join is small whatever the log's size.
    """
    position = committed.select("topic", "partition", F.col("offset").alias("committed"))
    behind = F.col("end_offset") - F.coalesce("committed", "begin_offset")
    return bounds.join(position, ["topic", "partition"], "left").select(
        "topic", "partition", "end_offset", "committed", behind.alias("lag")
    )


def delivery_report(df: DataFrame) -> DataFrame:
    """Delivered and failed messages, and the last delivered offset, per topic partition. `error`
    is NULL for a delivered message."""
    delivered = F.col("error").isNull()
    return df.groupBy("topic", "partition").agg(
        F.count_if(delivered).alias("delivered"),
        F.count_if(~delivered).alias("failed"),
        F.max(F.when(delivered, F.col("offset"))).alias("last_offset"),
    )


def watch_delivery(df: DataFrame, name: str | Observation = "delivery") -> DataFrame:
    """The same counts over all partitions, taken while a publishing query runs."""
    delivered = F.col("error").isNull()
    return df.observe(
        name,
        F.count_if(delivered).alias("delivered"),
        F.count_if(~delivered).alias("failed"),
    )
