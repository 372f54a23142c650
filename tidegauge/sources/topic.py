"""Reading a topic, as an endless table or between two bounds.

The result has the columns of Spark's Kafka source: key, value, topic, partition, offset, timestamp,
timestampType.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidegauge.settings import BROKERS, TOPIC

Bound = str | dict | datetime


def _bound(side: str, at: Bound) -> dict[str, str]:
    """`at` is "earliest"/"latest", {topic: {partition: offset}}, or a moment (naive means UTC)."""
    if isinstance(at, datetime):
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        return {f"{side}Timestamp": str(int(at.timestamp() * 1000))}
    return {f"{side}Offsets": json.dumps(at) if isinstance(at, dict) else at}


def topic_options(
    servers: str = BROKERS,
    topic: str = TOPIC,
    starting: Bound = "earliest",
    ending: Bound | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    Spark runs one task per topic partition; `min_partitions` cuts long offset ranges into more
    tasks, which is also what splits a topic partition that holds a hot indicator.
    `max_offsets_per_trigger` bounds a micro-batch, so that the first start on a long log does not
    become one huge batch.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    options |= _bound("starting", starting)
    if isinstance(starting, datetime):
        # A partition with nothing after the moment has nothing to read; it is no error.
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if ending is not None:
        options |= _bound("ending", ending)
    for name, number in (
        ("minPartitions", min_partitions),
        ("maxOffsetsPerTrigger", max_offsets_per_trigger),
        ("minOffsetsPerTrigger", min_offsets_per_trigger),
    ):
        if number is not None:
            options[name] = str(number)
    return options | (extra or {})


def read_topic_stream(
    spark: SparkSession,
    servers: str = BROKERS,
    topic: str = TOPIC,
    starting: Bound = "earliest",
    **more,
) -> DataFrame:
    """The topic as an endless table. `starting` counts at the first start only: later starts of
    the same checkpoint go on where the last one stopped."""
    options = topic_options(servers, topic, starting, **more)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(
    spark: SparkSession,
    servers: str = BROKERS,
    topic: str = TOPIC,
    start: Bound = "earliest",
    end: Bound = "latest",
    **more,
) -> DataFrame:
    """The part of the topic between two bounds, as a finite table."""
    options = topic_options(servers, topic, start, end, **more)
    return spark.read.format("kafka").options(**options).load()
