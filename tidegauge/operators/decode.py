"""Message bytes to typed events.

`from_json` is the dearest step of the whole pipeline. It sits inside a generator (`inline` of a
one-element array) on purpose: Catalyst copies expressions of a projection into the filters it
pushes below, which would parse every message twice; it never moves a filter below a generator on
the generator's own output.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidegauge.functions.event_time import millis_to_time
from tidegauge.schema import CORRUPT, EVENT_SCHEMA

ALONE = "__message"


def parse_events(
    df: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    body: str = "value",
    keep: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The fields of `schema` as columns, after the columns to `keep`.

    Permissive: an unreadable message gives a row of NULLs, an unreadable field a NULL, unknown
    fields are skipped. A shorter `schema` saves the work of converting fields nobody needs.
    """
    event = F.from_json(F.col(body).cast("string"), schema, options or {})
    return df.select(*keep, F.inline(F.array(event)))


def with_event_time(df: DataFrame, millis: str = "ts") -> DataFrame:
    """Adds `event_time` from epoch milliseconds."""
    return df.withColumn("event_time", millis_to_time(F.col(millis)))


def drop_no_event_time(df: DataFrame) -> DataFrame:
    """Rows that can belong to a window. Windowing drops the others by itself; this says so."""
    return df.filter(F.col("event_time").isNotNull())


def _alone(text: Column) -> Column:
    """`text` as the only entry of a list in an object: what follows the message breaks the list or
    adds to it, where a parser of the message by itself would stop reading."""
    return F.concat(F.lit(f'{{"{ALONE}":['), text, F.lit("]}"))


def tag_bad(
    df: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    body: str = "value",
    keep: tuple[str, ...] = (),
    required: tuple[str, ...] = (),
) -> DataFrame:
    """Parsed events plus `_corrupt_record`: the message text where the message is bad, else NULL.

    Bad is what is not one JSON object and nothing else (a NULL or blank text, a list, two objects,
    text behind the object), has a field that could not be read, or lacks one of the `required`
    fields; a field sent as null is present. A NULL text counts as an empty one. One parse and one
    pass; write it partitioned by a verdict to keep both kinds.
    """
    # Naming the column also stops Catalyst from parsing single fields only, which would overlook
    # a fault in another field.
    listed = StructType([StructField(ALONE, ArrayType(schema)), StructField(CORRUPT, StringType())])
    text = F.coalesce(F.col(body).cast("string"), F.lit(""))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = F.inline(F.array(F.from_json(_alone(text), listed, options)))
    rows = df.select(*keep, text.alias("__text"), read)
    event = F.get(F.col(ALONE), F.lit(0))
    # Names are read a second time only where a text could end the list itself, and where a required
    # field came out NULL.
    more_names = F.col("__text").contains("]") & (F.size(F.json_object_keys(_alone(F.col("__text")))) != 1)
    present = F.json_object_keys("__text")
    lacks = [
        event[f].isNull() & ~F.coalesce(F.array_contains(present, f), F.lit(False)) for f in required
    ]
    faults = [F.col(CORRUPT).isNotNull(), F.size(ALONE) != 1, event.isNull(), more_names, *lacks]
    bad = reduce(or_, [F.coalesce(fault, F.lit(True)) for fault in faults])
    fields = [event[f].alias(f) for f in schema.fieldNames()]
    return rows.select(*keep, *fields, F.when(bad, F.col("__text")).alias(CORRUPT))


def split_bad(
    df: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    body: str = "value",
    keep: tuple[str, ...] = (),
    required: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """(good events, bad messages as `raw` text): every message is one or the other."""
    tagged = tag_bad(df, schema, body, keep, required)
    good = tagged.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = tagged.filter(F.col(CORRUPT).isNotNull()).select(*keep, F.col(CORRUPT).alias("raw"))
    return good, bad


def parse_strict(
    df: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    body: str = "value",
    required: tuple[str, ...] = ("name", "value"),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """As `parse_events`, but a message that `tag_bad` would call bad ends the job before its
    progress is stored."""
    tagged = tag_bad(df, schema, body, keep, required)
    told = F.lit("message cannot be read, or lacks a required field: ")
    complaint = F.raise_error(F.concat(told, CORRUPT)).cast("boolean")
    # A filter, not a column: a projection that nobody reads would be pruned with its check.
    return tagged.filter(F.when(F.col(CORRUPT).isNull(), True).otherwise(complaint)).drop(CORRUPT)


def watch_quality(df: DataFrame, name: str | Observation = "quality") -> DataFrame:
    """Counts all rows and those no window will see, on the fly; read them from a batch's
    `Observation` or from the `observedMetrics` of a streaming query's progress."""
    return df.observe(
        name,
        F.count("*").alias("rows"),
        F.count_if(F.col("event_time").isNull()).alias("no_event_time"),
        F.count_if(F.col("value").isNull()).alias("no_value"),
    )


def watch_bad(tagged: DataFrame, name: str | Observation = "messages") -> DataFrame:
    """Counts good and bad messages of `tag_bad` on the fly."""
    return tagged.observe(
        name,
        F.count_if(F.col(CORRUPT).isNull()).alias("good"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"),
    )
