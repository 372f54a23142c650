"""Row types. Every field is nullable: wire data is never trusted to be complete."""

from pyspark.sql import types as T

# Wire field names and types of one event.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("indicator", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.LongType()),  # epoch milliseconds
        T.StructField("source", T.StringType()),
    ]
)

# What the statistics need: fields nobody reads are not worth converting.
READING_SCHEMA = T.StructType(
    [f for f in EVENT_SCHEMA.fields if f.name in ("indicator", "value", "ts")]
)

# What a consumer prints: the number as its text, whatever kind of number it is.
LINE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "value")])

CORRUPT = "_corrupt_record"

# Result columns, in this order.
STATS_SCHEMA = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("indicator", T.StringType()),
        T.StructField("avg_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("cnt", T.LongType()),
    ]
)

RAW_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField("event_time", T.TimestampType())])

# Where a message stood in its topic.
POSITION_SCHEMA = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])

# Partial results of `functions.stats`, as stored.
PANE_SCHEMA = T.StructType(
    [
        T.StructField("pane", T.TimestampType()),
        T.StructField("indicator", T.StringType()),
        *[T.StructField(n, T.LongType()) for n in ("small", "high", "low")],
        T.StructField("odd", T.DecimalType(38, 10)),
        T.StructField("beyond", T.DoubleType()),
        T.StructField("known", T.LongType()),
        T.StructField("highest", T.DoubleType()),
        T.StructField("rows", T.LongType()),
    ]
)


def with_fields(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """`schema` plus trailing fields, for reading a table with its partition columns typed."""
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in types.items()])


def response_schema(row_schema: T.StructType | str) -> T.StructType:
    """Type of one API response body around rows of `row_schema`, a type or a DDL text."""
    row = T.StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    # The two field names of a response.
    search = T.StructType([T.StructField("row", T.ArrayType(row))])
    return T.StructType([T.StructField("StatisticSearch", search)])
