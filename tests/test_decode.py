import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidegauge.operators.decode import (
    drop_no_event_time,
    parse_events,
    parse_strict,
    split_bad,
    tag_bad,
    watch_bad,
    watch_quality,
    with_event_time,
)
from tidegauge.operators.encode import encode_event, to_event
from tidegauge.schema import EVENT_SCHEMA

GOOD = '{"indicator":"cpi","name":"소비자물가지수","value":2.5,"ts":1718500000123,"source":"mock"}'


def swap(old, new):
    assert old in GOOD
    return GOOD.replace(old, new)


def topic(spark, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "offset bigint, text string").select(
        "offset", F.col("text").cast("binary").alias("value")
    )


FULL = ("cpi", "소비자물가지수", 2.5, 1718500000123, "mock")
NOTHING = (None,) * 5

MATRIX = [
    (GOOD, FULL, False),
    ("not json", NOTHING, True),
    ("", NOTHING, True),
    (" \t\n", NOTHING, True),
    ("null", NOTHING, True),
    ("{}", NOTHING, False),
    (GOOD + "\n", FULL, False),
    (GOOD + GOOD, FULL, True),
    (GOOD + "," + GOOD, FULL, True),
    (GOOD + "xyz", FULL, True),
    (GOOD + '],"more":[' + GOOD, FULL, True),
    (swap('"mock"', '"a]b[c"'), (*FULL[:4], "a]b[c"), False),
    (f"[{GOOD}]", NOTHING, True),
    (swap("2.5", '"oops"'), ("cpi", FULL[1], None, FULL[3], "mock"), True),
    (swap("2.5", '"2.5"'), ("cpi", FULL[1], None, FULL[3], "mock"), True),
    (swap("1718500000123", '"1718500000123"'), ("cpi", FULL[1], 2.5, None, "mock"), True),
    (swap("1718500000123", "1718500000123.0"), ("cpi", FULL[1], 2.5, None, "mock"), True),
    (swap("1718500000123", "null"), ("cpi", FULL[1], 2.5, None, "mock"), False),
    (swap('"value":2.5,', ""), ("cpi", FULL[1], None, FULL[3], "mock"), False),
    (swap('"value":2.5,', '"value":2.5,"unit":"x",'), FULL, False),
]


@pytest.mark.parametrize("text, fields, faulty", MATRIX)
def test_one_message(spark, text, fields, faulty):
    (row,) = parse_events(topic(spark, text)).collect()
    assert tuple(row) == fields
    good, bad = split_bad(topic(spark, text), keep=("offset",))
    assert [tuple(r) for r in bad.collect()] == ([(0, text)] if faulty else [])
    assert [tuple(r) for r in good.collect()] == ([] if faulty else [(0, *fields)])


def test_damaged_at_random(spark):
    """The parse inside a generator reads what a plain projection of the parse reads."""
    dice = random.Random(3)
    texts = []
    for _ in range(400):
        text = list(GOOD)
        for _ in range(dice.randint(1, 3)):
            at = dice.randrange(len(text))
            text[at : at + dice.randint(0, 4)] = dice.choice(["", '"', "{", "}", ",", ":", "0", "null", "\\"])
        texts.append("".join(text))
    df = topic(spark, *texts)
    plain = df.select("offset", F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("e"))
    plain = {r["offset"]: tuple(r["e"]) if r["e"] else NOTHING for r in plain.collect()}
    assert {r[0]: tuple(r)[1:] for r in parse_events(df, keep=("offset",)).collect()} == plain
    good, bad = split_bad(df, keep=("offset",))
    sound = {r[0]: tuple(r)[1:] for r in good.collect()}
    broken = {r["offset"]: r["raw"] for r in bad.collect()}
    assert sound.keys() | broken.keys() == plain.keys() and not sound.keys() & broken.keys()
    assert all(plain[i] == fields for i, fields in sound.items())
    assert all(texts[i] == raw for i, raw in broken.items())
    assert sound and broken


def test_no_message_text_at_all(spark):
    df = spark.createDataFrame([(None,)], "value binary")
    assert [tuple(r) for r in parse_events(df).collect()] == [NOTHING]
    good, bad = split_bad(df)
    assert good.collect() == [] and [tuple(r) for r in bad.collect()] == [("",)]


def test_required_fields(spark):
    texts = [GOOD, "{}", swap('"value":2.5,', ""), swap("2.5", "null")]
    good, bad = split_bad(topic(spark, *texts), keep=("offset",), required=("name", "value"))
    assert [r["offset"] for r in good.collect()] == [0, 3]
    assert [tuple(r) for r in bad.collect()] == [(1, texts[1]), (2, texts[2])]


def test_bad_and_good_are_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("m")
    watch_bad(tag_bad(topic(spark, GOOD, "", GOOD + "x")), seen).collect()
    assert seen.get == {"good": 1, "bad": 2}


def test_not_a_number_is_kept(spark):
    (row,) = parse_events(topic(spark, swap("2.5", "NaN"))).collect()
    assert math.isnan(row["value"])


def test_fault_in_an_unread_field_is_seen(spark):
    """Only the corrupt column is selected: the other fields must be parsed all the same."""
    df = tag_bad(topic(spark, GOOD, swap("2.5", '"oops"'))).select("_corrupt_record")
    assert sum(r[0] is not None for r in df.collect()) == 1


def test_shorter_schema(spark):
    short = StructType([StructField("value", DoubleType()), StructField("ts", LongType())])
    (row,) = parse_events(topic(spark, GOOD), short).collect()
    assert tuple(row) == (2.5, 1718500000123)


@pytest.mark.parametrize(
    "millis, expected",
    [
        (1718500000123, datetime(2024, 6, 16, 1, 6, 40, 123000)),
        (0, datetime(1970, 1, 1)),
        (-1, datetime(1969, 12, 31, 23, 59, 59, 999000)),
        (1718500000123000000, None),  # nanoseconds
        (9223372036854775807, None),
        (-9223372036854775808, None),
        (None, None),
    ],
)
def test_event_time(spark, millis, expected):
    df = spark.createDataFrame([(millis,)], "ts bigint")
    timed = with_event_time(df).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    assert timed.first()["event_time"] == expected
    assert drop_no_event_time(timed).count() == (expected is not None)


def test_strict_reads_good_messages(spark):
    nulled = swap("2.5", "null")
    rows = parse_strict(topic(spark, GOOD, nulled), keep=("offset",)).collect()
    assert [tuple(r) for r in rows] == [(0, *FULL), (1, *FULL[:2], None, *FULL[3:])]


@pytest.mark.parametrize(
    "text, complaint",
    [
        ("not json", "cannot be read"),
        ("", "cannot be read"),
        (None, "cannot be read"),
        ("{}", "lacks a required field"),
        (GOOD + GOOD, "cannot be read"),
        (GOOD + "xyz", "cannot be read"),
        (swap("2.5", '"oops"'), "cannot be read"),
        (swap('"value":2.5,', ""), "lacks a required field"),
        (swap('"name":"소비자물가지수",', ""), "lacks a required field"),
    ],
)
def test_strict_stops(spark, text, complaint):
    with pytest.raises(Exception, match=complaint):
        # A column the check does not need: the check must survive column pruning.
        parse_strict(topic(spark, GOOD, text)).select("indicator").collect()


def test_envelope_round_trip(spark):
    source = spark.createDataFrame(
        [("cpi", "소비자물가지수", 114.00005, datetime(2024, 1, 1, 0, 0, 0, 999999)),
         ("kospi", None, None, datetime(1969, 12, 31, 23, 59, 59, 999999))],
        "c string, n string, v double, at timestamp_ntz",
    )
    made = to_event(source, F.col("c"), F.col("n"), F.col("v"), F.col("at").cast("timestamp"))
    sent = encode_event(made)
    texts = [r["value"] for r in sent.orderBy("key").collect()]
    assert texts == [
        '{"indicator":"cpi","name":"소비자물가지수","value":114.0001,"ts":1704067200999,"source":"mock"}',
        '{"indicator":"kospi","name":null,"value":null,"ts":-1,"source":"mock"}',
    ]
    assert sent.filter("key = 'cpi'").count() == 1
    back = parse_events(sent).orderBy("indicator").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in made.orderBy("indicator").collect()]
    assert made.schema.fieldNames() == EVENT_SCHEMA.fieldNames()


def test_stamp_is_one_value_per_batch(spark):
    stamped = to_event(spark.range(1000).repartition(8), F.lit("a"), F.lit("b"), F.lit(1.0))
    before = int(datetime.now().timestamp() * 1000)
    stamps = {r["ts"] for r in stamped.collect()}
    assert len(stamps) == 1
    assert abs(stamps.pop() - before) < 60_000


def test_quality_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("q")
    df = with_event_time(parse_events(topic(spark, GOOD, "not json", swap('"value":2.5,', ""))))
    watch_quality(df, seen).collect()
    assert seen.get == {"rows": 3, "no_event_time": 1, "no_value": 2}
