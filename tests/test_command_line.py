"""The commands end to end, with files in place of a broker."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import __main__ as cli
from tidegauge.operators.decode import parse_events, with_event_time
from tidegauge.operators.windows import window_stats
from tidegauge.plans.feeds import EVENTS, events, messages, ticks
from tidegauge.plans import interval
from tidegauge.plans.interval import read_interval_stats, read_landed
from tidegauge.session import scratch_dir
from tidegauge.sources.replay import replay_stream
from tidegauge.streaming.sinks import read_batches, read_raw, read_stats


@pytest.fixture
def topic(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    asked = []

    def stream(session, servers, name, **more):
        asked.append((servers, name, more))
        return messages(replay_stream(session, f"{small}/events*.parquet", EVENTS))

    def batch(session, servers, name, start, end, **more):
        """Each message received a second after its event."""
        asked.append((servers, name, start, end))
        sent = messages(events(session, small).withColumn("received", F.col("ts").cast("timestamp")), keep=("received",))
        return sent.withColumn("timestamp", F.col("received") + F.expr("INTERVAL 1 SECOND")).drop("received")

    monkeypatch.setattr(cli, "read_topic_stream", stream)
    monkeypatch.setattr(interval, "read_topic_batch", batch)
    for name in ("KAFKA_BOOTSTRAP_SERVERS", "KAFKA_TOPIC", "KAFKA_GROUP_ID", "SINK", "OUTPUT_PATH", "CHECKPOINT_PATH"):
        monkeypatch.delenv(name, raising=False)
    rows = events(spark, small)
    return asked, rows, with_event_time(parse_events(messages(rows)))


def test_stream(spark, topic, monkeypatch):
    asked, rows, _ = topic
    folder = scratch_dir(spark, "t")
    monkeypatch.setenv("SINK", "parquet")
    monkeypatch.setenv("OUTPUT_PATH", f"{folder}/out")
    cli.main(["stream", "--checkpoint", f"{folder}/ck", "--drain", "--max-offsets", "7",
              "--state-partitions", "2", "--topic", "t"])
    assert asked == [("localhost:29092", "t", {"min_partitions": None, "max_offsets_per_trigger": 7})]
    # All but the windows that two minutes of lateness keep open.
    missing = window_stats(ticks(rows)).count() - read_stats(spark, f"{folder}/out").count()
    assert missing == 2


def test_consume(spark, topic):
    folder = scratch_dir(spark, "t")
    cli.main(["consume", "--path", f"{folder}/out", "--checkpoint", f"{folder}/ck", "--drain", "--strict"])
    lines = read_batches(spark, f"{folder}/out", T.StructType([T.StructField("line", T.StringType())]))
    assert lines.filter(F.col("line").rlike(r"^\[[0-2]@\d+\] 지표 \w+=\d+\.\d+$")).count() == 1000


def test_consume_needs_folders(capsys):
    with pytest.raises(SystemExit):
        cli.arguments(["consume"], {})
    assert "--path and --checkpoint" in capsys.readouterr().err


def test_interval_and_backfill(spark, topic):
    asked, _, decoded = topic
    store = scratch_dir(spark, "t")
    cli.main(["backfill", "--store", store, "--start", "2024-01-01", "--end", "2024-01-05", "--every", "1 day"])
    cli.main(["interval", "--store", store, "--start", "2024-01-05", "--every", "1 day"])
    wait = timedelta(minutes=2)
    assert asked[0][2:] == (datetime(2024, 1, 1) - wait, datetime(2024, 1, 5) + wait)
    assert asked[1][2:] == (datetime(2024, 1, 5) - wait, datetime(2024, 1, 6) + wait)
    rows = decoded.filter("event_time < '2024-01-06'")
    assert read_landed(spark, store).count() == rows.count() > 0
    closed = window_stats(rows).filter("end <= '2024-01-06'")
    got = read_interval_stats(spark, store).drop("dt", "slot")
    assert got.exceptAll(closed).count() == closed.exceptAll(got).count() == 0


def test_wait_and_loss_are_options(spark, topic, capsys):
    asked, _, _ = topic
    store = scratch_dir(spark, "t")
    run = ["interval", "--store", store, "--start", "2024-01-01", "--every", "1 day"]
    cli.main([*run, "--wait", "1 hour"])
    assert asked[0][2:] == (datetime(2023, 12, 31, 23), datetime(2024, 1, 2, 1))
    assert "'landed': " in capsys.readouterr().out
    with pytest.raises(ValueError, match="may lose rows has to say so"):
        interval.backfill(read_landed(spark, store, positions=True).filter("false"), store, datetime(2024, 1, 1), datetime(2024, 1, 2), "1 day")


def test_land(spark, topic):
    _, _, decoded = topic
    folder = scratch_dir(spark, "t")
    cli.main(["land", "--path", f"{folder}/out", "--checkpoint", f"{folder}/ck", "--drain"])
    got = read_raw(spark, f"{folder}/out").drop("dt")
    assert got.count() == decoded.count() and got.exceptAll(decoded).count() == 0


def test_results_and_publish_reach_their_writers(spark, topic, monkeypatch):
    told = {}
    monkeypatch.setattr(cli, "write_results_jdbc", lambda df, *rest, **more: told.update(rest=rest, more=more, columns=df.columns))
    monkeypatch.setattr(cli, "finish", lambda query: query)
    monkeypatch.setattr(cli, "progress", lambda query: [])
    cli.main(["results", "--url", "jdbc:x", "--table", "r", "--checkpoint", "ck", "--width", "1 hour", "--slide", "1 hour"])
    assert told["rest"] == ("jdbc:x", "r", "ck") and told["more"] == {"drain": False}
    assert told["columns"] == ["start", "end", "indicator", "avg_value", "max_value", "cnt"]
    _, _, decoded = topic
    path = f"{scratch_dir(spark, 't')}/in"
    decoded.drop("event_time").write.parquet(path)
    monkeypatch.setattr(cli, "write_topic", lambda df, *rest: told.update(sent=df.count(), columns=df.columns, rest=rest))
    cli.main(["publish", "--path", path, "--topic", "t"])
    assert (told["sent"], told["columns"], told["rest"]) == (1000, ["key", "value"], ("localhost:29092", "t"))


def test_consumer_group(spark, topic, monkeypatch):
    asked, _, _ = topic
    monkeypatch.setenv("KAFKA_GROUP_ID", "g7")
    folder = scratch_dir(spark, "t")
    cli.main(["consume", "--path", f"{folder}/out", "--checkpoint", f"{folder}/ck", "--drain"])
    assert asked[0][2]["extra"] == {"kafka.group.id": "g7"}


def test_times_are_utc():
    assert cli.moment("2024-01-01T10:00") == datetime(2024, 1, 1, 10)
    assert cli.moment("2024-01-01T10:00+09:00") == datetime(2024, 1, 1, 1)


def test_environment():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "k:1", "KAFKA_TOPIC": "t", "SINK": "PARQUET",
           "OUTPUT_PATH": "s3a://b/agg", "CHECKPOINT_PATH": "s3a://b/ck"}
    args = cli.arguments(["stream"], env)
    assert (args.servers, args.topic, args.sink, args.path, args.checkpoint) == (
        "k:1", "t", "parquet", "s3a://b/agg", "s3a://b/ck")
    args = cli.arguments(["stream"], {})
    assert (args.servers, args.topic, args.sink, args.path) == (
        "localhost:29092", "econ.indicators", "console", None)
