"""Command line: `spark-submit --packages <kafka connector> tidegauge/__main__.py stream ...`."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegauge.operators.decode import parse_events, with_event_time
from tidegauge.operators.encode import encode_event
from tidegauge.operators.windows import span
from tidegauge.plans.interval import EVERY, backfill, topic_events
from tidegauge.schema import EVENT_SCHEMA
from tidegauge.session import get_session
from tidegauge.settings import (
    BROKERS,
    CONSOLE_ROWS,
    CONSUMER_GROUP,
    LATENESS,
    SINK,
    TOPIC,
    WINDOW_SLIDE,
    WINDOW_WIDTH,
)
from tidegauge.sources.topic import read_topic_stream
from tidegauge.streaming.run import consume, finish, message_stats, progress, run_stream
from tidegauge.streaming.sinks import replace_batch, write_raw, write_results_jdbc, write_topic


def moment(text: str) -> datetime:
    """A time without zone is UTC."""
    at = datetime.fromisoformat(text)
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def arguments(argv: list[str] | None, env: dict[str, str]) -> argparse.Namespace:
    # Names of the environment variables deployments already set.
    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", default=env.get("KAFKA_BOOTSTRAP_SERVERS", BROKERS))
    topic.add_argument("--topic", default=env.get("KAFKA_TOPIC", TOPIC))
    read = argparse.ArgumentParser(add_help=False, parents=[topic])
    read.add_argument("--min-partitions", type=int)
    live = argparse.ArgumentParser(add_help=False, parents=[read])
    live.add_argument("--checkpoint", default=env.get("CHECKPOINT_PATH"))
    live.add_argument("--every", help="time from one micro-batch to the next")
    live.add_argument("--drain", action="store_true", help="stop when the topic is read")
    live.add_argument("--max-offsets", type=int, help="bound of a micro-batch")
    windows = argparse.ArgumentParser(add_help=False)
    windows.add_argument("--width", default=WINDOW_WIDTH, help="length of a window")
    windows.add_argument("--slide", default=WINDOW_SLIDE, help="from one window's start to the next")
    late = argparse.ArgumentParser(add_help=False)
    late.add_argument("--lateness", default=LATENESS, help="how late an event may come")

    parser = argparse.ArgumentParser(prog="tidegauge")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", parents=[live, windows, late], help="windowed statistics of a topic")
    stream.add_argument("--sink", default=env.get("SINK", SINK).lower())
    stream.add_argument("--path", default=env.get("OUTPUT_PATH"))
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--console-rows", type=int, default=CONSOLE_ROWS)

    results = commands.add_parser("results", parents=[live, windows, late], help="the same to a relational table")
    results.add_argument("--url", required=True, help="JDBC address of the database")
    results.add_argument("--table", required=True)

    lines = commands.add_parser("consume", parents=[live], help="a line per message, then commit")
    lines.add_argument("--path", default=env.get("OUTPUT_PATH"), help="folder of the lines")
    lines.add_argument("--strict", action="store_true")
    lines.add_argument("--group", default=env.get("KAFKA_GROUP_ID", CONSUMER_GROUP))

    land = commands.add_parser("land", parents=[live], help="raw events by date")
    land.add_argument("--path", default=env.get("OUTPUT_PATH"), help="folder of the events")

    publish = commands.add_parser("publish", parents=[topic], help="events of a folder to a topic")
    publish.add_argument("--path", required=True, help="folder of Parquet files")

    for name, text in (("interval", "one scheduled run"), ("backfill", "a range of runs")):
        job = commands.add_parser(name, parents=[read, windows], help=text)
        job.add_argument("--store", required=True)
        job.add_argument("--start", type=moment, required=True)
        job.add_argument("--every", default=EVERY)
        job.add_argument("--wait", default=LATENESS, help="how long after the range events may have come")
        job.add_argument("--may-lose", action="store_true", help="also replace by fewer rows than landed")
        if name == "backfill":
            job.add_argument("--end", type=moment, required=True)
    args = parser.parse_args(argv)
    if args.command in ("consume", "land") and not (args.path and args.checkpoint):
        parser.error(f"{args.command} needs --path and --checkpoint")
    if args.command == "results" and not args.checkpoint:
        parser.error("results needs --checkpoint")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv, dict(os.environ))
    spark = get_session()
    spark.sparkContext.setLogLevel("WARN")
    if args.command == "publish":
        write_topic(encode_event(spark.read.schema(EVENT_SCHEMA).parquet(args.path)), args.servers, args.topic)
        return
    if args.command in ("interval", "backfill"):
        end = args.end if args.command == "backfill" else args.start + span(args.every)
        events = topic_events(
            spark, args.servers, args.topic, args.start, end, args.wait, min_partitions=args.min_partitions
        )
        print(backfill(
            events, args.store, args.start, end, args.every, args.wait, args.may_lose,
            width=args.width, slide=args.slide,
        ))
        return
    group = {"extra": {"kafka.group.id": args.group}} if args.command == "consume" else {}
    messages = read_topic_stream(
        spark, args.servers, args.topic,
        min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets, **group,
    )
    how = {"drain": args.drain} | ({"every": args.every} if args.every else {})
    if args.command == "stream":
        query = run_stream(
            messages, args.sink, args.width, args.slide, args.lateness, path=args.path,
            checkpoint=args.checkpoint, shuffle_partitions=args.state_partitions,
            console_rows=args.console_rows, **how,
        )
    elif args.command == "results":
        stats = message_stats(messages, args.width, args.slide, args.lateness)
        query = write_results_jdbc(stats, args.url, args.table, args.checkpoint, **how)
    elif args.command == "land":
        query = write_raw(with_event_time(parse_events(messages)), args.path, args.checkpoint, **how)
    else:
        query = consume(messages, replace_batch(args.path), args.checkpoint, args.strict, **how)
    finish(query)
    for report in progress(query):
        print(report)


if __name__ == "__main__":
    main()
