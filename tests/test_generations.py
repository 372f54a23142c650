"""Batches merged into generations: what readers see before, between and after, and what is stored."""

import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.schema import STATS_SCHEMA
from tidegauge.session import scratch_dir
from tidegauge.streaming import generations
from tidegauge.streaming.generations import compact, latest_changes
from tidegauge.streaming.sinks import latest_results, newest_generations, read_batches, replace_batch

START = datetime(2024, 1, 1)


def changes(spark, batch_id, windows=50):
    """Every window changes in every batch."""
    rows = []
    for i in range(windows):
        start = START + timedelta(minutes=i)
        rows.append((start, start + timedelta(minutes=1), f"{i % 3}", float(batch_id), float(i), batch_id + 1))
    return spark.createDataFrame(rows, STATS_SCHEMA).repartition(4)


def results(spark, path):
    return sorted(map(tuple, latest_results(read_batches(spark, path, STATS_SCHEMA)).collect()))


def stored(spark, path):
    """Rows in all files, read or not."""
    files = [f for part in ("data", "generations") for f in glob.glob(f"{path}/{part}/**/*.parquet", recursive=True)]
    return sum(spark.read.parquet(f).count() for f in files), len(files)


def merge(spark, path):
    return compact(spark, path, STATS_SCHEMA, merge=latest_changes)


def test_results_stay_and_rows_do_not_grow(spark):
    path = scratch_dir(spark, "generations")
    write = replace_batch(path)
    for batch_id in range(24):
        write(changes(spark, batch_id), batch_id, 1)
        if batch_id % 6 == 5:
            before = results(spark, path)
            assert merge(spark, path)
            assert results(spark, path) == before
            assert before == sorted(map(tuple, changes(spark, batch_id).collect()))
    assert not merge(spark, path)
    # Two generations, and the six batches since the one before the last, and its newest.
    assert stored(spark, path)[0] <= (2 + 7) * 50
    assert read_batches(spark, path, STATS_SCHEMA).count() <= 2 * 50


def test_crash_before_the_record_changes_nothing(spark, monkeypatch):
    path = scratch_dir(spark, "generations")
    for batch_id in range(4):
        replace_batch(path)(changes(spark, batch_id), batch_id, 1)
    seen = read_batches(spark, path, STATS_SCHEMA).count()

    def fails(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(generations, "commit_generation", fails)
        with pytest.raises(RuntimeError):
            merge(spark, path)
    assert read_batches(spark, path, STATS_SCHEMA).count() == seen == 200
    assert merge(spark, path)
    assert read_batches(spark, path, STATS_SCHEMA).count() == 100
    assert {r.avg_value for r in latest_results(read_batches(spark, path, STATS_SCHEMA)).collect()} == {3.0}


def test_a_reader_of_the_generation_before_finds_its_files(spark):
    path = scratch_dir(spark, "generations")
    write = replace_batch(path)
    for batch_id in range(3):
        write(changes(spark, batch_id), batch_id, 1)
    merge(spark, path)
    reader = read_batches(spark, path, STATS_SCHEMA)
    write(changes(spark, 3), 3, 1)
    merge(spark, path)
    assert {r.avg_value for r in latest_results(reader).collect()} == {2.0}


def test_the_newest_batch_may_come_again(spark):
    """It is left out, so its second writing takes the place of the first; older runs have one too."""
    path = scratch_dir(spark, "generations")
    write = replace_batch(path)
    for run in (1, 2):
        for batch_id in range(3):
            write(changes(spark, 10 * run + batch_id), batch_id, run)
    merge(spark, path)
    assert newest_generations(spark, path)[0].upto == {1: 1, 2: 1}
    write(changes(spark, 99), 2, 2)
    assert {r.avg_value for r in latest_results(read_batches(spark, path, STATS_SCHEMA)).collect()} == {99.0}
    write(changes(spark, 5), 0, 3)
    assert {r.avg_value for r in latest_results(read_batches(spark, path, STATS_SCHEMA)).collect()} == {5.0}
    merge(spark, path)
    merge(spark, path)
    assert {r.avg_value for r in latest_results(read_batches(spark, path, STATS_SCHEMA)).collect()} == {5.0}


def test_files_are_gathered_in_place(spark):
    """All rows stay, without a key, by indicator; codes stay texts."""
    path, by = scratch_dir(spark, "generations"), ("indicator",)
    write = replace_batch(path, by)
    for batch_id in range(8):
        write(changes(spark, batch_id).withColumn("indicator", F.concat(F.lit("00"), "indicator")), batch_id, 1)
    before = sorted(map(tuple, read_batches(spark, path, STATS_SCHEMA).collect()))
    files = len(read_batches(spark, path, STATS_SCHEMA).inputFiles())
    assert compact(spark, path, STATS_SCHEMA, partition_by=by)
    after = read_batches(spark, path, STATS_SCHEMA)
    assert sorted(map(tuple, after.collect())) == before
    one = glob.glob(f"{path}/generations/**/*.parquet", recursive=True)
    assert len(one) < files / 8
    assert {r.indicator for r in after.collect()} == {"000", "001", "002"}


def test_empty_batches_and_an_empty_store(spark):
    path = scratch_dir(spark, "generations")
    for batch_id in range(3):
        replace_batch(path)(changes(spark, 0).limit(0), batch_id, 1)
    assert merge(spark, path)
    assert read_batches(spark, path, STATS_SCHEMA).collect() == []
    assert not merge(spark, path)
