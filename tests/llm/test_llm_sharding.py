import hashlib
import zlib
from collections import defaultdict

import pytest
from cases import documents, no_documents, on_disk

from pyspark.sql import functions as F

from tidegauge.llm import numbering, sharding
from tidegauge.llm.queries import SHARDS, op9_shards


def plain_jump(doc_id, shards):
    key, b, j, i = "" if doc_id is None else str(doc_id), -1, 0, 0
    while j < shards:
        b = j
        draw = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:8], 16) + 1) / 2**32
        j = int((b + 1) / draw)
        i += 1
    return b


def check(rows, given):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in given
    )
    slots = defaultdict(list)
    for r in rows:
        assert (r.law, r.shard, r.grown_shard) == ("key", plain_jump(r.doc_id, SHARDS), plain_jump(r.doc_id, SHARDS + 1))
        assert r.grown_shard in (r.shard, SHARDS)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_query_equals_brute_force(spark, sf_dir):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    slots = check(op9_shards(spark, sf_dir).collect(), given)
    assert len(slots) == SHARDS and max(map(len, slots.values())) < 4 * len(given) / SHARDS


def test_awkward_rows(spark, tmp_path):
    given = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect() if r.doc_id is not None]
    df = on_disk(documents(spark).filter("doc_id IS NOT NULL"), tmp_path / "docs")
    check(sharding.shard_digest(df, SHARDS).collect(), given)
    whole = sharding.shard_documents(on_disk(documents(spark), tmp_path / "all"), SHARDS)
    assert whole.count() == documents(spark).count()
    assert {r.shard for r in whole.filter("doc_id IS NULL").collect()} == {plain_jump(None, SHARDS)}


def test_few_shards_and_no_rows(spark, tmp_path):
    df = on_disk(documents(spark), tmp_path / "docs")
    assert {r.shard for r in sharding.shard_digest(df, 1).collect()} == {0}
    assert sharding.shard_digest(no_documents(spark), 3).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_digest(df, 0)


def test_a_shard_that_holds_most_rows_over_many_partitions(spark, tmp_path):
    """A repeated id is one key; its shard is numbered over all partitions of the input."""
    rows = [(7 if i % 3 else i, "text", "en", "a") for i in range(3000)]
    df = on_disk(documents(spark, rows).repartition(13), tmp_path / "docs")
    check(sharding.shard_digest(df, SHARDS).collect(), [(r[0], r[1]) for r in rows])


def test_growth_moves_its_share(spark):
    df = spark.range(40_000).selectExpr("id AS doc_id")
    moved = sharding.with_shard(df, 9).filter("shard <> grown_shard").count()
    assert abs(moved / 40_000 - 1 / 10) < 0.01


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    op9_shards(spark, sf_dir).explain()
    assert "Python" not in capsys.readouterr().out


def test_other_cores_between_the_reads(spark, tmp_path, monkeypatch):
    """The offsets and the rows of one plan may be read by other cores: numbers come from files and rows."""
    monkeypatch.setattr(numbering, "BLOCK", 100)
    df = on_disk(documents(spark, [(i % 700, "t", "en", "a") for i in range(3000)]).repartition(5), tmp_path / "docs")
    key, seen = "spark.sql.leafNodeDefaultParallelism", []
    for cores in (2, 8):
        spark.conf.set(key, cores)
        numbered = numbering.number_rows(numbering.with_place(df).withColumn("g", F.col("doc_id") % 3), "g", "n")
        seen.append(sorted((r.doc_id, r.g, r.n) for r in numbered.collect()))
    spark.conf.unset(key)
    assert seen[0] == seen[1]
    assert all(sorted(n for _, g, n in seen[0] if g == k) == list(range(len([1 for r in seen[0] if r[1] == k]))) for k in range(3))
