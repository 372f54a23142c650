"""Queries that SQL can express, on whole tables."""

import compare
import pytest

from tidegauge.llm.oracles import ORACLES
from tidegauge.llm.queries import QUERIES

TYPES = compare.SAME_TYPE | {"boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", ORACLES)
def test_same_rows(spark, sf_dir, key, monkeypatch):
    monkeypatch.setattr(compare, "SAME_TYPE", TYPES)
    df = QUERIES[key](spark, sf_dir)
    types, expected = compare.sql_rows(sf_dir, ORACLES[key])
    assert compare.spark_types(df) == types
    got = compare.spark_rows(df)
    assert got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])


@pytest.mark.parametrize("key", QUERIES)
def test_registered_and_whole(spark, sf_dir, key):
    import __spark_entry__ as entry_point

    assert entry_point.queries()[key] is QUERIES[key]
    table = {"op4": "pages", "op5": "pages", "op10": "embeddings", "op11": "embeddings"}.get(key.split("_")[0], "documents")
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    found = QUERIES[key](spark, sf_dir)
    if key.startswith("op13_"):  # a row per piece: the first pieces stand for their documents
        found = found.filter("start = 0")
    assert found.count() == rows
