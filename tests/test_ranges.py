"""Ranges against sets of numbers."""

import random
from collections import defaultdict

import pytest

from tidegauge.operators import ranges

KEYS = ("k", "p")
TYPES = "k string, p int, first bigint, until bigint"


def numbers(df):
    found = defaultdict(set)
    for r in df.collect():
        assert r["first"] < r["until"]
        part = set(range(r["first"], r["until"]))
        assert not part & found[r["k"], r["p"]]
        found[r["k"], r["p"]] |= part
    return dict(found)


def gapless(df):
    """No two ranges of a key that touch."""
    by = defaultdict(list)
    for r in df.collect():
        by[r["k"], r["p"]].append((r["first"], r["until"]))
    return all(a[1] < b[0] for rs in by.values() for a, b in zip(sorted(rs), sorted(rs)[1:]))


def some(dice, rows, widest):
    made = []
    for _ in range(rows):
        first = dice.randint(0, 300)
        made.append((dice.choice(["a", "b", None]), dice.choice([0, 1]), first, first + dice.randint(0, widest)))
    return made


def covered(rows):
    found = defaultdict(set)
    for k, p, first, until in rows:
        found[k, p] |= set(range(first, until))
    return {key: places for key, places in found.items() if places}


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 16)


@pytest.mark.parametrize("seed", range(4))
def test_merged_and_difference(spark, seed):
    dice = random.Random(seed)
    held, come = some(dice, 60, 20), some(dice, 60, 12)
    a, b = spark.createDataFrame(held, TYPES), spark.createDataFrame(come, TYPES)
    merged = ranges.merged(a, KEYS)
    assert numbers(merged) == covered(held) and gapless(merged)
    rest = ranges.difference(a, b, KEYS)
    left = {k: v - covered(come).get(k, set()) for k, v in covered(held).items()}
    assert numbers(rest) == {k: v for k, v in left.items() if v} and gapless(rest)


@pytest.mark.parametrize("seed", range(4))
def test_ranges_of_places_and_rows_outside(spark, seed):
    dice = random.Random(seed)
    places = [(dice.choice(["a", "b", None]), dice.choice([0, 1]), dice.choice([None, dice.randint(0, 200)])) for _ in range(400)]
    df = spark.createDataFrame(places, "k string, p int, place int").selectExpr("*", "7 AS first", "8 AS block")
    found = ranges.ranges_of(df, KEYS, "place")
    want = defaultdict(set)
    for k, p, place in places:
        if place is not None:
            want[k, p].add(place)
    assert numbers(found) == dict(want) and gapless(found)
    given = covered(some(dice, 30, 15))
    held = ranges.merged(spark.createDataFrame([(k, p, n, n + 1) for (k, p), v in given.items() for n in v], TYPES), KEYS)
    free = ranges.outside(df, held, KEYS, "place").select(*KEYS, "place").collect()
    expected = [r for r in places if r[2] is None or r[2] not in given.get(r[:2], set())]
    assert sorted(map(tuple, free), key=str) == sorted(expected, key=str)


def test_long_ranges_and_no_rows(spark):
    none = spark.createDataFrame([], TYPES)
    long = spark.createDataFrame([("a", 0, 5, 10_000), ("a", 0, 10_000, 10_007)], TYPES)
    assert ranges.merged(long, KEYS).collect() == [("a", 0, 5, 10_007)]
    assert ranges.difference(none, long, KEYS).collect() == ranges.merged(none, KEYS).collect() == []
    assert ranges.difference(long, none, KEYS).collect() == [("a", 0, 5, 10_007)]
    rows = spark.createDataFrame([("a", 0, 4), ("a", 0, 5), ("a", 0, 9_999), ("a", 0, 10_007), ("b", 0, 6)], "k string, p int, place bigint")
    free = ranges.outside(rows, ranges.merged(long, KEYS), KEYS, "place").collect()
    assert sorted(map(tuple, free)) == [("a", 0, 4), ("a", 0, 10_007), ("b", 0, 6)]
    assert ranges.outside(rows, none, KEYS, "place").count() == 5


def test_a_hot_key_is_sorted_in_blocks(spark, monkeypatch):
    """No task sorts the places of a whole key; what one key keeps is a range per gap."""
    monkeypatch.setattr(ranges, "BLOCK", 1 << 10)
    df = spark.range(100_000).selectExpr("'a' AS k", "0 AS p", "id + id DIV 50000 AS place")
    plan = ranges.ranges_of(df, KEYS, "place")
    assert plan.collect() == [("a", 0, 0, 50_000), ("a", 0, 50_001, 100_001)]
    assert "_block" in plan._jdf.queryExecution().executedPlan().toString()
