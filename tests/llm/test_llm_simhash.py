import numpy as np
import pytest
import xxhash
from cases import documents, no_documents, on_disk, union_find
from pyspark.sql import functions as F

from tidegauge.llm import simhash
from tidegauge.llm.components import components
from tidegauge.llm.queries import op3_simhash


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text", [None, "", " ", "one", "A b", "a B c d", "a b c d e", "x " * 501, "ÄÖ ä\xa0ö\x0bü a", "Ñ \x00 \x1c b"]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_hash_is_sparks(spark):
    text = "four words make one"
    row = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()
    assert np.array([row.h]).view(np.uint64)[0] == xxhash.xxh64_intdigest(text.encode(), 42)


def near(fps, distance):
    return [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= distance]


def scattered(seed, clusters=30, size=25, flips=5):
    rng = np.random.default_rng(seed)
    fps = set()
    for _ in range(clusters):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            bits = rng.choice(64, size=rng.integers(0, flips), replace=False)
            fps.add(centre ^ sum(1 << int(b) for b in bits))
    return sorted(fps)


@pytest.mark.parametrize("distance", [0, 2, 4, 5])
@pytest.mark.parametrize("longest", [4096, 2])
def test_links_join_what_brute_force_joins(spark, distance, longest):
    fps = scattered(distance)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {r.node: r.root for r in components(simhash.links(df, distance, longest)).collect()}
    back = dict(zip(fps, signed))
    expected = union_find(signed, [(back[a], back[b]) for a, b in near(fps, distance)])
    assert {n: found.get(n, n) for n in signed} == expected


def test_every_near_pair_shares_a_list():
    rng = np.random.default_rng(1)
    masks = simhash.list_masks(4)
    assert len(masks) == 70
    for _ in range(300):
        differ = sum(1 << int(b) for b in rng.choice(64, size=4, replace=False))
        shared = [m for m in masks.tolist() if not differ & m]
        assert shared
        assert all(any(not differ & int(f) for f in simhash.finer_masks(m, 4)) for m in shared[:3])


def check_groups(rows, texts):
    fps = {i: plain_fingerprint(t) for i, t in texts}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 4]
    roots = union_find(ids, links)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows if r.doc_id is not None} == {
        i: (fps[i], roots[i]) for i in ids
    }
    assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower() for r in rows)


def test_query_equals_brute_force(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op3_simhash(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    check_groups(rows, texts)


def test_awkward_rows(spark):
    df = documents(spark)
    rows = simhash.simhash_groups(df).collect()
    assert len(rows) == df.count()
    given = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    check_groups(rows, list(given.items()))
    # No words: all are one group, that of the least id; the row without id or text is in it.
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {3}


def test_no_rows(spark):
    assert simhash.simhash_groups(no_documents(spark)).collect() == []
    assert simhash.keep_first(no_documents(spark)).collect() == []


def test_keep_first(spark, tmp_path):
    df = on_disk(documents(spark), tmp_path / "docs")
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 not in ids and 6 in ids
    # Without an id, one is in the group of document 3, the other alone.
    assert [r.text for r in rows if r.doc_id is None] == ["a document without an id"]


def test_an_id_on_rows_of_several_groups(spark, tmp_path):
    """Each group keeps a document, though one id is the least of two and stands in a third."""
    one, two, three = ("the first of all texts here is about ships and the sea", "another text that tells of trains and of stations", "and a last one that is on birds in the woods")
    rows = [(1, three), (5, one), (5, one), (5, two), (5, three), (6, one), (7, two), (8, "a text of its own without any copy")]
    df = on_disk(documents(spark, [(i, t, "en", "a") for i, t in rows]), tmp_path / "docs")
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_first(df).collect())
    assert kept == sorted([(1, three), (5, one), (5, two), rows[-1]])


def test_one_huge_group_of_copies(spark):
    rows = [(i, "the very same words in every one of them", "en", "a") for i in range(5000)]
    found = simhash.simhash_groups(documents(spark, rows)).groupBy("component_id").count().collect()
    assert [tuple(r) for r in found] == [(0, 5000)]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(2, 1), (1, 2), (3, 2)], [(i + 1, i) for i in range(300)], [(0, i) for i in range(1, 300)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a bigint, b bigint")
    expected = union_find({n for link in links for n in link}, links)
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {n: r for n, r in expected.items() if any(n in link and link[0] != link[1] for link in links)}
