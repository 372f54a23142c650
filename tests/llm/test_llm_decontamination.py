import hashlib
import re

import pytest
from cases import documents, no_documents

from tidegauge.llm import decontamination as dec
from tidegauge.llm.queries import op7_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        parts = plain_words(body)
        n = min(window, len(parts))
        if not n:
            continue
        grams = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    names = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item!"),
    (10, "short ITEM"),
    (3, ""),
    (4, None),
    (5, "..."),
    (None, "nameless passage of just six words"),
    (6, "Ünïcode wörds ÄRE kept, as they stand: A-Z only"),
    (6, "Ünïcode wörds ÄRE kept, as they stand: A-Z only"),
    (7, " ".join(["same"] * 15)),
]
TEXTS = [
    None, "", "...", "short", "a short-item and SHORT\nitem.", "zero one two three four five six seven eight nine ten, eleven twelve thirteen",
    "one two three four five six seven eight nine", "two three four five six seven eight nine ten eleven", "nameless passage of just six words",
    "say: Ünïcode wörds ÄRE kept, as they stand: a-z only", "ünïcode wörds äre kept as they stand a z only", "same " * 9, "same " * 10, "same " * 40,
    "one two three four five six seven eight nine ten " * 2000 + "short item", "one\x0btwo\x0cthree four\tfive six seven eight nine\xa0ten eleven",
]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("size", [100_000, 3])
def test_awkward_rows(spark, size):
    """Also with the benchmark cut into many slices."""
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    rows = dec.scan_documents(docs, bench(spark), size=size).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == plain(TEXTS[r.doc_id], ITEMS), TEXTS[r.doc_id]
        assert sum(s.end - s.start for s in r.spans) == r.n_hit and len(r["items"]) == r.n_items


def test_query_equals_brute_force(spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_decontamination(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        assert tuple(r)[1:] == plain(texts[r.doc_id], items), r


def test_no_rows(spark):
    docs = documents(spark)
    assert dec.scan_documents(no_documents(spark), bench(spark)).collect() == []
    assert {r.contaminated for r in dec.scan_documents(docs, bench(spark, [])).collect()} == {False}


def test_remove_documents_and_spans(spark):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    kept = dec.remove_documents(docs, bench(spark))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if not plain(t, ITEMS)[4]}
    cut = dec.remove_spans(docs, bench(spark))
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[0] is None and left[4] == "a  and ." and left[6] == TEXTS[6]
    assert left[5] == "zero  thirteen"


@pytest.mark.parametrize("window", [1, 2, 10])
def test_any_window(spark, window):
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    for r in dec.scan_documents(docs, bench(spark), window).collect():
        assert (r.n_hit, r.n_items) == plain(TEXTS[r.doc_id], ITEMS, window)[1:3]
