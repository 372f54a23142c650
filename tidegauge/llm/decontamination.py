"""Benchmark passages in documents: a broadcast hash set of the items' windows, scanned and verified.

A window is so many consecutive words of an item, or all words of a shorter item. Every run of as
many words of a document is looked up by a rolling hash of its words; where the hash is in the set,
the words themselves are compared.

The set is broadcast in slices of a stated number of windows. A benchmark of any size is one scan
that looks into one slice after the other, so memory is bounded by the slice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Windows in one broadcast: about 200 bytes each, so a slice is some 20 MB.
SLICE = 100_000
PRIME = 0x9E3779B97F4A7C15

# Words are runs of digits, lower-case letters and everything beyond ASCII, after
# lowering A-Z; all other bytes part words.
NORMAL = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text; NULL has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Slice(NamedTuple):
    """Windows of the benchmark, by length: sorted hashes and, by hash, words and their items."""

    numbers: dict[bytes, int]
    hashes: dict[int, np.ndarray]
    windows: dict[int, dict[int, list[tuple[tuple[bytes, ...], tuple[str, ...]]]]]


def windows_of(items: DataFrame, window: int, id_column: str, text: str) -> DataFrame:
    """(words, ids): the distinct windows of all items, joined by spaces, and the ids they occur in.

    An item without an id gives windows that mark words but name no item.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {"words": [], "item": []}
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = normal_words(body)
                for start in range(max(min(len(parts), 1), len(parts) - window + 1)):
                    found["words"].append(b" ".join(parts[start : start + window]).decode("utf-8", "surrogatepass"))
                    found["item"].append(item)
            yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("words", pa.string()), ("item", pa.string())]))

    rows = items.select(F.col(id_column).cast("string"), text).mapInArrow(cut, "words string, item string")
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("ids"))


def _hash(numbers: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` numbers."""
    runs = len(numbers) - length + 1
    total = np.zeros(runs, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            total = (total ^ numbers[i : i + runs]) * np.uint64(PRIME)
            total ^= total >> np.uint64(29)
    return total


def make_slice(rows: list[tuple[str, list[str]]]) -> Slice:
    windows = [(tuple(w.encode("utf-8", "surrogatepass").split(b" ")), tuple(ids)) for w, ids in rows]
    numbers: dict[bytes, int] = {}
    for words, _ in windows:
        for word in words:
            numbers.setdefault(word, len(numbers) + 1)
    by_length: dict[int, dict[int, list]] = {}
    for words, ids in windows:
        coded = np.array([numbers[w] for w in words], dtype=np.uint64)
        key = int(_hash(coded, len(words))[0])
        by_length.setdefault(len(words), {}).setdefault(key, []).append((words, ids))
    hashes = {n: np.sort(np.array(list(keys), dtype=np.uint64)) for n, keys in by_length.items()}
    return Slice(numbers, hashes, by_length)


def find(parts: list[bytes], known: Slice) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """(start, length, items) of every run of `parts` that is a window of the slice.

    Words the slice doesn't have are 0, and no run with one is looked up.
    """
    number = known.numbers.get
    coded = np.array([number(w, 0) for w in parts], dtype=np.uint64)
    unknown = np.concatenate([[0], np.cumsum(coded == 0)])
    for length, hashes in known.hashes.items():
        if length > len(parts):
            continue
        starts = np.flatnonzero(unknown[length:] == unknown[:-length])
        if not len(starts):
            continue
        runs = _hash(coded, length)[starts]
        at = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
        for start, key in zip(starts[hashes[at] == runs].tolist(), runs[hashes[at] == runs].tolist()):
            here = tuple(parts[start : start + length])
            for words, ids in known.windows[length][key]:
                if words == here:
                    yield start, length, ids


def slices(
    benchmark: DataFrame, window: int = WINDOW, size: int = SLICE, id_column: str = "item_id", text: str = "text"
) -> list:
    """The benchmark's windows as broadcast variables of at most `size` windows each.

    Windows are dealt by their hash over as many slices as keep them near the size; the driver holds
    one slice at a time, and workers read them one after the other.
    """
    found = windows_of(benchmark, window, id_column, text).persist()
    try:
        dealt = max(1, -(-found.count() // size))
        part = F.pmod(F.xxhash64("words"), F.lit(dealt))
        context = benchmark.sparkSession.sparkContext
        return [
            context.broadcast(make_slice([(r.words, r.ids) for r in found.filter(part == i).collect()]))
            for i in range(dealt)
        ]
    finally:
        found.unpersist()


RESULT = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "spans array<struct<start:int,end:int>>, items array<string>"
)


def hits(body: Column, known: list) -> Column:
    """struct of n_words, n_hit, n_items, items_sha256, contaminated, spans and items of a text.

    `spans` are the stretches of hit words, from the first to behind the last; `items` the ids of
    the items found, sorted as strings.
    """

    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            parts = normal_words(text)
            marks = np.zeros(len(parts) + 1, dtype=np.int64)
            items: set[str] = set()
            for one in known:
                for start, length, ids in find(parts, one.value):
                    marks[start] += 1
                    marks[start + length] -= 1
                    items.update(ids)
            hit = np.concatenate([[0], np.cumsum(marks) > 0, [0]]).astype(np.int8)
            edges = np.flatnonzero(np.diff(hit)).reshape(-1, 2).tolist()
            names = sorted(items)
            digest = hashlib.sha256(",".join(names).encode("utf-8", "surrogatepass")).hexdigest()
            count = int(hit.sum())
            rows.append((len(parts), count, len(names), digest, count > 0, [{"start": a, "end": b} for a, b in edges], names))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"])

    scan.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(scan, RESULT)(body)


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text: str = "text",
    size: int = SLICE,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans and items.

    No shuffle of documents. A NULL or empty text has no words and no hits. Items that repeat count
    once; an empty benchmark hits nothing.
    """
    known = slices(benchmark, window, size)
    return docs.select(F.col(id_column).alias("doc_id"), hits(F.col(text), known).alias("found")).select(
        "doc_id", "found.*"
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents without a hit, whole rows with all their columns. No shuffle."""
    return docs.filter(~hits(F.col(text), slices(benchmark, window))["contaminated"])


# A word where it stands in the text.
IN_PLACE = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the words of `spans` and what stands between them; what is around stays."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in IN_PLACE.finditer(raw)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """All documents, `text` without the stretches that were hit. NULL texts stay NULL. No shuffle."""
    known = slices(benchmark, window)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [t if t is None or not len(s) else without_spans(t, [(p["start"], p["end"]) for p in s]) for t, s in zip(texts, spans)],
            dtype=object,
        )

    cut.__annotations__ = {"texts": pd.Series, "spans": pd.Series, "return": pd.Series}
    column = F.pandas_udf(cut, "string")(F.col(text), hits(F.col(text), known)["spans"])
    return docs.withColumn(text, column)
