"""SimHash fingerprints and the groups that few differing bits link.

The index has a posting list per four positions of the eight bytes of a fingerprint and their
values. Four or fewer differing bits touch at most four bytes, so linked fingerprints agree on at
least four bytes in place: the guaranteed minimum. Lists of single bytes would hold a 256th of all
fingerprints each, and tallying their pairs would be quadratic. A list of four bytes holds just the
pairs whose tally reaches the minimum, so the count filter is in its key; inside a list differing
bits are counted.

Only links that join groups leave a list: (fingerprint, least fingerprint of its group there), never
all its pairs. Components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import components
from tidegauge.llm.tables import settle, words

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Longer lists are dealt anew by half bytes.
LONGEST_LIST = 4096
HASHES_AT_ONCE = 200_000
PAIRS_AT_ONCE = 1_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number; 0 without words."""
    parts = words(text)
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(w) + 1 for w in parts]) - 1
    first = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(first.tolist(), ends[k - 1 :].tolist())], dtype="<u8"
    )
    # `unpackbits` of little-endian bytes, little bits first, gives bit 0 to 63 of each hash.
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        block = hashes[start : start + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["doc_id", "fp"])

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(hashed, f"doc_id {id_type}, fp bigint")


def list_masks(distance: int = DISTANCE) -> np.ndarray:
    """The bits that a list of the index fixes: a mask per choice of bytes that must be equal."""
    chosen = combinations(range(8), 8 - distance)
    return np.array([sum(0xFF << (8 * i) for i in c) for c in chosen], dtype=np.uint64)


def finer_masks(mask: int, distance: int) -> np.ndarray:
    """For a list that is too long: `mask` with a choice of half of the other bytes' half bytes.

    As many half bytes as bits may differ are equal in linked fingerprints, by the same count.
    """
    free = [i for i in range(16) if not mask >> (4 * i) & 1]
    chosen = combinations(free, len(free) - distance)
    return np.array([mask | sum(0xF << (4 * i) for i in c) for c in chosen], dtype=np.uint64)


def linked(fps: np.ndarray, distance: int) -> np.ndarray:
    """For distinct fingerprints in order: the place of the least one of each one's group.

    A block of rows meets all others at a time, so memory grows with the number of fingerprints, not
    its square. Groups form by taking the least place among neighbours until nothing changes.
    """
    n = len(fps)
    rows = max(1, PAIRS_AT_ONCE // n)
    root = np.arange(n)
    while True:
        new = root.copy()
        for start in range(0, n, rows):
            near = np.bitwise_count(fps[start : start + rows, None] ^ fps[None, :]) <= distance
            reach = np.where(near, new[None, :], n).min(axis=1)
            new[start : start + rows] = np.minimum(new[start : start + rows], reach)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _runs(batches: Iterator[pa.RecordBatch], longest: int | None) -> Iterator[tuple]:
    """(number, fingerprints, whole) of the lists in sorted rows of number, part and fp.

    A list may go on over many batches. One of more than `longest` rows is handed out in pieces,
    `whole` False, so no more than that and a batch are ever held.
    """
    held, cut = None, False
    for batch in batches:
        now = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        if not now.shape[1]:
            continue
        if held is not None:
            now = np.concatenate([held, now], axis=1)
        new = np.flatnonzero((now[0, 1:] != now[0, :-1]) | (now[1, 1:] != now[1, :-1])) + 1
        edges = np.concatenate([[0], new, [now.shape[1]]])
        sizes = np.diff(edges)
        # Lists of one fingerprint link nothing; the first may be the end of one in pieces, and the
        # last may go on.
        many = np.flatnonzero(sizes[:-1] > 1).tolist()
        if cut and len(sizes) > 1 and 0 not in many:
            many.insert(0, 0)
        for i in many:
            whole = not (cut and i == 0)
            yield int(now[0, edges[i]]), now[2, edges[i] : edges[i + 1]], whole
        if len(sizes) > 1:
            cut = False
        held = now[:, edges[-2] :]
        if longest and held.shape[1] > longest:
            yield int(held[0, 0]), held[2], False
            held, cut = held[:, -1:], True  # one row stays to know the list by; it is told twice
    if held is not None and (held.shape[1] > 1 or cut):
        yield int(held[0, 0]), held[2], not cut


def _tie_lists(rows: DataFrame, distance: int, longest: int | None) -> DataFrame:
    """(a, b, number): b is the least fingerprint of a's group in a list; or, where `number` is not
    NULL, a is in the list of that number, which is too long to compare here."""

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, signed, whole in _runs(batches, longest):
            if not whole or (longest and len(signed) > longest):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed), pa.array(signed), pa.array(np.full(len(signed), number, np.int32))],
                    ["a", "b", "number"],
                )
                continue
            root = linked(signed.view(np.uint64), distance)
            joined = np.flatnonzero(root != np.arange(len(root)))
            if len(joined):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed[joined]), pa.array(signed[root[joined]]), pa.nulls(len(joined), pa.int32())],
                    ["a", "b", "number"],
                )

    dealt = rows.repartition("number", "part").sortWithinPartitions("number", "part", "fp")
    return dealt.mapInArrow(tied, "a bigint, b bigint, number int")


def links(fps: DataFrame, distance: int = DISTANCE, longest: int = LONGEST_LIST) -> DataFrame:
    """(a, b): links that join what `distance` or fewer differing bits join; `fps` (fp) is distinct.

    A fingerprint is in as many lists as there are choices, so no list holds more than one row in 70
    at the usual distance. One longer than `longest` is dealt anew under half bytes; what is equal
    there leaves 16 free bits, so such a list can't hold more than 65,536 fingerprints, however many
    documents there are.
    """
    if not 0 <= distance < 8:
        raise ValueError("the index needs a byte that must be equal: a distance of 0 to 7")
    masks = list_masks(distance)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for number, mask in enumerate(masks):
                part = (fp.view(np.uint64) & mask).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), number, np.int32)), pa.array(part), pa.array(fp)],
                    ["number", "part", "fp"],
                )

    def listed_finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps_of, numbers = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for number in np.unique(numbers):
                fp = fps_of[numbers == number]
                finer = finer_masks(int(masks[number]), distance)
                for i, mask in enumerate(finer):
                    part = (fp.view(np.uint64) & mask).view(np.int64)
                    name = np.full(len(fp), number * len(finer) + i, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name), pa.array(part), pa.array(fp)], ["number", "part", "fp"]
                    )

    schema = "number int, part bigint, fp bigint"
    first = settle(_tie_lists(fps.select("fp").mapInArrow(listed, schema), distance, longest), "lists")
    long = first.filter("number IS NOT NULL").select("a", "number").distinct()
    second = _tie_lists(long.mapInArrow(listed_finer, schema), distance, None)
    return first.filter("number IS NULL").select("a", "b").unionByName(second.select("a", "b"))


def _grouped(docs: DataFrame, shingle: int, distance: int, id_column: str, text: str) -> DataFrame:
    """(doc_id, fp, root, component_id): root is a fingerprint and names a group, also where two groups
    have one component_id."""
    fps = settle(fingerprints(docs, shingle, id_column, text), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fps.select("fp").distinct(), distance))
    rooted = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.join(named, "root").select("fp", "root", "component_id")
    return fps.join(ids, "fp").select("doc_id", "fp", "root", "component_id")


def simhash_groups(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id among the documents that links reach, itself included. Texts
    without words, NULL among them, have the fingerprint 0 and are linked like others. A document
    without an id is linked too, but is nobody's component_id; a group of such documents only has
    NULL. Copies share a fingerprint, which the index sees once, so groups of any size cost no more
    than one row.
    """
    return _grouped(docs, shingle, distance, id_column, text).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One document of each group, whole rows: that of the smallest id. Of a group's rows that repeat
    this id one of the least fingerprint stays; rows of one id may stand in several groups. A group
    without any id has no such document; all of its rows stay."""
    groups = settle(_grouped(docs, shingle, distance, id_column, text), "groups")
    kept = groups.filter("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("fp").alias("_tg_fp"))
    kept = kept.select(F.col("doc_id").alias("_tg_id"), "_tg_fp")
    several = groups.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    several = several.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_tg_id"))
    nameless = groups.filter("component_id IS NULL").select(F.col("fp").alias("_tg_fp"))
    by_id = F.col(id_column) == F.col("_tg_id")
    mixed = not several.isEmpty()
    plain = kept.join(several, "_tg_id", "left_anti") if mixed else kept
    first = docs.join(plain.select("_tg_id").distinct(), by_id, "left_semi").dropDuplicates([id_column])
    if not mixed and nameless.isEmpty():
        return first

    def signed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="uint64").astype("int64")

    signed.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    sign = F.pandas_udf(signed, "bigint")(F.col(text))
    if mixed:
        # The id doesn't tell these rows apart: they are signed again.
        again = docs.join(several, by_id, "left_semi").withColumn("_tg_fp", sign)
        chosen = kept.select(F.col("_tg_id"), F.col("_tg_fp").alias("_tg_kept"))
        own = again.join(chosen, by_id & (F.col("_tg_fp") == F.col("_tg_kept")), "left_semi")
        first = first.unionByName(own.dropDuplicates([id_column, "_tg_fp"]).drop("_tg_fp"))
    without = docs.filter(F.col(id_column).isNull()).withColumn("_tg_fp", sign)
    return first.unionByName(without.join(nameless.distinct(), "_tg_fp", "left_semi").drop("_tg_fp"))
