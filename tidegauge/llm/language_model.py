"""Scoring texts by a weighted backoff automaton over the corpus's own n-grams.

States are n-grams seen in learning texts, the empty one among them. A seen n-gram is an arc from
the state of its first words, weighted with its smoothed probability; a state's failure arc leads to
the state without the first word, weighted with the share of probability it leaves. A text is read
once from left to right, carrying the state and adding up logarithms.

    p(w | h) = (c(hw) + T(h) p(w | h')) / (c(h) + T(h)),   T(h) = HEAPS_SCALE c(h) ** HEAPS_POWER

T(h) stands for the number of different words that follow h (Witten and Bell); by Heaps' law it is a
power of c(h), so nothing but counts has to be gathered. p(w) is the add-0.1 estimate, and the
failure arc's share is T(h) / (c(h) + T(h)): probabilities of all words add up to one in each state.

The automaton of a large corpus fits no machine. A task cuts the texts it reads into blocks of bounded
size and writes each as numbers, once. A block asks for its own distinct n-grams, sorted by hash and cut into a
fixed number of ranges, a row each; counting tasks sum what all blocks have seen in a range, a stretch of it at a
time, and answer each row. A block then builds the part of the automaton that its texts can reach. Texts are not
shuffled, and rows between the steps grow with the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import settle, words

ORDER = 2
ADD = 0.1
# Found on held-out texts: best among scales 0.5 to 16 and powers 0.5 to 1.
HEAPS_SCALE = 3.0
HEAPS_POWER = 0.85
#: Bytes of text in a block: it bounds what a task holds.
BLOCK_BYTES = 8_000_000
#: Ranges of hashes. A block sends a row for each, whatever the size of the corpus.
RANGES = 1024
#: N-grams that a counting task holds at a time, on average over stretches of its ranges.
HELD = 2_000_000
SEED = 17


class _Places(dict):
    """word: its place in the order of first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class Coded(NamedTuple):
    """Texts as numbers: a 64-bit hash of each different word, the place among them of each token, and the
    tokens of each text. Words are told apart by hash: two of a billion share one with odds of about 1 in 40."""

    words: np.ndarray
    tokens: np.ndarray
    lengths: np.ndarray


class Grams(NamedTuple):
    """The n-grams of a block, for each order: distinct hashes, the place of the n-gram that ends at
    each token (-1: the text is too short there), and for orders above 1 where each first occurs."""

    ends: np.ndarray
    distinct: list[np.ndarray]
    at: list[np.ndarray]
    first: list[np.ndarray | None]


def _mix(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A hash of an n-gram from those of its first words and its last."""
    with np.errstate(over="ignore"):
        x = (before * np.uint64(0x9E3779B97F4A7C15)) ^ word
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def code(texts: list[str | None]) -> Coded:
    """Each text is its words and one end, which is the empty word."""
    places, tokens, lengths = _Places(), [], []
    for text in texts:
        parts = words(text)
        parts.append(b"")
        tokens.append(np.array([places[w] for w in parts], dtype="<i4"))
        lengths.append(len(parts))
    hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in places], dtype="<u8")
    return Coded(hashes, np.concatenate(tokens), np.array(lengths, dtype="<i4"))


def grams(coded: Coded, order: int) -> Grams:
    ends = np.cumsum(coded.lengths, dtype=np.int64)
    since = np.arange(len(coded.tokens)) - np.repeat(ends - coded.lengths, coded.lengths)
    hashes = coded.words[coded.tokens]
    distinct, at, first, longer = [coded.words], [coded.tokens], [None], hashes
    for n in range(2, order + 1):
        longer = np.concatenate([[np.uint64(0)], _mix(longer[:-1], hashes[1:])])
        inside = np.flatnonzero(since >= n - 1)
        found, where, places = np.unique(longer[inside], return_index=True, return_inverse=True)
        place = np.full(len(hashes), -1, dtype="<i4")
        place[inside] = places
        distinct.append(found)
        at.append(place)
        first.append(inside[where])
    return Grams(ends, distinct, at, first)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, their first bytes together, then their second ones and so on. Those that are nearly equal
    compress away."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(hashes: np.ndarray) -> bytes:
    """By the steps from one to the next."""
    return pack(np.diff(hashes, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype="<u8")


def _block(texts: list, ids: list[pa.Array], learning: list) -> pa.RecordBatch:
    coded = code(texts)
    ids = pa.concat_arrays(ids)
    learning = np.array(learning, np.uint8)
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([len(coded.tokens)], pa.int64()), pa.array([int(coded.lengths[learning > 0].sum())], pa.int64()),
            *(pa.array([pack(x)], pa.binary()) for x in (learning, *coded)),
        ],
        names=["ids", "size", "learned", "learning", "words", "tokens", "lengths"],
    )


def cut_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """`docs` (doc_id, text, learning) as blocks, one row each, written once: block, ids, learning, and the
    parts of `Coded`, with the tokens of all texts (`size`) and of learning ones (`learned`). A task starts a new block when the texts of one reach `block_bytes` characters, so a block is
    longer than that by one text at most."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids, learning, size = [], [], [], 0
        for batch in batches:
            start = 0
            for i, (text, learns) in enumerate(zip(batch.column("text"), batch.column("learning").to_pylist())):
                texts.append(text.as_py())
                learning.append(learns)
                size += len(texts[-1] or "")
                if size >= block_bytes:
                    ids.append(batch.column("doc_id").slice(start, i + 1 - start))
                    yield _block(texts, ids, learning)
                    texts, ids, learning, size, start = [], [], [], 0, i + 1
            if start < batch.num_rows:
                ids.append(batch.column("doc_id").slice(start))
        if texts:
            yield _block(texts, ids, learning)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"ids array<{id_type}>, size bigint, learned bigint, learning binary, words binary, tokens binary, lengths binary"
    # The number is written with its row, so all that reads the blocks finds the same.
    return settle(docs.mapInArrow(cut, schema).withColumn("block", F.monotonically_increasing_id()), "blocks")


def _coded(words: bytes, tokens: bytes, lengths: bytes) -> Coded:
    return Coded(unpack(words, "<u8"), unpack(tokens, "<i4"), unpack(lengths, "<i4"))


def _cuts(hashes: np.ndarray, skip: int, bits: int) -> Iterator[tuple[int, int, int]]:
    """Sorted hashes by the `bits` bits that follow the first `skip`: the value, from where, to where. The first
    `skip` bits are the same in all."""
    value = ((hashes << np.uint64(skip)) >> np.uint64(64 - bits)) if bits else np.zeros(len(hashes), np.uint64)
    edges = np.flatnonzero(np.diff(value.astype(np.int64), prepend=-1))
    yield from zip(value[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(hashes)])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


PIECE = "part int, block bigint, grams binary, seen binary"
PIECE_ROWS = 256
WORD_ROWS = 1 << 16


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for held in batched(rows, PIECE_ROWS):
        columns = [pa.array(column, kind) for column, kind in zip(zip(*held), schema.types)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def requests(blocks: DataFrame, order: int, ranges: int = RANGES) -> DataFrame:
    """A row per block and range: the block's distinct n-grams up to `order` in it, by hash, and how often
    learning texts of the block have each. `ranges` is a power of two."""
    bits = ranges.bit_length() - 1
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("grams", pa.binary()), ("seen", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for number, *block in _rows(batches):
            learning, *coded = block
            known = grams(_coded(*coded), order)
            learn = np.repeat(unpack(learning, "?"), np.diff(known.ends, prepend=0))
            counts = np.concatenate([
                np.bincount(at[learn & (at >= 0)], minlength=len(distinct)) for distinct, at in zip(known.distinct, known.at)
            ]).astype("<i4")
            hashes = np.concatenate(known.distinct)
            by = by_hash(hashes)
            hashes, counts = hashes[by], counts[by]
            for part, start, end in _cuts(hashes, 0, bits):
                yield part, number, pack_sorted(hashes[start:end]), pack(counts[start:end])

    return blocks.select("block", "learning", "words", "tokens", "lengths").mapInArrow(
        lambda batches: _batches(ask(batches), schema), PIECE
    )


def by_hash(hashes: np.ndarray) -> np.ndarray:
    """The order in which a block asks for its n-grams and is answered."""
    return np.argsort(hashes, kind="stable")


def in_stretches(pieces: DataFrame, tasks: int, ranges: int, stretches: int) -> DataFrame:
    """Requests gathered by range, and in a task sorted by stretch, the further cut of a range that a counting
    task holds at once. Cutting and sorting send nothing: sorts may spill, and a stretch has as many rows
    as there are blocks with an n-gram in it, so rows are never more than n-grams."""
    skip, bits = ranges.bit_length() - 1, stretches.bit_length() - 1
    schema = pa.schema([
        ("part", pa.int32()), ("stretch", pa.int32()), ("block", pa.int64()), ("grams", pa.binary()), ("seen", pa.binary()),
    ])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, block, packed, seen in _rows(batches):
            hashes, counts = unpack_sorted(packed), unpack(seen, "<i4")
            for stretch, start, end in _cuts(hashes, skip, bits):
                yield part, stretch, block, pack_sorted(hashes[start:end]), pack(counts[start:end])

    gathered = pieces.repartition(tasks, "part")
    if stretches > 1:
        cut = gathered.mapInArrow(lambda b: _batches(split(b), schema), "part int, stretch int, block bigint, grams binary, seen binary")
    else:
        cut = gathered.select("part", F.lit(0).alias("stretch"), "block", "grams", "seen")
    return cut.sortWithinPartitions("part", "stretch", "block")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per stretch: its place, the blocks that ask, where each one's n-grams end, the totals of all different
    n-grams, and which of them each block asks for, one after another."""
    for (part, stretch), rows in groupby(_rows(batches), key=lambda row: row[:2]):
        blocks, asked, seen = zip(*((block, unpack_sorted(packed), unpack(counts, "<i4")) for _, _, block, packed, counts in rows))
        distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.zeros(len(distinct), dtype="<i8")
        np.add.at(totals, place, np.concatenate(seen))
        yield part, stretch, blocks, np.cumsum([len(a) for a in asked]).tolist(), totals, place


def different_words(blocks: DataFrame) -> int:
    """Of learning texts."""

    def heard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for learning, *block in _rows(batches):
            coded = _coded(*block)
            learn = np.repeat(unpack(learning, "?"), coded.lengths)
            found = coded.words[np.bincount(coded.tokens[learn], minlength=len(coded.words)) > 0].view("<i8")
            for start in range(0, len(found), WORD_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(found[start : start + WORD_ROWS])], names=["word"])

    coded = blocks.select("learning", "words", "tokens", "lengths")
    return coded.mapInArrow(heard, "word bigint").distinct().count()


def answers(stretches: DataFrame, several: bool) -> DataFrame:
    """A row per request: the counts in all learning texts, in the order asked. `several`: a range has more
    than one stretch, whose answers are joined first."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("totals", pa.binary())])
    cut = pa.schema([("part", pa.int32()), ("stretch", pa.int32()), ("block", pa.int64()), ("totals", pa.binary())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, stretch, blocks, ends, totals, place in _counted(batches):
            for block, start, end in zip(blocks, [0, *ends], ends):
                yield part, stretch, block, pack(totals[place[start:end]])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (part, block), rows in groupby(_rows(batches), key=lambda row: (row[0], row[2])):
            yield part, block, pack(np.concatenate([unpack(totals, "<i8") for *_, totals in rows]))

    told = stretches.mapInArrow(lambda b: _batches(answer(b), cut), "part int, stretch int, block bigint, totals binary")
    if not several:
        return told.drop("stretch")
    return told.sortWithinPartitions("part", "block", "stretch").mapInArrow(
        lambda b: _batches(joined(b), schema), "part int, block bigint, totals binary"
    )


class Automaton:
    """The part of the automaton that a block of texts can reach.

    `arc[n - 1]` is the base-10 logarithm of the arc of each n-gram of the block, and `seen` whether
    there is one; `fail[n - 1]` is the weight of the failure arc of the state of each n-gram. An
    unknown word has an arc from the empty state, which fails nowhere.
    """

    def __init__(self, known: Grams, counts: list[np.ndarray], tokens: int, types: int):
        order = len(counts)
        p = (counts[0] + ADD) / (tokens + ADD * (types + 1))
        self.base = np.log10(p)
        self.seen, self.arc, self.fail = [np.ones(len(p), bool)], [self.base], []
        smoothed = [p]
        for n in range(2, order + 1):
            c = counts[n - 2].astype(float)
            kept = HEAPS_SCALE * np.power(np.maximum(c, 1), HEAPS_POWER)
            self.fail.append(np.where(c > 0, np.log10(kept / (c + kept)), 0.0))
            # An n-gram's state and what it backs off to are read where it first occurs.
            end = known.first[n - 1]
            state = known.at[n - 2][end - 1]
            lower = smoothed[-1][known.at[n - 2][end]]
            value = np.where(c[state] > 0, (counts[n - 1] + kept[state] * lower) / (c[state] + kept[state]), lower)
            smoothed.append(value)
            self.seen.append(counts[n - 1] > 0)
            self.arc.append(np.log10(value))
        self.states = [c > 0 for c in counts[: order - 1]]
        # The last entry stands for n-grams that a text is too short for; it is never followed.
        for parts in (self.seen, self.arc, self.fail, self.states):
            parts[:] = [np.append(x, x.dtype.type(0)) for x in parts]

    def read(self, places: list[np.ndarray]) -> float:
        """The log probability of a text; `places` are those of its n-grams, by order and end."""
        seen, arc, fail, states = (
            [x[at].tolist() for x, at in zip(parts, places)] for parts in (self.seen, self.arc, self.fail, self.states)
        )
        longest, total, depth = len(states), 0.0, 0
        for i in range(len(places[0])):
            n = depth
            # Follow failure arcs until a state has an arc for this word.
            while n and not seen[n][i]:
                n -= 1
                total += fail[n][i - 1]
            total += arc[n][i]
            # The longest n-gram that ends here and is a state is carried on.
            depth = min(n + 1, longest)
            while depth and not states[depth - 1][i]:
                depth -= 1
        return total


def _score(block: dict, ids: pa.Array, totals: np.ndarray, order: int, tokens: int, types: int) -> pa.Table:
    known = grams(_coded(block["words"], block["tokens"], block["lengths"]), order)
    told = np.empty_like(totals)
    told[by_hash(np.concatenate(known.distinct))] = totals
    edges = np.cumsum([0, *map(len, known.distinct)])
    counts = [told[a:b] for a, b in zip(edges, edges[1:])]
    model = Automaton(known, counts, tokens, types)
    rows, start = [], 0
    for end in known.ends.tolist():
        at = [x[start:end] for x in known.at]
        uni = at[0]
        rows.append((end - start, int((counts[0][uni] > 0).sum()), float(model.base[uni].sum()), model.read(at)))
        start = end
    n_tokens, n_known, base, score = zip(*rows)
    learning = unpack(block["learning"], "?")
    return pa.table({
        "doc_id": ids, "held_out": pa.array(~learning), "n_tokens": pa.array(n_tokens, pa.int64()),
        "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * len(rows), pa.int64()),
        "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
    })


def score_texts(
    docs: DataFrame, learning: Column, id_column: str = "doc_id", text: str = "text",
    order: int = ORDER, block_bytes: int = BLOCK_BYTES, ranges: int = RANGES, held: int = HELD,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from the rows where `learning` holds (NULL: it doesn't) and scores all. A NULL or empty text is one end
    token. With nothing to learn from every token has the same probability. Texts of any length are
    read whole; a block holds at least one text. However often an n-gram occurs, a block asks for it once.
    `ranges`, a power of two, and `held` set the rows a block sends and the n-grams a counting task holds.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.coalesce(learning, F.lit(False)).alias("learning")
    )
    blocks = cut_blocks(rows, block_bytes)
    count, length, tokens = blocks.agg(
        F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "learned"))
    ).first()
    types = different_words(blocks)
    stretches = 1 << (order * length // (ranges * held)).bit_length()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(ranges, max(count, cores)))
    told = answers(in_stretches(requests(blocks, order, ranges), tasks, ranges, stretches), stretches > 1)

    def score(block: pa.Table, told: pa.Table) -> pa.Table:
        ids = block.column("ids").combine_chunks().flatten()
        known = block.drop_columns(["ids"]).to_pylist()[0]
        parts = sorted(zip(told.column("part").to_pylist(), told.column("totals").to_pylist()))
        totals = np.concatenate([unpack(totals, "<i8") for _, totals in parts])
        return _score(known, ids, totals, order, tokens, types)

    id_type = docs.schema[id_column].dataType.simpleString()
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score,
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
