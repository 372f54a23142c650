"""Packing documents into training sequences, in their order.

The tokens of consecutive documents form one line, which is cut into windows, each a sequence. Cuts
are free between documents and cost a little at the end of a sentence; only a stretch longer than a
window without either is cut elsewhere. A window shorter than the sequence length is padded, unless
its length is a power of two. The cuts of least total cost are found by dynamic programming:

    cost(b) = penalty(b) + min over a of cost(a) + padding(b - a),   b - a <= length

Padding is linear, so the best a for a padded window is the least cost(a) + a among the places inside
the length: a queue of rising values gives it without a search, and each place enters and leaves it
once. Windows without padding are looked up, one place per power of two.

A task reads its part of the table once, in blocks. The last windows of a block stand at an end that
is none, so their tokens are given back to the next one.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: the sequence length, and the id that ends a document.
LENGTH = 4096
END = 2
#: Costs in tokens of padding: of a cut at the end of a sentence, of one inside a sentence, and of a
#: sequence as such, without which many short ones, free of padding, would be as good as a few long.
SENTENCE_CUT = 8
BROKEN_CUT = 512
SEQUENCE = 64
#: Places per window where a stretch longer than a window may be cut inside a sentence.
BROKEN_PLACES = 64
#: Tokens that a block has at least, unless there are no more, and bytes of text tokenized at a time.
BLOCK = 1 << 20
AT_ONCE = 1 << 22
#: Words whose ids a worker keeps. Beyond, they are dropped and begun anew; results do not change.
MOST_KEPT = 1_000_000
#: Windows at the end of a block that are decided again with what follows.
GIVEN_BACK = 3

# What ends a sentence: tokens of punctuation with one of these in it, and the tokens of these.
STOPS, OTHER_STOPS = frozenset(".!?"), "…。！？"
#: Closing punctuation behind an ASCII letter, which the tokenizer splits off anyhow.
CLOSING = r"([a-zA-Z])([.,;:!?]+)( |$)"
#: A word that stands between words tokenized in one go, and how many such there are.
BETWEEN, TOGETHER = "★", 64


def words(texts: pa.Array) -> pa.ListArray:
    """The words of texts: what stands between spaces, one kind of space made of all that text files
    have. Case goes and closing punctuation becomes a word where that changes no token; a special
    token counts as one in its own case only."""
    plain = pc.fill_null(texts, "")
    for space in "\n\t\r":
        plain = pc.replace_substring(plain, space, " ")
    if not pc.any(pc.match_substring(plain, "<|")).as_py():
        plain = pc.ascii_lower(plain)
    return pc.split_pattern(pc.replace_substring_regex(plain, CLOSING, r"\1 \2\3"), " ")


class Encoder:
    """Token ids of texts, equal to those of the tokenizer on the whole text.

    No token of the vocabulary reaches over white space, so each word has its ids, whatever stands
    around it. Words come again and again; each is tokenized once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spelled = [(i, s.removesuffix("</w>")) for s, i in self.tokenizer.get_vocab().items()]
        size = max(i for i, _ in spelled) + 1
        self.stops = np.zeros(size, bool)
        self.stops[[i for i, s in spelled if STOPS & set(s) and not any(map(str.isalnum, s))]] = True
        for stop in OTHER_STOPS:
            ids = self.tokenizer.encode(stop, add_special_tokens=False).ids
            self.stops[ids] |= len(ids) == 1
        (self.between,) = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        """Code 0 is the end of a document, which is no word."""
        self.codes: dict[str, int] = {}
        self.ids = np.array([END], np.uint32)
        self.lengths = np.array([1])

    def learn(self, unseen: list[str]) -> None:
        """Words are tokenized many at once, told apart by a word whose token no other word has."""
        odd = [word for word in unseen if BETWEEN in word]
        most = [word for word in unseen if BETWEEN not in word]
        joined = [f" {BETWEEN} ".join(most[i : i + TOGETHER]) for i in range(0, len(most), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        line = np.array(list(chain.from_iterable([*e.ids, self.between] for e in found)), np.uint32)
        gaps = np.flatnonzero(line == self.between)
        alone = [e.ids for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
        lengths = np.concatenate([np.diff(gaps, prepend=-1) - 1, np.array([len(a) for a in alone], np.int64)])
        self.codes.update(zip(chain(most, odd), range(len(self.lengths), len(self.lengths) + len(unseen))))
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate(
            [self.ids, line[line != self.between], np.array(list(chain.from_iterable(alone)), np.uint32)]
        )

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (at least one), each with its END, and how many each has."""
        listed = words(texts)
        coded = listed.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.codes) > MOST_KEPT:
            self.forget()
        code = np.fromiter(map(self.codes.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(code < 0)
        if len(new):
            unseen = [distinct[i] for i in new.tolist()]
            self.learn(unseen)
            code[new] = [self.codes[word] for word in unseen]
        ends = np.cumsum(pc.list_value_length(listed).to_numpy())
        codes = np.insert(code[coded.indices.to_numpy()], ends, 0)
        lengths = self.lengths[codes]
        until = np.cumsum(lengths)
        starts = (np.cumsum(self.lengths) - self.lengths)[codes]
        ids = self.ids[np.repeat(starts - (until - lengths), lengths) + np.arange(until[-1])]
        return ids, np.diff(until[ends + np.arange(len(ends))], prepend=0)


class Line(NamedTuple):
    """Consecutive tokens, whole documents but perhaps the first: where each document ends, its row,
    and, for the first, how many of its tokens came before."""

    ids: np.ndarray
    ends: np.ndarray
    rows: list
    skipped: int


class Row(NamedTuple):
    doc_id: object
    tokens: int


def places(line: Line, stops: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Where a line may be cut, beginning and end included, and the penalty of each place."""
    sentences = np.flatnonzero(stops[line.ids]) + 1
    at = np.union1d(np.concatenate([[0], line.ends]), sentences)
    penalty = np.where(np.isin(at, line.ends, assume_unique=True), 0, SENTENCE_CUT)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > length)
    if len(wide):
        step = max(1, length // BROKEN_PLACES)
        more = np.concatenate([np.arange(at[i] + step, at[i + 1], step) for i in wide])
        at, penalty = np.concatenate([at, more]), np.concatenate([penalty, np.full(len(more), BROKEN_CUT)])
        order = np.argsort(at)
        at, penalty = at[order], penalty[order]
    return at, penalty + SEQUENCE


def exact_windows(at: np.ndarray, length: int = LENGTH) -> tuple[list[int], list[int]]:
    """For each place, the places a power of two before it, as one list and where each one's part ends."""
    later, earlier = [], []
    for power in range(length.bit_length()):
        want = at - (1 << power)
        found = np.searchsorted(at, want)
        hit = np.flatnonzero((want >= 0) & (at[found] == want))
        later.append(hit)
        earlier.append(found[hit])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    return earlier[order].tolist(), np.cumsum(np.bincount(later, minlength=len(at))).tolist()


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Numbers of the places that cut the line at the least cost, first and last included."""
    places, extra = at.tolist(), penalty.tolist()
    before, upto = exact_windows(at, length)
    cost, came = [0] * len(places), [0] * len(places)
    # Places that may begin a padded window, cost + place rising: the first is the best one.
    queue: deque[tuple[int, int, int]] = deque()
    start = upto[0]
    for i in range(1, len(places)):
        here = places[i]
        value = cost[i - 1] + places[i - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i - 1, places[i - 1]))
        while queue[0][2] < here - length:
            queue.popleft()
        least, origin, _ = queue[0]
        least += length - here
        stop = upto[i]
        for j in before[start:stop]:
            if cost[j] < least:
                least, origin = cost[j], j
        start = stop
        cost[i], came[i] = least + extra[i], origin
    path = [len(places) - 1]
    while path[-1]:
        path.append(came[path[-1]])
    return np.array(path[::-1])


def pieces(line: Line, cuts: np.ndarray, first_sequence: int, first_start: int) -> dict[str, np.ndarray]:
    """Pieces of documents up to the last cut, in order. `first_start`: tokens of the first document
    before the line."""
    bounds = np.union1d(cuts, line.ends[line.ends < cuts[-1]])
    begin, end = bounds[:-1], bounds[1:]
    doc = np.searchsorted(line.ends, begin, side="right")
    doc_begin = np.concatenate([[-first_start], line.ends])[doc]
    sequence = np.searchsorted(cuts, begin, side="right") - 1
    return {
        "doc": doc, "start": begin - doc_begin, "length": end - begin, "begin": begin,
        "sequence": sequence + first_sequence, "offset": begin - cuts[sequence],
    }


def pack(
    texts: Iterable[tuple[list, pa.Array]], encoder: Encoder, length: int = LENGTH, block: int = BLOCK
) -> Iterator[tuple[Line, dict[str, np.ndarray]]]:
    """Lines with their pieces, from batches of (ids of documents, texts)."""
    line = Line(np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0)
    sequence = 0

    def cut(last: bool) -> tuple[dict[str, np.ndarray], np.ndarray]:
        at, penalty = places(line, encoder.stops, length)
        path = at[best_cuts(at, penalty, length)]
        path = path if last or len(path) <= GIVEN_BACK + 1 else path[:-GIVEN_BACK]
        return pieces(line, path, sequence, line.skipped), path

    for doc_ids, bodies in texts:
        ids, sizes = encoder(bodies)
        ends = np.cumsum(sizes) + len(line.ids)
        rows = [Row(doc_id, size) for doc_id, size in zip(doc_ids, sizes.tolist())]
        line = Line(np.concatenate([line.ids, ids]), np.concatenate([line.ends, ends]), line.rows + rows, line.skipped)
        if len(line.ids) < block:
            continue
        found, path = cut(False)
        yield line, found
        sequence += len(path) - 1
        done = int(path[-1])
        first = int(np.searchsorted(line.ends, done, side="right"))
        begun = line.ends[first - 1] if first else -line.skipped
        line = Line(line.ids[done:].copy(), line.ends[first:] - done, line.rows[first:], int(done - begun) if first < len(line.ends) else 0)
    if len(line.ids):
        yield line, cut(True)[0]


def portions(texts: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts of at most so many bytes; a longer text is a run by itself."""
    until = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(until):
        before = until[first - 1] if first else 0
        last = max(int(np.searchsorted(until, before + at_once, side="right")), first + 1)
        yield first, last - first
        first = last


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker: its words serve all the tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_documents(
    docs: DataFrame, vocabulary: str, length: int = LENGTH, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per piece of a document: doc_id, start (its tokens before), length, ids (unsigned 32-bit little
    endian numbers), doc_tokens, sequence_id and offset (its place in the sequence).

    Every document ends in END; a NULL or empty text has that token alone. A text of any length is
    tokenized whole and cut as often as needed. Rows are packed in their order inside each partition of
    the input, and a sequence holds rows of one partition, so nothing is shuffled and a lost task makes
    the same pieces again. Rows that repeat an id, or have none, are packed like others, each with
    pieces of its own. `vocabulary` is a file that every executor can read.

    A task holds a block of tokens, at least the longest document.
    """
    if length < 2 or length & (length - 1):
        raise ValueError("a sequence length has to be a power of two")
    id_type = docs.schema[id_column].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, id_kind = TaskContext.get().partitionId() << 33, None

        def texts() -> Iterator[tuple[list, pa.Array]]:
            nonlocal id_kind
            for batch in batches:
                id_kind = batch.column(0).type
                for first, number in portions(batch.column(1)):
                    part = batch.slice(first, number)
                    yield part.column(0).to_pylist(), part.column(1)

        for line, found in pack(texts(), _encoder(vocabulary), length):
            rows = [line.rows[i] for i in found["doc"].tolist()]
            until = 4 * np.append(found["begin"], found["begin"][-1] + found["length"][-1])
            ids = line.ids[: until[-1] // 4].astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row.doc_id for row in rows], id_kind),
                    pa.array(found["start"]),
                    pa.array(found["length"]),
                    pa.Array.from_buffers(
                        pa.binary(), len(rows), [None, pa.py_buffer(until.astype(np.int32)), pa.py_buffer(ids)]
                    ),
                    pa.array([row.tokens for row in rows], pa.int64()),
                    pa.array(found["sequence"] + place),
                    pa.array(found["offset"]),
                ],
                names,
            )

    return docs.select(id_column, text).mapInArrow(
        work,
        f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def digest(packed: DataFrame) -> DataFrame:
    """A checksum of each piece in place of its ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
