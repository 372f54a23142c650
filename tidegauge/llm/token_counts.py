"""Token counts under a unigram model, over a trie of distinct pre-tokens.

The tokens of a pre-token are the segmentation of the greatest probability. Its forward scores,
one per prefix, depend on the prefix alone: they belong to the nodes of a trie of all distinct
pre-tokens, and a prefix that many share is scored once. What the node where a pre-token ends says,
how many tokens it takes, is kept.

Pieces come from a public vocabulary file. It ranks pieces by merges rather than giving their
probabilities; the piece of rank r gets one in proportion to 1 / (r + 1), as ranked words have.
Characters without a piece fall back to the pieces of their UTF-8 bytes, as likely as the last piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: what the vocabulary puts before a word.
WORD_START = "▁"
#: Words of the documents a task counts at a time, and pre-tokens whose counts it keeps from one time
#: to the next. Kept ones are dropped and begun anew beyond; counts come out the same.
WORDS_AT_ONCE = 1_000_000
MOST_KEPT = 500_000


class Pieces(NamedTuple):
    """`tails`: every ending of a piece, with the score of the one that is a piece itself, else
    None. Read backwards from a place in a text, they end where no piece can reach it."""

    scores: dict[str, float]
    tails: dict[str, float | None]
    longest: int
    byte: float


def pieces(ranked: list[str]) -> Pieces:
    """Scores of pieces in the order of their ranks; the first of equal ones counts."""
    total = math.log(sum(1 / (r + 1) for r in range(len(ranked) + 1)))
    scores: dict[str, float] = {}
    for rank, piece in enumerate(ranked):
        scores.setdefault(piece, -math.log(rank + 1) - total)
    tails = {piece[start:]: None for piece in scores for start in range(len(piece))} | scores
    return Pieces(scores, tails, max(map(len, scores), default=1), -math.log(len(ranked) + 1) - total)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The ordinary pieces of a vocabulary file, read once by the driver: some 32,000 short strings."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    special = (model.IsControl, model.IsUnknown, model.IsUnused, model.IsByte)
    return pieces([model.IdToPiece(i) for i in range(model.GetPieceSize()) if not any(s(i) for s in special)])


def forward(known: Pieces, distinct: Iterable[bytes]) -> dict[bytes, tuple[int, float]]:
    """(tokens, score) of every pre-token. Of equal scores the one of fewer tokens is taken.

    In order, pre-tokens are the ends of a trie met depth first: what one shares with the one before is
    the branch down to where they part, whose forward scores stand, and only nodes beyond are new.
    So no more than one branch is ever held.
    """
    tails, byte, infinite = known.tails, known.byte, math.inf
    found: dict[bytes, tuple[int, float]] = {}
    scores, tokens, last = [0.0], [0], ""
    for word in sorted(distinct):
        spelled = WORD_START + word.decode("utf-8", "surrogatepass")
        shared = 0
        for x, y in zip(last, spelled):
            if x != y:
                break
            shared += 1
        del scores[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(spelled) + 1):
            best, fewest, start = -infinite, 0, end
            while start:
                start -= 1
                piece = tails.get(spelled[start:end], infinite)
                if piece is None:
                    continue
                if piece == infinite:
                    break
                score = scores[start] + piece
                if score > best or (score == best and tokens[start] < fewest):
                    best, fewest = score, tokens[start] + 1
            if tails.get(spelled[end - 1]) is None:
                length = len(spelled[end - 1].encode("utf-8", "surrogatepass"))
                score, count = scores[end - 1] + length * byte, tokens[end - 1] + length
                if score > best or (score == best and count < fewest):
                    best, fewest = score, count
            scores.append(best)
            tokens.append(fewest)
        found[word] = tokens[-1], scores[-1]
        last = spelled
    return found


def counted(known: Pieces, texts: Iterable[str | None]) -> Iterator[tuple[int, int, float]]:
    """(pre-tokens, tokens, log probability) of each text."""
    kept: dict[bytes, tuple[int, float]] = {}
    waiting: list[list[bytes]] = []
    size = 0

    def count() -> Iterator[tuple[int, int, float]]:
        distinct = set().union(*waiting)
        if len(kept) > MOST_KEPT:
            kept.clear()
        kept.update(forward(known, distinct.difference(kept)))
        for words in waiting:
            pairs = [kept[word] for word in words]
            yield len(words), sum(map(itemgetter(0), pairs)), math.fsum(map(itemgetter(1), pairs))

    for text in texts:
        waiting.append((text or "").encode("utf-8", "surrogatepass").split())
        size += len(waiting[-1])
        if size >= WORDS_AT_ONCE:
            yield from count()
            waiting, size = [], 0
    yield from count()


def count_tokens(
    docs: DataFrame, known: Pieces, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_pretokens, n_tokens and log_prob, the natural logarithm of the
    probability of its tokens.

    Pre-tokens are what stands between the six ASCII white space characters, case kept. A NULL or
    empty text has none. A task counts a bounded number of documents at a time and keeps a bounded
    number of counts; nothing is shuffled, and a lost task is just run again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)  # a vocabulary: bounded by its file
    names = ["doc_id", "n_pretokens", "n_tokens", "log_prob"]
    types = (pa.int64(), pa.int64(), pa.float64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*counted(shared.value, (body.as_py() for body in batch.column(1)))))
            columns = [pa.array(c, t) for c, t in zip(rows or [[]] * 3, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(
        count, f"doc_id {id_type}, n_pretokens bigint, n_tokens bigint, log_prob double"
    )
