"""Fill-in-the-middle: texts cut into prefix, middle and suffix, with the middle moved to the end.

A text is a row of units: runs of ASCII letters, and single other characters. Two draws choose the
units after which it is cut. Models want these places in characters, files in bytes. A text is kept
as its UTF-8 bytes with a sparse index of its exceptions: where its multibyte characters stand, and
how many bytes beyond one they have taken so far. Between them a place in bytes and one in characters
differ by a constant, so converting a cut is one binary search, and in an ASCII text nothing at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import id_text

# Fixed values of the contract: marks, seed of the draws, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
CHANGED = 90
SUFFIX_FIRST = 20
DRAWS = 4


class Exceptions(NamedTuple):
    """Multibyte characters of a text: the byte each begins at, its number as a character, and the
    excess bytes of all before each, and, as the last entry, of all."""

    at_byte: np.ndarray
    at_char: np.ndarray
    excess: np.ndarray

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Cuts between characters, given in bytes, as numbers of characters."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Cuts given in characters, as numbers of bytes."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)]


def exceptions(text: np.ndarray) -> Exceptions:
    """The index of a text, given as its UTF-8 bytes."""
    at = np.flatnonzero(text >= 0xC0)
    lead = text[at]
    more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
    excess = np.concatenate([[0], np.cumsum(more)]).astype(np.int64)
    return Exceptions(at, at - excess[:-1], excess)


def unit_starts(text: np.ndarray) -> np.ndarray:
    """The bytes at which units begin, and the end of the text."""
    letter = ((text | 0x20) >= 0x61) & ((text | 0x20) <= 0x7A)
    begins = (text & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.append(np.flatnonzero(begins), len(text))


class Cut(NamedTuple):
    """One text's units, form, cuts in characters (None: left as it is) and output."""

    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def rearrange(body: bytes, draws: tuple[int, ...], changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> Cut:
    """`draws`: two for the cuts, one for whether the text is changed, one for the form."""
    prefix, suffix, middle = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    text = np.frombuffer(body, np.uint8)
    starts = unit_starts(text)
    n = len(starts) - 1
    if not body or any(mark in body for mark in (prefix, suffix, middle)) or draws[2] % 100 >= changed:
        return Cut(n, "plain", None, None, body)
    ends = starts[sorted((draws[0] % (n + 1), draws[1] % (n + 1)))]
    first, second = ends.tolist()
    head, hole, tail = body[:first], body[first:second], body[second:]
    before, until = exceptions(text).chars(ends).tolist()
    if draws[3] % 100 < suffix_first:
        return Cut(n, "spm", before, until - before, b"".join((suffix, tail, prefix, head, middle, hole)))
    return Cut(n, "psm", before, until - before, b"".join((prefix, head, suffix, tail, middle, hole)))


def draws(id_column: str, seed: int = SEED) -> list[Column]:
    """Unsigned 32-bit numbers that depend on the id alone; a NULL id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text(id_column)), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(DRAWS)]


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = SEED,
    changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Per document: its id, n (units), form ("plain", "psm" or "spm"), prefix_chars, middle_chars and
    the output.

    A NULL text counts as empty. An empty text, one that holds a mark already, and those the third
    draw leaves out stay as they are: plain, without cuts. Cuts may meet, or stand at an end. Rows
    that share an id share the draws, and their texts are cut each by itself. Texts of any length are
    read whole; nothing is shuffled, and a task holds one batch of texts.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            drawn = zip(*(batch.column(2 + i).to_pylist() for i in range(DRAWS)))
            cut = [rearrange(body or b"", d, changed, suffix_first) for body, d in zip(bodies, drawn)]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*cut), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(
        F.col(id_column), F.col(text).cast("binary"), *[d.alias(f"draw{i}") for i, d in enumerate(draws(id_column, seed))]
    )
    made = rows.mapInArrow(
        work, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
    )
    return made.withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. A text that holds a mark stays plain, so each mark of
    another output stands there once, and the three parts lie between them."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = [F.get(parts, F.lit(i)) for i in range(4)]
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def digest(made: DataFrame) -> DataFrame:
    """Hashes of output and restored text in place of the output."""
    restored = restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )
