"""A time-varying mix of sources, in DataFrame functions only.

Each source has a schedule: its weight at times from 0 to 1 as a line through knots. The area under
the line is the source's weight in the mix, which sets how many of its words are taken. A word's
place in the stream of its source is then a share of that area; the time at which the schedule has
used up this share is the word's training position. Sorted by position, documents follow the
schedules: a source whose weight falls comes early, one whose weight rises comes late.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.numbering import PLACE, with_place
from tidegauge.llm.tables import WORD, id_text, settle

Schedule = Sequence[tuple[float, float]]

# Fixed values of the mix over `documents`. Weights are the areas of the schedules: 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 4.0), (0.5, 3.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (1.0, 3.0)),
)
BUDGET = 1.5
REPEATS = 2


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(start, length, weight at the start, slope, area before) of each piece of a schedule."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1:
        raise ValueError("a schedule runs from time 0 to time 1")
    pieces, area = [], 0.0
    for (t, w), (later, then) in zip(schedule, schedule[1:]):
        if later <= t or w < 0 or then < 0 or w + then == 0:
            raise ValueError("times have to rise, weights must not be negative, nor a piece empty")
        pieces.append((t, later - t, w, (then - w) / (later - t), area))
        area += (w + then) / 2 * (later - t)
    return pieces


def area(schedule: Schedule) -> float:
    return sum((w + then) / 2 * (later - t) for (t, w), (later, then) in zip(schedule, schedule[1:]))


def when_used(schedule: Schedule, share: Column) -> Column:
    """The time at which the schedule has used up `share` (0 to 1) of its area.

    Inside a piece the area grows as w x + slope x^2 / 2, solved for x in the form that also holds
    for a flat piece.
    """
    total, at = area(schedule), None
    for start, _, w, slope, before in reversed(segments(schedule)):
        rest = share * total - before
        root = F.sqrt(F.greatest(F.lit(0.0), w * w + 2 * slope * rest))
        x = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (w + root))
        here = F.least(F.lit(1.0), start + x)
        at = here if at is None else F.when(share * total < stop, here).otherwise(at)
        stop = before
    return at


def source_targets(
    sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, budget: float = BUDGET, repeats: int = REPEATS
) -> DataFrame:
    """Per row of `sizes` (source, source_size): its `kind` (index of its schedule) and `target`.

    Sources are ranked by code point, NULL last, and take the schedules in turn. `budget` times all
    words are shared out by weight; no target exceeds `repeats` times its source, and what a full
    source leaves goes to the others by weight until none is above. That is one common level times
    each weight, cut at the cap: full sources are those with the least cap per weight, so sums over
    the sources in that order give the level. The windows run over one row per source.
    """
    cap = F.col("source_size") * repeats
    weights = F.array(*[F.lit(area(s)) for s in schedules])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("fill"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    levels = (
        sizes.withColumn("kind", ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int"))
        .withColumn("weight", F.element_at(weights, F.col("kind") + 1))
        .withColumn("fill", cap / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(budget))
        .withColumn("full", F.coalesce(F.sum(cap).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("words") - F.col("full")) / F.col("open"))
    )
    # Levels of sources that come too early are too high for them, those of later ones ever lower;
    # where all are full, there is none.
    level = F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(everything)
    target = F.least(cap.cast("double"), F.coalesce(level * F.col("weight"), cap.cast("double")))
    return levels.withColumn("target", target).drop("weight", "fill", "words", "full", "open", "level")


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document: id, size, source_size, target, taken, copies and the positions of its copies.

    The stream of a source is its documents in the order of a hash of their ids, passed through
    again until the target is reached. `taken` counts a document's words in that stretch, so a
    source's words taken are its target but for a fraction of a word, and the one document at the
    end may be taken in part. `copies` counts passes of which at least half is inside: whole
    documents to write. `positions` holds the training position of each of them.

    A source may hold any share of the rows: its stream is cut into parts by the
    hash, whose sums give offsets, and only a part is ever sorted in one task. Documents of no words
    take nothing. A NULL text has no words, NULL is a source like others, and reruns agree, since
    nothing but ids, sizes and sources decides. Rows with equal ids are neighbours in the stream.
    """
    narrow = docs.select(*_narrow(id_column, text, source))
    return mix_sizes(settle(narrow, "sizes"), schedules, budget, repeats)


def _narrow(id_column: str, text: str, source: str) -> list[Column]:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(id_text(id_column).cast("binary"))
    return [
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), key.alias("key")
    ]


def part_count(rows: int) -> int:
    """Parts of a stream: as many as a part would have rows if one source had them all. So neither the
    rows of a part nor the offsets of a source, which one task sorts each, grow faster than the root."""
    return math.isqrt(rows) + 1


def mix_sizes(
    narrow: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, budget: float = BUDGET,
    repeats: int = REPEATS, keep: Sequence[str] = (),
) -> DataFrame:
    """`mix` over rows of doc_id, source, size and key, the hex digits that order a stream; the
    columns to `keep` come along, and order what is equal in all these."""
    count = part_count(narrow.count())
    # The leading digits as a share of all keys: parts follow each other as keys do.
    part = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * count / 2**32).cast("int")
    # NULL gets a name of its own, so that plain equality joins it.
    stream = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = narrow.withColumn("stream", stream).withColumn("part", part)
    parts = rows.groupBy("stream", "part").agg(
        F.sum("size").alias("part_size"), F.first("source").alias("source")
    )
    before = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "stream", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset")
    )
    totals = parts.groupBy("stream").agg(
        F.first("source").alias("source"), F.sum("part_size").alias("source_size")
    )
    targets = source_targets(totals, schedules, budget, repeats).drop("source")
    inside = Window.partitionBy("stream", "part").orderBy("key", "doc_id", "size", *keep).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = F.floor("target").cast("long")
    passes = F.sequence(F.lit(0), F.lit(repeats - 1))

    def words_in(k: Column) -> Column:
        left = whole - k * F.col("source_size") - F.col("start")
        return F.least(F.col("size"), F.greatest(F.lit(0), left))

    def position(k: Column) -> Column:
        share = (k * F.col("source_size") + F.col("start")) / F.col("target")
        at = when_used(schedules[-1], share)
        for kind in reversed(range(len(schedules) - 1)):
            at = F.when(F.col("kind") == kind, when_used(schedules[kind], share)).otherwise(at)
        return at

    taken = F.aggregate(passes, F.lit(0).cast("long"), lambda total, k: total + words_in(k))
    mostly = F.filter(passes, lambda k: (F.col("size") > 0) & (2 * words_in(k) >= F.col("size")))
    return (
        rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["stream", "part"])
        .join(targets, "stream")
        .withColumn("start", F.col("offset") + F.col("inside"))
        .select(
            *keep, "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
            F.transform(mostly, position).alias("positions"),
        )
        .withColumn("copies", F.size("positions"))
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Rows range-sorted by the position of their first copy; documents not taken come last."""
    first = F.try_element_at("positions", F.lit(1))
    return mixed.withColumn("position", first).orderBy(
        F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()
    )


def mix_documents(
    docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, budget: float = BUDGET, repeats: int = REPEATS,
    id_column: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The rows to train on, as whole as they came: each as often as the mix takes it, range-sorted by
    training position.

    Rows are told apart by their place, not by their ids: `docs` is a table, or what select and filter
    take from one (rows from elsewhere are written first). The table is read twice, for sizes and for
    texts; a row's place is its file and its number there, whatever cores read it.
    """
    placed = with_place(docs)
    narrow = placed.select(*PLACE, *_narrow(id_column, text, source))
    mixed = mix_sizes(settle(narrow, "sizes"), schedules, budget, repeats, keep=PLACE)
    positions = mixed.filter("copies > 0").select(*PLACE, F.col("positions").alias("_tg_positions"))
    return (
        placed.join(positions, list(PLACE))
        .withColumn("_tg_position", F.explode("_tg_positions"))
        .orderBy("_tg_position", *PLACE)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
