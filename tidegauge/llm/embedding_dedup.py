"""Near-duplicate vectors by sorted passes over random projections.

A pass hashes each vector to the signs of its products with random directions, most telling vectors
of a small angle alike, and sorts vectors by label and hash. Neighbours in this order are compared
with the cosine; every vector meets the ones up to a window's width before it. Passes have
directions of their own, so what one sorts apart another sorts together; the links of all passes
are united to components.

A window can't cover a tight group larger than itself, so it only has to hold a component together.
All of a component is then compared with all of it, tile against tile, and only numbers of links
leave a tile: `n_links` is whole inside a component, whatever its size. Vectors whose hashes agree
stand in an order of its own in each pass.

Equal vectors are one class and compared once, so copies can't fill a window. For two vectors of
cosine 0.98 one sign differs with odds of 6 %; among n classes of a label and a window w they meet in a
pass with odds of about 0.94 ** log2(n / w) at least, and miss in all of 12 passes with the twelfth
power of the rest: under 0.1 % for a million classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.components import components
from tidegauge.llm.tables import settle

THRESHOLD = 0.98
PASSES = 12
WINDOW = 512
#: Rows a task compares, besides the window before them.
TILE = 2048
BITS = 64
SEED = 20240
BLOCK = 512


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: components that are all finite, and one that isn't 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision. Scaling first keeps squares from overflowing."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def directions(number: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, number, size]).standard_normal((size, BITS))


def hashes(vectors: np.ndarray, number: int) -> np.ndarray:
    """The signs in pass `number`, first ones highest, as numbers that sort like them."""
    signs = (vectors @ directions(number, vectors.shape[1]) > 0).astype(np.uint8)
    key = np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def _keyed(classes: DataFrame, passes: int) -> DataFrame:
    """(pass, label, size, key, node): a row per class and pass."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(rows))
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
                vectors = units(flat.astype(np.float64).reshape(-1, size))
                for number in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), number, np.int32)), part.column(1), pa.array(np.full(len(rows), size, np.int32)),
                         pa.array(hashes(vectors, number)), part.column(0)],
                        ["pass", "label", "size", "key", "node"],
                    )

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("node", "label", "vector").mapInArrow(key, f"pass int, label {label}, size int, key bigint, node bigint")


def _ranked(table: DataFrame, *order: str | Column) -> DataFrame:
    """Adds `rank`, the place in the order of all rows.

    Rows are range-sorted and written with their place in their partition; the rows of the partitions
    before, one number each, make it a place among all.
    """
    placed = settle(
        table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "order",
    )
    part = F.shiftright("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(offsets, "part").select(
        *table.columns, (F.col("offset") + inside).alias("rank")
    )


def compare(tile: pd.DataFrame, number: int, width: int, rows: int, threshold: float) -> pd.DataFrame:
    """Pairs of a tile's own rows with the `width` rows before them, own or of the tile before.

    Products of whole blocks find candidates; their cosine is then summed up pair by pair.
    """
    tile = tile.sort_values("rank")
    rank, node = tile["rank"].to_numpy(), tile["node"].to_numpy()
    # Rows of one pass, label and size stand together; others are never compared.
    same = tile[["pass", "label", "size"]]
    line = (same != same.shift()).any(axis=1).cumsum().to_numpy()
    found = []
    for code in np.unique(line):
        at = np.flatnonzero(line == code)
        own = np.flatnonzero(rank[at] >= number * rows)
        if not len(own) or len(at) < 2:
            continue
        vectors = units(np.stack(tile["vector"].iloc[at].to_list()).astype(np.float64))
        for start in range(own[0], len(at), BLOCK):
            end, first = min(start + BLOCK, len(at)), max(0, start - width)
            near = vectors[start:end] @ vectors[first:end].T >= threshold - 1e-9
            later, earlier = np.nonzero(near)
            later, earlier = later + start, earlier + first
            kept = (earlier < later) & (later - earlier <= width)
            later, earlier = later[kept], earlier[kept]
            cosine = np.einsum("ij,ij->i", vectors[later], vectors[earlier])
            later, earlier = later[cosine >= threshold], earlier[cosine >= threshold]
            found.append((node[at[later]], node[at[earlier]]))
    a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.int64)])
    b = np.concatenate([x for _, x in found] or [np.zeros(0, np.int64)])
    return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})


def pairs(
    classes: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, width: int = WINDOW, rows: int = TILE
) -> DataFrame:
    """(a, b): linked classes, a > b, each once. `classes` has node (bigint, unique), label, vector.

    The order of a pass is cut into tiles; a row that the next tile's window reaches is sent there
    too. No tile exceeds its rows and a window, whatever the data; vectors are sent out only once
    their tiles are known.
    """
    if rows < width:
        raise ValueError("a window must not reach beyond the tile before")
    tile = F.floor(F.col("rank") / rows)
    last = F.pmod("rank", F.lit(rows)) >= rows - width
    ranked = _ranked(_keyed(classes, passes), "pass", "label", "size", "key", F.xxhash64("node", "pass"), "node")
    tiles = ranked.drop("key").withColumn(
        "tile", F.explode(F.when(last, F.array(tile, tile + 1)).otherwise(F.array(tile)))
    )

    def compared(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return compare(frame, key[0], width, rows, threshold)

    return (
        tiles.join(classes.select("node", "vector"), "node")
        .groupBy("tile")
        .applyInPandas(compared, "a bigint, b bigint")
        .distinct()
    )


def count(frame: pd.DataFrame, low: int, high: int, threshold: float) -> pd.DataFrame:
    """(node, others): rows each class of two tiles links with, those of the other tile, or inside one.

    Products near the threshold are summed up again pair by pair, as in `compare`.
    """
    found = []
    for _, line in frame.groupby(["root", "label", "size"], sort=False):
        tile, node, copies = (line[c].to_numpy() for c in ("tile", "node", "copies"))
        a, b = np.flatnonzero(tile == high), np.flatnonzero(tile == low)
        if not len(a) or not len(b):
            continue
        vectors = units(np.stack(line["vector"].to_list()).astype(np.float64))
        others = np.zeros(len(line), np.int64)
        for start in range(0, len(a), BLOCK):
            rows = a[start : start + BLOCK]
            product = vectors[rows] @ vectors[b].T
            near = product >= threshold
            i, j = np.nonzero(np.abs(product - threshold) < 1e-9)
            near[i, j] = np.einsum("ij,ij->i", vectors[rows[i]], vectors[b[j]]) >= threshold
            if low == high:
                near[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
            else:
                others[b] += copies[rows] @ near
            others[rows] += near @ copies[b]
        found.append(pd.DataFrame({"node": node, "others": others}))
    return pd.concat(found) if found else pd.DataFrame({"node": [], "others": []}, dtype="int64")


def links_inside(classes: DataFrame, roots: DataFrame, threshold: float = THRESHOLD, rows: int = TILE) -> DataFrame:
    """(node, others): rows that a class of a component links with, found by all pairs of the component.

    `classes` has node, label, copies, vector; `roots` node and root. Components stand one after the
    other and are cut into tiles; two tiles meet where the first ends in the component the second
    begins with. No task holds more than two tiles.
    """
    members = classes.select("node", "label", F.size("vector").alias("size"), "copies").join(roots, "node")
    line = ["root", "label", "size"]
    tiles = settle(
        _ranked(members, *line, "node").withColumn("tile", F.floor(F.col("rank") / rows)).select(*line, "node", "copies", "tile", "rank"),
        "tiles",
    )
    at = F.struct(*line)
    ends = tiles.groupBy("tile").agg(F.min_by(at, "rank").alias("first"), F.max_by(at, "rank").alias("last"))
    met = (
        ends.select(F.col("tile").alias("low"), F.col("last").alias("at"))
        .join(ends.select(F.col("tile").alias("high"), F.col("first").alias("at")), "at")
        .filter("low < high").select("low", "high")
    )
    alone = ends.select(F.col("tile").alias("low"), F.col("tile").alias("high"))
    sent = alone.unionByName(met).withColumn("tile", F.explode(F.array_distinct(F.array("low", "high"))))

    def counted(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return count(frame, key[0], key[1], threshold)

    return (
        sent.join(tiles.drop("rank"), "tile").join(classes.select("node", "label", "vector"), ["node", "label"])
        .groupBy("low", "high")
        .applyInPandas(counted, "node bigint, others bigint")
        .groupBy("node")
        .agg(F.sum("others").alias("others"))
    )


def near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, width: int = WINDOW,
    rows: int = TILE, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept.

    Only rows of equal labels and lengths are compared. Rows without a label, an id or a direction
    (NULL, empty, zero, or holding NULL, NaN or infinity) link with nothing and are their own
    component. Equal vectors of a label link with each other. Rows that repeat an id are several
    vectors of one id, each with links and a component of its own.
    """
    every = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    sorted_out = every.withColumn("able", able)
    classes = sorted_out.filter("able").groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # Two classes may share their least id. Each has a number of its own, and those of lesser ids come
    # first, so the least node of a component is a class that has its least id.
    nodes = settle(_ranked(classes, "first", "label", F.xxhash64("vector")).withColumnRenamed("rank", "node"), "classes")
    rooted = settle(components(pairs(nodes, threshold, passes, width, rows)), "roots")
    others = links_inside(nodes, rooted, threshold, rows)
    least = nodes.select(F.col("node").alias("root"), F.col("first").alias("least"))
    roots = rooted.join(least, "root").select("node", "least")
    named = (
        nodes.join(others, "node", "left").join(roots, "node", "left")
        .select("label", "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("least", "first").alias("root"))
    )
    linked = sorted_out.filter("able").join(named, ["label", "vector"]).select("vec_id", "links", "root")
    alone = sorted_out.filter("NOT able").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("root"))
    return linked.unionByName(alone).select(
        "vec_id", F.col("links").alias("n_links"), F.col("root").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("root"), F.lit(False)).alias("kept"),
    )
