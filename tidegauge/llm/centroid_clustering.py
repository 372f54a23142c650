"""Clusters of vectors around centroids, with bounds that spare most distances.

Vectors are whole numbers, so every distance that decides is exact. Before any is computed, the
n-simplex projection narrows the choice. A few pivots, chosen among the first centroids, span a
simplex. A vector's distances to the pivots place it as the apex over that simplex: coordinates in
the space of the pivots, and last its height above it. The distance of two apexes is never above
the distance of their vectors, and with one of them turned to the other side never below it
(Connor, Vadicamo and others, "Supermetric search"). The centroid of the least lower bound is compared
in whole numbers. One whose lower bound exceeds this distance, or the least upper bound of all
centroids, is not the nearest; the rest are compared in whole numbers too.

Apexes of the vectors are computed once and written beside them. Each round needs apexes of the
centroids only, which the driver holds: they are few, whatever the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import id_text, settle
from tidegauge.sources.values import value_table

# Fixed values of the contract.
DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Corners of the simplex, at most.
PIVOTS = 40
#: A pivot has to stand out of the simplex before it by this share of the greatest squared distance.
LEAST_HEIGHT = 0.01
#: What rounding may add to a squared bound, as a share of the squared distances to the first pivot.
#: Heights near 0 are off by the root of a double's precision; this is several times that.
MARGIN = 1e-5
#: Components below this keep every squared distance inside 64 bits.
LARGEST = 2**27
ROWS = 8192
#: Pairs compared at a time: as many as stay in a core's cache.
PAIRS = 1024
RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


class Simplex(NamedTuple):
    """Pivots, and the lower triangle that turns products with their edges into coordinates."""

    pivots: np.ndarray
    edges: np.ndarray
    triangle: np.ndarray


def span_simplex(points: np.ndarray, most: int = PIVOTS) -> Simplex:
    """A simplex on some of `points` (whole numbers, at least one): from the first one on, always the
    point that stands out furthest from those before, until none does."""
    moved = (points - points[0]).astype(float)
    chosen, rest = [0], moved.copy()
    height = (rest * rest).sum(axis=1)
    least = LEAST_HEIGHT * height.max()
    while len(chosen) < most and height.max() > max(least, 0.5):
        tip = int(height.argmax())
        chosen.append(tip)
        axis = rest[tip] / np.sqrt(height[tip])
        rest -= np.outer(rest @ axis, axis)
        height = (rest * rest).sum(axis=1)
    edges = moved[chosen[1:]]
    triangle = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.zeros((0, 0))
    return Simplex(points[chosen], edges, triangle)


def pivot_distances(vectors: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Squared distances to the pivots. Measured from the first pivot, so that vectors close together
    and far from the origin keep their digits."""
    moved = (vectors - simplex.pivots[0]).astype(float)
    first = (moved * moved).sum(axis=1, keepdims=True)
    lengths = (simplex.edges * simplex.edges).sum(axis=1)
    others = first - 2 * (moved @ simplex.edges.T) + lengths
    return np.hstack([first, others])


def apexes(distances: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Apex coordinates from squared distances to the pivots; the last one is the height, at least 0."""
    first = distances[:, :1]
    lengths = (simplex.edges * simplex.edges).sum(axis=1)
    products = (first + lengths - distances[:, 1:]) / 2
    inside = np.linalg.solve(simplex.triangle, products.T).T if len(lengths) else products
    height = np.sqrt(np.maximum(first[:, 0] - (inside * inside).sum(axis=1), 0))
    return np.hstack([inside, height[:, None]])


def squared(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row, of 64-bit whole numbers."""
    apart = vectors - others
    return np.einsum("ij,ij->i", apart, apart)


def bounds(apex: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all squared distances, each wide enough for what rounding adds."""
    own = (apex * apex).sum(axis=1, keepdims=True)
    theirs = (centres * centres).sum(axis=1)
    lower = own + theirs - 2 * (apex @ centres.T)
    margin = MARGIN * (own + theirs)
    return lower - margin, lower + 4 * np.outer(apex[:, -1], centres[:, -1]) + margin


def nearest(
    vectors: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centres: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector, the smaller number of equal ones; its squared distance; and
    how many distances were computed.

    The centroid of the least lower bound is compared first: its distance is an upper bound too, and
    mostly the tighter one.
    """
    lower, upper = bounds(apex, centres)
    likely = lower.argmin(axis=1)
    least = np.minimum(squared(vectors, centroids[likely]), upper.min(axis=1))
    row, centroid = np.nonzero(lower <= least[:, None])
    exact = np.full(lower.shape, np.iinfo(np.int64).max)
    for i in range(0, len(row), PAIRS):
        r, c = row[i : i + PAIRS], centroid[i : i + PAIRS]
        exact[r, c] = squared(vectors[r], centroids[c])
    return exact.argmin(axis=1), exact.min(axis=1), len(row)


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE x) of each component. One too large for exact distances ends the job: there is no
    right result in 64 bits, and a wrong one would pass unseen."""
    x = lambda v: v.cast("double") * SCALE
    told = F.raise_error(F.lit("a component is too large for exact distances")).cast("int")
    return F.transform(vector, lambda v: F.when(F.abs(x(v)) < LARGEST, F.floor(x(v)).cast("int")).otherwise(told))


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has just so many components, none NULL, NaN or infinite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, corners: int) -> Iterator[tuple]:
    """(ids, vectors, apexes) of at most ROWS rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part.column(0), _matrix(part.column(1), width, np.int64), _matrix(part.column(2), corners, float)


def _with_apexes(rows: DataFrame, simplex: Simplex, dimensions: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), dimensions, np.int64)
            found = apexes(pivot_distances(vectors, simplex), simplex)
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], ["vec_id", "vector", "apex"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(place, f"vec_id {id_type}, vector array<int>, apex array<double>")


def _sums(placed: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """(cluster, rows, sums) after assigning every vector: one row per cluster.

    A task sends what it has summed up, so a cluster of any size is at most one row per task; the sums
    are then added component by component, each of them a key of its own.
    """
    centres, width = apexes(pivot_distances(centroids, simplex), simplex), centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, vectors, apex in _blocks(batches, width, centres.shape[1]):
            cluster, _, _ = nearest(vectors, apex, centroids, centres)
            rows += np.bincount(cluster, minlength=len(rows))
            np.add.at(sums, cluster, vectors)
        seen = np.flatnonzero(rows)
        # The number of rows travels as one more component.
        values = np.hstack([rows[seen, None], sums[seen]])
        where = np.repeat(seen, width + 1), np.tile(np.arange(width + 1), len(seen))
        columns = [pa.array(where[0].astype(np.int32)), pa.array(where[1].astype(np.int32)), pa.array(values.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "component", "total"])

    parts = placed.mapInArrow(add, "cluster int, component int, total bigint")
    return parts.groupBy("cluster", "component").agg(F.sum("total").alias("total"))


def moved(centroids: np.ndarray, totals: list) -> np.ndarray:
    """Centroids after a round: floor of the mean of their vectors; those without vectors stay."""
    found: dict[int, dict[int, int]] = {}
    for cluster, component, total in totals:
        found.setdefault(cluster, {})[component] = total
    then = centroids.copy()
    for cluster, values in found.items():
        then[cluster] = [values[i + 1] // values[0] for i in range(centroids.shape[1])]
    return then


def _assigned(placed: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    centres, width = apexes(pivot_distances(centroids, simplex), simplex), centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, apex in _blocks(batches, width, centres.shape[1]):
            cluster, distance, _ = nearest(vectors, apex, centroids, centres)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    id_type = placed.schema["vec_id"].dataType.simpleString()
    return placed.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance bigint")


def cluster_vectors(
    embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    pivots: int = PIVOTS, seed: int = SEED, id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and the hash of
    its centroid.

    Vectors of another length, NULL ones, and those that hold NULL, NaN or infinity are left out. The
    first centroids are the vectors whose ids hash lowest; of rows that repeat an id (NULL counts as
    empty text) the lesser vectors come first, and each row counts. Fewer vectors than `centroids` make
    as many clusters, equal centroids leave the later one empty, and an empty table gives no rows. A
    component of 2 ** 19 or more (LARGEST / SCALE) ends the job.

    The driver holds the centroids and, a round, their sums: `centroids` rows whatever the data.
    """
    spark = embeddings.sparkSession
    rows = embeddings.filter(usable(F.col(vector), dimensions)).select(
        F.col(id_column).alias("vec_id"), whole_numbers(F.col(vector)).alias("vector")
    )
    id_type = rows.schema["vec_id"].dataType.simpleString()
    order = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("vec_id")), 256)
    first = rows.orderBy(order, "vector").limit(centroids).collect()
    if not first:
        return spark.createDataFrame([], f"vec_id {id_type}, {RESULT}")
    now = np.array([r["vector"] for r in first], dtype=np.int64)
    simplex = span_simplex(now, pivots)
    placed = settle(_with_apexes(rows, simplex, dimensions), "apexes")
    for _ in range(rounds):
        now = moved(now, _sums(placed, now, simplex).collect())
    assigned = settle(_assigned(placed, now, simplex), "clusters")
    inertia = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    told = [
        (cluster, total, sum(inertia.values()), hashlib.sha256(",".join(map(str, now[cluster].tolist())).encode()).hexdigest())
        for cluster, total in sorted(inertia.items())
    ]
    columns = {"cluster": "int", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
    return assigned.join(value_table(spark, columns, told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
