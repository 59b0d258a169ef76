"""Centroid clustering of integer vectors, with rotated coordinates that rule centroids out.

Vectors are turned onto the principal axes of all of them.  A written table holds for each
vector its integers, its leading coordinates on those axes and the norm of the rest.  The
squared distance of two vectors is at least that of their leading coordinates plus the squared
difference of their rests' norms.  Of a vector's centroids, the one with the least bound is
measured first; those whose bound is not above that distance are measured too, in integers.
Rounding can only let more centroids through, never rule out the nearest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.session import shared_path
from peakwise.sources.tables import write_table

#: Leading coordinates kept of a vector.
LEADING = 16

#: Numbers in all centroids together, which go to every task.
MOST_NUMBERS = 1 << 22

#: Bounds of a batch, and exact distances worked out at a time.
CELLS, PAIRS = 1 << 20, 1 << 14

#: Share of two vectors' norms that a bound's square root may be wrong by.
SLACK = 1e-6


class Centroids(NamedTuple):
    """Integer centroids, one a row, and the axes that bounds are taken on."""

    points: np.ndarray
    middle: np.ndarray
    axes: np.ndarray

    def turned(self, vectors: np.ndarray, leading: int) -> np.ndarray:
        """Leading coordinates and the norm of the rest, one row for each vector."""
        turned = (vectors - self.middle) @ self.axes
        rest = np.sqrt(np.square(turned[:, leading:]).sum(axis=1))
        return np.column_stack([turned[:, :leading], rest])

    def digest(self, number: int) -> str:
        text = ",".join(map(str, self.points[number].tolist()))
        return hashlib.sha256(text.encode()).hexdigest()


def nearest(vectors, turned, points, turned_points) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest point of every vector, the smaller of equally near ones, the
    squared distance, and how many distances were worked out."""
    square = np.square(turned).sum(axis=1)
    square_points = np.square(turned_points).sum(axis=1)
    bounds = square[:, None] + square_points - 2 * (turned @ turned_points.T)
    guess = bounds.argmin(axis=1)
    first = np.square(vectors - points[guess]).sum(axis=1)
    slack = SLACK * (np.sqrt(square)[:, None] + np.sqrt(square_points))
    bounds = np.square(np.maximum(np.sqrt(np.maximum(bounds, 0)) - slack, 0))
    left = bounds <= first[:, None] * (1 + 1e-12)
    left[np.arange(len(guess)), guess] = False
    row, number = np.nonzero(left)
    exact = np.full(bounds.shape, np.iinfo(np.int64).max)
    exact[np.arange(len(guess)), guess] = first
    for at in range(0, len(row), PAIRS):
        r, c = row[at : at + PAIRS], number[at : at + PAIRS]
        exact[r, c] = np.square(vectors[r] - points[c]).sum(axis=1)
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(len(cluster)), cluster], len(row) + len(guess)


def _sound(column: str, size: int):
    """Whether a vector has exactly ``size`` components, none null or non-finite."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    vector = F.col(column)
    return vector.isNotNull() & (F.size(vector) == size) & F.forall(vector, finite)


def _matrix(column, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _integers(column, size: int, scale: float) -> np.ndarray:
    """Integers of a column of vectors; an error where squared distances could exceed 64 bits."""
    values = np.floor(scale * _matrix(column, size))
    if len(values) and 4 * size * np.abs(values).max() ** 2 >= 2**63:
        raise OverflowError("a vector's components are too large for 64-bit distances")
    return values.astype(np.int64)


def _moments(rows: DataFrame, size: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes of all vectors, the widest first; sums are made in Spark, and
    ``size * (size + 1) + 1`` numbers reach the driver."""
    import pyarrow as pa

    def add(batches):
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            values = _integers(batch.column(0), size, scale).astype(np.float64)
            total[0] += len(values)
            total[1 : 1 + size] += values.sum(axis=0)
            total[1 + size :] += (values.T @ values).ravel()
        if total[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"]
            )

    sums = rows.select("__vector").mapInArrow(add, "at bigint, value double")
    found = sums.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    if not found.num_rows:
        return np.zeros(size), np.eye(size)
    total = np.zeros(1 + size + size * size)
    total[found["at"].to_numpy()] = found["value"].to_numpy()
    middle = total[1 : 1 + size] / total[0]
    spread = total[1 + size :].reshape(size, size) / total[0] - np.outer(middle, middle)
    return middle, np.linalg.eigh(spread)[1][:, ::-1]


def _assigned(table: DataFrame, found: Centroids, leading: int, schema: str, emit) -> DataFrame:
    """Rows that ``emit(batch, clusters, distances)`` gives for every batch of ``table``, and
    after a partition's last one for ``None``."""
    size = found.points.shape[1]
    turned_points = found.turned(found.points, leading)
    step = max(1, CELLS // max(1, len(found.points)))

    def assign(batches: Iterator) -> Iterator:
        made = emit()
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                vectors = _matrix(rows.column("__integers"), size)
                turned = _matrix(rows.column("__turned"), leading + 1).astype(np.float64)
                cluster, distance, _ = nearest(vectors, turned, found.points, turned_points)
                yield from made(rows, vectors, cluster, distance)
        yield from made(None, None, None, None)

    return table.mapInArrow(assign, schema)


def _next_points(table: DataFrame, found: Centroids, leading: int) -> Centroids:
    """Centroids moved to the floor of their vectors' exact means; those without vectors stay."""
    import pyarrow as pa

    k, size = found.points.shape

    def emit():
        sums, counts = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)

        def add(rows, vectors, cluster, distance):
            if rows is not None:
                order = np.argsort(cluster, kind="stable")
                numbers, first = np.unique(cluster[order], return_index=True)
                sums[numbers] += np.add.reduceat(vectors[order], first, axis=0)
                counts[:] += np.bincount(cluster, minlength=k)
                return
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen), pa.array(counts[seen]), pa.array(list(sums[seen]), pa.list_(pa.int64()))],
                names=["cluster", "n", "sums"],
            )

        return add

    schema = "cluster bigint, n bigint, sums array<bigint>"
    partial = _assigned(table.select("__integers", "__turned"), found, leading, schema, emit)
    totals = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums")
    )
    points = found.points.copy()
    for row in totals.collect():  # one row a centroid
        points[row.cluster] = [s // row.n for s in row.sums]
    return found._replace(points=points)


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    seed: int = 2,
    scale: float = 256.0,
    leading: int = LEADING,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """``(vec_id, cluster, distance)`` of every vector kept, and the final centroids.

    Kept are vectors of exactly ``size`` components, none null or non-finite; a component ``x``
    counts as the integer ``floor(scale * x)``.  Centroids start as the ``k`` vectors with the
    smallest SHA-256 of ``<seed>:<vec_id>`` (a null id counts as empty, of equal ids the smaller
    vector comes first, fewer vectors make fewer centroids).  Each round assigns every vector to
    the nearest centroid, of equally near ones the smaller number, and moves centroids to the
    floor of their vectors' mean; centroids without vectors stay.  Distances are squared.

    Rows that repeat an id stay rows of their own; other columns are left out; no vectors give
    no rows.  Components for which squared distances could pass 64 bits are an error.  The
    centroids go to every task, so ``k * size`` is limited to ``MOST_NUMBERS``.
    """
    import pyarrow as pa

    if k < 1 or k * size > MOST_NUMBERS:
        raise ValueError(f"k times size must be from 1 to {MOST_NUMBERS}")
    leading = min(leading, size)
    spark = vectors.sparkSession
    source = f"`{embedding}`"
    rows = vectors.where(_sound(source, size)).select(
        F.col(source).cast("array<double>").alias("__vector"), F.col(f"`{vec_id}`").alias("vec_id")
    )
    middle, axes = _moments(rows, size, scale)
    plain = Centroids(np.zeros((0, size), dtype=np.int64), middle, axes)

    def turn(batches: Iterator) -> Iterator:
        for batch in batches:
            values = _integers(batch.column(0), size, scale)
            turned = plain.turned(values, leading).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), _lists(values), _lists(turned)],
                names=["vec_id", "__integers", "__turned"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, __integers array<bigint>, __turned array<float>"
    table = write_table(rows.mapInArrow(turn, schema), shared_path(spark, "turned-vectors"))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = table.orderBy(F.sha2(named, 256), "__integers").limit(k).select("__integers")
    points = np.array([r[0] for r in first.collect()], dtype=np.int64).reshape(-1, size)
    found = plain._replace(points=points)
    for _ in range(rounds if len(points) else 0):
        found = _next_points(table, found, leading)

    def emit():
        def give(rows, vectors, cluster, distance):
            if rows is not None:
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

        return give

    schema = f"vec_id {kind}, cluster int, distance bigint"
    if not len(points):
        return spark.createDataFrame([], schema), found
    result = _assigned(table, found, leading, schema, emit)
    return write_table(result, shared_path(spark, "clusters")), found


def _lists(values: np.ndarray):
    """Arrow array of the rows of a matrix."""
    import pyarrow as pa

    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def with_inertia(assigned: DataFrame, found: Centroids) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the sums of
    distances have one row a centroid and are broadcast."""
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(r.cluster_inertia for r in sums)
    facts = assigned.sparkSession.createDataFrame(
        [(r.cluster, r.cluster_inertia, total, found.digest(r.cluster)) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster")
