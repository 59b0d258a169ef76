"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are scaled to unit length and turned onto the principal axes of a sample, so that the
first coordinates carry most of a product.  A tree over the leading coordinates cuts the
vectors into tiles; a vector is compared in its own tile and in every later tile that comes
within the distance its threshold allows.  In a tile products are summed from the leading
coordinates on, and a pair is given up as soon as its sum and the product of the norms of the
coordinates left cannot reach the threshold.  Pairs that remain are decided by the cosine of
the vectors themselves in double precision.

Tree and axes are fitted on a bounded sample; they steer the work and never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.llm.components import connected_components
from peakwise.llm.worker import carried, merged, ranges
from peakwise.session import shared_path
from peakwise.sources.tables import write_table

THRESHOLD = 0.95

#: Vectors of the sample that axes and tree are fitted on, and its size in components.
SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 16_000_000

#: Vectors of a tile; a tile with over twice as many is split by a digest.
TILE_ROWS = 8192

#: Vectors of either side compared at a time.
BLOCK = 1024

#: Bounds are computed in single precision; this much is granted to rounding.
SLACK = 1e-4


class Tiles:
    """Axes and a tree whose leaves are tiles, numbered from left to right."""

    def __init__(self, sample: np.ndarray, n_tiles: int, threshold: float):
        unit = _scaled(sample)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        _, axes = np.linalg.eigh(unit.T @ unit)
        self.axes = np.ascontiguousarray(axes[:, ::-1])
        self.threshold = threshold
        #: Largest distance of unit vectors that may link.
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
        turned = unit @ self.axes
        self.depth = max(0, int(np.ceil(np.log2(max(1, n_tiles)))))
        inner = (1 << self.depth) - 1
        self.axis = np.zeros(inner, dtype=np.int64)
        self.cut = np.zeros(inner)
        rows = {0: np.arange(len(turned))}
        for node in range(inner):
            own = rows.pop(node)
            if len(own):
                spread = turned[own].std(axis=0)
                self.axis[node] = int(spread.argmax())
                values = turned[own, self.axis[node]]
                self.cut[node] = np.median(values)
                left = values <= self.cut[node]
            else:
                left = np.zeros(0, dtype=bool)
            rows[2 * node + 1], rows[2 * node + 2] = own[left], own[~left]

    def turned(self, scaled: np.ndarray) -> np.ndarray:
        return scaled / np.linalg.norm(scaled, axis=1, keepdims=True) @ self.axes

    def home(self, turned: np.ndarray) -> np.ndarray:
        node = np.zeros(len(turned), dtype=np.int64)
        every = np.arange(len(turned))
        for _ in range(self.depth):
            right = turned[every, self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)

    def near(self, turned: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the tiles after their own that may hold a partner: those whose box is within
        reach.  What a vector lacks to the box on each axis is known from the cuts passed."""
        axes, column = np.unique(self.axis, return_inverse=True)
        row = np.arange(len(turned))
        node = np.zeros(len(turned), dtype=np.int64)
        lack = np.zeros((len(turned), len(axes)))
        for _ in range(self.depth):
            value = turned[row, self.axis[node]] - self.cut[node]
            every, own = np.arange(len(row)), column.ravel()[node]
            sides = []
            for side, beyond in ((1, value), (2, -value)):
                lacking = lack.copy()
                lacking[every, own] = np.maximum(lacking[every, own], beyond)
                close = np.square(lacking).sum(axis=1) <= self.reach**2
                sides.append((row[close], 2 * node[close] + side, lacking[close]))
            row, node, lack = (np.concatenate(x) for x in zip(*sides))
        tile = node - ((1 << self.depth) - 1)
        later = tile > home[row]
        return row[later], tile[later]


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest component near one, so that no
    square is lost or infinite.  Nothing is rounded but what is too small to matter."""
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])


def _matrix(column) -> np.ndarray:
    """Scaled vectors of an Arrow column, as doubles."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _scaled(values.reshape(len(flat), -1)) if len(flat) else values.reshape(0, 1)


def _spread(tiles: Tiles, parts: np.ndarray):
    """Tasks that send vectors to tiles: as members (0), and to ask members of their own tile
    (1) and of later ones (2).  A tile in several parts has its members dealt over them."""
    import pyarrow as pa

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                vectors = tiles.turned(_matrix(piece.column(2)))
                uid = piece.column(0).to_numpy()
                home = tiles.home(vectors)
                part = (uid * 2654435761 >> 7) % parts[home]
                every = np.arange(len(uid))
                far_row, far_tile = tiles.near(vectors, home)
                asks = [(every, home, 1), (far_row, far_tile, 2)]
                rows, cells, subs, kinds = [every], [home], [part], [np.zeros(len(uid), int)]
                for row, tile, kind in asks:
                    copy, sub = ranges(parts[tile])
                    rows.append(row[copy])
                    cells.append(tile[copy])
                    subs.append(sub)
                    kinds.append(np.full(len(copy), kind))
                rows = np.concatenate(rows)
                taken = piece.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(cells)),
                        pa.array(np.concatenate(subs).astype(np.int64)),
                        pa.array(np.concatenate(kinds).astype(np.int32)),
                        *taken.columns,
                    ],
                    names=["tile", "part", "kind", "uid", "n", "embedding"],
                )

    return send


class _Side:
    """Vectors with their turned coordinates and the norms of what each level leaves."""

    def __init__(self, tiles: Tiles, uid, n, raw):
        self.uid, self.n, self.raw = uid, n, raw
        self.norm = np.sqrt((raw * raw).sum(axis=1))
        self.turned = tiles.turned(raw)
        width = raw.shape[1]
        self.levels = sorted({max(1, width // 4), max(1, width // 2), width})
        left = np.cumsum(self.turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        left = np.column_stack([left, np.zeros(len(raw))])
        self.left = np.sqrt(left[:, self.levels])
        first = self.levels[0]
        self.lead = np.column_stack([self.turned[:, :first], self.left[:, 0]]).astype(np.float32)


def _linked(asking: _Side, members: _Side, own: np.ndarray, threshold: float):
    """Positions of linked pairs; where ``own`` says that both are of one tile, a pair counts
    only from its smaller uid."""
    levels = asking.levels
    found = []
    for i in range(0, len(asking.uid), BLOCK):
        for j in range(0, len(members.uid), BLOCK):
            bound = asking.lead[i : i + BLOCK] @ members.lead[j : j + BLOCK].T
            a, b = np.nonzero(bound >= threshold - SLACK)
            a, b = a + i, b + j
            once = ~own[a] | (asking.uid[a] < members.uid[b])
            a, b = a[once], b[once]
            for cut in range(0, len(a), 1 << 16):
                p, q = a[cut : cut + (1 << 16)], b[cut : cut + (1 << 16)]
                total = np.zeros(len(p))
                done = 0
                for level, upto in enumerate(levels):
                    total += np.einsum(
                        "ij,ij->i", asking.turned[p, done:upto], members.turned[q, done:upto]
                    )
                    reach = total + asking.left[p, level] * members.left[q, level]
                    hope = reach >= threshold - SLACK
                    p, q, total, done = p[hope], q[hope], total[hope], upto
                dot = np.einsum("ij,ij->i", asking.raw[p], members.raw[q])
                near = dot / (asking.norm[p] * members.norm[q]) >= threshold
                found.append((p[near], q[near]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _compare(tiles: Tiles):
    """Tasks over rows sorted by tile, part and kind.  They return the copies a vector links
    with (``b`` null) and as many links as connect what is connected."""
    import pyarrow as pa

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, members = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            kind = batch.column(2).to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *new], [*new, len(key)]):
                if group != tuple(key[low]):
                    group, held, members = tuple(key[low]), [], None
                turn = low + np.searchsorted(kind[low:high], 1)
                if turn > low:
                    held.append(batch.slice(low, turn - low))
                if turn == high or not held:
                    continue
                if members is None:
                    columns = [
                        np.concatenate([h.column(c).to_numpy() for h in held]) for c in (3, 4)
                    ]
                    raw = np.concatenate([_matrix(h.column(5)) for h in held])
                    members = _Side(tiles, *columns, raw)
                    held = [held[0].slice(0, 0)]
                for at in range(turn, high, BLOCK):
                    rows = batch.slice(at, min(BLOCK, high - at))
                    asking = _Side(
                        tiles, rows.column(3).to_numpy(), rows.column(4).to_numpy(),
                        _matrix(rows.column(5)),
                    )
                    own = rows.column(2).to_numpy() == 1
                    a, b = _linked(asking, members, own, tiles.threshold)
                    if not len(a):
                        continue
                    nodes = np.concatenate([asking.uid, members.uid])
                    copies = np.bincount(a, members.n[b], len(nodes))
                    copies += np.bincount(len(own) + b, asking.n[a], len(nodes))
                    root = merged(np.arange(len(nodes)), a, len(own) + b)
                    told = np.flatnonzero(copies)
                    away = np.flatnonzero(root != np.arange(len(nodes)))
                    ends = np.concatenate([np.zeros(len(told), np.int64), nodes[root[away]]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([nodes[told], nodes[away]])),
                            pa.array(ends, mask=np.arange(len(ends)) < len(told)),
                            pa.array(
                                np.concatenate([copies[told], np.zeros(len(away))]).astype(np.int64)
                            ),
                        ],
                        names=["a", "b", "copies"],
                    )

    return compare


def _links(distinct: DataFrame, n: int, width: int, threshold: float) -> DataFrame:
    """``(a, b, copies)`` over the ``uid`` of distinct vectors of one length."""
    import pyarrow as pa

    rows = min(SAMPLE_ROWS, max(1, SAMPLE_VALUES // width))
    sample = distinct.orderBy(F.xxhash64("uid"), "uid").limit(rows).select("embedding").toArrow()
    tiles = Tiles(_matrix(sample["embedding"]), min(-(-n // TILE_ROWS), rows // 8 + 1), threshold)

    def count(batches):
        total = np.zeros(1 << tiles.depth, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                vectors = tiles.turned(_matrix(batch.slice(at, BLOCK).column(0)))
                total += np.bincount(tiles.home(vectors), minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["tile", "n"]
        )

    sizes = distinct.select("embedding").mapInArrow(count, "tile bigint, n bigint")
    sizes = sizes.groupBy("tile").agg(F.sum("n").alias("n")).toArrow()
    parts = np.ones(1 << tiles.depth, dtype=np.int64)
    parts[sizes["tile"].to_numpy()] = np.maximum(1, sizes["n"].to_numpy() // (2 * TILE_ROWS))
    vector = distinct.schema["embedding"].dataType.simpleString()
    schema = f"tile bigint, part bigint, kind int, uid bigint, n bigint, embedding {vector}"
    sent = distinct.select("uid", "n", "embedding").mapInArrow(_spread(tiles, parts), schema)
    sent = sent.repartition("tile", "part").sortWithinPartitions("tile", "part", "kind")
    return sent.mapInArrow(_compare(tiles), "a bigint, b bigint, copies bigint")


def embedding_components(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vectors`` without the embedding, with ``n_links``, ``component_id`` and ``kept``.

    Vectors link when their cosine, in double precision, is ``threshold`` or more (above 0).  ``n_links`` counts the
    other rows a row links with, copies included; ``component_id`` is the smallest id reachable
    over links and ``kept`` marks its row.  Vectors that are null, empty or zero, or hold a null
    or non-finite component, link with nothing and are kept; so are, among themselves, vectors
    of different lengths.  Equal vectors are compared once, so copies cost nothing.  Rows without
    an id count as links; they are never kept, and their component may be null.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    spark = vectors.sparkSession
    packed, unpacked = carried(vectors, embedding, "n_links", "component_id", "kept")
    kind = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType.simpleString()
    value = F.col(f"`{embedding}`").cast("array<float>" if kind == "array<float>" else "array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.coalesce(
        F.forall(value, finite) & F.exists(value, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(
        *packed, F.col(f"`{vec_id}`").alias("_id"), F.when(sound, value).alias("_vector")
    )
    distinct = (
        rows.where("_vector is not null")
        .groupBy("_vector")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_least"))
        .select(
            F.monotonically_increasing_id().alias("uid"),
            "n",
            "_least",
            F.col("_vector").alias("embedding"),
            F.size("_vector").alias("_width"),
        )
    )
    distinct = write_table(distinct, shared_path(spark, "distinct-vectors"))
    links = None
    for width, n in sorted(map(tuple, distinct.groupBy("_width").count().collect())):
        found = _links(distinct.where(F.col("_width") == width), n, width, threshold)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = spark.createDataFrame([], "a bigint, b bigint, copies bigint")
    links = write_table(links, shared_path(spark, "vector-links"))
    root = connected_components(links.where("b is not null").select("a", "b"))
    copies = links.groupBy(F.col("a").alias("uid")).agg(F.sum("copies").alias("_copies"))
    named = (
        distinct.join(root.withColumnRenamed("node", "uid"), "uid", "left")
        .join(copies, "uid", "left")
        .select(
            "embedding",
            "_least",
            F.coalesce("component", "uid").alias("_root"),
            (F.col("n") - 1 + F.coalesce("_copies", F.lit(0))).alias("n_links"),
        )
    )
    named = write_table(named, shared_path(spark, "named-vectors"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    classes = named.drop("_least").join(write_table(least, shared_path(spark, "roots")), "_root")
    classes = write_table(
        classes.select(F.col("embedding").alias("_vector"), "n_links", "component_id"),
        shared_path(spark, "vector-classes"),
    )
    joined = rows.join(classes, "_vector", "left")
    lone = F.col("_vector").isNull()
    component = F.when(lone, F.col("_id")).otherwise(F.col("component_id"))
    return joined.select(
        *unpacked,
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"),
    )
