"""Candidates of a query: library molecules with the same mass key, ranked by cosine.

Pairs of a query and a molecule never become rows.  Masses of ordinary size are packed into
buckets by a digest of their key, so that the number of tasks' groups follows the data and not
the number of masses.  Both sides of a mass shared by more rows are cut into blocks, and every
pair of blocks is one tile.  A tile hands on only the best ``n`` molecules per query.  Ranking
is exact: each molecule meets each query of its mass in exactly one tile.  Tiles carry ids,
vectors and the columns that decide ties; the rest is joined to the ranked rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from peakwise.session import shared_path
from peakwise.sources.tables import shuffles_removed, write_table

#: Rows of masses packed into a bucket, and the fewest per side of a tile.  Two blocks of 384
#: doubles take 25 MB, their products 134 MB per 4096 x 4096 tile, computed a strip of queries
#: at a time.
TILE_ROWS = 4096

#: Vectors of a block as doubles, and rows of one however short they are.  A row moves once per
#: block it faces and a query has ``n`` candidates from each, so blocks are as large as a task
#: can hold.
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 1 << 16

#: Blocks per side of a mass, each of whose rows moves once per block it faces; a mass of more
#: rows has larger blocks, up to :data:`MOST_ROWS`, before it has more of them.
BLOCKS, MOST_ROWS = 8, 1 << 14

#: Tiles for every task that runs at a time, if masses are few; their queries are cut for it.
TILES_PER_CORE = 4

#: Masses whose block counts are broadcast: 100 MB as a hash table.
BROADCAST_KEYS = 2_000_000

#: Components of vectors gathered, and scores made, at a time: 16 MB and 8 MB.
GATHERED, SCORES = 2_000_000, 1_000_000

#: Cosines are compared at this many decimals, so copies of a molecule tie.
COSINE_DIGITS = 12


def match_candidates(queries: DataFrame, library: DataFrame) -> DataFrame:
    """Matched queries with their candidate set in brief: its size, first and last id.

    The library is reduced per mass before the join, so the output is one row per matched
    query.  The reduced library is written: only a join of two scans lets adaptive execution
    split the queries of a mass that many share.
    """
    groups = (
        library.where(F.col("mass_key").isNotNull())
        .groupBy("mass_key")
        .agg(
            F.count(F.lit(1)).alias("n_candidates"),
            F.min("library_id").alias("first_candidate"),
            F.max("library_id").alias("last_candidate"),
        )
    )
    groups = write_table(groups, shared_path(queries.sparkSession, "mass-groups"))
    return queries.join(groups, "mass_key")


def unmatched_queries(queries: DataFrame, library: DataFrame) -> DataFrame:
    """Queries without a candidate, those without a mass key included."""
    masses = library.select("mass_key").where("mass_key is not null").distinct()
    masses = write_table(masses, shared_path(queries.sparkSession, "masses"))
    return queries.join(masses, "mass_key", "left_anti")


def _block_rows(library: DataFrame) -> int:
    """Rows per side of a tile, from the length of one of the library's vectors."""
    vector = library.where(F.col("embedding").isNotNull()).select(F.size("embedding")).first()
    fit = BLOCK_BYTES // (8 * max(1, vector[0] if vector else 1))
    return max(TILE_ROWS, min(BLOCK_ROWS, fit))


def _block_counts(queries: DataFrame, library: DataFrame, tile_rows: int):
    """Per matched mass: candidates and the blocks of either side, from the keys alone, and the
    number of buckets for masses of few rows.

    A row moves to at most :data:`BLOCKS` tiles while a mass has no more than that many times
    ``tile_rows`` or :data:`MOST_ROWS` rows.  The table is written and counted.  Up to
    :data:`BROADCAST_KEYS` masses it is broadcast, which saves moving the embeddings once only to
    learn their blocks; beyond that it is joined like any other table.
    """
    spark = queries.sparkSession
    packed = min(tile_rows, TILE_ROWS)

    def rows_of(n: str):
        most = F.lit(max(tile_rows, MOST_ROWS))
        return F.greatest(F.lit(tile_rows), F.least(F.ceil(F.col(n) / BLOCKS), most))

    def blocks_of(n: str, rows):
        return F.ceil(F.col(n) / rows).cast("int")

    q_sizes = queries.groupBy("mass_key").agg(F.count(F.lit(1)).alias("_nq"))
    l_sizes = library.groupBy("mass_key").agg(F.count(F.lit(1)).alias("n_candidates"))
    sizes = q_sizes.join(l_sizes, "mass_key").select("mass_key", "_nq", "n_candidates")
    sizes = write_table(sizes, shared_path(spark, "blocks"))
    small = (F.col("_nq") <= packed) & (F.col("n_candidates") <= packed)
    rows = F.when(small, F.col("_nq") + F.col("n_candidates")).otherwise(0)
    pairs = F.col("_nq").cast("double") * F.col("n_candidates")
    n_masses, n_rows, n_pairs = sizes.agg(F.count(F.lit(1)), F.sum(rows), F.sum(pairs)).first()
    buckets = max(1, -(-(n_rows or 0) // packed))
    # A tile's share of all pairs.  More blocks of queries repeat library rows only, where more
    # blocks of the library would repeat queries and their candidates.
    share = (n_pairs or 0.0) / (TILES_PER_CORE * spark.sparkContext.defaultParallelism)
    facing = F.least(F.col("n_candidates"), rows_of("n_candidates"))
    dealt = F.greatest(F.lit(packed), F.ceil(F.col("_nq") / BLOCKS), F.ceil(F.lit(share) / facing))
    blocks = sizes.select(
        "mass_key",
        "n_candidates",
        small.alias("_small"),
        blocks_of("_nq", F.least(rows_of("_nq"), dealt)).alias("_qb"),
        blocks_of("n_candidates", rows_of("n_candidates")).alias("_lb"),
    )
    return (F.broadcast(blocks) if n_masses <= BROADCAST_KEYS else blocks), buckets


def _tiles(queries: DataFrame, library: DataFrame, tile_rows: int):
    """Both sides with ``tile = (_tile, _q, _l)``: a bucket of masses, or a mass with the blocks
    of either side; rows repeat only for the blocks they face."""
    blocks, buckets = _block_counts(queries, library, tile_rows)
    bucket = F.pmod(F.xxhash64("mass_key"), F.lit(buckets))
    # Buckets and masses of their own have different signs of _q.
    tile = F.when(F.col("_small"), bucket).otherwise(F.col("mass_key"))

    def spread(side: DataFrame, id_column: str, own: str, own_n: str, other: str, other_n: str):
        block = F.pmod(F.xxhash64(id_column), F.col(own_n)).cast("int")
        faced = F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))
        rows = side.select("*", tile.alias("_tile"), block.alias(own), faced.alias(other))
        return rows.withColumn("_q", F.when(F.col("_small"), -1).otherwise(F.col("_q"))).drop(
            "_qb", "_lb", "_small"
        )

    q = spread(queries.join(blocks, "mass_key"), "spectrum_id", "_q", "_qb", "_l", "_lb")
    lib = spread(library.join(blocks, "mass_key"), "library_id", "_l", "_lb", "_q", "_qb")
    return q, lib.drop("n_candidates")


def _tile_ranker(
    n: int, query_columns: list[str], library_columns: list[str], order: list[str], schema
):
    """Function of two Arrow tables: the best ``n`` library rows per query of a tile."""
    import numpy as np
    import pyarrow as pa

    digits = COSINE_DIGITS

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        """Rows of unit vectors; those that are null, zero or hold a null are NaN."""
        vectors = column.combine_chunks()
        lengths = vectors.value_lengths().drop_null().to_numpy()
        if len(lengths) and (lengths != lengths[0]).any():
            raise ValueError("embeddings differ in length")
        width = int(lengths[0]) if len(lengths) else 0
        dense = np.full((len(vectors), width), np.nan)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        dense[valid] = flat.reshape(len(lengths), width)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.divide(dense, np.linalg.norm(dense, axis=1, keepdims=True), out=dense)

    def product(q: np.ndarray, lib: np.ndarray) -> np.ndarray:
        """Rounded cosines of rows, or of rows of each of a stack; -2, below any cosine, where
        there is none, so that such pairs rank last."""
        scores = np.round(q @ np.swapaxes(lib, -1, -2), digits)
        scores[np.isnan(scores)] = -2.0
        return scores

    def best(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and values of the n largest per row, ties by position."""
        rows = np.arange(len(scores))
        width = min(n, scores.shape[1])
        if width > 16:
            positions = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            return positions, np.take_along_axis(scores, positions, axis=1)
        positions = np.empty((len(scores), width), dtype=np.int64)
        values = np.empty((len(scores), width))
        for k in range(width):
            positions[:, k] = scores.argmax(axis=1)
            values[:, k] = scores[rows, positions[:, k]]
            scores[rows, positions[:, k]] = -np.inf
        return positions, values

    def strips(n_rows: int, n_columns: int):
        """Slices of rows whose products with all columns make up to so many scores."""
        step = max(1, SCORES // max(1, n_columns))
        return (slice(at, at + step) for at in range(0, n_rows, step))

    def by_mass(q, lib, q_mass, lib_mass):
        """Positions and cosines of the best of each query, masses of the same numbers of rows
        on both sides at a time; both sides are unit vectors, the library in the order of ties.

        Masses of one shape are a stack of matrix products, cut so that a stack gathers a
        bounded number of components and makes a bounded number of scores.
        """
        q_order, l_order = (np.argsort(m, kind="stable") for m in (q_mass, lib_mass))
        masses, q_first, n_q = np.unique(q_mass[q_order], return_index=True, return_counts=True)
        l_first = np.searchsorted(lib_mass[l_order], masses, "left")
        n_l = np.searchsorted(lib_mass[l_order], masses, "right") - l_first
        shapes, shape = np.unique(np.stack([n_q, n_l], axis=1), axis=0, return_inverse=True)
        rows, places, values = [], [], []

        def ranked(row, place, scores):
            at, found = best(scores)
            rows.append(np.repeat(row, at.shape[1]))
            places.append(np.take_along_axis(place, at, axis=1).ravel())
            values.append(found.ravel())

        for number, (height, width) in enumerate(shapes.tolist()):
            if not width:
                continue
            same = np.flatnonzero(shape.ravel() == number)
            limit = min(GATHERED // max(1, (height + width) * q.shape[1]), SCORES // (height * width))
            for start in range(0, len(same), max(1, limit)):
                some = same[start : start + max(1, limit)]
                row = q_order[q_first[some][:, None] + np.arange(height)]
                place = l_order[l_first[some][:, None] + np.arange(width)]
                if len(some) == 1:
                    for part in strips(height, width):
                        found = product(q[row[0, part]], lib[place[0]])
                        ranked(row[0, part], np.broadcast_to(place[0], found.shape), found)
                else:
                    found = product(q[row], lib[place])
                    ranked(row.ravel(), np.repeat(place, height, axis=0), found.reshape(-1, width))
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return tuple(np.concatenate(x) for x in (rows, places, values))

    def rank_tile(queries: pa.Table, library: pa.Table) -> pa.Table:
        if not len(queries) or not len(library):
            return schema.empty_table()
        library = library.sort_by([(c, "ascending") for c in order])
        q, lib = matrix(queries["embedding"]), matrix(library["embedding"])
        if not (q.shape[1] and lib.shape[1]):  # no vectors on a side
            q, lib = np.full((len(q), 1), np.nan), np.full((len(lib), 1), np.nan)
        if q.shape[1] != lib.shape[1]:
            raise ValueError("query and library embeddings differ in length")
        if queries["_q"][0].as_py() < 0:
            masses = [t["mass_key"].to_numpy() for t in (queries, library)]
            query_rows, positions, values = by_mass(q, lib, *masses)
        else:
            parts = [best(product(q[part], lib)) for part in strips(len(q), len(lib))]
            positions = np.concatenate([p for p, _ in parts])
            values = np.concatenate([v for _, v in parts]).ravel()
            query_rows = np.repeat(np.arange(len(q)), positions.shape[1])
            positions = positions.ravel()
        columns = [queries[c].take(pa.array(query_rows)) for c in query_columns]
        columns += [library[c].take(pa.array(positions)) for c in library_columns]
        columns.append(pa.array(values, mask=values < -1.5))
        return pa.table(columns, names=query_columns + library_columns + ["cosine"]).cast(schema)

    return rank_tile


def top_candidates(
    queries: DataFrame,
    library: DataFrame,
    n: int = 5,
    query_columns: tuple[str, ...] = (),
    library_columns: tuple[str, ...] = ("smile", "inchikey"),
    tile_rows: int | None = None,
) -> DataFrame:
    """The best ``n`` candidates of each query by cosine, with ``rank`` from 1.

    ``queries`` needs unique ``spectrum_id, mass_key, embedding`` and ``library`` needs
    unique ``library_id, mass_key, embedding``; the named columns of either side go along, as
    does ``n_candidates``.  Equal cosines rank by the library columns in their order, null
    cosines last: those of vectors that are null, zero or hold a null.  Queries without a
    candidate have no rows.  ``tile_rows`` is the number of rows per side of a tile, as many as
    a task can hold vectors of unless it is given.

    The keys of both frames and one vector of the library are read ahead of the rest, when this
    is called.  Pass written tables when the frames are costly.
    """
    order = _tie_columns(library, library_columns)
    later = [c for c in library_columns if c not in order]
    kept = ["library_id", *order] if later else order
    rows = tile_rows or _block_rows(library)
    best = _best_of_tiles(queries, library, n, order, kept, rows)
    ranked = _ranked(best, n, order)
    if query_columns:
        ranked = ranked.join(queries.select("spectrum_id", *query_columns), "spectrum_id")
    if later:
        ranked = ranked.join(library.select("library_id", *later), "library_id")
    return ranked.select(
        "spectrum_id", *query_columns, "n_candidates", *library_columns, "cosine", "rank"
    )


def _tie_columns(library: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of ``columns`` that ties are ordered by: all that are no collections."""
    collections = (T.ArrayType, T.MapType, T.StructType)
    return [c for c in columns if not isinstance(library.schema[c].dataType, collections)]


def _best_of_groups(
    q: DataFrame, lib: DataFrame, keys: list[str], n: int, order: list[str], kept: list[str]
) -> DataFrame:
    """The best ``n`` of each query in each group of ``keys``, with the library's ``kept``
    columns and ``cosine``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept_q = ["spectrum_id", "n_candidates"]
    fields = [T.StructField(c, q.schema[c].dataType) for c in kept_q]
    fields += [T.StructField(c, lib.schema[c].dataType) for c in kept]
    schema = T.StructType([*fields, T.StructField("cosine", T.DoubleType())])
    rank_tile = _tile_ranker(n, kept_q, kept, order, to_arrow_schema(schema))
    return q.groupBy(*keys).cogroup(lib.groupBy(*keys)).applyInArrow(rank_tile, schema)


def _best_of_tiles(
    queries: DataFrame, library: DataFrame, n: int, order: list[str], kept: list[str], tile_rows: int
) -> DataFrame:
    own = dict.fromkeys(["library_id", *order, *kept, "mass_key", "embedding"])
    lib = library.select(*own).where(F.col("mass_key").isNotNull())
    q, lib = _tiles(queries.select("spectrum_id", "mass_key", "embedding"), lib, tile_rows)
    return _best_of_groups(q, lib, ["_tile", "_q", "_l"], n, order, kept)


def _ranked(best: DataFrame, n: int, order: list[str]) -> DataFrame:
    by_cosine = Window.partitionBy("spectrum_id").orderBy(
        F.col("cosine").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order]
    )
    return best.withColumn("rank", F.row_number().over(by_cosine)).where(F.col("rank") <= n)


#: Column of a laid-out library that names the slot of a mass.
SLOT = "mass_slot"


def write_by_mass(
    library: DataFrame, path: str, tile_rows: int = TILE_ROWS, buckets: int | None = None
) -> None:
    """Lay out a keyed library below ``path`` for :func:`top_of_laid_out`.

    Masses of up to ``tile_rows`` molecules are packed into slots of about as many rows, and the
    table is bucketed and sorted by slot, so that jobs read it where it lies; there are as many
    buckets as the session's shuffle partitions, or as slots if those are fewer.  Larger masses
    have a table of their own, ``masses`` counts all, and molecules without a mass are left out.
    """
    spark = library.sparkSession
    keyed = library.where(F.col("mass_key").isNotNull())
    sizes = keyed.groupBy("mass_key").agg(F.count(F.lit(1)).alias("n_candidates"))
    sizes = write_table(sizes, f"{path}/masses")
    large = sizes.where(F.col("n_candidates") > tile_rows).select("mass_key")
    rows = sizes.where(F.col("n_candidates") <= tile_rows).agg(F.sum("n_candidates")).first()[0]
    slots = max(1, -(-(rows or 0) // tile_rows))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(slots, buckets or partitions)
    write_table(keyed.join(large, "mass_key", "left_semi"), f"{path}/large")
    ordinary = keyed.join(large, "mass_key", "left_anti").withColumn(SLOT, _slot(slots))
    with shuffles_removed(spark):
        (
            ordinary.repartition(buckets, SLOT)
            .write.format("parquet")
            .bucketBy(buckets, SLOT)
            .sortBy(SLOT, "mass_key")
            .option("path", f"{path}/ordinary")
            .saveAsTable(_table_name(path))
        )
    facts = [(slots, buckets, tile_rows, ordinary.schema.json())]
    facts = spark.createDataFrame(facts, "slots bigint, buckets int, tile_rows int, schema string")
    facts.coalesce(1).write.parquet(f"{path}/layout")


def _slot(slots: int):
    return F.pmod(F.xxhash64("mass_key"), F.lit(slots))


def _table_name(path: str) -> str:
    return f"peakwise_library_{hashlib.sha1(path.encode()).hexdigest()[:24]}"


def _laid_out(spark, path: str):
    """The bucketed table, which a session that did not write it learns of here, and the facts
    of the layout."""
    facts = spark.read.parquet(f"{path}/layout").first()
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        schema = T.StructType.fromJson(json.loads(facts.schema))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({SLOT}) "
            f"SORTED BY ({SLOT}, mass_key) INTO {facts.buckets} BUCKETS LOCATION '{path}/ordinary'"
        )
    return spark.table(name), facts


def top_of_laid_out(
    queries: DataFrame,
    path: str,
    n: int = 5,
    query_columns: tuple[str, ...] = (),
    library_columns: tuple[str, ...] = ("smile", "inchikey"),
) -> DataFrame:
    """:func:`top_candidates` against a library of :func:`write_by_mass`; only queries move.

    Queries go to the buckets of their slots, where the library's rows are read.  Masses that
    are large on either side are cut into tiles as ever, and only their molecules are moved.
    The masses of the queries are counted and written when this is called.
    """
    spark = queries.sparkSession
    library, facts = _laid_out(spark, path)
    order = _tie_columns(library, library_columns)
    kept = list(library_columns)
    sizes = spark.read.parquet(f"{path}/masses")
    asked = queries.groupBy("mass_key").agg(F.count(F.lit(1)).alias("_nq")).join(sizes, "mass_key")
    asked = write_table(asked, shared_path(spark, "asked-masses"))
    tiled = (F.col("_nq") > facts.tile_rows) | (F.col("n_candidates") > facts.tile_rows)
    few = asked.count() <= BROADCAST_KEYS
    marked = F.broadcast(asked) if few else asked
    q = queries.select("spectrum_id", "mass_key", "embedding")
    parts = []
    if asked.where(~tiled).limit(1).count():
        own = q.join(marked.where(~tiled), "mass_key").withColumn(SLOT, _slot(facts.slots))
        own = own.withColumn("_q", F.lit(-1))
        rows = library.select(*dict.fromkeys([*order, *kept, "mass_key", "embedding", SLOT]))
        if few:  # a broadcast leaves the library's rows where they are
            rows = rows.join(marked.where(~tiled).select("mass_key"), "mass_key", "left_semi")
        parts.append(_best_of_groups(own, rows, [SLOT], n, order, kept))
    if asked.where(tiled).limit(1).count():
        masses = asked.where(tiled).select("mass_key")
        large = spark.read.parquet(f"{path}/large")
        molecules = large.unionByName(library.drop(SLOT))
        rows = molecules.join(masses, "mass_key", "left_semi")
        own = q.join(masses, "mass_key", "left_semi")
        block_rows = max(facts.tile_rows, _block_rows(molecules))
        parts.append(_best_of_tiles(own, rows, n, order, kept, block_rows))
    if not parts:
        none = q.limit(0).join(sizes, "mass_key")
        parts = [_best_of_groups(none.withColumns({SLOT: F.lit(0).cast("bigint"), "_q": F.lit(-1)}),
                                 library.limit(0), [SLOT], n, order, kept)]
    ranked = _ranked(reduce(DataFrame.unionByName, parts), n, order)
    if query_columns:
        ranked = ranked.join(queries.select("spectrum_id", *query_columns), "spectrum_id")
    return ranked.select(
        "spectrum_id", *query_columns, "n_candidates", *library_columns, "cosine", "rank"
    )


def wide_results(
    ranked: DataFrame, n: int, columns: Iterable[tuple[str, str]], key: str = "spectrum_id"
) -> DataFrame:
    """One row per query: for each ``(column, label)`` the columns ``Top_1_label`` to
    ``Top_n_label``, null past the last candidate."""
    columns = list(columns)
    entry = F.struct("rank", *[c for c, _ in columns])
    gathered = (
        ranked.where(F.col("rank") <= n)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(entry)).alias("_top"))
    )
    return gathered.select(
        F.col(key).alias("Unique_ID"),
        *[
            F.get(F.col("_top"), F.lit(i))[column].alias(f"Top_{i + 1}_{label}")
            for column, label in columns
            for i in range(n)
        ],
    )


def wide_annotated(ranked: DataFrame, n: int = 5) -> DataFrame:
    return wide_results(
        ranked, n, [("cosine", "cosine"), ("smile", "SMILE"), ("tanimoto", "Tanimoto")]
    )


def wide_unannotated(ranked: DataFrame, n: int = 5) -> DataFrame:
    return wide_results(
        ranked, n, [("cosine", "cosine"), ("smile", "SMILE"), ("inchikey", "InChIKey")]
    )
