"""Spectrum embeddings from a caller-supplied model.

A model is named by a *loader*: a picklable function without arguments that reads weights
from a path every executor can reach and returns ``predict``.  It runs once per Python
worker, so weights are never broadcast or captured in a closure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spectra turned into dense rows at a time: 64 x 70,000 float32 take 18 MB.
DENSE_ROWS = 64

#: Bins and dimensions of a tile of weights, 64 MB, and spectra that meet it.
RANGE_BINS, BLOCK_WIDTH, TILE_SPECTRA = 1 << 17, 64, 1 << 17

#: Largest weight table, as doubles, that the driver and every executor hold.
BROADCAST_BYTES = 64 << 20

#: Weights gathered at a time: 32 MB.
GATHERED = 4_000_000


def _loaded(key: str, load: Callable):
    """The predictor of this worker process.

    Functions shipped by value share no globals, so it is kept on a module of the worker.  A
    worker keeps one model: another key replaces it.
    """
    import sys
    import types

    slot = sys.modules.setdefault("_peakwise_model", types.ModuleType("_peakwise_model"))
    if getattr(slot, "key", None) != key:
        slot.model = None  # frees the old one before the new one is read
        slot.key, slot.model = key, load()
    return slot.model


def embed_spectra(
    df: DataFrame,
    load: Callable[[], Callable],
    n_bins: int = 70_000,
    dense: bool = True,
    model_key: str | None = None,
) -> DataFrame:
    """Add ``embedding ARRAY<FLOAT>`` from ``bins``.

    ``predict`` gets a ``(rows, n_bins)`` float32 matrix of zeros and ones, or with
    ``dense=False`` a list of bin index arrays, and returns a ``(rows, width)`` matrix.
    Only bin indexes cross from Spark to Python; the matrix exists for
    :data:`DENSE_ROWS` spectra at a time.  ``model_key`` lets tasks of later jobs reuse a
    loaded model; give each model its own.
    """
    embed_udf = F.pandas_udf(
        _embedder({"": load}, n_bins, dense, model_key), T.ArrayType(T.FloatType())
    )
    return df.withColumn("embedding", embed_udf("bins", F.lit("")))


def _embedder(
    loaders: Mapping[str, Callable], n_bins: int, dense: bool, model_key: str | None
) -> Callable:
    """Function of an iterator of series ``(bins, mode)``: embeddings by the mode's model."""
    import uuid

    key = model_key or uuid.uuid4().hex

    def densify(chunk: list[np.ndarray]) -> np.ndarray:
        matrix = np.zeros((len(chunk), n_bins), dtype=np.float32)
        for row, bins in zip(matrix, chunk):
            row[bins] = 1.0
        return matrix

    def embed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch, modes in batches:
            vectors: list[np.ndarray | None] = [None] * len(batch)
            for mode in modes.unique():
                predict = _loaded(f"{key}/{mode}", loaders[mode])
                rows = np.flatnonzero(modes == mode)
                for start in range(0, len(rows), DENSE_ROWS):
                    some = rows[start : start + DENSE_ROWS]
                    chunk = list(batch.iloc[some])
                    found = np.asarray(predict(densify(chunk) if dense else chunk), np.float32)
                    for row, vector in zip(some, found):
                        vectors[row] = vector
            yield pd.Series(vectors)

    return embed


def embed_by_mode(
    df: DataFrame,
    loaders: Mapping[str, Callable],
    n_bins: int = 70_000,
    dense: bool = True,
    model_key: str | None = None,
) -> DataFrame:
    """:func:`embed_spectra` with one model per ``ion_mode``; rows of other modes are left out.

    Rows are counted by mode and dealt to partitions that hold one mode each, as many as the
    mode's share of the session's shuffle partitions, so that a task loads one model and
    ``df`` is read once for the bins.  Pass written features.
    """
    rows = df.where(F.col("ion_mode").isin(list(loaders)))
    counts = {r.ion_mode: r["count"] for r in rows.groupBy("ion_mode").count().collect()}
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = partitions / max(1, sum(counts.values()))
    to, first = F.lit(0), 0
    for mode in loaders:
        own = max(1, round(counts.get(mode, 0) * share))
        place = F.pmod(F.monotonically_increasing_id(), F.lit(own)) + first
        to = F.when(F.col("ion_mode") == mode, place).otherwise(to)
        first += own
    dealt = rows.withColumn("_to", to.cast("int")).repartitionById(first, "_to").drop("_to")
    embed_udf = F.pandas_udf(
        _embedder(loaders, n_bins, dense, model_key), T.ArrayType(T.FloatType())
    )
    return dealt.withColumn("embedding", embed_udf("bins", "ion_mode"))


def _layer(lists, bins: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``matrix`` whose ``bins`` (ascending) an Arrow array of lists names;
    other bins add nothing."""
    counts = lists.value_lengths().to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.searchsorted(bins, flat)
    known = (at < len(bins)) & (bins[np.minimum(at, len(bins) - 1)] == flat) if len(bins) else (
        np.zeros(len(flat), dtype=bool)
    )
    row, at = np.repeat(np.arange(len(counts)), counts)[known], at[known]
    sums = np.zeros((len(counts), matrix.shape[1]))
    step = max(1, GATHERED // max(1, matrix.shape[1]))
    for start in range(0, len(row), step):
        some = row[start : start + step]
        first = np.flatnonzero(np.diff(some, prepend=-1))
        sums[some[first]] += np.add.reduceat(matrix[at[start : start + step]], first, axis=0)
    return sums


def _matrix(rows, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending bins and their weights from an Arrow table ``(bin, w)``."""
    rows = rows.sort_by("bin")
    flat = rows["w"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(rows) * width:
        raise ValueError(f"weight rows are not all of width {width}")
    return rows["bin"].to_numpy(), flat.reshape(-1, width)


def _vectors(values: np.ndarray):
    """Arrow array of the rows of a matrix."""
    import pyarrow as pa

    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _linear_in_tasks(rows: DataFrame, weights: DataFrame, start: np.ndarray) -> DataFrame:
    """``(key, activation)`` where the whole weight table goes to every executor."""
    import pyarrow as pa

    table = rows.sparkSession.sparkContext.broadcast(_matrix(weights.toArrow(), len(start)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layer = _layer(batch.column(1), *table.value) + start
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _vectors(layer)], names=["key", "activation"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(sums, f"key {kind}, activation array<double>")


def _linear_in_tiles(rows: DataFrame, weights: DataFrame, start: np.ndarray) -> DataFrame:
    """``(key, activation)`` from tiles of a range of bins, a block of dimensions and a block of
    spectra.  A spectrum has a row per tile that it touches, with the tile's bins, and gets a
    part of its activation from each; only weights wider than a range add parts up."""
    import pyarrow as pa

    width = len(start)
    n_parts = -(-width // BLOCK_WIDTH)
    n_blocks = max(1, -(-rows.count() // TILE_SPECTRA))
    n_ranges = (weights.agg(F.max("bin")).first()[0] or 0) // RANGE_BINS + 1
    in_range = lambda name: F.floor(F.col(name) / RANGE_BINS).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    slices = [F.slice("w", p * BLOCK_WIDTH + 1, BLOCK_WIDTH) for p in range(n_parts)]
    cells = weights.select(in_range("bin").alias("range"), "bin", F.posexplode(F.array(*slices)))
    cells = cells.select("range", F.col("pos").alias("part"), every(n_blocks).alias("block"),
                         "bin", F.col("col").alias("w"))
    block = F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int")
    own = lambda b: F.floor(b / RANGE_BINS) == F.col("range")
    spread = rows.select("key", "bins", block.alias("block"), every(n_ranges).alias("range"))
    spread = spread.withColumn("bins", F.filter("bins", own) if n_ranges > 1 else F.col("bins"))
    # Every spectrum is in the first range, which adds the bias.
    spread = spread.where((F.size("bins") > 0) | (F.col("range") == 0))
    spread = spread.select("*", every(n_parts).alias("part"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "part", "v"]

    def tile(spectra: pa.Table, cells: pa.Table) -> pa.Table:
        part = (spectra if len(spectra) else cells)["part"][0].as_py()
        base = start[part * BLOCK_WIDTH : (part + 1) * BLOCK_WIDTH]
        bins, matrix = _matrix(cells, len(base)) if len(cells) else (np.empty(0), base[None][:0])
        found = [
            _layer(chunk, bins, matrix) for chunk in spectra["bins"].chunks if len(chunk)
        ]
        layer = np.concatenate(found) if found else np.empty((0, len(base)))
        if len(spectra) and spectra["range"][0].as_py() == 0:
            layer = layer + base
        return pa.table([spectra["key"], spectra["part"], _vectors(layer)], names=names)

    at = ["range", "part", "block"]
    parts = spread.groupBy(*at).cogroup(cells.groupBy(*at)).applyInArrow(
        tile, f"key {kind}, part int, v array<double>"
    )
    if n_ranges > 1:
        places = range(min(width, BLOCK_WIDTH))
        sums = parts.groupBy("key", "part").agg(
            *[F.sum(F.get("v", F.lit(i))).alias(f"_{i}") for i in places]
        )
        # A part's last places are null where the width is no multiple of the block's.
        whole = F.array_compact(F.array(*[F.col(f"_{i}") for i in places]))
        parts = sums.select("key", "part", whole.alias("v"))
    if n_parts == 1:
        return parts.select("key", F.col("v").alias("activation"))
    ordered = F.array_sort(F.collect_list(F.struct("part", "v")))
    return parts.groupBy("key").agg(
        F.flatten(F.transform(ordered, lambda p: p["v"])).alias("activation")
    )


def sparse_linear(
    df: DataFrame,
    weights: DataFrame,
    width: int,
    key: str = "spectrum_id",
    relu: bool = True,
    bias: Sequence[float] | None = None,
) -> DataFrame:
    """First dense layer on binary input: the bias plus the weight rows of the occupied bins.

    ``weights`` is ``(bin, w ARRAY)`` with at most one row per grid point, and ``key`` names a
    spectrum.  Bins without a weight row add nothing, so a spectrum without any other keeps the
    bias; spectra whose ``bins`` are null have no row.  The table is counted first.  Up to
    :data:`BROADCAST_BYTES` it goes to every executor and spectra are summed where they are; a
    larger one meets them in tiles, each with at most :data:`RANGE_BINS` times
    :data:`BLOCK_WIDTH` weights and about :data:`TILE_SPECTRA` spectra, which are counted too.
    """
    start = np.zeros(width) if bias is None else np.array(bias, dtype=np.float64)
    if start.shape != (width,):
        raise ValueError(f"{len(start)} values of bias for a width of {width}")
    weights = weights.select(F.col("bin").cast("int").alias("bin"), F.col("w").cast("array<double>"))
    rows = df.where(F.col("bins").isNotNull()).select(
        F.col(key).alias("key"), F.col("bins").cast("array<int>").alias("bins")
    )
    small = weights.count() * width * 8 <= BROADCAST_BYTES
    layer = (_linear_in_tasks if small else _linear_in_tiles)(rows, weights, start)
    value = F.col("activation")
    if relu:
        value = F.transform(value, lambda x: F.greatest(x, F.lit(0.0)))
    return layer.select(F.col("key").alias(key), value.alias("activation"))
