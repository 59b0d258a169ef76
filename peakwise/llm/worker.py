"""Helpers for Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names with this prefix are the operators' own; they never meet a frame's other columns.
OWN = "__"


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` with ``__row``, a name of its own for every row.

    Rows are named by their place, not by an id, which may repeat or be null.  Rows straight
    from Parquet have one, the file and the number in it; any other frame is written first.
    """
    from peakwise.session import shared_path
    from peakwise.sources.tables import write_table

    if _is_parquet(df) and "_metadata" not in df.columns:
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        return df.select("*", place.alias(f"{OWN}row"))
    rows = df.withColumn(f"{OWN}row", F.monotonically_increasing_id())
    return write_table(rows, shared_path(df.sparkSession, label))


def _is_parquet(df: DataFrame) -> bool:
    """Whether a frame is Parquet files as they are."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return (
        relation.getClass().getSimpleName() == "HadoopFsRelation"
        and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"
    )


def carried(df: DataFrame, *but: str) -> tuple[list, list]:
    """Columns of ``df`` but those named, as one struct ``__others``, and its fields again."""
    others = [c for c in df.columns if c not in but]
    if not others:
        return [], []
    packed = F.struct(*[F.col(f"`{c}`").alias(c) for c in others]).alias(f"{OWN}others")
    return [packed], [F.col(f"{OWN}others")[c].alias(c) for c in others]


def kept(slot: str, key: str, make: Callable):
    """``make()``, made once per Python worker, slot and key.

    A slot holds one value: another key replaces it.  Functions are shipped by value and so
    share no globals; slots are attributes of a module of the worker, which later tasks of the
    same worker find again.
    """
    import sys
    import types

    slots = sys.modules.setdefault("_peakwise_llm_slots", types.ModuleType("_slots"))
    held = getattr(slots, slot, None)
    if held is None or held[0] != key:
        held = (key, make())
        setattr(slots, slot, held)
    return held[1]


def slices(batch, column: int | str, size: int) -> Iterator:
    """Runs of an Arrow batch's rows with up to so many bytes in a column, and a row at least.

    What a run leaves in Arrow's pool goes back to the machine, which the executor's other
    tasks share.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy())
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, upto - at)
        pa.default_memory_pool().release_unused()
        at = upto


def ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each element and its place within the row, for rows of the given lengths."""
    counts = np.asarray(counts, dtype=np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - starts[row]


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` names the smallest known node reachable from each node; the result also follows
    the links ``a[i] - b[i]``."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, high[apart], low[apart])
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
