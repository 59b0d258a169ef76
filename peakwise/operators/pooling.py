"""Pooling replicate spectra and keeping first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY_LENGTH = 14


def structure_key(inchikey: Column) -> Column:
    """The part of an InChIKey that encodes the skeleton."""
    return F.substring(inchikey, 1, KEY_LENGTH)


def first_per_key(df: DataFrame, key: str, columns: tuple[str, ...], order: str = "ordinal"):
    """Values of the first row of each key; rows without a key are left out."""
    rows = df.where(F.col(key).isNotNull()).select(key, *columns, F.col(order).alias("_order"))
    return first_row(rows, key, "_order").drop("_order")


def first_row(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each ``key``, whole.  Spark cuts each task's rows to one per key
    ahead of the shuffle."""
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(ranked)).where("_n = 1").drop("_n")


def dedupe_by_id(df: DataFrame, order: str = "ordinal") -> DataFrame:
    return first_row(df, "spectrum_id", order)


def dedupe_by_smile(df: DataFrame) -> DataFrame:
    """First row per structure string, in structure key order."""
    return first_row(df, "smile", "structure_key")


def pool_by_structure(spectra: DataFrame, peaks: DataFrame) -> DataFrame:
    """Pooled peaks of each structure, from ``spectra(spectrum_id, structure_key, smile,
    precursor, ordinal)`` and ``peaks(spectrum_id, pos, mz, intensity)``.

    The peaks of a structure in pooled order are its rows by ``(ordinal, pos)``; ``smile``
    and ``precursor`` become those of its first spectrum with a peak.  Structures whose first
    ``smile`` repeats one of a smaller key are left out.  What is pooled is found among the
    spectra; peaks are joined once.
    """
    with_peaks = spectra.join(peaks.select("spectrum_id").distinct(), "spectrum_id", "left_semi")
    first = dedupe_by_smile(first_per_key(with_peaks, "structure_key", ("smile", "precursor")))
    pooled = spectra.select("spectrum_id", "structure_key", "ordinal").join(first, "structure_key")
    return peaks.join(pooled, "spectrum_id")
