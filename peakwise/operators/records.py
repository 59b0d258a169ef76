"""Steps over spectrum records (one row per spectrum); none of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakwise.functions import binning, peaks

# The published defaults.
TOLERANCE = 0.01
RESOLUTION = 0.01
MAX_MZ = 700
INTENSITY_THRESHOLD = 1.0
MAX_PRECURSOR = 1000.0


def precursor_window(df: DataFrame) -> DataFrame:
    return df.withColumn("peaks", peaks.within_precursor(F.col("peaks"), F.col("precursor")))


def drop_empty(df: DataFrame) -> DataFrame:
    return df.where(F.size("peaks") > 0)


def base_peak_scale(df: DataFrame) -> DataFrame:
    return df.withColumn("peaks", peaks.scale_to_base_peak(F.col("peaks")))


def intensity_threshold(df: DataFrame, threshold: float = INTENSITY_THRESHOLD) -> DataFrame:
    return df.withColumn("peaks", peaks.above_relative_intensity(F.col("peaks"), threshold))


def total_ion_scale(df: DataFrame) -> DataFrame:
    return df.withColumn("peaks", peaks.scale_to_total(F.col("peaks")))


def clean(
    df: DataFrame, threshold: float = INTENSITY_THRESHOLD, keep: Column | None = None
) -> DataFrame:
    """All cleaning steps; spectra left without a peak are dropped.

    Same as the single steps in order, but the peaks go through a generator: a filter on
    their number would be pushed below the projection and clean every spectrum twice.  Rows
    that ``keep`` marks stay, with null peaks.
    """
    cleaned = peaks.clean_peaks(F.col("peaks"), F.col("precursor"), threshold)
    left = F.filter(F.array(cleaned), lambda ps: F.size(ps) > 0)
    if keep is not None:
        left = F.when(keep, F.array(F.lit(None))).otherwise(left)
    others = [c for c in df.columns if c != "peaks"]
    return df.select(*others, F.explode(left).alias("peaks"))


def unzip_peaks(df: DataFrame) -> DataFrame:
    """Peaks as the parallel arrays ``mz`` and ``ints``."""
    return df.withColumns({"mz": F.col("peaks.mz"), "ints": F.col("peaks.intensity")})


def merge_peaks(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return df.withColumn("merged", peaks.merge_close_peaks(F.col("peaks"), tolerance))


def precursor_cutoff(df: DataFrame, limit: float = MAX_PRECURSOR) -> DataFrame:
    """Keep precursors up to ``limit``.  Apply after de-duplication: which row is the first
    of its id must not depend on the cutoff."""
    return df.where(F.col("precursor") <= limit)


def encode(
    df: DataFrame,
    tolerance: float = TOLERANCE,
    resolution: float = RESOLUTION,
    max_mz: float = MAX_MZ,
) -> DataFrame:
    """Merge close peaks, add neutral losses and encode the occupied bins.

    Adds ``mz``, ``ints`` (the cleaned peaks), ``bins`` (sorted, distinct) and ``len_frag``.
    """
    merged_mz = peaks.merge_close_peaks(F.col("peaks"), tolerance)["mz"]
    values = peaks.with_neutral_losses(merged_mz, F.col("precursor"))
    encoded = unzip_peaks(df).withColumn(
        "bins", binning.occupied_bins(values, resolution, max_mz)
    )
    return encoded.withColumn("len_frag", F.size("bins"))
