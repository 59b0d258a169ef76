"""Steps over peak rows (one row per peak).

Groups are reduced by partial aggregates and joined back instead of being gathered: a
spectrum or structure that owns a third of all peaks costs its tasks a few rows.  The reduced
table is written ahead of the join, since adaptive execution splits a hot key only where both
sides come straight from a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peakwise.functions import binning, peaks
from peakwise.functions.rounding import round_even
from peakwise.operators import records
from peakwise.session import shared_path
from peakwise.sources.tables import spread, write_table


def explode_peaks(df: DataFrame, *keep: str, position: bool = False) -> DataFrame:
    """Records to peak rows, with ``pos`` of each peak on request.

    Without it a scan only reads the peak fields used later on.
    """
    if position:
        rows = df.select(*keep, F.posexplode("peaks").alias("pos", "peak"))
        keep = (*keep, "pos")
    else:
        rows = df.select(*keep, F.explode("peaks").alias("peak"))
    return rows.select(
        *keep, F.col("peak.mz").alias("mz"), F.col("peak.intensity").alias("intensity")
    )


def precursor_window(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("mz") <= F.col("precursor") + peaks.PRECURSOR_MARGIN)


def remaining_spectra(rows: DataFrame, key: str) -> DataFrame:
    """Keys that still have a peak, with their peak count.  Empty spectra have no rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_peaks"))


def base_peak_scale(rows: DataFrame, key: str) -> DataFrame:
    """``intensity`` as a percentage of the highest peak.

    Also adds ``base_pct``, the scaled value of the highest peak after scaling: 100, unless
    every intensity is negative.
    """
    base = rows.groupBy(key).agg(
        F.max("intensity").alias("_base"), F.min("intensity").alias("_low")
    )
    base = write_table(base, shared_path(rows.sparkSession, "base-peaks"))
    top = F.when(F.col("_base") < 0, F.try_divide(F.col("_low"), F.col("_base")) * 100.0)
    return (
        rows.join(base, key)
        .withColumns(
            {
                "intensity": F.try_divide(F.col("intensity"), F.col("_base")) * 100.0,
                "base_pct": top.otherwise(F.lit(100.0)),
            }
        )
        .drop("_base", "_low")
    )


def intensity_threshold(
    rows: DataFrame, threshold: float = records.INTENSITY_THRESHOLD
) -> DataFrame:
    """Rows of :func:`base_peak_scale` at or above ``threshold`` percent."""
    return rows.where(F.col("intensity") / F.col("base_pct") * 100.0 >= threshold)


def total_ion_scale(rows: DataFrame, key: str) -> DataFrame:
    total = rows.groupBy(key).agg(F.sum("intensity").alias("_total"))
    total = write_table(total, shared_path(rows.sparkSession, "total-ions"))
    return (
        rows.join(total, key)
        .withColumn("intensity", F.try_divide(F.col("intensity"), F.col("_total")))
        .drop("_total")
    )


def clean(
    rows: DataFrame, key: str, threshold: float = records.INTENSITY_THRESHOLD
) -> DataFrame:
    scaled = base_peak_scale(precursor_window(rows), key)
    return total_ion_scale(intensity_threshold(scaled, threshold), key).drop("base_pct")


def _cell(mz: Column, tolerance: float) -> Column:
    if tolerance <= 0:
        return mz
    cell = mz / (tolerance / 2)
    # Beyond 2^53 numbers are whole, and too large for an integer cell soon after.
    return F.when(F.abs(cell) < 2.0**53, F.floor(cell).cast("double")).otherwise(cell)


def merge_peaks(
    rows: DataFrame, key: str, tolerance: float = records.TOLERANCE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Chains of peaks whose neighbours differ by at most ``tolerance``, one row per chain.

    Peaks are first summed into cells half a tolerance wide.  Peaks of one cell always
    belong to one chain, and neighbouring cells chain exactly when the last peak of one and
    the first of the next are close enough.  The cells of a key are bounded by the mass
    range over the tolerance however many peaks the key owns, so ordering them within the
    key is safe.  They are dealt over as many tasks as the input deserves, which the steps after
    this one share.  ``carry`` names columns that are constant per key.

    Means are sums of decimals over the count, as in :mod:`peakwise.functions.peaks`: the same
    in whatever order partial sums arrive.
    """
    cells = rows.groupBy(key, *carry, _cell(F.col("mz"), tolerance).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(peaks.decimal_mz(F.col("mz"))).alias("_mz"),
        F.sum(peaks.far_mz(F.col("mz"))).alias("_far"),
        F.sum("intensity").alias("_intensity"),
        F.min("mz").alias("_low"),
        F.max("mz").alias("_high"),
    )
    cells = spread(cells, key)
    along = Window.partitionBy(key).orderBy("_cell")
    gap = F.col("_low") - F.lag("_high").over(along)
    chained = cells.withColumn("_new", F.coalesce((gap > tolerance).cast("int"), F.lit(1)))
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = chained.withColumn("chain", F.sum("_new").over(so_far))
    count = F.sum("_n")
    mean = (F.sum("_mz").cast("double") + F.sum("_far")) / count
    return chained.groupBy(key, *carry, "chain").agg(
        round_even(round_even(mean, 3), 2).alias("mz"),
        F.sum("_intensity").alias("intensity"),
        count.alias("n_merged"),
    )


def with_neutral_losses(rows: DataFrame, *keep: str) -> DataFrame:
    """Two rows per merged peak: its m/z (``kind`` 0) and its neutral loss (``kind`` 1)."""
    both = F.array(F.col("mz"), peaks.neutral_loss(F.col("precursor"), F.col("mz")))
    return rows.select(*keep, F.posexplode(both).alias("kind", "value"))


def bin_rows(
    values: DataFrame,
    key: str,
    *carry: str,
    resolution: float = records.RESOLUTION,
    max_mz: float = records.MAX_MZ,
) -> DataFrame:
    """Distinct occupied bins, one row each."""
    return values.select(
        key, *carry, binning.bin_index(F.col("value"), resolution, max_mz).alias("bin")
    ).distinct()


def collect_bins(bins: DataFrame, key: str, *carry: str) -> DataFrame:
    """Bin rows to sparse records.  Bins are distinct, so a record holds at most one entry
    per grid point."""
    return (
        bins.groupBy(key, *carry)
        .agg(F.sort_array(F.collect_list("bin")).alias("bins"))
        .withColumn("len_frag", F.size("bins"))
    )


def encode(
    rows: DataFrame,
    key: str,
    tolerance: float = records.TOLERANCE,
    resolution: float = records.RESOLUTION,
    max_mz: float = records.MAX_MZ,
) -> DataFrame:
    """Peak rows with a ``precursor`` constant per key to sparse records."""
    merged = merge_peaks(rows, key, tolerance, carry=("precursor",))
    values = with_neutral_losses(records.precursor_cutoff(merged), key, "precursor")
    bins = bin_rows(values, key, "precursor", resolution=resolution, max_mz=max_mz)
    return collect_bins(bins, key, "precursor")
