"""Per-record peak list expressions.  ``peaks`` is ``ARRAY<STRUCT<mz, intensity>>``.

Each expression mentions its peak list once (see :func:`bind`), so chained steps collapse
into one projection without repeating work.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peakwise.functions.bind import bind
from peakwise.functions.rounding import round_even

PRECURSOR_MARGIN = 0.5  # fixed value

#: What m/z are summed as: exact for any order and number of peaks.  Those of 1e12 and more,
#: which it cannot hold, are summed as doubles.
MZ_DECIMAL = "decimal(28,16)"


def _peak(mz: Column, intensity: Column) -> Column:
    return F.struct(mz.alias("mz"), intensity.alias("intensity"))


def _total(peaks: Column, field: str) -> Column:
    return F.aggregate(peaks, F.lit(0.0), lambda total, p: total + p[field])


def within_precursor(peaks: Column, precursor: Column) -> Column:
    """Peaks with ``mz <= precursor + 0.5``."""
    return bind(
        F.struct(peaks.alias("peaks"), (precursor + PRECURSOR_MARGIN).alias("limit")),
        lambda s: F.filter(s["peaks"], lambda p: p["mz"] <= s["limit"]),
    )


def _with_base(peaks: Column, body) -> Column:
    """``body(peaks, base)`` with the intensity of the highest peak."""
    return bind(
        bind(
            peaks,
            lambda ps: F.struct(
                ps.alias("peaks"), F.array_max(ps["intensity"]).alias("base")
            ),
        ),
        lambda s: body(s["peaks"], s["base"]),
    )


def scale_to_base_peak(peaks: Column) -> Column:
    """Intensities as a percentage of the highest one; null when that is zero."""
    return _with_base(
        peaks,
        lambda ps, base: F.transform(
            ps, lambda p: _peak(p["mz"], F.try_divide(p["intensity"], base) * 100.0)
        ),
    )


def above_relative_intensity(peaks: Column, threshold: float) -> Column:
    """Peaks at or above ``threshold`` percent of the highest one, values unchanged."""
    return _with_base(
        peaks,
        lambda ps, base: F.filter(
            ps,
            lambda p: F.try_divide(p["intensity"], base) * 100.0 >= F.lit(float(threshold)),
        ),
    )


def scale_to_total(peaks: Column) -> Column:
    """Intensities divided by their sum."""
    return bind(
        bind(
            peaks,
            lambda ps: F.struct(ps.alias("peaks"), _total(ps, "intensity").alias("total")),
        ),
        lambda s: F.transform(
            s["peaks"],
            lambda p: _peak(p["mz"], F.try_divide(p["intensity"], s["total"])),
        ),
    )


def clean_peaks(peaks: Column, precursor: Column, threshold: float) -> Column:
    """Window, base peak scaling, threshold and total-ion scaling in one expression."""
    windowed = within_precursor(peaks, precursor)
    return scale_to_total(above_relative_intensity(scale_to_base_peak(windowed), threshold))


def decimal_mz(mz: Column) -> Column:
    """An m/z as a decimal, zero if it is too large for one."""
    return F.coalesce(mz.try_cast(MZ_DECIMAL), F.lit(0).cast(MZ_DECIMAL))


def far_mz(mz: Column) -> Column:
    """What :func:`decimal_mz` leaves out."""
    return F.when(mz.try_cast(MZ_DECIMAL).isNull(), mz).otherwise(0.0)


def merge_close_peaks(peaks: Column, tolerance: float) -> Column:
    """Chains of peaks whose neighbours differ by at most ``tolerance``, as one peak each.

    A merged peak has the mean m/z (three, then two decimals) and the summed intensity.  The
    mean is the sum of decimals over the count, whatever the count.
    """

    def rounded(mz: Column) -> Column:
        return round_even(round_even(mz, 3), 2)

    def mean(chain: Column, length: Column) -> Column:
        zero = F.lit(0).cast("decimal(37,16)")
        total = F.aggregate(
            chain, zero, lambda t, p: (t + decimal_mz(p["mz"])).cast("decimal(37,16)")
        )
        far = F.aggregate(chain, F.lit(0.0), lambda t, p: t + far_mz(p["mz"]))
        return (total.cast("double") + far) / length

    def chain_peak(ordered: Column, start: Column, length: Column) -> Column:
        only = F.get(ordered, start - 1)
        chain = F.slice(ordered, start, length)
        return F.when(
            length == 1,
            _peak(rounded(decimal_mz(only["mz"]).cast("double") + far_mz(only["mz"])),
                  only["intensity"]),
        ).otherwise(_peak(rounded(mean(chain, length)), _total(chain, "intensity")))

    def merged(ordered: Column) -> Column:
        # 1-based positions where a chain starts; sequence(1, 0) would count down.
        positions = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions,
            lambda i: (i == 1)
            | (F.get(ordered, i - 1)["mz"] - F.get(ordered, i - 2)["mz"] > F.lit(tolerance)),
        )
        return bind(
            starts,
            lambda st: F.transform(
                st,
                lambda start, j: chain_peak(
                    ordered,
                    start,
                    F.coalesce(F.get(st, j + 1), F.size(ordered) + 1) - start,
                ),
            ),
        )

    return bind(F.sort_array(peaks), merged)


def neutral_loss(precursor: Column, mz: Column) -> Column:
    """What the precursor (plus its margin) loses to leave a fragment at ``mz``."""
    return round_even(round_even(precursor, 3) + PRECURSOR_MARGIN - round_even(mz, 3), 3)


def with_neutral_losses(mz: Column, precursor: Column) -> Column:
    """The m/z list followed by the neutral loss of each entry."""
    return bind(
        F.struct(mz.alias("mz"), precursor.alias("precursor")),
        lambda s: F.concat(
            s["mz"], F.transform(s["mz"], lambda m: neutral_loss(s["precursor"], m))
        ),
    )
