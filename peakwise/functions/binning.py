"""Fixed m/z grid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from peakwise.functions.bind import bind


def grid_size(resolution: float, max_mz: float) -> int:
    """Number of grid points ``i * resolution`` below ``max_mz``."""
    return math.ceil(max_mz / resolution)


def bin_index(value: Column, resolution: float, max_mz: float) -> Column:
    """First grid point at or above ``value``, clamped to the grid.

    The division can land one step off the product it inverts, so the neighbours of the
    quotient are compared on the grid itself.
    """
    # Values off the grid need no index that could overflow.
    value = F.least(F.greatest(value, F.lit(-1.0)), F.lit(max_mz + 1.0))
    k = F.ceil(value / resolution)
    first = (
        F.when((k - 1) * F.lit(resolution) >= value, k - 1)
        .when(k * F.lit(resolution) < value, k + 1)
        .otherwise(k)
    )
    last = grid_size(resolution, max_mz) - 1
    return F.least(F.greatest(first, F.lit(0)), F.lit(last)).cast("int")


def occupied_bins(values: Column, resolution: float, max_mz: float) -> Column:
    """Sorted distinct bins of an array of m/z values."""
    return bind(
        F.transform(values, lambda v: bin_index(v, resolution, max_mz)),
        lambda b: F.sort_array(F.array_distinct(b)),
    )
