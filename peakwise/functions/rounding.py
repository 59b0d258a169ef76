"""The two rounding rules and the integer mass keys built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mass of a proton in Da.
PROTON_MASS = 1.007276


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rule for peaks and neutral losses."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def adduct_mz(exact_mass: Column, ion_mode: Column | str) -> Column:
    """m/z of the protonated (``+``) or, for any other mode, deprotonated molecule."""
    mode = F.lit(ion_mode) if isinstance(ion_mode, str) else ion_mode
    return exact_mass + F.when(mode == "+", F.lit(1.0)).otherwise(F.lit(-1.0)) * PROTON_MASS


def rounded_mass_key(mz: Column) -> Column:
    """Milli-dalton key of an m/z rounded to three decimals."""
    return F.rint(F.round(mz, 3) * 1000.0).cast("bigint")


def truncated_mass_key(mz: Column) -> Column:
    """Milli-dalton key of an m/z whose decimal text is cut after three fraction digits.

    The cast to decimal goes through the shortest decimal text of the double, so 478.1
    gives 478100 although ``478.1 * 1000`` is below it.
    """
    return F.floor(mz.cast("decimal(30,15)") * F.lit(1000).cast("decimal(4,0)")).cast("bigint")
