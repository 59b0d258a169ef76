"""Molecule properties and mass keys of libraries and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakwise.functions.rounding import adduct_mz, rounded_mass_key, truncated_mass_key
from peakwise.operators.pooling import structure_key


#: Tasks that the spectra of one molecule are dealt over where a join's tasks are counted.
COPIES = 8


def attach_properties(
    spectra: DataFrame, molecules: DataFrame, *columns: str, tasks: int = 0
) -> DataFrame:
    """Left join of ``molecules`` (one row per ``smile``), plus the structure key.

    Spectra of an unknown structure keep null properties.  With ``tasks`` the join has that many
    in place of the session's.  Adaptive execution does not split a hot molecule there, so its
    spectra are dealt over :data:`COPIES` tasks by ``ordinal``.
    """
    properties = molecules.select(
        "smile", structure_key(F.col("inchikey")).alias("structure_key"), *columns
    )
    if not tasks:
        return spectra.join(properties, "smile", "left")
    every = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    properties = properties.withColumn("_copy", every).repartition(tasks, "smile", "_copy")
    copy = F.pmod(F.xxhash64("ordinal"), F.lit(COPIES)).cast("int")
    joined = spectra.withColumn("_copy", copy).join(properties, ["smile", "_copy"], "left")
    return joined.drop("_copy")


def with_library_key(library: DataFrame, ion_mode: Column | str) -> DataFrame:
    """``precursor_mz`` and ``mass_key`` from ``exact_mass``.  A molecule without a mass
    keeps a null key, which never matches."""
    mz = adduct_mz(F.col("exact_mass"), ion_mode)
    return library.withColumns(
        {"precursor_mz": F.round(mz, 3), "mass_key": rounded_mass_key(mz)}
    )


def with_structure_mass_key(queries: DataFrame, ion_mode: Column | str) -> DataFrame:
    """Key of annotated queries: the rounded m/z of their known structure."""
    mz = adduct_mz(F.col("exact_mass"), ion_mode)
    return queries.withColumn("mass_key", rounded_mass_key(mz))


def with_measured_mass_key(queries: DataFrame, mode: str = "truncate") -> DataFrame:
    """Key of unannotated queries: their measured precursor, cut after three decimals.

    ``mode="round"`` rounds like the library does, which keeps matches whose fourth decimal
    is five or more.
    """
    if mode not in ("truncate", "round"):
        raise ValueError(f"unknown mode {mode!r}")
    key = truncated_mass_key if mode == "truncate" else rounded_mass_key
    return queries.withColumn("mass_key", key(F.col("precursor")))
