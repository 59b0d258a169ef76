"""Vector and fingerprint similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when either is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared over combined on-bits; null when a fingerprint is missing or both are empty."""
    return F.try_divide(
        F.size(F.array_intersect(a, b)).cast("double"),
        F.size(F.array_union(a, b)).cast("double"),
    )


def tanimoto_packed(a: Column, b: Column) -> Column:
    """:func:`tanimoto` for fingerprints packed into an array of BIGINT words."""

    def ones(words: Column) -> Column:
        return F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))

    return F.try_divide(
        ones(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))).cast("double"),
        ones(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))).cast("double"),
    )


def same_structure(similarity: Column, threshold: float = 0.95) -> Column:
    """True where a fingerprint similarity counts as the correct structure."""
    return F.coalesce(similarity >= F.lit(threshold), F.lit(False))
