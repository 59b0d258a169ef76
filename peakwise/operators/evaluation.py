"""Retrieval accuracy from ranked candidates with a ``tanimoto`` to the true structure.

``by`` names columns that results are kept apart by, such as the model of an evaluation of
several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.functions.similarity import same_structure, tanimoto

# Ranks that count, the bucket of queries with candidates but no hit, and the
# Tanimoto similarity of a match.
MAX_RANK = 5
MISS = 11
MATCH_THRESHOLD = 0.95


def with_tanimoto(ranked: DataFrame) -> DataFrame:
    """Similarity of ``ground_fp`` and ``fp_bits`` for ranked candidates only."""
    return ranked.withColumn("tanimoto", tanimoto(F.col("ground_fp"), F.col("fp_bits"))).drop(
        "ground_fp", "fp_bits"
    )


def first_hit_rank(
    ranked: DataFrame, threshold: float = MATCH_THRESHOLD, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per query with candidates: the smallest rank up to five that is a structure match."""
    hit = same_structure(F.col("tanimoto"), threshold) & (F.col("rank") <= MAX_RANK)
    return ranked.groupBy(*by, "spectrum_id").agg(
        F.min(F.when(hit, F.col("rank"))).alias("hit_rank"),
        F.max("n_candidates").alias("n_candidates"),
    )


def with_bucket(hits: DataFrame) -> DataFrame:
    return hits.withColumn("bucket", F.coalesce(F.col("hit_rank"), F.lit(MISS)))


def hit_histogram(hits: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Queries and candidate-set sizes per bucket: ranks 1 to 5, misses in 11."""
    return (
        with_bucket(hits)
        .groupBy(*by, "bucket")
        .agg(
            F.count(F.lit(1)).alias("n_queries"),
            F.sum("n_candidates").alias("sum_candidates"),
            F.min("n_candidates").alias("min_candidates"),
            F.max("n_candidates").alias("max_candidates"),
        )
    )


def topk_accuracy(
    queries: DataFrame, hits: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """``(rank, hits, pct, cumulative_pct)`` for ranks 1 to 5 over all queries.

    Queries without a candidate only count in the denominator.
    """
    ranks = range(1, MAX_RANK + 1)
    totals = (
        queries.select(*by, "spectrum_id")
        .join(hits.select(*by, "spectrum_id", "hit_rank"), [*by, "spectrum_id"], "left")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col("hit_rank") == r).alias(f"h{r}") for r in ranks],
        )
    )

    def row(r: int):
        hit = F.col(f"h{r}")
        up_to = sum((F.col(f"h{k}") for k in range(2, r + 1)), F.col("h1"))
        return F.struct(
            F.lit(r).alias("rank"),
            hit.alias("hits"),
            F.try_divide(hit * 100.0, F.col("n")).alias("pct"),
            F.try_divide(up_to * 100.0, F.col("n")).alias("cumulative_pct"),
        )

    return totals.select(*by, F.inline(F.array(*[row(r) for r in ranks])))


def hit_detail(ranked: DataFrame, hits: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The candidate each query is judged by: the hit, or rank 1 of a miss.

    ``inchikey`` and ``precursor_mz`` are kept for hits at rank 1 only.
    """
    chosen = with_bucket(hits).select(
        *by,
        "spectrum_id",
        "bucket",
        F.coalesce(F.col("hit_rank"), F.lit(1)).alias("rank"),
    )
    first = F.col("bucket") == 1
    return ranked.join(chosen, [*by, "spectrum_id", "rank"]).select(
        *by,
        "spectrum_id",
        "bucket",
        "smile",
        "tanimoto",
        "cosine",
        "n_candidates",
        F.when(first, F.col("inchikey")).alias("inchikey"),
        F.when(first, F.col("precursor_mz")).alias("precursor_mz"),
    )
