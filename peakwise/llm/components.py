"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round replaces the links of a node by links to the smallest node around it.  Nodes of any
degree are reduced by partial aggregates, and the hub side of the join back is split by
adaptive execution because the aggregate is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.session import shared_path
from peakwise.sources.tables import write_table


def _written(df: DataFrame, label: str) -> DataFrame:
    return write_table(df, shared_path(df.sparkSession, label))


def _state(links: DataFrame) -> tuple:
    """Two links tables with the same state hold the same links."""
    digest = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    joined = both.join(_written(least, "large-star"), "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(_written(least, "small-star"), "a")
    down = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.unionByName(joined.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a BIGINT, b BIGINT)`` that is not the
    smallest of its component; ``component`` is that smallest node.

    Links may repeat, point either way or join a node to itself; links with a null end say
    nothing.  Without links the result is empty.  The number of rounds grows with the
    logarithm of the longest chain.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = _written(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        links = _written(_large_star(links), "links")
        links = _written(_small_star(links), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
