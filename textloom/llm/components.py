"""Connected components of links between numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.joins import BROADCAST_ROWS, lookup_join
from textloom.session import stored


def _lowest(pairs: DataFrame) -> DataFrame:
    """``(u, v, low)``: with each pair the lowest of ``u`` and all its partners.

    The minimum is combined before the shuffle; the join of a hot ``u`` can be split by Spark.
    """
    low = pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return pairs.join(low, "u")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its lowest node.

    Each round hangs all partners of a node on the lowest of them, first the higher partners,
    then the lower ones, until nothing moves; rounds grow with the logarithm of the longest
    chain. Every round is written to the shared folder, so lineage stays short and a lost
    executor costs no earlier round. Links with NULL or with both ends equal say nothing.
    """
    pairs = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                pairs.select("v", "v").distinct()
            )
        before = mark
        both = pairs.union(pairs.select("v", "u"))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        near = _lowest(large)
        small = near.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        pairs = stored(small.union(near.select("u", F.col("low").alias("v"))).distinct(), "links")


def lowest_reachable(rows: DataFrame, component: str, low: str, key: str, out: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``out``, the lowest ``low`` of all rows with one ``component``; its own where that is NULL.

    ``rows`` are stored. Only components count, so rows without links never meet. Up to ``limit``
    components are broadcast; beyond it a component with very many rows is dealt over copies of
    its result by a hash of ``key``, so no task takes it whole.
    """
    alone = rows.where(F.col(component).isNull()).withColumn(out, F.col(low))
    linked = rows.where(F.col(component).isNotNull())
    lowest = stored(linked.groupBy(component).agg(F.min(low).alias(out)), "lowest")
    small = limit > 0 and lowest.count() <= limit
    return alone.unionByName(lookup_join(linked, lowest, component, [key], "inner", small))
