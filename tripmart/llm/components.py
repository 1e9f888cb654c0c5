"""Connected components of a link table by alternating large and small stars.

Every round is a few joins and grouped minima over the links, so no node, link
or component is ever held by the driver or by one task.  Hub nodes are only
reached through joins, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the least node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("hub"), F.least("a", "m").alias("m"))
    return (
        both.join(least, both.a == least.hub)
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of them (links run from a down to b)."""
    least = links.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    moved = links.join(least, links.a == least.hub).where(F.col("b") != F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("hub", "m")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node reachable.

    Self links are ignored; no links give an empty table.  The rounds stop when
    a round changes no link, which the driver sees from three numbers.
    """
    current = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        row = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if tuple(row) == state or row[0] == 0:
            break
        state = tuple(row)
        current = staged(_small_star(_large_star(current)), "links")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
