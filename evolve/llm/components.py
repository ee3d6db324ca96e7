"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evolve.storage import stored

ROWS_PER_FILE = 250_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node that has an edge.

    Alternates two steps until every node hangs on its root, each a minimum per node (combined before
    the shuffle) and a join whose shuffle can be split at hot nodes. First every larger
    neighbour of a node is tied to the node's smallest neighbour, then every smaller one.
    The number of rounds grows with the logarithm of the longest path. Every round is
    written to the shared checkpoint folder; only a count and a flag come to the driver.
    """
    # Edges always run from the larger node to the smaller.
    now = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct()
    )
    rows = now.count()
    while rows and not _settled(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = _written(large, rows)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        now = _written(small, rows)
        rows = now.count()
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _written(edges: DataFrame, rows: int) -> DataFrame:
    """Stored, in few files while there are few edges; a round does not make more of them."""
    return stored(edges.coalesce(max(4, 2 * rows // ROWS_PER_FILE)))


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root hangs on anything."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).union(edges.select("v", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return per_node.where("ups > 1 or ups > 0 and downs > 0").isEmpty()
