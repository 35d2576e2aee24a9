"""Connected components of an edge table, by alternating star contraction.

Large and small stars in turn: every node's larger (then smaller) neighbours are
linked to the smallest node it knows.  Each step is a minimum per node, combined
in each task first, and a join back; no node's neighbours are ever gathered in
one place, so a hub of any size is safe.  The number of rounds grows with the
logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (a, b) with a > b."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.struct("a").alias("node"), F.least("a", "m").alias("m")
    )
    # Large: larger neighbours to the smallest.  Small: all smaller neighbours,
    # and the node itself.
    # The struct is another key than the one that was grouped by, so both sides
    # are shuffled and Spark can split what a hub makes of the left one.
    joined = both.join(least, F.struct("a") == F.col("node"))
    if large:
        linked = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("node.a", F.col("m").alias("b"))
        )
    return linked.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b) edges that are not their own root.

    The root is the smallest node of the component.  Nodes of any type that can
    be ordered; self-loops and repeated edges do no harm.
    """
    current = stored(
        edges.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()
    )
    state = None
    while True:
        following = stored(_star(_star(current, large=True), large=False))
        # Equal sets of rows have an equal count and sums.
        new = following.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if new == state or not new[0]:
            return following.select(F.col("a").alias("node"), F.col("b").alias("root"))
        current, state = following, new
