"""Connected components of a graph of long ids, by alternating large and small
stars (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Every round is joins and minima on Spark; nothing is gathered on the driver but
two numbers a round.  A round's edges are written to the shared folder, so the
plan does not grow and the loss of an executor costs at most a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or else the others and itself) are
    linked to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.where("b > a") if large else both
    linked = out.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.union(least.select("a", F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the component is the
    smallest node that can be reached.  Ends when both stars change nothing."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    before = None
    while True:
        after = stored(_star(_star(now, True), False), "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        now, before = after, state
    nodes = after.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
