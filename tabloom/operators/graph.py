"""Connected components of a links table.

Nothing but a row count comes to the driver; the state of each round is written to the
shared folder, so that lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import delete, materialise


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node that each node of links (u, v) reaches: (node, root).

    Large-star and small-star rounds in turn until no link changes: every node hangs on
    the least of its neighbours, which halves paths, so that the number of rounds grows
    with the logarithm of the longest path. Both kinds of stars come from one grouping
    with a map-side minimum and one join; no neighbour list is ever held in memory.
    Joins are merges: tables that grow with the links never pass through the driver.
    Nodes may be of any ordered type; links of a node with itself, or with null, don't count.
    """
    edges = materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    state = _measure(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        # large star: larger neighbours go to the least neighbour (or the node itself)
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the least neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
        small = large.join(low.hint("merge"), "u").select(F.explode(ends).alias("e")).select("e.*")
        before, edges = edges, materialise(small.filter("u <> v").distinct(), "links")
        for path in before.inputFiles()[:1]:  # the round before is read no more
            delete(edges.sparkSession, path.rsplit("/", 1)[0])
        now = _measure(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _measure(edges: DataFrame) -> tuple:
    """Equal for two rounds only if nothing has changed (count and checksum of the links)."""
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)
