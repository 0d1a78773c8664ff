"""Connected components of a table of links, by contraction.

Each round every node moves to its neighbour with the smallest hash (or stays), twice over,
and links are renamed; nodes thin out by a constant factor, as hashes leave no long
descending chains. All of it is joins and pre-aggregated minima, so a hub with most of the nodes
does no harm; nothing comes to the driver but whether links are left. A round's links are staged
and its moves cached: what a lost executor held of them is computed again from the links.
"""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from barkeep.scratch import stage


def components(links, left="a", right="b"):
    """(node, root) of every node that has a link; links of a node to itself count for nothing."""
    links = stage(
        links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct(), "links"
    )
    held, moves = [], []

    def hold(df):
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("hash"), F.col(c).alias("id"))
        near = both.groupBy("a").agg(F.min(order("b")).alias("near"))
        step = hold(
            near.select(F.col("a").alias("node"), F.least(order("a"), F.col("near"))["id"].alias("next"))
        )
        onward = step.select(F.col("node").alias("next"), F.col("next").alias("root"))
        move = hold(step.join(onward, "next").select("node", "root"))
        moves.append(move)
        for end in ("a", "b"):
            links = (
                links.join(move, links[end] == move["node"]).withColumn(end, F.col("root")).select("a", "b")
            )
        links = stage(links.where("a <> b").distinct(), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0]
    for move in moves[1:]:
        onward = move.select(F.col("node").alias("root"), F.col("root").alias("onward"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("onward", "root").alias("root"))
    found = stage(found, "roots")
    for df in held:
        df.unpersist()
    return found
