"""Connected components over links between longs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step. Every (u, v) has u > v.

    Large: each node links its larger neighbours to its smallest neighbour. Small: each node links its smaller
    neighbours, and itself, to the smallest of them. The smallest neighbour comes from a partial aggregate and goes
    back by a join, so that a hub's neighbours are never gathered in one row or one window.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.where("u != v").distinct()


def contract(links: DataFrame) -> DataFrame:
    """A small star without a join, for links (u, v), u > v, in which each node has a bounded number of smaller neighbours.

    Posting lists give a node one smaller neighbour for each list that holds it, often another one; those are few nodes in
    all, so linking them to each other leaves little more than a link for each node.
    """
    near = links.groupBy("u").agg(F.sort_array(F.collect_set("v")).alias("vs"))
    ends = near.select(F.get("vs", F.lit(0)).alias("m"), F.explode(F.concat(F.array("u"), F.expr("slice(vs, 2, greatest(size(vs), 1))"))).alias("u"))
    return ends.select("u", F.col("m").alias("v")).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (u long, v long), in any direction -> (node long, root long) of each linked node, root the smallest of its component.

    Nodes without links don't appear; a link of a node to itself says nothing; no links give no rows. Rounds go on
    until a round changes nothing, each written to the checkpoint folder. Of a node's links to smaller nodes, which ``contract``
    gathers first, the callers give a bounded number.
    """
    now = checkpointed(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = checkpointed(contract(now))
    seen = None
    for _ in range(MAX_ROUNDS):
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()
        if sign == seen or not sign["n"]:
            roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = sign
        now = checkpointed(_star(_star(now, True), False))
    raise RuntimeError("components: the rounds did not settle")
