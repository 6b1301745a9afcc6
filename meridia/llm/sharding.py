"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

Each shard draws for each id an exponential time, by hash, at a rate of its weight; a rack's draw is the least of its
shards' draws and a region's the least of its racks', so that a node wins at a rate of the weight below it. An id
descends: the region with the least draw, in it the rack, in that the shard. A draw depends on the id and the shard
alone. So adding a shard, or raising its weight, can only lower the draws on its own path: rows move into that shard
and nowhere else, and a subtree whose weights stay keeps its rows. The shard that a descent ends at is the one of the least
draw of all, as of a flat draw over all shards; draws of their own at each level would let rows move within a region.

Scale. A row's shard is an expression on its id. Slots come from counts of (shard, bucket) and a row number within
such a bucket; no task orders a whole shard, and texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.llm.common import shuffle_partitions, table, utf8

SHARDS = 16
SHARDS_PER_RACK, RACKS_PER_REGION = 2, 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, weights: dict[int, float] | None = None) -> list[Leaf]:
    """Shard k's place depends on k alone, so one more shard leaves the others where they are."""
    return [Leaf(k // SHARDS_PER_RACK // RACKS_PER_REGION, k // SHARDS_PER_RACK, k, (weights or {}).get(k, 1.0)) for k in range(shards)]


def draw(key: Column, leaf: Leaf) -> Column:
    """An exponential time at the leaf's rate, from 53 bits of the hash of key and shard."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(leaf.shard)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(leaf.weight)


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard that an id comes to, level by level. Leaves of weight zero or less take nothing."""
    leaves = [x for x in leaves if x.weight > 0]
    if not leaves:
        raise ValueError("a tree needs a shard of positive weight")

    def winner(nodes: list[Column]) -> Column:
        return F.array_min(F.array(*nodes))

    def least(of: list[Leaf]) -> Column:
        return winner([draw(key, x) for x in of])

    def pick(choices: list[tuple[Column, Column]]) -> Column:
        """The second of the pair with the least first; the earlier one if equal."""
        return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(k).alias("k"), v.alias("v")) for k, (d, v) in enumerate(choices)]))["v"]

    def descend(of: list[Leaf], level: int) -> Column:
        name = ("region", "rack", "shard")[level]
        groups: dict[int, list[Leaf]] = {}
        for x in of:
            groups.setdefault(getattr(x, name), []).append(x)
        if level == 2:
            return pick([(draw(key, g[0]), F.lit(g[0].shard)) for g in groups.values()])
        if len(groups) == 1:
            return descend(of, level + 1)
        number = pick([(least(g), F.lit(k)) for k, g in groups.items()])
        chosen = F.when(F.lit(False), F.lit(None).cast("int"))
        for k, g in groups.items():
            chosen = chosen.when(number == k, descend(g, level + 1))
        return chosen

    return descend(leaves, 0)


def shard(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id long, size long, text_crc32 long, shard int, slot long, grown_shard int): a row for each row of ``docs``.

    The id alone decides the shard: rows with one id, and all rows with a null id, share a shard. Null text: size 1,
    CRC 0, as an empty one. Slots of a shard count from 0 without gaps; equal rows take slots of their own. No rows
    give no rows. ``grown``: the tree after a change, for ``grown_shard``; null without.
    """
    buckets = 8 * shuffle_partitions(docs.sparkSession)
    key = F.col(f"`{id_col}`").cast("long")
    bucket = F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(buckets)).cast("int")
    placed = docs.select(key.alias("id"), bucket.alias("bucket"), place(key, leaves).alias("shard"), (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"), F.octet_length(utf8(text_col)).cast("long").alias("bytes"), F.crc32(utf8(text_col)).alias("text_crc32"))
    counts = docs.select(bucket.alias("bucket"), place(key, leaves).alias("shard")).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    firsts = counts.withColumn("first", F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)))
    within = placed.withColumn("k", F.row_number().over(W.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "bytes")) - 1)
    done = within.join(firsts.drop("n"), ["shard", "bucket"])
    return done.select("id", (F.col("bytes") + 1).alias("size"), "text_crc32", "shard", (F.coalesce("first", F.lit(0)) + F.col("k")).cast("long").alias("slot"), "grown_shard")


def op4_hash_tree(spark, sf_dir: str) -> DataFrame:
    """Contract of op4 by the law ``key``, over all of ``documents``."""
    done = shard(table(spark, sf_dir, "documents"), tree(SHARDS), tree(SHARDS + 1))
    return done.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
