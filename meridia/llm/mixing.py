"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets come from weights, capped at ``MAX_EPOCHS`` times a source's size. Each source's documents stand in an order of
their own, by hash, cut into ``BLOCKS`` blocks; a source gives whole passes over all its blocks and a last pass over the
first blocks of its order, as far as its target goes. That makes an exact quota of blocks for each source. A binary
tree over the output shards splits the quotas: at each node, one draw from the multivariate hypergeometric law says how
many blocks of each source go left. A shard then draws that many blocks from the source's permuted order, disjoint from
all other shards', and shuffles its rows locally.

Scale. Sizes are summed by (source, block) with map-side combining; prefix sums run over at most ``BLOCKS`` rows of a
source. Only the one block in which a source's target ends is looked at row by row. The tree works on a row for each
source. The text is read once to be counted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, shuffle_partitions, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCKS = 1024
SEED = 8
OUT_SHARDS = 16
#: Hexadecimal digits of the hash that order a source's documents.
DIGITS = 15


#: Joined by broadcast up to so many rows, by shuffle beyond.
BROADCAST_ROWS = 100_000


def _size(text_col: str) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _at(key: Column) -> Column:
    """The place of an id in its source's order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, DIGITS), 16, 10).cast("long")


def _block(at: Column) -> Column:
    return F.floor(at / F.lit(16**DIGITS // BLOCKS)).cast("int")


def _small(rows: DataFrame) -> DataFrame:
    rows = checkpointed(rows)
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, at, block): words, and the place of each row in its source's order."""
    key = F.col(f"`{id_col}`").cast("long")
    return docs.select(key.alias("id"), F.col(f"`{source_col}`").alias("source"), _size(text_col).alias("size"), _at(key).alias("at")).withColumn("block", _block(F.col("at")))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) -> and weight, target. A row for each source; one small task orders them.

    Filling up: in order of cap over weight, a source is capped if what is left, shared by weight among those not yet
    capped, is at least its cap; the rest share what remains.
    """
    ranked = sources.withColumn("k", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("k") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.lit(float(MAX_EPOCHS)) * F.col("source_size"))
    up = W.orderBy(F.col("cap") / F.col("weight"), "k")
    before, after = up.rowsBetween(W.unboundedPreceding, -1), up.rowsBetween(0, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy("k")
    ranked = ranked.withColumn("all", F.lit(SHARE) * F.sum("source_size").over(whole))
    ranked = ranked.withColumn("left", F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(after))
    ranked = ranked.withColumn("capped", F.col("cap") <= F.col("left") * F.col("weight") / F.col("open"))
    free = F.col("all") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0.0))
    rest = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
    return ranked.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", free * F.col("weight") / rest))).select("source", "source_size", "weight", "target")


def take(rows: DataFrame) -> DataFrame:
    """``rows`` of ``sized`` -> with source_size, target, passes (how often a row is taken) and last (in the last pass).

    The last pass takes a source's rows in order while the middle of a row lies within what the whole passes leave of
    the target. Sizes decide alone: a source without words is not taken.
    """
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    order = W.partitionBy("source").orderBy("block")
    sums = blocks.withColumn("before", F.coalesce(F.sum("block_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    sources = blocks.groupBy("source").agg(F.sum("block_size").alias("source_size"))
    aims = targets(sources).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    aims = aims.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    named = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    plan = sums.withColumn("name", named).drop("source").join(aims.withColumn("name", named).drop("source"), "name")
    plan = plan.withColumn("cut", (F.col("before") < F.col("rest")) & (F.col("before") + F.col("block_size") > F.col("rest")))
    dealt = rows.withColumn("name", named).join(plan, ["name", "block"])
    clear = dealt.where(~F.col("cut")).withColumn("last", (F.col("size") > 0) & (F.col("before") + F.col("block_size") <= F.col("rest")) & (F.col("before") < F.col("rest")))
    within = W.partitionBy("name").orderBy("at", F.col("id").asc_nulls_first(), "size").rowsBetween(W.unboundedPreceding, -1)
    cut = dealt.where("cut").withColumn("upto", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    cut = cut.withColumn("last", (F.col("size") > 0) & (2 * F.col("upto") + F.col("size") <= 2 * F.col("rest"))).drop("upto")
    both = clear.unionByName(cut)
    return both.withColumn("passes", F.when(F.col("size") > 0, F.col("whole") + F.col("last").cast("int")).otherwise(0))


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source for each shard, (shards, sources): a tree of multivariate-hypergeometric draws.

    A node over some shards holds exact quotas; its left half gets a draw of as many blocks as its share of the shards
    says. Leaves add up to the quotas.
    """
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        n = int(have.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = np.zeros_like(have)
        todo, pool = n, int(have.sum())
        for k, c in enumerate(have.tolist()):  # marginals: a hypergeometric draw for each source
            pool -= c
            left[k] = rng.hypergeometric(c, pool, todo) if todo and c and pool else min(todo, c)
            todo -= int(left[k])
        split(lo, mid, left)
        split(mid, hi, have - left)

    if shards > 0:
        split(0, shards, np.asarray(quotas, np.int64))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, passes, taken): a row for each row of ``docs``.

    Null text: no words. Null source: a source of its own, last. Equal rows keep a row each; those of one id stand next
    to each other in their source's order. No rows give no rows. The same rows give the same mix in any order.
    """
    done = take(checkpointed(sized(docs, id_col, text_col, source_col)))
    return done.select("id", "source", "size", "source_size", "target", "passes", (F.col("passes") * F.col("size")).cast("long").alias("taken"), "block")


def deal(mixed: DataFrame, shards: int = OUT_SHARDS) -> DataFrame:
    """``mixed`` rows, repeated as taken -> with shard and order, the row's place in its shard's local shuffle.

    A block of a pass goes to one shard whole. The quotas, a row for each source, go through the splitting tree.
    """
    taken = mixed.where("passes > 0").withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    taken = taken.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    drawn = taken.select("name", "pass", "block").distinct()
    drawn = drawn.withColumn("k", F.row_number().over(W.partitionBy("name").orderBy(F.xxhash64("pass", "block", F.lit(SEED)), "pass", "block")))
    drawn = checkpointed(drawn)
    quotas = drawn.groupBy("name").agg(F.count("*").alias("n")).orderBy("name").collect()
    dealt = split_quotas(np.array([q["n"] for q in quotas], np.int64), shards)
    ends = np.cumsum(dealt, axis=0)
    rows = [(q["name"], s, int(ends[s][j] - dealt[s][j]), int(ends[s][j])) for j, q in enumerate(quotas) for s in range(shards) if dealt[s][j]]
    spans = mixed.sparkSession.createDataFrame(rows, "name string, shard int, first long, end long")
    placed = drawn.join(spans, "name").where("k > first AND k <= end").select("name", "pass", "block", "shard")
    return taken.join(placed, ["name", "pass", "block"]).withColumn("order", F.xxhash64("id", "pass", F.lit(SEED + 1)))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = OUT_SHARDS) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, by output shard, shuffled within it; all columns stay.

    A row is taken as often as in ``mix``. What is joined to the rows is a cut for each source and a shard for each
    (source, pass, block): at most ``BLOCKS`` times ``MAX_EPOCHS`` rows a source. Within the tie of one id and size, rows
    go together.
    """
    decided = checkpointed(mix(docs, id_col, text_col, source_col).withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))))
    places = deal(decided, shards).select("name", "pass", "block", "shard").distinct()
    whole = F.floor(F.col("target") / F.col("source_size")).cast("int")
    at = _at(F.col("id"))
    cuts = decided.where("size > 0").groupBy("name").agg(F.first(whole).alias("whole"), F.max(F.when(F.col("passes") > whole, F.struct(at.alias("at"), F.coalesce("id", F.lit(-(1 << 63))).alias("id"), F.col("size").alias("size")))).alias("cut"))
    key, source = F.col(f"`{id_col}`").cast("long"), F.col(f"`{source_col}`")
    size = _size(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("name"), F.struct(_at(key).alias("at"), F.coalesce(key, F.lit(-(1 << 63))).alias("id"), size.alias("size")).alias("here"))
    rows = rows.where("here.size > 0").join(_small(cuts), "name")
    rows = rows.withColumn("passes", F.col("whole") + F.coalesce((F.col("here") <= F.col("cut")).cast("int"), F.lit(0))).where("passes > 0")
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes")))).withColumn("block", _block(F.col("here.at")))
    rows = rows.join(_small(places), ["name", "pass", "block"]).withColumn("order", F.xxhash64("here.id", "pass", F.lit(SEED + 1)))
    parts = max(shards, shuffle_partitions(docs.sparkSession))
    return rows.repartition(parts, "shard", F.pmod("order", F.lit(max(1, parts // shards)))).sortWithinPartitions("shard", "order").select("row.*")


def dealt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = OUT_SHARDS) -> DataFrame:
    """Rows of ``mix``, with passes and taken counted from what the shards of ``deal`` draw; and draws, of each its shard and order."""
    row = F.monotonically_increasing_id().alias("row")
    mixed = checkpointed(mix(docs, id_col, text_col, source_col).select(row, "*"))
    drawn = deal(mixed, shards).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "order"))).alias("draws"))  # a row has at most MAX_EPOCHS
    counted = mixed.drop("passes", "taken").join(drawn, "row", "left").drop("row")
    none = F.array().cast("array<struct<pass:int,shard:int,order:bigint>>")
    return counted.withColumn("passes", F.when(F.col("draws").isNull(), 0).otherwise(F.size("draws"))).withColumn("taken", (F.col("passes") * F.col("size")).cast("long")).withColumn("draws", F.coalesce("draws", none))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract of op8 over all of ``documents``; taken is what the shards draw. The contract has no place for shard and order."""
    done = dealt(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "size", "source_size", F.col("target").cast("double").alias("target"), "taken")


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, {DIGITS}))::BIGINT AS pos FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight, {MAX_EPOCHS}e0 * source_size AS cap, {SHARE}e0 * sum(source_size) OVER () AS total FROM s),
o AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS rest,
    sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
c AS (SELECT *, cap <= rest * weight / open AS capped FROM o),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE least(cap,
    (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0e0)) * weight / sum(CASE WHEN NOT capped THEN weight END) OVER ()) END AS target FROM c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
r AS (
  SELECT doc_id, size, source_size, target, passes, target - passes * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY pos, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (passes + CASE WHEN 2 * upto + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
