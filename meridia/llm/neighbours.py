"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the least distance. Each of ``TABLES`` tables has some
Gaussian projections, cut into cells of width ``WIDTH``; the cells of a vector are its bucket. A query visits its own
bucket and buckets with one or more cells moved to a neighbour, in order of the estimated chance of success: the sum of
the squared distances from this query to the borders that a move crosses. What all tables give is merged and ranked by
exact cosine on the original vectors.

How many projections a table has follows from the number of rows, and how many buckets are visited is fitted on
``SAMPLE`` vectors, which are held against all rows, so that their neighbours are found at a recall of ``RECALL``; every row
is indexed. A query that finds fewer than it should is held against all rows, in blocks.

Scale. Equal vectors are one entry with its ``k`` + 1 smallest ids, however many rows have them; ids are cut to that in
each input partition before they are shuffled. Which moves may be among a query's first comes from one template of expected
distances, ``SPARE`` times as long; its own distances put them in order. So a query's buckets are a product of matrices and
are made again where they are looked up: only its vector is sent, once to each group of buckets that it visits. A group has entries of one table. A bucket of over
``GROUP`` entries is cut into pieces; these buckets, one in ``GROUP`` entries at most, are known to all tasks. A task holds
the entries of one group and reads its queries in batches.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, shuffle_partitions, table

TABLES = 8
WIDTH = 2.0
SEED = 6
SAMPLE = 200
RECALL = 0.93
ROWS_PER_BUCKET = 20
MOST_PROBES = 4096
SPARE = 4
#: Entries of a group of buckets, and of a piece of a bucket, on average; groups of a table at least.
GROUP = 8192
LEAST_GROUPS = 4
#: Queries of a group that are looked up together.
ASKED = 128
K = 5
EVERY = 50


class Hashes:
    """The tables' projections for vectors of one dimension."""

    def __init__(self, dim: int, projections: int):
        rng = np.random.Generator(np.random.PCG64([SEED, dim, projections]))
        self.a = rng.standard_normal((TABLES, dim, projections))
        self.b = rng.uniform(0, WIDTH, (TABLES, projections))
        self.mix = rng.integers(1, 1 << 62, (TABLES, projections), dtype=np.int64) | 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """(tables, vectors, projections): places in units of cells."""
        return (np.einsum("nd,tdp->tnp", x, self.a) + self.b[:, None, :]) / WIDTH

    def keys(self, cells: np.ndarray, t: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mix[t]).sum(axis=-1) * np.int64(2 * TABLES + 1) + t

    def probes(self, places: np.ndarray, t: int, n: int) -> np.ndarray:
        """(vectors, n or fewer): keys of each vector's first buckets in table t, its own first."""
        cells = np.floor(places)
        low = places - cells
        borders = np.concatenate([low, 1 - low], axis=1)
        order = np.argsort(borders, axis=1, kind="stable")
        step = self.mix[t] * np.int64(2 * TABLES + 1)
        moves = np.take_along_axis(np.broadcast_to(np.concatenate([-step, step]), borders.shape), order, axis=1)
        made = template(places.shape[1], SPARE * n)
        cost = np.take_along_axis(borders, order, axis=1) ** 2 @ made.T
        first = np.argsort(cost, axis=1, kind="stable")[:, :n]
        with np.errstate(over="ignore"):
            return self.keys(cells, t)[:, None] + np.take_along_axis(moves @ made.T, first, axis=1)


@functools.lru_cache(maxsize=64)
def template(projections: int, n: int) -> np.ndarray:
    """(n or fewer, 2 * projections): which of a vector's borders, nearest first, a bucket crosses; by expected squared distance.

    Place j from the near end and place j from the far end are the two borders of one projection, which moves one way only.
    """
    m = projections
    near = [(j * (j + 1)) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost = near + [1 - j / (m + 1) + (j * (j + 1)) / (4 * (m + 1) * (m + 2)) for j in range(m, 0, -1)]
    out: list[tuple[int, ...]] = [()]
    heap: list[tuple[float, tuple[int, ...]]] = [(cost[0], (0,))]
    while heap and len(out) < n:
        c, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - j in chosen for j in chosen):
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (c + cost[last + 1], (*chosen, last + 1)))
    made = np.zeros((len(out), 2 * m), np.int64)
    for i, chosen in enumerate(out):
        made[i, list(chosen)] = 1
    return made


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(samples: list[tuple[np.ndarray, np.ndarray]], projections: int) -> tuple[int, int]:
    """(projections, visits): so many buckets of a table that vectors find their neighbours; ``samples`` are pairs of both, row by row.

    Where ``MOST_PROBES`` buckets don't, there are fewer projections, whose buckets are larger.
    """
    while samples:
        recall = [_recall(unit(x), unit(y), projections) for x, y in samples]
        enough = all(r[-1] >= RECALL for r in recall)
        if projections == 1 or enough:
            return projections, max(int(np.argmax(r >= RECALL)) + 1 if r[-1] >= RECALL else MOST_PROBES for r in recall)
        projections -= 1
    return projections, 1


def _recall(x: np.ndarray, y: np.ndarray, projections: int) -> np.ndarray:
    """The share of the ``y`` that their ``x`` finds with 1, 2, ... ``MOST_PROBES`` buckets."""
    hashes = Hashes(x.shape[1], projections)
    places, keyed = hashes.places(x), np.floor(hashes.places(y))
    first = np.full(len(x), MOST_PROBES)
    for t in range(TABLES):
        keys = hashes.keys(keyed[t], t)
        for at in range(0, len(x), ASKED):
            hit = hashes.probes(places[t][at : at + ASKED], t, MOST_PROBES) == keys[at : at + ASKED, None]
            first[at : at + ASKED] = np.minimum(first[at : at + ASKED], np.where(hit.any(axis=1), hit.argmax(axis=1), MOST_PROBES))
    return np.cumsum(np.bincount(first, minlength=MOST_PROBES + 1)[:MOST_PROBES]) / len(first)


def entries(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(key, dim, id, ids, vec): a row for each distinct usable vector; ids its k + 1 smallest, id the smallest."""
    vec = F.col(f"`{vec_col}`").cast("array<float>")
    usable = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    usable = usable.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = v.values.to_numpy(zero_copy_only=False).tobytes()
                ids = held.setdefault(b, [])
                ids.append(i)
                if len(ids) > 4 * (k + 1):
                    held[b] = sorted(ids)[: k + 1]
            if len(held) > 50_000:
                yield made(held)
                held = {}
        if held:
            yield made(held)

    def made(held: dict[bytes, list[int]]) -> pa.RecordBatch:
        ids = pa.array([sorted(i)[: k + 1] for i in held.values()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array([np.frombuffer(b, np.float32) for b in held], pa.list_(pa.float32()))], names=["ids", "vec"])

    cut = usable.mapInArrow(first_ids, "ids array<long>, vec array<float>").withColumn("key", F.xxhash64("vec")).withColumn("key2", F.xxhash64("vec", F.lit(1)))
    ids = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1)
    one = cut.groupBy("key", "key2").agg(ids.alias("ids"), F.first("vec").alias("vec"))
    return one.select("key", F.size("vec").alias("dim"), F.get("ids", F.lit(0)).alias("id"), "ids", "vec")


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    return t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries``, its ``k`` nearest in ``vectors`` but itself.

    ``queries`` are rows of ``vectors``. Null ids, and vectors that are null, empty, zero or hold a null or non-finite
    component, take no part. Vectors of another dimension than the query's are no candidates. Ties go to the smaller id.
    Repeated ids: a query's own id is no candidate, however often it stands; another id may stand as often as its
    rows with different vectors. No usable rows give no rows. Fewer than ``k`` others: all of them.
    """
    parts = shuffle_partitions(vectors.sparkSession)
    base = checkpointed(entries(vectors, id_col, vec_col, k))
    total = base.count()
    projections, visits = 1, 1  # until they are fitted
    each = max(LEAST_GROUPS, -(-total // GROUP))  # groups of a table

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Hashes, np.ndarray]]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for dim in set(t["dim"].to_pylist()):
                own = t.filter(pa.compute.equal(t["dim"], dim))
                hashes = Hashes(dim, projections)
                yield own, hashes, hashes.places(unit(_matrix(own, dim)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, hashes, places in placed(batches):
            for n in range(TABLES):
                key = pa.array(hashes.keys(np.floor(places[n]), n))
                yield from own.select(["id", "ids", "vec"]).append_column("bucket", key).append_column("t", pa.array(np.full(len(key), n, np.int32))).to_batches()

    def pieces(key: np.ndarray) -> np.ndarray:
        """Into how many pieces the buckets are cut."""
        if not len(large_key):
            return np.ones(len(key), np.int64)
        at = np.minimum(np.searchsorted(large_key, key), len(large_key) - 1)
        return np.where(large_key[at] == key, large_pieces[at], 1)

    def group_of(key: np.ndarray, t: np.ndarray | int, piece: np.ndarray | int) -> np.ndarray:
        return (t + TABLES * (((key ^ (key >> 29)) % 1_000_003 + piece) % each)).astype(np.int32)

    large_key, large_pieces = np.empty(0, np.int64), np.empty(0, np.int64)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, t, own = (batch.column(n).to_numpy() for n in ("bucket", "t", "id"))
            g = group_of(key, t, (own ^ (own >> 7)) % pieces(key))
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.zeros(len(g), np.int32)), *(batch.column(n) for n in ("id", "bucket", "ids", "vec"))], names=names)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, hashes, places in placed(batches):
            for n in range(TABLES):
                for at in range(0, own.num_rows, ASKED):
                    keys = hashes.probes(places[n][at : at + ASKED], n, visits)
                    seen = np.zeros((len(keys), each), bool)
                    row = np.repeat(np.arange(len(keys)), keys.shape[1])
                    cut = pieces(keys.ravel())
                    seen[row, group_of(keys.ravel(), 0, 0) // TABLES] = True
                    for i in np.nonzero(cut > 1)[0]:
                        seen[row[i], group_of(keys.ravel()[i], 0, np.arange(cut[i])) // TABLES] = True
                    q, g = np.nonzero(seen)
                    sent = own.slice(at, ASKED).take(pa.array(q)).select(["id", "vec"]).combine_chunks()
                    none = pa.array(np.zeros(len(q), np.int64))
                    yield from pa.table([pa.array((n + TABLES * g).astype(np.int32)), pa.array(np.ones(len(q), np.int32)), sent["id"], none, pa.array([[]] * len(q), pa.list_(pa.int64())), sent["vec"]], names=names).to_batches()

    names = ["g", "side", "id", "bucket", "ids", "vec"]
    row_schema = "g int, side int, id long, bucket long, ids array<long>, vec array<float>"
    out_schema = "q long, id long, ids array<long>, score double"

    def look_up(held: pa.Table, asked: pa.Table, t: int | None) -> Iterator[pa.RecordBatch]:
        """The k + 1 best of each query in ``asked``, by exact cosine, ties to the smaller id, of those ``held`` rows that it visits; of all, if t is None."""
        lens, ask_lens = (pa.compute.list_value_length(x["vec"]).to_numpy() for x in (held, asked))
        for dim in np.intersect1d(lens, ask_lens).tolist():
            own = held.take(pa.array(np.nonzero(lens == dim)[0]))
            own = own.take(pa.array(np.argsort(own["bucket"].to_numpy(), kind="stable")))
            some = asked.take(pa.array(np.nonzero(ask_lens == dim)[0]))
            x, y, ids, q_ids = _matrix(own, dim), _matrix(some, dim), own["id"].to_numpy(), some["id"].to_numpy()
            x_norm, y_norm = (np.sqrt((v * v).sum(axis=1)) for v in (x, y))
            bucket, of = np.unique(own["bucket"].to_numpy(), return_inverse=True)
            hashes = Hashes(dim, projections)
            places = hashes.places(unit(y))[t] if t is not None else None
            near = np.argsort(hashes.keys(np.floor(places), t), kind="stable") if t is not None else np.arange(len(y))
            for at in range(0, len(near), ASKED):  # queries of a bucket together: they visit much the same
                q = near[at : at + ASKED]
                visited = np.ones((len(q), len(bucket)), bool)
                if t is not None:
                    keys = hashes.probes(places[q], t, visits)
                    spot = np.minimum(np.searchsorted(bucket, keys), len(bucket) - 1)
                    hit = bucket[spot] == keys
                    visited[:] = False
                    visited[np.nonzero(hit)[0], spot[hit]] = True
                rows = np.nonzero(visited.any(axis=0)[of])[0]
                if not len(rows):
                    continue
                rough = (y[q] @ x[rows].T) / x_norm[rows] / y_norm[q][:, None]
                rough[~visited[:, of[rows]]] = -np.inf
                edge = np.partition(rough, len(rows) - k - 1, axis=1)[:, len(rows) - k - 1] if len(rows) > k + 1 else np.full(len(q), -np.inf)
                i, j = np.nonzero((rough >= edge[:, None] - 1e-9) & (rough > -np.inf))
                i, j = q[i], rows[j]
                score = (x[j] * y[i]).sum(axis=1) / (x_norm[j] * y_norm[i])
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                heads = np.nonzero(np.append(True, i[1:] != i[:-1]))[0]
                best = np.arange(len(i)) - np.repeat(heads, np.diff(np.append(heads, len(i)))) <= k
                got = own.take(pa.array(j[best]))
                yield from pa.table([pa.array(q_ids[i[best]]), got["id"], got["ids"], pa.array(score[best])], names=["q", "id", "ids", "score"]).combine_chunks().to_batches()

    def rank(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come by group, in each its entries before its queries."""
            now, held = None, []
            for batch in batches:
                t = pa.Table.from_batches([batch])
                g = t["g"].to_numpy()
                starts = np.append(0, np.nonzero(np.diff(g))[0] + 1) if len(g) else np.empty(0, np.int64)
                for at, end in zip(starts, np.append(starts[1:], len(g))):
                    part = t.slice(at, end - at)
                    if g[at] != now:
                        now, held = g[at], []
                    first = int((part["side"].to_numpy() == 0).sum())
                    if first:
                        held.append(part.slice(0, first))
                    if first < part.num_rows and held:
                        held = [pa.concat_tables(held).combine_chunks()]
                        yield from look_up(held[0], part.slice(first), None if whole else int(now) % TABLES)

        return run

    def ranked(rows: DataFrame, whole: bool) -> DataFrame:
        return rows.repartition(parts, "g").sortWithinPartitions("g", "side", "id").mapInArrow(rank(whole), out_schema)

    everywhere = F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("g")
    none = F.array().cast("array<long>").alias("ids")
    blocks = base.select(F.pmod(F.xxhash64("id"), F.lit(each)).cast("int").alias("g"), F.lit(0).alias("side"), "id", F.lit(0).cast("long").alias("bucket"), "ids", "vec")

    def in_all(few: DataFrame) -> DataFrame:
        """What entries (id, vec) find among all rows, in blocks: their k + 1 best of each."""
        return ranked(blocks.unionByName(few.select(everywhere, F.lit(1).alias("side"), "id", F.lit(0).cast("long").alias("bucket"), none, "vec")), True)

    sample = checkpointed(base.orderBy(F.xxhash64("key")).limit(SAMPLE))
    near = in_all(sample).where("q != id").withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k)
    pairs = near.join(sample.select(F.col("id").alias("q"), "dim", F.col("vec").alias("x")), "q").join(base.select("id", F.col("vec").alias("y")), "id").select("dim", "x", "y").collect()  # k of each
    dims: dict[int, list] = {}
    for r in pairs:
        dims.setdefault(r["dim"], []).append((r["x"], r["y"]))
    wanted_projections = max(2, int(np.ceil(np.log(max(2.0, total / ROWS_PER_BUCKET)) / np.log(2.2))))
    projections, visits = fit([tuple(np.array(side, np.float64) for side in zip(*v)) for v in dims.values()], wanted_projections)

    posted = base.select("dim", "id", "ids", "vec").mapInArrow(post, "id long, ids array<long>, vec array<float>, bucket long, t int")
    large = sorted((r["bucket"], -(-r["n"] // GROUP)) for r in posted.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).collect())
    large_key, large_pieces = np.array([r[0] for r in large], np.int64), np.array([r[1] for r in large], np.int64)

    asked = queries.select(F.col(f"`{id_col}`").cast("long").alias("query_id"), F.xxhash64(F.col(f"`{vec_col}`").cast("array<float>")).alias("key"), F.xxhash64(F.col(f"`{vec_col}`").cast("array<float>"), F.lit(1)).alias("key2")).distinct()
    keyed = base.withColumn("key2", F.xxhash64("vec", F.lit(1)))
    asked = checkpointed(asked.join(keyed.select("key", "key2", F.col("id").alias("q")), ["key", "key2"]).select("query_id", "q"))
    wanted = base.join(asked.select(F.col("q").alias("id")).distinct(), "id", "left_semi")
    probes = wanted.select("dim", "id", "vec").repartition(parts, "id").mapInArrow(probe, row_schema)
    found = checkpointed(ranked(posted.mapInArrow(grouped, row_schema).unionByName(probes), False).distinct())

    def nearest(found: DataFrame) -> DataFrame:
        classes = found.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
        each = asked.join(classes, "q").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
        ranked = each.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    done = checkpointed(nearest(found))
    short = checkpointed(asked.join(done.where(F.col("rank") == k).select("query_id"), "query_id", "left_anti"))
    if not short.limit(1).count():
        return done
    again = base.join(short.select(F.col("q").alias("id")).distinct(), "id", "left_semi")  # the rest
    whole = nearest(in_all(again)).join(short.select("query_id"), "query_id", "left_semi")
    return done.join(short.select("query_id"), "query_id", "left_anti").unionByName(whole)


def op6_multiprobe(spark, sf_dir: str) -> DataFrame:
    """Contract of op6 over all of ``embeddings``; queries are the rows whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
