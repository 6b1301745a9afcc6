"""One row of each group of near-duplicates: SimHash candidates from positional bytes, verified by exact Jaccard similarity.

A row's shingles are a set of hashes. Its fingerprint has ``WORDS`` words of 64 bits, made of further hashes of each
shingle; that is ``8 * WORDS`` positional bytes. Rows are posted under ``GROUPS`` triples of positional bytes. What two
rows of one posting list share of all positional bytes is tallied; pairs below ``LEAST_SHARED`` are dropped (a pair of at
most ``8 * WORDS - LEAST_SHARED`` differing bits has that many for certain), as are pairs that differ in over
``DIFFERING`` of the bits or whose sets' sizes exclude the similarity. What is left is a candidate, and a candidate links
only if the Jaccard similarity of the two sets reaches ``SIMILARITY``. So no link is false; a link is missed if a pair
shares none of the triples, which at a similarity of 0.8 is a matter of chance (see the README for measured recall).

A list of many similar rows has a square of candidates. A unit of work (a list, or two blocks of a long one) therefore
proposes a spanning forest of its candidates, nearest first, and the distinct proposals are verified. Where all of them
hold, every candidate of the unit is connected. Groups of rows in which a proposal was refuted are settled in a second
round: the group's rows meet with their texts, in blocks, and the candidates that join different parts of what is verified
so far are verified in place, nearest first, until they are joined or none is left. Only links come out of it. The rows
of a group's largest part are connected already and do not meet each other again. So no candidate goes undecided.

Scale. Rows with equal sets are one entry. Entries stand in blocks, and a block sends each triple one compressed message on
all of them. Of a triple's lists (split by key where there are many entries) only those of two or more entries come back,
to each block one message on its own entries, with the lists' lengths; the block deals them with their fingerprints to
units, again in one message for many. So no join ever makes a row for an entry in a list, of which a large group of
near copies has up to ``GROUPS`` for each of its rows. Units hold at most two parts of a list (``simhash.BLOCK`` entries each). Candidates carry ids; texts, compressed, are joined to distinct proposals and to
the rows of refuted groups alone.
A key has 24 bits, so a list of unrelated rows has one in 2 ** 24.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.llm.blocks import answer, ask, narrow, pack, settled, unpack
from meridia.llm.common import checkpointed, shuffle_partitions, utf8
from meridia.llm.components import components
from meridia.llm.simhash import BLOCK, bit_counts, further, grouped_batches, shared_bytes, shingle_hashes

WIDTH = 5
SIMILARITY = (4, 5)
WORDS = 8
GROUPS = 288
#: The share of bits in which a pair may differ: a similarity of 0.8 turns 0.151 of them, give or take 0.016.
DIFFERING = 0.185
#: Pairs that differ in at most this share belong together nearly for certain; they are proposed without looking for the nearest.
CLOSE = 0.08
LEAST_SHARED = 7
#: Up to this size the candidates of a list are looked at together with those of other lists.
SMALL = 16
#: Entries whose keys under one triple stand in one task.
ENTRIES = 1 << 22
#: Sets that a task keeps while it verifies.
HELD = 64
SEED = 5
COLUMNS = [f"f{k}" for k in range(WORDS)]


def triples() -> np.ndarray:
    """(GROUPS, 3) distinct triples of the positional bytes, in which each byte stands about equally often."""
    rng, used, found = np.random.Generator(np.random.PCG64(SEED)), np.zeros(8 * WORDS), {}
    while len(found) < GROUPS:
        least = np.argsort(used + 1.5 * rng.random(len(used)))[:12]
        t = tuple(sorted(rng.choice(least, 3, replace=False).tolist()))
        if t not in found:
            found[t] = True
            used[list(t)] += 1
    return np.array(list(found))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, ascending."""
    parts = [np.array(h, np.uint64) for h in shingle_hashes(text, width)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def fingerprint(grams: np.ndarray) -> np.ndarray:
    """``WORDS`` words: a bit is 1 if over half of the set's hashes have it."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(grams), 1 << 14):
        ones += bit_counts(np.stack([further(grams[at : at + (1 << 14)], k) for k in range(WORDS)], axis=1))
    return np.packbits(2 * ones > len(grams), bitorder="little").view("<u8")


def sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, sum, same, n, f0 ..): a row for each row; sum is a hash of the text, same one of its set, n the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), width) for t in batch.column(2)]
            prints = np.array([fingerprint(g) for g in made], np.uint64).reshape(-1, WORDS).view(np.int64)
            n, same = pa.array([len(g) for g in made], pa.int32()), pa.array(np.array([xxhash.xxh64_intdigest(g) for g in made], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], same, n, *(pa.array(prints[:, k]) for k in range(WORDS))], names=["id", "sum", "same", "n", *COLUMNS])

    schema = "id long, sum long, same long, n int, " + ", ".join(f"{c} long" for c in COLUMNS)
    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("sum"), utf8(text_col).alias("text"))


def in_blocks(entries: DataFrame) -> DataFrame:
    """(block long, payload binary): the entries' nodes, sizes and fingerprints, many together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(b for b in batches if b.num_rows):
            payload = pack([c.to_numpy() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array([first + k], pa.int64()), pa.array([payload], pa.binary())], names=["block", "payload"])

    return settled(entries.select("node", "n", *COLUMNS).mapInArrow(run, "block long, payload binary"))


def postings(blocks: DataFrame, total: int) -> DataFrame:
    """(block, message): the lists, each of the entries under a triple of positional bytes, that hold an entry of the block and another one.

    A message has keys, lengths and places in the block. A key names a list by its entries, so that lists of the same
    entries, which similar texts have many of, are one. ``total``: of all entries.
    """
    chosen = triples()
    split = max(0, int(np.ceil(np.log2(max(1, total) / ENTRIES))))  # by so many high bits of the bytes

    def post(payload: bytes, _) -> Iterator[tuple[int, bytes]]:
        node, _, *words = unpack(payload)
        own = np.stack(words, axis=1).view(np.uint8).astype(np.int64)
        for g, t in enumerate(chosen):
            key = own[:, t[0]] | own[:, t[1]] << 8 | own[:, t[2]] << 16
            order = np.argsort(key, kind="stable")
            part = key[order] >> (24 - split)
            cuts = np.nonzero(np.append(True, part[1:] != part[:-1]))[0].tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(part)]):
                at = order[lo:hi]
                yield g << split | int(part[lo]), pack([narrow(np.diff(key[at], prepend=0)), narrow(node[at] - node[0]), narrow(at), node[:1]])

    def meet(_: int, blocks: list[int], messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        keys, nodes, places = [], [], []
        for m in messages:
            rises, more, at, base = unpack(m)
            keys.append(np.cumsum(rises, dtype=np.int64))
            nodes.append(more.astype(np.int64) + base[0])
            places.append(at)
        of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        key, node, place = np.concatenate(keys), np.concatenate(nodes), np.concatenate(places).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, node, place, of = key[order], node[order], place[order], of[order]
        equal = key[1:] == key[:-1]
        several = np.append(equal, False) | np.append(False, equal)
        key, node, place, of = key[several], node[several], place[several], of[several]
        if not len(key):
            return
        begin = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        length = np.diff(np.append(begin, len(key)))
        marks = further(node.view(np.uint64), 3)
        name = further(np.add.reduceat(marks, begin) ^ further(np.bitwise_xor.reduceat(marks, begin), 1), 2)
        name, length = np.repeat(name, length), np.repeat(length, length)
        by = np.argsort(of, kind="stable")
        cuts = np.nonzero(np.append(True, of[by][1:] != of[by][:-1]))[0].tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
            at = by[lo:hi]
            yield blocks[of[at[0]]], pack([name[at], narrow(length[at]), narrow(place[at])])

    return answer(ask(blocks, post), meet)


def proposals(entries: DataFrame, parts: int) -> DataFrame:
    """(u, v): the candidates that the units of all lists propose, each list cut into parts of which any two are a unit."""
    blocks, longest, solve = in_blocks(entries), BLOCK, solver(SMALL)

    def deal(payload: bytes, messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        if not messages:
            return
        node, n, *words = unpack(payload)
        key, length, place = (np.concatenate(x) for x in zip(*map(unpack, messages)))
        order = np.lexsort((place, key))
        key, length, place = key[order], length[order].astype(np.int64), place[order].astype(np.int64)
        new = np.append(True, (key[1:] != key[:-1]) | (place[1:] != place[:-1]))
        key, place, cut = key[new], place[new], -(-length[new] // longest)
        own = (further(node[place].view(np.uint64), 4) % cut.astype(np.uint64)).astype(np.int64)
        row = np.repeat(np.arange(len(key)), cut)
        other = np.arange(len(row)) - np.repeat(np.cumsum(cut) - cut, cut)
        i, j = np.minimum(own[row], other), np.maximum(own[row], other)
        key, place = key[row], place[row]
        bucket = (further(key ^ (i << 32 | j).view(np.uint64), 5) % np.uint64(parts)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.nonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))[0].tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(by)]):
            at = by[lo:hi]
            used, where = np.unique(place[at], return_inverse=True)  # an entry's fingerprint goes once
            yield int(bucket[at[0]]), pack([key[at], narrow(i[at]), narrow(j[at]), narrow(where), node[used], n[used], *(w[used] for w in words)])

    def run(group: pa.Table) -> pa.Table:
        told = [unpack(m.as_py()) for m in group["message"]]
        cols = [np.concatenate(x) for x in zip(*([m[0].view(np.int64), m[1].astype(np.int32), m[2].astype(np.int32), *(c[m[3]] for c in m[4:])] for m in told))]
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        key, i, j, node, n, *words = (c[order] for c in cols)
        found = pa.Table.from_batches(solve(pa.table([key, i, j, node, n, node, *words], names=["key", "i", "j", "node", "n", "root", *COLUMNS])))
        return found.select(["u", "v"]).group_by(["u", "v"]).aggregate([])

    return ask(blocks, deal, [postings(blocks, entries.count())]).groupBy("bucket").applyInArrow(run, "u long, v long").distinct()


class Unit:
    """The entries of some units of work: fingerprints, sizes, and components so far."""

    def __init__(self, node: np.ndarray, prints: np.ndarray, n: np.ndarray, root: np.ndarray, small: int):
        self.node, self.prints, self.n, self.root, self.small = node, prints, n.astype(np.int64), root, small
        self.most, self.close = int(DIFFERING * 64 * WORDS), int(CLOSE * 64 * WORDS)

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Differing bits of broadcastable places; beyond all bits for pairs that cannot link."""
        x = self.prints[a] ^ self.prints[b]
        d = np.bitwise_count(x).sum(axis=-1, dtype=np.int64)
        low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        likely = d <= self.most
        fits = likely & (SIMILARITY[1] * low >= SIMILARITY[0] * high)
        at = np.nonzero(fits)
        if len(at[0]):
            fits[at] = shared_bytes(x[at]).sum(axis=-1, dtype=np.int64) >= LEAST_SHARED
        return np.where(fits, d, 64 * WORDS + 1)

    def forest(self, lo: int, hi: int, holds: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
        """Candidates among places lo to hi that join different components, nearest first, if they hold; without ``holds``, they do."""
        a, b, d = self.pairs(lo, hi, holds is not None)
        ok = self.root[a] != self.root[b]
        a, b, d = a[ok], b[ok], d[ok]
        order = np.lexsort((self.node[b], self.node[a], d))
        label: dict[int, int] = {}

        def find(x: int) -> int:
            while label.setdefault(x, x) != x:
                label[x] = x = label[label[x]]
            return x

        out = []
        for x, y in zip(a[order].tolist(), b[order].tolist()):
            p, q = find(int(self.root[x])), find(int(self.root[y]))
            if p != q and (holds is None or holds(x, y)):
                label[p] = q
                out.append((x, y))
        return out

    def pairs(self, lo: int, hi: int, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Candidates among places lo to hi. ``every``: all that join different components; else enough to connect what all connect.

        Of a long list, first those to a row that is close, or of one component; then those between rows that are not.
        """
        if hi - lo <= 4 * self.small:
            a, b = np.triu_indices(hi - lo, 1)
            d = self.distance(a + lo, b + lo)
            ok = d <= self.most
            return a[ok] + lo, b[ok] + lo, d[ok]
        rest, heads, out = np.arange(lo, hi), [], []
        while len(rest):
            x, rest = rest[0], rest[1:]
            d = self.distance(np.full(len(rest), x), rest)
            near = self.root[rest] == self.root[x] if every else d <= self.close
            out.append((np.full(int(near.sum()), x), rest[near], d[near]))
            heads.append(x)
            rest = rest[~near]
        of = np.empty(hi - lo, np.int64)  # the head of each place
        of[np.array(heads) - lo] = heads
        for x, near, _ in out:
            of[near - lo] = x
        # between followers of different heads, the largest groups first, so that such a group meets the others alone
        size = np.bincount(of - lo, minlength=hi - lo)[of - lo]
        member = np.lexsort((np.arange(hi - lo), of, -size)) + lo
        head = of[member - lo]
        ends = np.searchsorted(-size[member - lo] * (hi + 1) + head, -size[member - lo] * (hi + 1) + head, side="right")
        at = 0
        while at < len(member):
            first = int(ends[at]) if ends[at] - at >= 64 else at + 1
            if first >= len(member):
                break
            upto = min(int(ends[at]) if ends[at] - at >= 64 else len(member), at + max(64, (1 << 19) // (len(member) - first)))
            rows, others = member[at:upto], member[first:]
            d = self.distance(rows[:, None], others[None, :])
            i, j = np.nonzero((d <= self.most) & (head[at:upto][:, None] != head[first:][None, :]) & (np.arange(at, upto)[:, None] < np.arange(first, len(member))[None, :]))
            a, b, d, p, q = rows[i], others[j], d[i, j], head[at + i], head[first + j]
            if not every:  # the nearest of two groups connects them
                order = np.lexsort((b, a, d, q, p))
                p, q = p[order], q[order]
                order = order[np.append(True, (p[1:] != p[:-1]) | (q[1:] != q[:-1]))[: len(p)]]
                a, b, d = a[order], b[order], d[order]
            out.append((a, b, d))
            at = upto
        return tuple(np.concatenate(x) for x in zip(*out))


def solver(small: int, width: int | None = None) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """(key, i, j, u, v): the forest that each unit of a table in order of (key, i, j) proposes; with texts ``z`` and ``width``, of verified links."""
    names = ["key", "i", "j", "node", "n", "root", *COLUMNS]

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        cols = {c: t[c].to_numpy() for c in names}
        unit = Unit(cols["node"], np.stack([cols[c] for c in COLUMNS], axis=1).view(np.uint64), cols["n"], cols["root"], small)
        key, i, j = cols["key"], cols["i"], cols["j"]
        starts = np.nonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))[0]
        sizes = np.diff(np.append(starts, len(key)))
        found: list[tuple[int, int]] = []
        if width:
            texts = t["z"]
            for lo, n in zip(starts.tolist(), sizes.tolist()):
                grams = cache(lambda x: shingle_set(zstandard.decompress(texts[x].as_py()), width))
                found += unit.forest(lo, lo + n, lambda x, y: similar(grams(x), grams(y)))
        else:
            two = starts[sizes == 2]
            ok = unit.distance(two, two + 1) <= unit.most
            found += [(x, x + 1) for x in two[ok].tolist()]
            for n in range(3, small + 1):  # lists with a candidate at all, of a size together
                at = starts[sizes == n]
                if len(at):
                    a, b = np.triu_indices(n, 1)
                    hit = (unit.distance(at[:, None] + a, at[:, None] + b) <= unit.most).sum(axis=1)
                    for lo in at[hit > 0].tolist():
                        found += unit.forest(lo, lo + n)
            for lo, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
                found += unit.forest(lo, lo + n)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        u, v = np.maximum(unit.node[a], unit.node[b]), np.minimum(unit.node[a], unit.node[b])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[a], i[a], j[a], u, v)], names=["key", "i", "j", "u", "v"])

    return solve


def solved(dealt: DataFrame, parts: int, width: int) -> DataFrame:
    """(key, i, j, u, v): the forest of verified links that each unit of ``dealt`` has."""
    names = ["key", "i", "j", "node", "n", "root", *COLUMNS, "z"]
    ordered = dealt.select(names).repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return ordered.mapInArrow(grouped_batches(solver(SMALL, width), ["key", "i", "j"]), "key long, i int, j int, u long, v long")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two ascending sets reaches ``SIMILARITY``."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return SIMILARITY[1] * same >= SIMILARITY[0] * (len(x) + len(y) - same)


def packed_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, z): the compressed text of each entry of ``wanted`` (node, least), from ``docs`` (id, sum, text)."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = zstandard.ZstdCompressor(level=3)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([z.compress(t.as_py()) for t in batch.column(1)], pa.binary())], names=["node", "z"])

    wanted = wanted.select("node", F.col("least.id").alias("id"), F.col("least.sum").alias("sum"))
    found = docs.join(wanted, docs["id"].eqNullSafe(wanted["id"]) & (docs["sum"] == wanted["sum"])).select("node", "text").mapInArrow(squeeze, "node long, z binary")
    return checkpointed(found.groupBy("node").agg(F.first("z").alias("z")))


def verify(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(u, v, ok): whether the sets of each pair reach the similarity; exactly, from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, held = zstandard.ZstdDecompressor(), {}

        def grams(node: int, z: pa.Scalar) -> np.ndarray:
            if node not in held:
                if len(held) >= HELD:
                    held.clear()
                held[node] = shingle_set(unzip.decompress(z.as_py()), width)
            return held[node]

        for batch in batches:
            ok = [similar(grams(u, a), grams(v, b)) for u, v, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["u", "v", "ok"])

    left, right = (texts.select(F.col("node").alias(c), F.col("z").alias(f"z_{c}")) for c in ("u", "v"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "z_u", "z_v").mapInArrow(run, "u long, v long, ok boolean")


def regrouped(verdicts: DataFrame) -> DataFrame:
    """(key, i, j, node, root): groups with a refuted proposal, as units of blocks; root is what is verified so far.

    Rows of a group's largest part stand in blocks of their own, which meet blocks of other rows only; those also meet each other.
    """
    group = components(verdicts.select("u", "v")).withColumnRenamed("root", "key")
    part = components(verdicts.where("ok").select("u", "v"))
    again = verdicts.where("NOT ok").select(F.col("u").alias("node")).join(group, "node").select("key").distinct()
    rows = checkpointed(group.join(again, "key", "left_semi").join(part, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most"))
    rows = rows.join(sizes.select("key", F.col("most.root").alias("main"), F.ceil(F.col("most.n") / F.lit(BLOCK)).cast("int").alias("m"), F.ceil((F.col("all") - F.col("most.n")) / F.lit(BLOCK)).cast("int").alias("o")), "key")
    main, at = F.col("root") == F.col("main"), F.xxhash64("node")
    rows = rows.withColumn("b", F.when(main, F.pmod(at, F.col("m"))).otherwise(F.col("m") + F.pmod(at, F.greatest(F.col("o"), F.lit(1)))).cast("int"))
    others = F.sequence(F.col("m"), F.col("m") + F.col("o") - 1)
    met = F.explode(F.when(main, others).otherwise(F.concat(F.sequence(F.lit(0), F.col("m") - 1), others))).alias("with")
    return rows.where("o > 0").select("key", "node", "root", "b", met).select("key", F.least("b", "with").alias("i"), F.greatest("b", "with").alias("j"), "node", "root").distinct()


def links(entries: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(u, v): verified links that connect what all verified candidates connect."""
    parts = shuffle_partitions(entries.sparkSession)
    prints = entries.select("node", "n", *COLUMNS)
    proposed = checkpointed(proposals(entries, parts))
    ends = proposed.select(F.col("u").alias("node")).unionByName(proposed.select(F.col("v").alias("node"))).distinct()
    texts = packed_texts(entries.join(ends, "node", "left_semi"), docs)
    verdicts = checkpointed(verify(proposed, texts, width))
    sure = verdicts.where("ok").select("u", "v")
    if not verdicts.where("NOT ok").limit(1).count():
        return sure
    more = solved(regrouped(verdicts).join(prints, "node").join(texts, "node"), parts, width)
    return sure.unionByName(checkpointed(more.select("u", "v")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest id; groups are what links connect.

    Two rows link if the Jaccard similarity of their sets of shingles is at least 0.8. Words are told apart without regard
    to the case of A-Z; a text of fewer words than a shingle has is one shingle. Null texts and those without words have no
    shingles and are duplicates of each other, of nothing else. Rows equal in id and text are one. A null id stands after
    all others. No rows give no rows. All columns stay, of any name; only the two named are read.
    """
    found = sets(docs, id_col, text_col, width)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "sum")).alias("least")
    entries = checkpointed(found.groupBy("same").agg(first, *[F.first(c).alias(c) for c in ("n", *COLUMNS)]).withColumn("node", F.monotonically_increasing_id()))
    member = components(links(entries, keyed(docs, id_col, text_col), width))
    rooted = entries.select("node", "least").join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.id").alias("kept_id"), F.col("least.sum").alias("kept_sum"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("sum"))
    twice = checkpointed(rows.groupBy("id", "sum").agg(F.count("*").alias("n")).where("n > 1").select("id", "sum"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sum") == F.col("kept_sum")), "left_semi")
    if not twice.limit(1).count():
        return rows.select("row.*")
    same = rows["id"].eqNullSafe(twice["id"]) & (rows["sum"] == twice["sum"])
    again = rows.join(twice, same, "left_semi")
    alone = again.withColumn("k", F.row_number().over(W.partitionBy("id", "sum").orderBy(F.lit(0)))).where("k = 1")
    return rows.join(twice, same, "left_anti").select("row.*").unionByName(alone.select("row.*"))
