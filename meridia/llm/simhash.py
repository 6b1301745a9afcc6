"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ in at most ``bits`` bits
share at least ``8 - bits`` of the eight positional bytes, however the bits fall. The index posts each fingerprint
under positional bytes; what two fingerprints share there is tallied for each pair, pairs below the guaranteed
minimum are dropped, and the rest are verified by their Hamming distance.

Posting lists of single bytes would hold 1/256 of all fingerprints each. So a posting is keyed by a *group* of
positional bytes, and the groups are a covering design: whichever bytes a pair shares, if they are at least the
guaranteed minimum, one group lies wholly among them. Four of eight takes 20 groups of three bytes (24 bits).

Scale. Equal fingerprints are one entry. A list of over ``BLOCK`` entries is cut into blocks, and each pair of its
blocks is a unit of work of its own, so that no task ever holds a whole hot list; a unit returns a spanning forest
of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import ascii_lower, checkpointed, shuffle_partitions, table, utf8, words
from meridia.llm.components import components

SEED = 42
POSITIONS = 8
#: Entries of a posting list that one side of a unit of work holds at most.
BLOCK = 4096
#: Up to this size the pairs of a list are laid out together with those of other lists.
SMALL = 16


def covering_groups(shared: int) -> list[tuple[int, ...]]:
    """Groups of positions, one of which lies within any ``shared`` of the eight: Turan's constructions."""
    if shared >= 4:
        part = [(0, 1, 2), (3, 4, 5), (6, 7)]
        of = {p: k for k, ps in enumerate(part) for p in ps}
        groups = []
        for t in combinations(range(POSITIONS), 3):
            n = [sum(of[p] == k for p in t) for k in range(3)]
            if 3 in n or any(n[k] == 2 and n[(k + 1) % 3] == 1 for k in range(3)):
                groups.append(t)
        return groups
    if shared == 3:
        return [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 2)]
    if shared == 2:
        return list(combinations(range(POSITIONS), 2))
    if shared == 1:
        return [(p,) for p in range(POSITIONS)]
    raise ValueError("pairs must share a byte: at most seven differing bits")


#: The bits of a byte, each in a byte of a long.
SPREAD = np.array([sum((b >> j & 1) << (8 * j) for j in range(8)) for b in range(256)], np.uint64)


def further(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further 64-bit hash of each hash (the finaliser of splitmix64); the hash itself for 0."""
    if not k:
        return h
    with np.errstate(over="ignore"):
        z = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def bit_counts(h: np.ndarray) -> np.ndarray:
    """Of (rows, words) longs: in how many rows each bit is set, lowest bit of the first word first."""
    own = np.ascontiguousarray(h, "<u8").view(np.uint8).reshape(len(h), -1)
    out = np.zeros(8 * own.shape[1], np.int64)
    for at in range(0, len(own), 255):  # eight counts of up to 255 in a long
        out += SPREAD[own[at : at + 255]].sum(axis=0, dtype=np.uint64).astype("<u8").view(np.uint8)
    return out


def shingle_hashes(text: bytes, width: int) -> Iterator[list[int]]:
    """XXH64 of each shingle of ``width`` words, in lists; of the whole sequence, if it has fewer words; none without words."""
    kept: list[bytes] = []
    made = False
    for part in words(ascii_lower(text)):
        have = kept + part
        if len(have) >= width:
            joined = b" ".join(have)
            ends = np.cumsum([len(w) + 1 for w in have]).tolist()
            starts = [0, *ends]
            made = True
            yield [xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :])]
            kept = have[len(have) - width + 1 :]
        else:
            kept = have
    if not made and kept:
        yield [xxhash.xxh64_intdigest(b" ".join(kept), SEED)]


def fingerprint(text: bytes, width: int) -> int:
    """A bit is 1 if over half of the shingles' hashes have it, repeats counted. Without words: zero."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, width):
        ones += bit_counts(np.array(hashes, np.uint64)[:, None])
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, node long): the fingerprints as signed longs, a row for each row. Null text: as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["id", "node"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text")).mapInArrow(run, "id long, node long")


def postings(entries: DataFrame, shared: int) -> DataFrame:
    """(key, node): each node under the key of each group of its positional bytes. A key is the group's number, then the bytes."""
    groups = covering_groups(shared)

    def key(g: int, ps: tuple[int, ...]):
        k = F.lit(g).cast("long")
        for p in ps:
            k = F.shiftleft(k, 8).bitwiseOR(F.shiftrightunsigned("node", 8 * p).bitwiseAND(F.lit(255)))
        return k

    return entries.select("node", F.explode(F.array(*(key(g, ps) for g, ps in enumerate(groups)))).alias("key"))


def units(posted: DataFrame) -> DataFrame:
    """(key, i, j, side, node): posting lists dealt into units of work, the pairs of a list's blocks i <= j.

    Most lists are one unit (0, 0); lists of one entry go. ``side`` is 0 in block i and 1 in block j. The join with the
    lists' lengths is where a hot list stands under one key; it carries 16 bytes an entry, and adaptive execution splits it.
    """
    counts = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = posted.join(counts, "key").withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
    dealt = dealt.withColumn("b", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).otherwise(F.lit(0)))
    return dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side"), "node")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of its eight bytes each XOR has at zero: the tally of positional bytes that a pair shares."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return np.uint8(8) - np.bitwise_count((((x & low) + low) | x) & ~low)


class Matcher:
    """Which pairs link: they share at least ``least_shared`` bytes, and differ in at most ``bits`` bits."""

    def __init__(self, bits: int, least_shared: int):
        self.bits, self.least_shared = bits, least_shared

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a ^ b
        return (shared_bytes(x) >= self.least_shared) & (np.bitwise_count(x) <= self.bits)


def forest(match: Matcher, prints: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (u, v) of a spanning forest of a unit's links between two sides, or within one if both are the same."""
    label = np.arange(len(prints))
    for at in range(0, len(left), 64):
        rows = left[at : at + 64]
        for r, hit in zip(rows, match(prints[rows][:, None], prints[right][None, :])):
            if hit.any():
                met = np.unique(label[np.append(right[hit], r)])
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
    far = np.nonzero(label != np.arange(len(prints)))[0]
    return far, label[far]


def grouped_batches(solve: Callable[[pa.Table], Iterator[pa.RecordBatch]], keys: list[str], rows: int = 4 * BLOCK) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` over rows in order of ``keys``: ``solve`` gets whole groups, many together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                t = pa.Table.from_batches(held).combine_chunks()
                other = np.zeros(t.num_rows, bool)
                for k in keys:
                    c = t[k].to_numpy()
                    other |= c != c[-1]
                last = np.nonzero(other)[0]
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield from solve(t.slice(0, cut).combine_chunks())
                held, n = t.slice(cut).to_batches(), t.num_rows - cut
        if n:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    return run


def link(entries: DataFrame, bits: int, shared: int) -> DataFrame:
    """(u, v) of nodes: links that connect what pairs of ``entries`` (node) with at most ``bits`` differing bits connect."""
    match, parts = Matcher(bits, shared), shuffle_partitions(entries.sparkSession)

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, i, j, side, node = (t[c].to_numpy() for c in ("key", "i", "j", "side", "node"))
        prints = node.view(np.uint64)
        starts = np.nonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))[0]
        sizes = np.diff(np.append(starts, len(key)))
        whole = i[starts] == j[starts]
        small = whole & (sizes > 1) & (sizes <= SMALL)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(2, SMALL + 1):  # lists of a size: their pairs, position by position
            at = starts[small & (sizes == n)]
            for x, y in combinations(range(n), 2) if len(at) else ():
                hit = match(prints[at + x], prints[at + y])
                found.append((at[hit] + x, at[hit] + y))
        for k in np.nonzero(~small & (sizes > 1))[0]:
            s = slice(starts[k], starts[k] + sizes[k])
            own = np.arange(sizes[k])
            left, right = (own, own) if whole[k] else (own[side[s] == 0], own[side[s] == 1])
            u, v = forest(match, prints[s], left, right)
            found.append((u + starts[k], v + starts[k]))
        if found:
            u, v = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["u", "v"])

    ordered = units(postings(entries, shared)).repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return ordered.select("key", "i", "j", "side", "node").mapInArrow(grouped_batches(solve, ["key", "i", "j"]), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, bits: int = 4) -> DataFrame:
    """Connected components of rows whose SimHash fingerprints differ in at most ``bits`` bits.

    Returns (id long, fingerprint long, component_id long): a row for each row of ``docs``, ``component_id`` the
    smallest id of the component. Null text: as an empty one; texts without words have fingerprint zero and link
    like any other. Equal rows: each is returned. A null id takes part, is no smallest id while others are there,
    and stands as its component's id only if all ids there are null. No rows give no rows. Only the two named
    columns are read, so that others may have any name.
    """
    found = checkpointed(fingerprints(docs, id_col, text_col, width))
    entries = checkpointed(found.groupBy("node").agg(F.min("id").alias("least")))
    member = components(link(entries.select("node"), bits, POSITIONS - bits))
    rooted = entries.join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return found.join(named, "node").select("id", F.col("node").alias("fingerprint"), "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract of op1: four words, four bits, over all of ``documents``."""
    done = near_duplicates(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
