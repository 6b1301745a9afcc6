"""Scoring texts by a probabilistic suffix tree over words.

Symbols are words, and one end for each text. The root predicts by add-one counts over all training words. A context of
any number of symbols is a node if it was seen at least ``Limits.context`` times, its parent (the context without its first
symbol) is a node, and its next-symbol counts diverge from the parent's prediction: the count times the Kullback-Leibler
divergence over the node's own symbols reaches ``Limits.divergence`` nats. A node's own symbols are those seen at least
``Limits.next`` times after it and more often than chance explains: with e = c(s) * P(x | parent), the Poisson bound
c ln(c / e) - c + e on the logarithm of such a chance reaches ``Limits.surprise``. So the many pairs of a frequent word with words
that merely are frequent too make no nodes. A node leaves all other symbols to its parent:

    P(x | s) = c(s, x) / (c(s) + prior) for kept x  +  (c(s) + prior - kept counts) / (c(s) + prior) * P(x | parent)

so each node's prediction sums to one. A text is scored by the longest suffix of what precedes a symbol that is a node.
All limits are counts or nats, so the tree grows with the corpus; levels are added until one has no node.

Scale. Nothing is broadcast and no whole tree stands anywhere. Words and contexts live in buckets. For each level a block
sends its contexts, next symbols, counts and the parents' predictions (which it has from the levels before; those of the
root follow from a symbol's count, which goes once); the bucket has a context's whole counts, judges it, and answers what
the block asked: counts up to 63, and the whole counts of kept symbols. Contexts that an estimate from
their count and their parent's shows to be under the divergence are not sent. From level ``STATED`` on, a block also sends
itself, by way of the buckets, how far it has come: the places that are still asked about, and of all others only their
rows' sums. So a level costs what is left at it, not all levels above it again. Blocks grow with the number of buckets, to
``MOST_BYTES``: a context and its next symbols are then told by fewer blocks, each with the names and predictions once. A context's entries are aggregated by block and meet in one bucket. Contexts of two symbols and more are told apart by hashes of 64 bits. All counts are over the whole corpus.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.llm.blocks import BLOCK_BYTES, answer, ask, bucket_count, finish, narrow, pack, pack_rows, to_blocks, unpack, unpack_rows
from meridia.llm.common import pieces, table


@dataclass(frozen=True)
class Limits:
    """What makes a node, in counts and nats, whatever the size of the corpus."""

    context: int = 32
    next: int = 4
    divergence: float = 20.0
    surprise: float = 10.0
    prior: float = 10.0


#: Counts of symbols that are not kept serve as bounds only, and are told up to here.
MOST_TOLD = 63
#: From this level on a block keeps how far it has come; the levels above are gone down again from the answers.
STATED = 3
#: Text bytes of a block grow by so many for each bucket, so that its messages keep their size, up to what a worker has room for.
BYTES_PER_BUCKET = 200 << 10
MOST_BYTES = 10 << 20
#: Stands for the bucket in a message on how far a block has come.
STATE = (1 << 32) - 1
#: No word: it holds white space.
END = b"\n"


def encode(rows: pa.Table) -> bytes:
    """A block's rows with their texts as numbers of the block's own words: of each row id and held; packed, sizes, symbols and words."""
    parts, owner = [], []
    for row, text in enumerate(rows["text"]):
        for part in pieces((text.as_py() or b"").lower()):
            parts.append(part)
            owner.append(row)
    split = pc.ascii_split_whitespace(pa.array(parts, pa.large_binary()).view(pa.large_string()))  # of the six characters of SPACES
    flat = split.flatten().view(pa.large_binary())
    filled = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(filled).dictionary_encode()
    owner = np.repeat(np.array(owner, np.int64), split.value_lengths().to_numpy())[filled.to_numpy(zero_copy_only=False)]
    sizes = np.bincount(owner, minlength=len(rows)) + 1
    own = pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_binary())])
    symbol = np.full(int(sizes.sum()), len(own) - 1, np.int64)
    word = np.ones(len(symbol), bool)
    word[np.cumsum(sizes) - 1] = False
    symbol[word] = coded.indices.to_numpy()
    order = np.argsort(-np.bincount(symbol, minlength=len(own)), kind="stable")  # frequent words have small numbers
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    lengths = pc.binary_length(own).to_numpy()[order]
    packed = pack([narrow(sizes), narrow(rank[symbol]), narrow(lengths), np.frombuffer(b"".join(own.take(pa.array(order)).to_pylist()), np.uint8)])
    return pack_rows(rows.select(["id", "held"]).replace_schema_metadata({b"packed": packed}))


class Local:
    """A block's words, and its rows as numbers of them."""

    def __init__(self, payload: bytes):
        self.rows = unpack_rows(payload)
        sizes, symbol, lengths, flat = unpack(self.rows.schema.metadata[b"packed"])
        self.sizes, self.symbol = sizes.astype(np.int64), symbol.astype(np.min_scalar_type(-len(lengths) - 1))
        self.flat, self.ends = flat, np.cumsum(lengths, dtype=np.int64)
        self.held = np.array(self.rows["held"].to_pylist(), bool)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(~self.held, self.sizes)

    def bytes_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and joined bytes of words."""
        first = np.append(0, self.ends)[at]
        size = self.ends[at] - first
        return size, self.flat[np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]

    def by_bucket(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of words by bucket, which a polynomial of a word's bytes tells; no word is empty."""
        first = np.append(0, self.ends)[:-1]
        size = self.ends - first
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.full(int(size.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64))
            h = np.add.reduceat(power[np.arange(len(self.flat)) - np.repeat(first, size)] * (self.flat + np.uint64(1)), first) if len(first) else np.empty(0, np.uint64)
        b = (_mix(h, np.zeros(len(h), np.uint64)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        cuts = np.nonzero(np.append(True, b[order][1:] != b[order][:-1]))[0] if len(order) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            yield int(b[order[lo]]), order[lo:hi]


def _count_words(n: int):
    def question(payload: bytes, _) -> Iterator[tuple[int, bytes]]:
        local = Local(payload)
        counts = np.bincount(local.symbol[local.train], minlength=len(local.ends)).astype(np.int64)
        for b, at in local.by_bucket(n):
            size, flat = local.bytes_of(at)
            yield b, pack([narrow(counts[at]), narrow(size), flat])

    return question


def _total_words():
    def reply(bucket: int, blocks: list[int], messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """To each block the counts and numbers of its words, in all blocks the same; to block -1 the bucket's totals."""
        parts = [unpack(m) for m in messages]
        kinds = [len(p[0]) for p in parts]
        counts, sizes, flat = (np.concatenate(x) for x in zip(*parts))
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).dictionary_encode()
        word = coded.indices.to_numpy()
        total = np.bincount(word, weights=counts, minlength=len(coded.dictionary)).astype(np.int64)
        order = pc.sort_indices(pa.table({"less": -total, "word": coded.dictionary}), sort_keys=[("less", "ascending"), ("word", "ascending")]).to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        at = 0
        for block, m in zip(blocks, kinds):
            mine = word[at : (at := at + m)]
            yield block, struct.pack("<II", 0, bucket) + pack([narrow(total[mine]), narrow(number[mine])])
        yield -1, struct.pack("<qq", int(total.sum()), int((total > 0).sum()))

    return reply


def _mix(name: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Names of contexts: a parent's name and one more symbol before it; a context of one symbol has that symbol's number."""
    with np.errstate(over="ignore"):
        z = name * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = (z ^ (z >> np.uint64(31))) + symbol.astype(np.uint64)
        return z


@dataclass
class Tree:
    """A tree to ask outside of blocks: nodes of a level by sorted key; a node's symbols by sorted (node, symbol)."""

    symbols: dict[bytes, int] | np.ndarray
    count: np.ndarray  # of each symbol
    total: int = 0
    kinds: int = 0
    keys: list[np.ndarray] = field(default_factory=list)  # contexts: number of the parent among its level's nodes (0: root) * len(symbols) + first symbol
    back: list[np.ndarray] = field(default_factory=list)  # what a node leaves to its parent
    pairs: list[np.ndarray] = field(default_factory=list)  # node * len(symbols) + symbol
    gain: list[np.ndarray] = field(default_factory=list)  # c / (c(s) + prior) of each pair

    def predict(self, p: np.ndarray, symbol: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        """Probabilities of symbols (-1: never seen) after what precedes them; ``p`` is the root's."""
        at, node = np.arange(len(p)), np.zeros(len(p), np.int64)
        for depth in range(1, len(self.keys) + 1):
            p, at, node = self.step(depth, p, symbol, before[depth - 1][at], at, node)
        return p

    def step(self, depth: int, p: np.ndarray, symbol: np.ndarray, before: np.ndarray, at: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One level: the places ``at``, at ``node`` of the level above, that have a node with ``before`` in front, and it."""
        keys, pairs = self.keys[depth - 1], self.pairs[depth - 1]
        if not len(keys):
            return p, at[:0], node[:0]
        key = node * np.int64(len(self.symbols)) + before
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        ok = (before >= 0) & (keys[found] == key)
        at, node = at[ok], found[ok]
        own = np.zeros(len(at))
        if len(pairs):
            pair = node * np.int64(len(self.symbols)) + symbol[at]
            k = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            hit = (pairs[k] == pair) & (symbol[at] >= 0)
            own[hit] = self.gain[depth - 1][k[hit]]
        p = p.copy()
        p[at] = own + self.back[depth - 1][node] * p[at]
        return p, at, node

    def root(self, symbol: np.ndarray) -> np.ndarray:
        return (self.count[symbol] + 1.0) / (self.total + self.kinds + 1.0)


def rises(a: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences."""
    return np.diff(a, prepend=a[:1] * 0) if len(a) else a


def steps(a: np.ndarray) -> np.ndarray:
    """Numbers in no order as differences without a sign; ``unsteps`` takes them back."""
    d = rises(a.astype(np.int64))
    return np.where(d < 0, -2 * d - 1, 2 * d)


def unsteps(d: np.ndarray) -> np.ndarray:
    d = d.astype(np.int64)
    return np.cumsum(np.where(d & 1, -(d + 1) // 2, d // 2))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` of whole numbers from zero, with its inverse; keys and their places are sorted as one number where both fit."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits > 63:
        return np.unique(keys, return_inverse=True)
    both = keys.astype(np.int64)
    both <<= bits
    both |= np.arange(len(keys))
    both.sort()
    at = both & ((1 << bits) - 1)
    both >>= bits
    new = np.append(True, both[1:] != both[:-1])[: len(both)]
    inverse = np.empty(len(keys), np.int64)
    inverse[at] = np.cumsum(new) - 1
    return both[new], inverse


def coarse(seen: np.ndarray, limits: Limits) -> np.ndarray:
    """Counts, in which under ``Limits.context`` only the side of ``Limits.next`` matters."""
    return np.where(seen < limits.next, 0, np.where(seen < limits.context, min(limits.next, limits.context), seen))


class Part:
    """A block, and how far its places have come down the tree."""

    def __init__(self, payload: bytes, total: int, kinds: int, n: int, limits: Limits, messages: list[bytes]):
        self.limits = limits
        local = Local(payload)
        self.rows, self.sizes, self.symbol, self.held, self.first, self.train, self.n = local.rows, local.sizes, local.symbol, local.held, local.first, local.train, n
        told: dict[int, dict[int, list[np.ndarray]]] = {}
        for m in messages:
            level, bucket = struct.unpack("<II", m[:8])
            told.setdefault(level, {})[bucket] = unpack(m[8:])
        counts, self.number = np.zeros(len(local.ends), np.int64), np.zeros(len(local.ends), np.int64)
        for b, at in local.by_bucket(n):
            counts[at], number = told[0][b]
            self.number[at] = number.astype(np.int64) * n + b
        self.count, self.root = counts, Tree(self.number, counts, total, kinds).root(np.arange(len(counts)))
        self.place = np.arange(len(self.symbol)) - np.repeat(self.first, self.sizes)  # within its row
        level, state = next(((k, v.pop(STATE)) for k, v in told.items() if STATE in v), (1, None))
        #: levels gone down
        self.depth = level - 1
        if state:
            self.restore(state)
        else:
            self.p, self.done = self.root[self.symbol], np.zeros(len(self.sizes))
            #: seen[i]: how often the last symbols up to i, one more each level, stand in training; at most, where not asked
            self.seen = counts[self.symbol]
            self.at, self.node = np.arange(len(self.symbol)), np.zeros(len(self.symbol), np.int64)
            self.name = np.zeros(1, np.uint64)
            #: of a node: what its shares are of, its commonest kept symbol's count, and the count of all else
            self.have, self.top, self.rest = np.array([total + kinds + 1.0]), np.zeros(1), np.array([total + 0.0])
        for k in range(level, max(told, default=0) + 1):
            self.down(told.get(k, {}))

    def by_row(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.first) if len(x) else np.empty(0, x.dtype)  # each row has its end

    def scores(self) -> np.ndarray:
        return self.done + self.by_row(np.log10(self.p))

    def state(self) -> bytes:
        """How far the block has come, ``asked`` having left the places it asks about. The others' probabilities are final: their rows' sums stay."""
        final = self.p.copy()
        final[self.at] = 1.0
        done = self.done + self.by_row(np.log10(final))
        nodes, node = distinct(self.node)
        pairs, pair = distinct(self.alike(node))
        p = np.empty(len(pairs))
        p[pair] = self.p[self.at]
        total, top = (self.rest[nodes] + self.top[nodes]).astype(np.int64), self.top[nodes].astype(np.int64)
        return struct.pack("<II", self.depth + 1, STATE) + pack([narrow(rises(self.at)), narrow(node), p, narrow(self.within()), done, self.name[nodes], narrow(total), narrow(top)])

    def alike(self, node: np.ndarray) -> np.ndarray:
        """Of each place asked about its node and symbol, which tell its probability."""
        return node * np.int64(len(self.number)) + self.symbol[self.at]

    def within(self) -> np.ndarray:
        """``seen`` at the places asked about and before them, back to one under ``Limits.context``; it is a bound for all that ends there, so no other matters."""
        n = len(self.seen)
        asked = np.full(n + 1, n)
        asked[self.at] = self.at
        short = np.where(self.seen < self.limits.context, np.arange(n), n)
        short[self.at] = n
        short = np.append(short, n)
        asked, short = (np.minimum.accumulate(x[::-1])[::-1] for x in (asked, short))
        need = (asked[1:] < n) & (asked[1:] <= short[1:])
        need[self.at] = True
        return np.where(need, coarse(self.seen, self.limits), 0)

    def restore(self, state: list[np.ndarray]) -> None:
        at, node, p, seen, self.done, self.name, total, top = state
        self.at, self.node, self.seen = np.cumsum(at, dtype=np.int64), node.astype(np.int64), seen.astype(np.int64)
        self.p = np.ones(len(self.symbol))
        self.p[self.at] = p[distinct(self.alike(self.node))[1]]
        self.have, self.top, self.rest = total + self.limits.prior, top + 0.0, total.astype(np.int64) - top.astype(np.int64) + 0.0

    def asked(self):
        """Contexts of the next level, by bucket: their keys and names, cuts of their pairs, and of each pair the symbol (that of none: the others).

        Places without such a context are left: a context's bounds are the same at all its places, so it is no node.
        """
        k, depth = np.int64(len(self.number)), self.depth + 1
        at, node = self.at, self.node
        kept = self.place[at] >= depth
        at, node = at[kept], node[kept]
        kept = self.seen[at - 1] >= self.limits.context
        at, node = at[kept], node[kept]
        keys, context = distinct(node * k + self.symbol[at - depth])
        seen, of = np.empty(len(keys), np.int64), keys // max(k, 1)
        seen[context] = self.seen[at - 1]
        # symbols of a context stand after its parent at least as often, so they share at most the rest there, each c(s, x) of have
        have, some = self.have[of], np.maximum(np.minimum(seen, np.minimum(self.rest[of], self.have[of] / np.e)), 1e-9)
        most = some * np.log(have / some) + seen * np.log(have / np.maximum(self.top[of], 1e-9)) * (self.top[of] > 0)
        good = most >= self.limits.divergence - 1e-6
        kept = good[context]
        self.at, self.node = at, node = at[kept], node[kept]
        keys, context = keys[good], (np.cumsum(good) - 1)[context[kept]]
        names = _mix(self.name[keys // max(k, 1)], self.number[keys % max(k, 1)])
        bucket = (names % np.uint64(self.n)).astype(np.int64)
        order = np.lexsort((names, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        of = rank[context]
        other = self.seen[at] < self.limits.next
        pairs, pair = distinct(of * (k + 1) + np.where(other, k, self.symbol[at]))
        return at, of, names[order], bucket[order], pairs // (k + 1), pairs % (k + 1), pair

    def question(self) -> Iterator[tuple[int, bytes]]:
        at, _, names, bucket, context, symbol, pair = self.asked()
        if self.depth + 1 >= STATED:
            state = self.state()
            yield self.n + len(state) % self.n, state
        k = len(self.number)
        counts = np.bincount(pair, weights=self.train[at], minlength=len(context)).astype(np.int64)
        deep = self.depth > 0
        parent = np.zeros(len(context) if deep else 0, np.float32)
        if deep:
            parent[pair] = self.p[at]
            parent[(counts == 0) | (symbol == k)] = 0  # not asked for
        cuts = np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0].tolist() if len(bucket) else []
        by_number = np.argsort(self.number)
        spot = np.empty(k + 1, np.int64)
        spot[by_number], spot[k] = np.arange(k), k
        for lo, hi in zip(cuts, [*cuts[1:], len(bucket)]):
            a, b = np.searchsorted(context, [lo, hi])
            used, next_ = distinct(spot[symbol[a:b]])  # symbols by their places in a list
            others = len(used) > 0 and used[-1] == k
            used = by_number[used[: len(used) - others]]
            parent_ = parent[a:b] if deep else narrow(steps(self.count[used]))
            yield int(bucket[lo]), pack([narrow(rises(names[lo:hi] // np.uint64(self.n))), narrow(np.bincount(context[a:b] - lo, minlength=hi - lo)), narrow(rises(self.number[used])), narrow(next_), narrow(counts[a:b]), parent_])

    def down(self, told: dict[int, list[np.ndarray]]) -> None:
        """Take what the buckets answered, and go down a level."""
        k = len(self.number)
        at, of, names, bucket, context, symbol, pair = self.asked()
        own_buckets = np.unique(bucket)
        parts = [told[b] for b in own_buckets.tolist()]
        total, kept, count, top = (np.concatenate([p[j] for p in parts]).astype(np.int64) if parts else np.empty(0, np.int64) for j in (0, 1, 2, 5))
        begin = np.searchsorted(context, np.searchsorted(bucket, own_buckets)).tolist()
        use, used = (np.concatenate(x).astype(np.int64) if parts else np.empty(0, np.int64) for x in ([np.cumsum(p[3], dtype=np.int64) + a for p, a in zip(parts, begin)], [p[4] for p in parts]))
        good = np.nonzero(kept > 0)[0]
        number = np.full(len(names), -1, np.int64)
        number[good] = np.arange(len(good))
        have = total + self.limits.prior
        gain = np.zeros(len(context))  # c / (c(s) + prior) of each pair
        gain[use] = used / have[context[use]]
        self.name, self.have, self.top, self.rest = names[good], have[good], top[good] + 0.0, total[good] - top[good] + 0.0
        self.depth += 1
        longer = np.minimum(self.seen, np.append(0, self.seen[:-1])) if len(self.seen) else self.seen
        exact = (symbol < k) & (count < MOST_TOLD)
        exact = exact[pair]
        longer[at[exact]] = count[pair[exact]]
        self.seen = longer
        node = number[of]
        hit = node >= 0
        self.at, self.node = at[hit], node[hit]
        self.p[self.at] = gain[pair[hit]] + ((have - kept) / have)[of[hit]] * self.p[self.at]


def _judge(level: int, whole: float, limits: Limits, n: int):
    """A bucket's contexts of a level: whole counts, divergence from the parents, and the answers. ``whole``: what the root's shares are of.

    Beyond the ``n`` buckets stand the blocks' messages to themselves.
    """

    def reply(bucket: int, blocks: list[int], messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        if bucket >= n:
            yield from zip(blocks, messages)
            return
        parts = []
        for m in messages:
            names, sizes, numbers, next_, counts, extra = unpack(m)
            numbers = np.append(np.cumsum(numbers, dtype=np.int64), -1) + 1
            if level == 1:
                extra = np.append((unsteps(extra) + 1.0) / whole, 0.0)[next_]
            parts.append((np.cumsum(names, dtype=np.uint64), sizes.astype(np.int64), numbers, counts.astype(np.int64), extra, next_))
        names, context = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        context = np.repeat(context, np.concatenate([p[1] for p in parts]))
        symbols = np.unique(np.concatenate([p[2] for p in parts]))
        symbol = np.concatenate([np.searchsorted(symbols, p[2])[p[5]] for p in parts])
        counts = np.concatenate([p[3] for p in parts])
        total = np.bincount(context, weights=counts, minlength=len(names)).astype(np.int64)
        pairs, pair = distinct(context * np.int64(len(symbols)) + symbol)
        count = np.bincount(pair, weights=counts, minlength=len(pairs)).astype(np.int64)
        parent = np.zeros(len(pairs))
        np.maximum.at(parent, pair, np.concatenate([p[4] for p in parts]).astype(np.float64))
        of, x = pairs // len(symbols), symbols[pairs % len(symbols)]
        use = np.nonzero((x > 0) & (count >= limits.next))[0]
        c, e = count[use], total[of[use]] * parent[use]
        gain = c * np.log(c / e)
        own = (c > e) & (gain - c + e >= limits.surprise)
        use, c, gain = use[own], c[own], gain[own]
        divergence = np.bincount(of[use], weights=gain, minlength=len(names))
        node = (divergence >= limits.divergence) & (total >= limits.context)
        kept = np.where(node, np.bincount(of[use], weights=c, minlength=len(names)).astype(np.int64), 0)
        is_kept = np.zeros(len(pairs), bool)
        is_kept[use] = node[of[use]]
        top = np.zeros(len(names), np.int64)
        np.maximum.at(top, of[use], c)
        top = np.where(node, top, 0)
        yield -1, struct.pack("<q", int(node.sum()))
        rest = np.minimum(coarse(count, limits), MOST_TOLD).astype(np.uint8)
        a = b = 0
        for block, p in zip(blocks, parts):
            own = np.searchsorted(names, p[0])
            b = a + len(p[3])
            mine = pair[a:b]
            hit = np.nonzero(is_kept[mine])[0]
            yield block, struct.pack("<II", level, bucket) + pack([narrow(np.where(node[own], total[own], 0)), narrow(kept[own]), rest[mine], narrow(rises(hit)), narrow(count[mine[hit]]), narrow(top[own])])
            a = b

    return reply


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): a row for each row of ``docs``.

    held: whether a row is kept out of the training. Null text: as an empty one, which has its end alone. Equal rows
    count each in training and score alike. Without training rows every symbol is unknown, N and V are zero. No rows give
    no rows. Only the two named columns, and those in ``held``, are read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"), held.alias("held"))
    n = bucket_count(rows, 1)
    blocks = to_blocks(rows, "text", "id", encode, min(max(BLOCK_BYTES, n * BYTES_PER_BUCKET), MOST_BYTES))
    counted = answer(ask(blocks, _count_words(n)), _total_words())
    sums = [struct.unpack("<qq", bytes(r["message"])) for r in counted.where("block = -1").collect()]  # a row a bucket
    total, kinds = sum(s[0] for s in sums), sum(s[1] for s in sums)
    numbers, level = counted.where("block >= 0"), 0
    told = [numbers]

    def question(payload: bytes, messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        return Part(payload, total, kinds, n, limits, messages).question()

    while True:
        level += 1
        judged = answer(ask(blocks, question, told), _judge(level, total + kinds + 1.0, limits, n))
        nodes = sum(struct.unpack("<q", bytes(r["message"]))[0] for r in judged.where("block = -1").collect())  # a row a bucket
        if not nodes:
            break
        told = [numbers, *(told[1:] if level < STATED else []), judged.where("block >= 0")]

    def last(payload: bytes, messages: list[bytes]) -> pa.Table:
        part = Part(payload, total, kinds, n, limits, messages)
        return pa.table([part.rows["id"], pa.array(part.held), pa.array(part.sizes), pa.array(part.by_row((part.count > 0).astype(np.int64)[part.symbol])), pa.array(np.full(len(part.sizes), total, np.int64)), pa.array(part.by_row(np.log10(part.root)[part.symbol])), pa.array(part.scores())], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return finish(blocks, told, last, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Contract of op7 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return score(docs, held).withColumnRenamed("id", "doc_id")
