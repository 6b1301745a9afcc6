"""Removing long repeated substrings, by run-length indexes over the places where texts may repeat.

Bytes covered by a ``length``-byte string that also starts in a document with a smaller id are removed.

1. Windows. Of every window of ``length`` bytes, the anchor is the leftmost of its ``gram``-byte strings with the least
   hash. It depends on the window's bytes alone, so equal windows have equal anchors at equal places. Consecutive
   windows with one anchor make a segment (about 70 bytes for 50); a text is cut into segments, each with the hash of
   its anchor and a hash of its bytes.
2. Blocks of documents tell buckets of anchors their distinct segments, with the smallest document. A bucket answers
   where a smaller document elsewhere has the same segment: then all its windows are repeats. Where an anchor also has
   other segments, windows may repeat in part, but only where the segments agree on more than the anchor: in an equal
   window the anchor has equally many bytes to its left, and either few to its left or few to its right. So blocks tell
   ``SIDES`` short hashes of the anchor with as many bytes on both sides as any such window has. Only where one is equal
   are bytes needed, and only from the segment's first document.
3. Those segments' bytes, each distinct one once, go to their anchor's bucket, which builds a run-compressed
   Burrows-Wheeler transform with sampled run ends over them, streams their matching statistics, and marks the windows
   whose match of ``length`` bytes also stands in a smaller document's segment.
4. Blocks put the marks together and cut the texts.

A window's bytes are compared in step 3 and by two independent 64-bit hashes (anchor and segment) in step 2. Hot
passages are one entry for each block in step 2 and one segment in step 3; an index holds at most ``CHUNK`` bytes, and
an anchor with more is indexed in parts, against each of which all of its segments are streamed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridia.llm.blocks import answer, ask, bucket_count, finish, pack, to_blocks, unpack, unpack_rows
from meridia.llm.common import table
from meridia.llm.rindex import RunLengthIndex, words_at

LENGTH = 50
#: Windows of a segment at most; a segment's marks fit a long.
MOST_WINDOWS = 35
#: Ranges of an anchor's place in a window, for each of which a segment has a hash of what all windows of the range hold.
SIDES = 3
#: Bytes that an index holds.
CHUNK = 1 << 19
#: Window starts that are worked on at a time.
STRIDE = 1 << 17
#: Stands for a null id: after all others, and not smaller than itself.
NO_ID = np.int64((1 << 63) - 1)

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def gram_size(length: int) -> int:
    return max(8, length - MOST_WINDOWS + 1)


def segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts given flat: (anchor hash, segment hash, first window's start, windows, anchor's start) of each segment, in text order."""
    gram, n = gram_size(length), len(data)
    span = length - gram + 1
    padded = np.zeros(n + length + 16, np.uint8)
    padded[:n] = data
    starts = np.append(0, ends[:-1])
    offsets = [*range(0, gram - 7, 8)] + ([gram - 8] if gram % 8 else [])
    out: list[tuple[np.ndarray, ...]] = []
    with np.errstate(over="ignore"):
        for lo in range(0, n, STRIDE):
            hi = min(n, lo + STRIDE)
            grams = hi - lo + span - 1
            view = words_at(padded[lo : hi + length + 15])
            h = np.full(grams, _A)
            for o in offsets:
                h = (h ^ view[o : o + grams]) * _B
                h ^= h >> np.uint64(29)
            h = _mix(h)
            # leftmost least: the place in the low bits settles ties to the left
            low = np.uint64((1 << 18) - 1)
            m = (h & ~low) | np.arange(grams, dtype=np.uint64)
            width = 1
            while 2 * width <= span:
                m = np.minimum(m[:-width], m[width:])
                width *= 2
            if width < span:
                m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
            at = (m & low).astype(np.int64)
            good = np.ones(hi - lo, bool)
            near = np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi + length, side="left") + 1
            for s, e in zip(starts[near[0] : near[1]].tolist(), ends[near[0] : near[1]].tolist()):
                good[max(s, e - length + 1, lo) - lo : max(0, min(e, hi) - lo)] = False
            edge = np.ones(hi - lo, bool)
            edge[1:] = (at[1:] != at[:-1]) | (good[1:] != good[:-1])
            first = np.nonzero(edge)[0]
            count = np.diff(np.append(first, hi - lo))
            keep = good[first]
            first, count = first[keep], count[keep]
            if not len(first):
                continue
            anchor = _mix(h[at[first]] + _A)
            size = (count + length - 1).astype(np.int64)
            c = size.astype(np.uint64) * _A
            for k in range(0, (length - 8) // 8 + 1):  # words from the left cover the first window
                c = _mix(c ^ view[first + 8 * k]) + _C
            for k in range(1, (MOST_WINDOWS + 14) // 8 + 2):  # words from the right cover what is beyond it
                c = _mix(c ^ view[np.maximum(first, first + size - 8 * k)]) + _B
            out.append((anchor, c, first + lo, count, at[first] + lo))
    if not out:
        return tuple(np.empty(0, d) for d in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def sides(data: np.ndarray, first: np.ndarray, size: np.ndarray, anchor: np.ndarray, length: int) -> list[np.ndarray]:
    """Of segments in flat bytes: short hashes of their anchors with bytes on both sides; 0 for those that haven't so many.

    A window with from a to b bytes left of the anchor holds a bytes left of it and length - gram - b right of it.
    """
    gram = gram_size(length)
    span = length - gram + 1
    cuts = [span * k // SIDES for k in range(SIDES + 1)]
    view, out = words_at(np.append(data, np.zeros(8, np.uint8))), []
    for left, beyond in zip(cuts, cuts[1:]):
        right = span - beyond
        n, start = left + gram + right, anchor - left
        fits = (beyond > left) & (start >= first) & (start + n <= first + size)
        h = np.zeros(len(first), np.uint16)
        start = start[fits]
        x = np.full(len(start), _A)
        with np.errstate(over="ignore"):
            for o in [*range(0, n - 7, 8), n - 8]:
                x = (x ^ view[start + o]) * _B
                x ^= x >> np.uint64(29)
            h[fits] = np.maximum(_mix(x) >> np.uint64(48), np.uint64(1))
        out.append(h)
    return out


class Block:
    """A block's rows as flat bytes, their segments, and the distinct ones in order of (anchor, segment)."""

    def __init__(self, rows: pa.Table, id_col: str, text_col: str, length: int):
        text = rows[text_col].combine_chunks().cast(pa.large_binary())
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.large_binary())
        self.texts = [t or b"" for t in text.to_pylist()]
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        ids = rows[id_col].combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.int64())
        self.ids = ids.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        a, c, self.first, self.count, self.anchor = segments(self.data, self.ends, length)
        self.owner = self.ids[np.searchsorted(self.ends, self.first, side="right")] if len(self.first) else np.empty(0, np.int64)
        order = np.lexsort((c, a))  # stable: rows stand by id, so the first of equal segments is the smallest's
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.rep = order[new]
        self.a, self.c, self.least = a[self.rep], c[self.rep], self.owner[self.rep]

    def buckets(self, n: int) -> Iterator[tuple[int, slice]]:
        """Ranges of distinct segments by bucket of their anchor."""
        if len(self.a):
            b = ((self.a >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            cuts = np.nonzero(np.append(True, b[1:] != b[:-1]))[0]
            for lo, hi in zip(cuts, np.append(cuts[1:], len(b))):
                yield int(b[lo]), slice(int(lo), int(hi))


def _told(messages: list[bytes], kind: int) -> list[list[np.ndarray]]:
    return [unpack(m[1:]) for m in messages if m[0] == kind]


def _compare(_: int, blocks: list[int], messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """A bucket's reply on segments: their smallest document, where another block has it; and whose bytes are needed."""
    parts = [unpack(m) for m in messages]
    of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    a, c, d, e, *near = (np.concatenate([p[k] for p in parts]) for k in range(4 + SIDES))
    order = np.lexsort((d, c, a))
    a, c, d, e, of = a[order], c[order], d[order], e[order], of[order]
    new_a = np.append(True, a[1:] != a[:-1])
    new_c = new_a | np.append(True, c[1:] != c[:-1])
    least = d[np.nonzero(new_c)[0]][np.cumsum(new_c) - 1]
    group = np.cumsum(new_a) - 1
    kinds = np.bincount(group, weights=new_c)[group]
    heads = np.nonzero(new_a)[0]
    many = np.minimum.reduceat(d, heads) != np.maximum.reduceat(d, heads)
    several = np.nonzero((kinds > 1) & many[group])[0]
    wanted = np.zeros(len(a), bool)
    for x in near:
        x = x[order[several]].astype(np.int64)
        rows = several[x > 0]
        key = group[rows] << 16 | x[x > 0]
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        begin = np.nonzero(np.append(True, key[1:] != key[:-1]))[0] if len(key) else []
        if len(begin):
            differ = [np.minimum.reduceat(v[rows], begin) != np.maximum.reduceat(v[rows], begin) for v in (c, d)]
            wanted[rows] |= np.repeat(differ[0] & differ[1], np.diff(np.append(begin, len(rows))))
    wanted &= d == least
    for k in np.unique(of[(least < d) | wanted]).tolist():
        mine = of == k
        low, want = mine & (least < d), mine & wanted
        yield blocks[k], b"\x00" + pack([e[low], least[low], e[want]])


def _index(length: int, chunk: int, blocks: list[int], messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """A bucket's reply on segments with bytes: their windows that also stand in a smaller document, as bits of a long."""
    parts = [unpack(m) for m in messages]
    of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    a, size, d, e = (np.concatenate([p[k] for p in parts]) for k in range(4))
    data = np.concatenate([p[4] for p in parts])
    size = size.astype(np.int64)
    begin = np.cumsum(size) - size
    order = np.lexsort((d, a))
    bits = np.zeros(len(a), np.uint64)

    def flat(rows: np.ndarray) -> np.ndarray:
        n = size[rows]
        return data[np.repeat(begin[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def mark(indexed: np.ndarray, streamed: np.ndarray) -> None:
        index = RunLengthIndex(flat(indexed), size[indexed], length)
        found = index.earlier(flat(streamed), size[streamed], d[streamed], d[indexed])
        n = size[streamed]
        at = np.nonzero(found)[0]
        row = np.searchsorted(np.cumsum(n), at, side="right")
        shift = (at - (np.cumsum(n) - n)[row]).astype(np.uint64)
        np.bitwise_or.at(bits, streamed[row], np.uint64(1) << shift)

    heads = np.nonzero(np.append(True, a[order][1:] != a[order][:-1]))[0]
    tails = np.append(heads[1:], len(order))
    total = np.cumsum(size[order])
    lo = 0
    while lo < len(heads):
        base = total[heads[lo]] - size[order[heads[lo]]]
        hi = max(lo + 1, int(np.searchsorted(total[tails - 1], base + chunk, side="right")))
        rows = order[heads[lo] : tails[hi - 1]]
        part = np.append(0, np.nonzero(np.diff((np.cumsum(size[rows]) - 1) // chunk))[0] + 1)
        for x, y in zip(part, np.append(part[1:], len(rows))):
            mark(rows[x:y], rows[x:])  # what stands before has smaller documents: nothing of this part is earlier there
        lo = hi
    for k in np.unique(of[bits != 0]).tolist():
        mine = (of == k) & (bits != 0)
        yield blocks[k], b"\x01" + pack([e[mine], bits[mine]])


def removed_bytes(block: Block, messages: list[bytes], length: int) -> np.ndarray:
    """Whether each byte of the block goes."""
    least, bits = block.least.copy(), np.zeros(len(block.a), np.uint64)
    for e, low, _ in _told(messages, 0):
        least[e] = low
    for e, b in _told(messages, 1):
        bits[e] |= b
    change = np.zeros(len(block.data) + 1, np.int64)
    whole = block.owner > least[block.entry]
    np.add.at(change, block.first[whole], 1)
    np.add.at(change, block.first[whole] + block.count[whole] + length - 1, -1)
    some = np.nonzero(~whole & (bits[block.entry] != 0))[0]
    for o in range(MOST_WINDOWS):
        hit = some[(bits[block.entry[some]] >> np.uint64(o)) & np.uint64(1) == 1]
        np.add.at(change, block.first[hit] + o, 1)
        np.add.at(change, block.first[hit] + o + length, -1)
    return np.cumsum(change[:-1]) > 0


def dedup_blocks(blocks: DataFrame, id_col: str, text_col: str, length: int, last: Callable[[pa.Table, Block, np.ndarray], pa.Table], schema) -> DataFrame:
    """Rows that ``last`` makes of each block's rows and marked bytes."""
    if length < 16:
        raise ValueError("length: at least 16 bytes")
    n, chunk = bucket_count(blocks), CHUNK

    def distinct(payload: bytes, _) -> Iterator[tuple[int, bytes]]:
        block = Block(unpack_rows(payload), id_col, text_col, length)
        near = sides(block.data, block.first[block.rep], block.count[block.rep] + length - 1, block.anchor[block.rep], length)
        for b, s in block.buckets(n):
            yield b, pack([block.a[s], block.c[s], block.least[s], np.arange(s.start, s.stop, dtype=np.int32), *(x[s] for x in near)])

    def texts(payload: bytes, messages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        asked = [w for _, _, w in _told(messages, 0) if len(w)]
        if not asked:
            return
        block = Block(unpack_rows(payload), id_col, text_col, length)
        want = np.zeros(len(block.a), bool)
        want[np.concatenate(asked)] = True
        for b, s in block.buckets(n):
            e = np.nonzero(want[s])[0] + s.start
            if len(e):
                first, size = block.first[block.rep[e]], block.count[block.rep[e]] + length - 1
                at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                yield b, pack([block.a[e], size.astype(np.int16), block.least[e], e.astype(np.int32), block.data[at]])

    def cut(payload: bytes, messages: list[bytes]) -> pa.Table:
        rows = unpack_rows(payload)
        block = Block(rows, id_col, text_col, length)
        return last(rows, block, removed_bytes(block, messages, length))

    first = answer(ask(blocks, distinct), _compare)
    second = answer(ask(blocks, texts, [first]), lambda _, b, m: _index(length, chunk, b, m))
    return finish(blocks, [first, second], cut, schema)


def _pieces(block: Block, gone: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    lo = 0
    for text, hi in zip(block.texts, block.ends.tolist()):
        yield text, gone[lo:hi]
        lo = hi


def kept_bytes(text: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, spans array<struct<start long, end long>>, kept binary): a row for each row of ``docs``.

    Null text: as an empty one. A null id stands after all others; rows of one id, or with null ids, are not smaller
    than each other, so repeated rows keep what only they share. Texts under ``length`` bytes lose nothing. Spans are
    the maximal removed runs, in order; ``kept`` the bytes left, which may cut a character. No rows give no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def last(table: pa.Table, block: Block, gone: np.ndarray) -> pa.Table:
        ids, sizes, cuts, kept = table["id"].combine_chunks(), [], [], []
        for text, g in _pieces(block, gone):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
            sizes.append(len(text))
            cuts.append([{"start": s, "end": e} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())])
            kept.append(kept_bytes(text, g))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table([ids, pa.array(sizes, pa.int64()), pa.array(cuts, pa.list_(span)), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return dedup_blocks(to_blocks(rows, "text", "id"), "id", "text", length, last, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the text that is left; all columns and rows stay. What a cut leaves of a character is dropped.

    Null texts stay null. Otherwise as ``spans``.
    """
    schema = docs.schema

    def last(table: pa.Table, block: Block, gone: np.ndarray) -> pa.Table:
        null = table[text_col].is_null().to_pylist()
        texts = [None if n else kept_bytes(t, g).decode("utf-8", "ignore") for n, (t, g) in zip(null, _pieces(block, gone))]
        k = table.schema.get_field_index(text_col)
        return table.set_column(k, text_col, pa.array(texts, pa.string()))

    if not isinstance(schema[text_col].dataType, T.StringType):
        raise TypeError("the text column must be a string")
    return dedup_blocks(to_blocks(docs, text_col, id_col), id_col, text_col, length, last, schema)


def op3_rindex(spark, sf_dir: str) -> DataFrame:
    """Contract of op3 over all of ``documents``."""
    done = spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
