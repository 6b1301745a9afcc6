"""Best-fit packing into bins of several permitted sequence lengths.

Items are documents by their number of words; one over the largest length is cut into full pieces and a rest. A sequence
of length n costs ``OVERHEAD`` + n * (1 + n / ``SQUARE``): a step of its own, its places, and attention that grows with the
square. So a place is cheapest in a middling length, if that length can be filled, and the lengths are chosen jointly.

Items go in by decreasing size, each into the open bin that it leaves fullest. An item that no open bin holds opens one,
of the length that costs least for each word in it, when the bin is filled as the items still to come allow: for each
permitted length, ever the largest of them that fits is laid in, and the bin is downsized to its contents. At the end each
bin is downsized to the least permitted length that holds its contents. Items in one group and what is left of them are
known in whole, so no bin is opened by a rule for the group at large.

Scale. Groups are dealt by hash of the item and its place among equal ones, about ``GROUP_ITEMS`` to a group, however many
items one document or source has; each group is packed by itself, with bins' rest space in order of size. A group's loss
is under a bin of each length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, table

LENGTHS = (512, 1024, 2048, 4096)
SQUARE = 16_384
OVERHEAD = 256
GROUP_ITEMS = 20_000


def cost(length: int, square: int = SQUARE, overhead: int = OVERHEAD) -> float:
    return overhead + length * (1 + length / square)


class Remaining:
    """The sizes of the items still to come, with how many there are of each."""

    def __init__(self, sizes: list[int]):
        self.count: dict[int, int] = {}
        for n in sizes:
            self.count[n] = self.count.get(n, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            del self.count[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def fill(self, room: int) -> int:
        """How much of ``room`` is filled, ever with the largest that fits."""
        k, left = bisect_right(self.sizes, room) - 1, room
        while k >= 0 and left >= self.sizes[0]:
            size = self.sizes[k]
            n = min(self.count[size], left // size)
            left -= n * size
            k = min(k - 1, bisect_right(self.sizes, left) - 1)
        return room - left


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, square: int = SQUARE, overhead: int = OVERHEAD) -> tuple[list[list[int]], list[int]]:
    """Bins of places in ``sizes`` (decreasing, each at most the largest length) and each bin's length."""
    rest_of = Remaining(sizes)
    price = [cost(n, square, overhead) for n in lengths]

    def opening(size: int) -> int:
        """The length whose bin, opened by an item of ``size``, costs least for each word; the longer one of equals."""
        best: tuple[float, int] | None = None
        for n in lengths[bisect_left(lengths, size) :]:
            held = size + rest_of.fill(n - size)
            per = (price[bisect_left(lengths, held)] / held, -n)
            if best is None or per < best:
                best = per
        return -best[1]

    bins: list[list[int]] = []
    space: list[tuple[int, int]] = []  # (rest, -bin), ascending: the least rest that holds an item is the fullest bin
    for k, size in enumerate(sizes):
        rest_of.take(size)
        j = bisect_left(space, (size, -len(bins)))
        if j < len(space):
            rest, b = space.pop(j)
            b = -b
        else:
            rest, b = opening(size), len(bins)
            bins.append([])
        bins[b].append(k)
        if rest > size:
            insort(space, (rest - size, -b))
    return bins, [lengths[bisect_left(lengths, sum(sizes[k] for k in b))] for b in bins]


def pack_groups(items: DataFrame, lengths: tuple[int, ...], square: int, overhead: int, group_items: int) -> DataFrame:
    """Items (id long, piece int, first long, size long) -> with group, bin, bin_length and offset."""
    total = items.agg(F.count("*")).first()[0]
    groups = max(1, -(-total // group_items))

    def run(group: pa.Table) -> pa.Table:
        size = group["size"].to_numpy()
        order = np.lexsort((group["first"].to_numpy(), group["id"].fill_null(-1).to_numpy(), group["id"].is_null().to_numpy(), -size))
        group = group.take(pa.array(order))
        bins, held = pack(size[order].tolist(), lengths, square, overhead)
        n = group.num_rows
        number, length, offset = np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(n, np.int64)
        sizes = size[order]
        for b, ks in enumerate(bins):
            number[ks], length[ks] = b, held[b]
            offset[ks] = np.cumsum(sizes[ks]) - sizes[ks]
        for name, a in (("bin", number), ("bin_length", length), ("offset", offset)):
            group = group.append_column(name, pa.array(a))
        return group.select(["id", "piece", "first", "size", "group", "bin", "bin_length", "offset"])

    # equal items are told apart by where they stand, which a checkpoint keeps; which of them goes where makes no difference
    dealt = items.withColumn("group", F.pmod(F.xxhash64("id", "piece", "size", F.when(F.lit(groups > 1), F.monotonically_increasing_id())), F.lit(groups)).cast("int"))
    return dealt.groupBy("group").applyInArrow(run, "id long, piece int, first long, size long, group int, bin long, bin_length int, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS, square: int = SQUARE, overhead: int = OVERHEAD, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(id, piece, first, size, group, bin, bin_length, offset): a row for each piece of each row of ``docs``.

    Sizes are words. ``first`` is the piece's first word in its text, ``offset`` its place in its bin; (group, bin) names
    a bin. A text without words, or a null one, needs no place and gives no row. Equal rows are packed each. No rows give
    no rows. Rows that are written the same way give the same bins again.
    """
    lengths = tuple(sorted(set(lengths)))
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths: at least one, each at least 1")
    most = lengths[-1]
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")
    sized = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), words.alias("words")).where("words > 0")
    last = F.floor((F.col("words") - 1) / F.lit(most)).cast("int")
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    items = cut.select("id", "piece", (F.col("piece").cast("long") * most).alias("first"), F.least(F.lit(most).cast("long"), F.col("words") - F.col("piece").cast("long") * most).alias("size"))

    return pack_groups(checkpointed(items), lengths, square, overhead, group_items)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, by words, into sequences of 512 to 4,096."""
    done = pack_documents(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "piece", "first", "size", F.col("group").alias("bin_group"), "bin", "bin_length", "offset")
