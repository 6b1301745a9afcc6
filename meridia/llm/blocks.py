"""Documents in compressed blocks, and questions that blocks put to buckets.

A block is some megabytes of rows, packed once and written to the checkpoint folder. Work that needs corpus-wide
knowledge about keys (substrings, words) asks for it block by block: a block sends each bucket of keys one compressed
message on its distinct keys, a bucket answers each block, and the answers meet the blocks again. So what is shuffled
is aggregated by block first; a key that stands in a third of all rows is one entry for each block, and no task
gathers a key's rows. Blocks and answers are written dealt by the block's number, so that they meet without another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, release, shuffle_partitions

#: Text bytes of a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
BUCKETS_PER_PARTITION = 4
#: Partitions that blocks are dealt to, for each shuffle partition: few blocks each, so that tasks are even.
DEALT_PER_PARTITION = 4


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays to bytes: each sorted into byte planes, so that slowly changing high bytes compress."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts.append(a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + planes)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        dtype, n = np.dtype(data[at : at + 4].strip().decode()), int.from_bytes(data[at + 4 : at + 12], "little")
        size = n * dtype.itemsize
        planes = np.frombuffer(data, np.uint8, size, at + 12).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if n else np.empty(0, dtype))
        at += 12 + size
    return out


def pack_rows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_rows(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def settled(df: DataFrame) -> DataFrame:
    """Checkpointed, dealt by ``block``. Spark keeps note of that only where the plan is not adaptive, so it isn't for this one write.

    First the shuffles of steps before, whose results are written, are let go of.
    """
    release(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    was = conf.get(key)
    conf.set(key, "false")
    try:
        return checkpointed(df.repartition(DEALT_PER_PARTITION * shuffle_partitions(df.sparkSession), "block"))
    finally:
        conf.set(key, was)


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers from zero in the least type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def to_blocks(rows: DataFrame, text: str, order: str, encode: Callable[[pa.Table], bytes] = pack_rows, most: int = BLOCK_BYTES) -> DataFrame:
    """(block long, payload binary): the rows of ``rows``, ``most`` text bytes a block, by the long column ``order`` within it, encoded and settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, k = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def out():
            table = pa.Table.from_batches(held)
            table = table.take(pa.compute.sort_indices(table[order], null_placement="at_end"))
            return pa.RecordBatch.from_arrays([pa.array([first + k], pa.int64()), pa.array([encode(table)], pa.binary())], names=["block", "payload"])

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch[text]), 0).to_numpy()
            at = 0
            while at < len(lengths):
                upto = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), most - size, side="right")))
                held.append(batch.slice(at, upto - at))
                size += int(lengths[at:upto].sum())
                at = upto
                if size >= most // 2 and (size >= most or at < len(lengths)):
                    yield out()
                    held, size, k = [], 0, k + 1
        if held:
            yield out()

    return settled(rows.mapInArrow(run, "block long, payload binary"))


def bucket_count(blocks: DataFrame, per_partition: int = BUCKETS_PER_PARTITION) -> int:
    """Buckets of keys: in proportion to the shuffle partitions that the cluster is set to."""
    return per_partition * shuffle_partitions(blocks.sparkSession)


def _with(blocks: DataFrame, answers: list[DataFrame], what: Callable[[int, bytes, list[bytes]], pa.Table], schema) -> DataFrame:
    """What each block makes of its payload and of all messages to it. Blocks and answers are settled alike, so nothing is shuffled."""
    joined, names = blocks, [f"m{k}" for k in range(len(answers))]
    for name, a in zip(names, answers):
        joined = joined.join(a.groupBy("block").agg(F.collect_list("message").alias(name)).hint("merge"), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                messages = [m for c in batch.columns[2:] for m in c[k].as_py() or ()]
                yield from what(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), messages).to_batches()

    return joined.select("block", "payload", *names).mapInArrow(run, schema)


def ask(blocks: DataFrame, question: Callable[[bytes, list[bytes]], Iterator[tuple[int, bytes]]], answers: list[DataFrame] = ()) -> DataFrame:
    """(bucket int, block long, message binary) from every block's payload. ``answers``: messages to blocks, handed to ``question``."""

    def told(block: int, payload: bytes, messages: list[bytes]) -> pa.Table:
        found = list(question(payload, messages))
        return pa.table([pa.array([b for b, _ in found], pa.int32()), pa.array([block] * len(found), pa.int64()), pa.array([m for _, m in found], pa.binary())], names=["bucket", "block", "message"])

    return _with(blocks, list(answers), told, "bucket int, block long, message binary")


def answer(questions: DataFrame, reply: Callable[[int, list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(block long, message binary): what each bucket, given all messages to it, replies to blocks; settled."""

    def run(group: pa.Table) -> pa.Table:
        found = list(reply(group["bucket"][0].as_py(), group["block"].to_pylist(), group["message"].to_pylist()))
        return pa.table([pa.array([b for b, _ in found], pa.int64()), pa.array([m for _, m in found], pa.binary())], names=["block", "message"])

    return settled(questions.groupBy("bucket").applyInArrow(run, "block long, message binary"))


def finish(blocks: DataFrame, answers: list[DataFrame], last: Callable[[bytes, list[bytes]], pa.Table], schema) -> DataFrame:
    """Rows that each block makes of its payload and all messages to it."""
    return _with(blocks, answers, lambda _, payload, messages: last(payload, messages), schema)
