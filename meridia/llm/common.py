"""Pieces that the corpus operators share: tables, lineage cuts, words, internal names."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six characters (space, \t, \n, \v, \f, \r).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
#: A long text is read in pieces of about so many bytes, so that its words never stand in memory together.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir``.

    Where none is set, a local run takes a temporary folder; a cluster's machines would not see it, so there it is an error.
    """
    context = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir", "") and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="meridia-checkpoint-"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of what shuffles that nothing refers to any longer hold on the executors' disks.

    Spark removes them when their handles on the driver are collected, which a driver with little to do puts off for long.
    """
    gc.collect()
    # Python's own handles are given back by a thread beside, which looks for them once a second
    handles, until = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ()), time.monotonic() + 3
    while handles and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.05)
    spark.sparkContext._jvm.java.lang.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a text, empty for a null one."""
    return F.coalesce(F.col(f"`{column}`").cast("binary"), F.lit(b""))


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Cut a text at white space into pieces of about ``size`` bytes; a word is never cut."""
    at, n = 0, len(text)
    while n - at > size:
        ends = [e for c in SPACES if (e := text.find(bytes([c]), at + size, at + 2 * size)) >= 0]
        if not ends:  # a word of over size bytes: look as far as it goes
            ends = [e for c in SPACES if (e := text.find(bytes([c]), at + size)) >= 0]
        if not ends:
            break
        yield text[at : (at := min(ends))]
    yield text[at:]


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; ``bytes.split`` knows exactly the six characters of ``SPACES``."""
    for piece in pieces(text):
        yield piece.split()


def ascii_lower(text: bytes) -> bytes:
    """A-Z only, as ``bytes.lower`` does."""
    return text.lower()
