"""Shared helpers: reading tables, Arrow text buffers, bounded bitmaps, components.

Conventions of every operator in this package: a null ``text`` counts as the
empty text, rows with a null ``doc_id`` are kept, extra columns are ignored
(working columns carry the prefix ``_q_``), and an empty table gives an empty
result with the same schema.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

TASK_ROWS = 100_000  # ids or pairs of ids that are worth a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(col: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage so that a
    lost executor never replays what came before."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many small rows, in as many tasks as these need: joins and groups
    of what little is left shuffle nothing when one task is enough."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def kept(df: DataFrame, tag: str, rows: int) -> DataFrame:
    """Like :func:`saved`, fitted to its rows as it is written and as it is read."""
    return fitted(saved(fitted(df, rows), tag), rows)


# -- Arrow ----------------------------------------------------------------------
def buffers(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string or binary array (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string()).cast(pa.large_binary())
    else:
        arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, offs, data = arr.buffers()
    if offs is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer one stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def texts_of(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """First and last row and the texts of parts of a batch of about ``limit``
    bytes, so that few Python strings are held at a time."""
    col = batch.column(column)
    _, offsets = buffers(col)
    for i, j in slices(offsets, limit):
        yield i, j, col.slice(i, j - i).to_pylist()


class Memo(dict):
    """What ``make`` gives for a string, remembered in two generations of ``size``
    entries: the older one goes when the newer is full, so what is used again
    stays. Long strings are not kept."""

    def __init__(self, make: Callable[[str], Any], size: int, longest: int = 100):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key: str):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


# -- memory of Python workers ------------------------------------------------------
def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator]) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """``run`` for ``mapInArrow``, giving what its task has freed back to the machine: Spark keeps
    Python workers for later tasks, and each would keep the most it ever held beside the executor."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator:
        yield from run(batches)
        _give_back()

    return task


class Sent:
    """An array that tasks index: sent once for all steps that read it, and held once by a worker."""

    def __init__(self, spark: SparkSession, array: np.ndarray):
        self.held = spark.sparkContext.broadcast(array)

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.held.value[places]


# -- 64-bit hashing in numpy -------------------------------------------------------
def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


# -- connected components ------------------------------------------------------------
def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of each node in ``edges(a, b)``; root is the smallest node id.

    Each round every node takes the smallest of itself and its neighbours, then what that one
    took, and the edges are rewritten to what their ends took: ends that are equal and
    repeated edges fall away, so rounds shrink to the few nodes that still
    stand for others. The rounds are then undone from the last to the first, which gives
    every node its root. Tables are written to the shared folder between rounds; only a count reaches the driver.
    """
    left = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    taken: list[tuple[DataFrame, int]] = []
    for _ in range(max_rounds):
        n = left.count()
        if not n:
            break
        left = fitted(left, n)
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        first = kept(both.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("m")).select("node", F.least("node", "m").alias("up")), "first", 2 * n)
        second = first.select(F.col("node").alias("up"), F.col("up").alias("root"))
        of = kept(first.join(second, "up").select("node", "root"), "taken", 2 * n)
        taken.append((of, 2 * n))
        moved = (left.join(of.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                 .join(of.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b"))
        left = kept(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a <> b").distinct(), "edges", n)
    else:
        raise RuntimeError("components did not settle")
    if not taken:
        return left.select(F.col("a").alias("node"), F.col("a").alias("root"))
    roots, _ = taken.pop()
    while taken:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        before, n = taken.pop()
        roots = kept(before.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "labels", n)
    return roots
