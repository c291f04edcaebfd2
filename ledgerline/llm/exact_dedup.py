"""Exact dedup over an extendible-hash index.

The index maps a 64-bit hash of a text to a chain of distinct texts. Its
directory has 2^g slots, one for each g-bit prefix of the hash; a bucket is
named by all slots that share its local depth's prefix. While some bucket
holds more distinct hashes than its capacity it is split, and when its local
depth equals g the directory doubles first. Depth stops at ``max_depth``, so a
directory is at most 2^max_depth bytes whatever the data (the only thing that
is sent to tasks); buckets at that depth grow chains instead and stay exact.

Rows with equal texts are combined inside each map task before any shuffle, so
a text that holds a third of all rows reaches its owner as one row per map
task. An owner task holds whole buckets (key ranges), sorts by hash, chains the
distinct texts of one hash, and compares bytes. Entries are written to the
shared folder: (bucket, hash, chain position, kept id, rows, SHA-256).

Defined cases: a null text is the empty text; a null ``doc_id`` never wins over
a number, and a group of only null ids keeps ``keep_id`` null with its rows
``kept``; repeated rows of one winning id are all reported ``kept`` (they are
one document) while :func:`deduplicate` returns one row of them; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, released, saved, text_of

BUCKET_KEYS = 512       # distinct hashes in a bucket before it is split
MAX_DEPTH = 20          # directory of at most 2^20 slots, one byte each
COMBINE_BYTES = 16 << 20  # texts held by a map task while it combines equal rows


class Directory:
    """Local depth of the bucket of each slot."""

    def __init__(self, depths: np.ndarray):
        self.depths = depths
        self.depth = int(len(depths)).bit_length() - 1

    @classmethod
    def grow(cls, counts: np.ndarray, capacity: int) -> Directory:
        """``counts``: distinct hashes under each prefix of the greatest depth.
        Starts with one bucket and splits overfull ones, doubling as needed."""
        deepest = int(len(counts)).bit_length() - 1
        depths = np.zeros(1, np.uint8)
        for d in range(deepest):
            under = counts.reshape(1 << d, -1).sum(axis=1)
            over = (depths == d) & (under > capacity)  # buckets at this depth that must split
            if not over.any():
                break
            depths = np.repeat(np.where(over, d + 1, depths).astype(np.uint8), 2)  # doubled
        return cls(depths)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        """First slot of the bucket of each hash, as if the directory had 2^MAX_DEPTH slots."""
        top = hashes.astype(np.int64).view(np.uint64) >> np.uint64(64 - MAX_DEPTH)
        depth = self.depths[(top >> np.uint64(MAX_DEPTH - self.depth)).astype(np.int64)].astype(np.uint64)
        rest = np.uint64(MAX_DEPTH) - depth
        return ((top >> rest) << rest).astype(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (never null) and its 64-bit hash."""
    t = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("h"))


def build_directory(keys: DataFrame, capacity: int = BUCKET_KEYS) -> Directory:
    """From a histogram of distinct hashes by prefix, at most 2^MAX_DEPTH counts."""
    total = keys.agg(F.approx_count_distinct("h")).first()[0]
    deepest = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(2, total / capacity))) + 3))
    prefix = F.shiftrightunsigned("h", 64 - deepest)
    counts = np.zeros(1 << deepest, np.int64)
    for r in (keys.select("h").distinct().groupBy(prefix.alias("p")).agg(F.count("*").alias("n"))).toLocalIterator():
        counts[r.p] = r.n
    return Directory.grow(counts, capacity)


_ROUTED = "bucket long, h long, text binary, keep_id long, n long"
_ENTRY = "bucket long, h long, chain int, keep_id long, n long, sha string"


def _later(a, b):
    return b if a is None else a if b is None else max(a, b)


def _combine(directory: Directory):
    def flush(table: dict) -> pa.RecordBatch:
        h = np.fromiter((k[0] for k in table), np.int64, len(table))
        return pa.RecordBatch.from_arrays(
            [pa.array(directory.bucket(h)), pa.array(h), pa.array([k[1] for k in table], pa.binary()),
             pa.array([v[0] for v in table.values()], pa.int64()), pa.array([v[1] for v in table.values()], pa.int64())],
            ["bucket", "h", "text", "keep_id", "n"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict = {}
        held = 0
        for b in batches:
            ids, hashes, raw = b.column("doc_id").to_pylist(), b.column("h").to_pylist(), b.column("text").cast(pa.binary())
            for k, (i, h) in enumerate(zip(ids, hashes)):
                t = raw[k].as_py()
                got = table.get((h, t))
                if got is None:
                    table[h, t] = [i, 1]
                    held += len(t) + 200
                    if held > COMBINE_BYTES:
                        yield flush(table)
                        table, held = {}, 0
                else:
                    got[0], got[1] = _later(got[0], i), got[1] + 1
        if table:
            yield flush(table)

    return run


@released
def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and hash: chain the distinct texts of a hash."""
    names = ["bucket", "h", "chain", "keep_id", "n", "sha"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def links(bucket, h, chain):
        return [(bucket, h, k, e[1], e[2], hashlib.sha256(e[0]).hexdigest()) for k, e in enumerate(chain)]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    at, chain, out = None, [], []
    for b in batches:
        for bucket, h, text, keep, n in zip(*(b.column(c).to_pylist() for c in ("bucket", "h", "text", "keep_id", "n"))):
            if at != (bucket, h):
                if chain:
                    out += links(*at, chain)
                at, chain = (bucket, h), []
            for e in chain:
                if e[0] == text:  # bytes, not hashes
                    e[1], e[2] = _later(e[1], keep), e[2] + n
                    break
            else:
                chain.append([text, keep, n])
        if len(out) > 5000:
            yield pack(out)
            out = []
    if chain:
        out += links(*at, chain)
    if out:
        yield pack(out)


def build_index(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """The index's entries, written to the shared folder."""
    keys = keyed(docs)
    directory = build_directory(keys, capacity)
    routed = keys.mapInArrow(_combine(directory), _ROUTED)
    owned = routed.repartition("bucket").sortWithinPartitions("bucket", "h").mapInArrow(_own, _ENTRY)
    return saved(owned, "exact-index")


def exact_groups(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``."""
    entries = build_index(docs, capacity).select("h", F.col("sha").alias("text_sha256"), "keep_id",
                                                 F.col("n").alias("group_size"))
    rows = keyed(docs).select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    return (rows.join(entries, ["h", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def deduplicate(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """One row of each distinct text, that of the largest doc_id, with all columns of ``docs``."""
    entries = build_index(docs, capacity).select(F.col("h").alias("_q_h"), F.col("sha").alias("_q_sha"),
                                                 F.col("keep_id").alias("_q_keep"))
    t = text_of()
    rows = docs.withColumn("_q_h", F.xxhash64(t)).withColumn("_q_sha", F.sha2(t, 256))
    won = rows.join(entries, ["_q_h", "_q_sha"]).where(F.col("doc_id").eqNullSafe(F.col("_q_keep")))
    first = F.row_number().over(Window.partitionBy("_q_h", "_q_sha").orderBy("doc_id"))  # repeated rows of one id
    return won.withColumn("_q_n", first).where("_q_n = 1").select(*docs.columns)


def op6_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir))


SQL = {"op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""}
