"""Best-fit packing with certified bounds.

Documents become token ids plus an end id; only one longer than a sequence is
cut: its first piece takes the remainder, the others are full sequences of
their own. The rest are dealt to partitions of about ``PART_ITEMS`` pieces, and
each is packed by best-fit decreasing. Dual feasible functions give a lower
bound on the sequences a partition needs; where the count equals the bound the
partition is certified: it keeps its sequences, but for those less than half
full. Partitions with a gap keep their full sequences only. The pieces of the
others form one pool, which is dealt anew to fewer partitions (documents change
partition), and best-fit decreasing runs again, until the pool is empty or a round does not
lower the count; such a round is not taken. Pieces are dealt by a number each got when
it was written, so repeated rows part too.

Defined cases: a null text is empty and still has the end id; repeated rows are
packed once each; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, released, saved, text_of, texts_of
from ledgerline.llm.tokens import default_path, encoder

SEQUENCE = 1024
END_ID = 2
PART_ITEMS = 8192
FULL = 1 << 62  # sequence ids of pieces that fill one by themselves

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
ROW = "_q_row"  # number of a written piece


# -- bounds and packing of one partition -----------------------------------------------
def lower_bound(lengths: np.ndarray, capacity: int = SEQUENCE) -> int:
    """The greatest bound of two families of dual feasible functions, on a histogram."""
    if not len(lengths):
        return 0
    hist = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((hist * size).sum()) // capacity)
    # f_e: over C - e counts whole, under e counts nothing
    count_from = np.cumsum(hist[::-1])[::-1]           # items of at least s
    total_from = np.cumsum((hist * size)[::-1])[::-1]  # their sizes
    for e in range(1, capacity // 2 + 1):
        large = int(count_from[capacity - e + 1])
        middle = int(total_from[e] - total_from[capacity - e + 1])
        best = max(best, large + -(-middle // capacity))
    # u_k: (k + 1) s / C rounded down unless whole, over k
    for k in range(1, 31):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        value = np.where(whole, size * k, (scaled // capacity) * capacity)  # times k
        best = max(best, -(-int((hist * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = SEQUENCE) -> np.ndarray:
    """Bin of each piece, best-fit decreasing. Bins are kept by the room they
    have left; a bit mask finds the least room that suffices."""
    order = np.argsort(-lengths, kind="stable")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    out = np.zeros(len(lengths), np.int64)
    sizes = lengths.tolist()
    for k in order.tolist():
        s = sizes[k]
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, bins
            bins += 1
        out[k] = b
        left = r - s
        if left:
            room[left].append(b)
            mask |= 1 << left
    return out


def _pack(round_no: int, capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        bins = best_fit(lengths, capacity)
        count, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
        part = int(rows["part"].iloc[0])
        order = np.lexsort((np.arange(len(rows)), bins))
        rows, bins = rows.iloc[order], bins[order]
        lengths = rows["length"].to_numpy()
        first = np.r_[True, bins[1:] != bins[:-1]]
        ends = np.cumsum(lengths)
        start = ends - lengths
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        out = rows[["doc_id", "piece", "start", "length", "ids_crc32", ROW]].copy()
        out["sequence_id"] = (np.int64(min(round_no, 15)) << 58) | (np.int64(part) << 26) | bins
        out["offset"] = start - np.maximum.accumulate(np.where(first, start, 0))
        out["part"], out["gap"] = part, count - bound
        out["fill"] = fill[bins]
        return out

    return run


PACKED = PIECE + f", {ROW} long, sequence_id long, offset long, part int, gap long, fill long"


def _deal(pool: DataFrame, count: int, round_no: int) -> DataFrame:
    parts = max(1, -(-count // (PART_ITEMS << min(round_no, 3))))
    by = F.pmod(F.xxhash64(ROW, F.lit(round_no)), F.lit(parts))
    return pool.select("doc_id", "piece", "start", "length", "ids_crc32", ROW, by.cast("int").alias("part"))


def _sequences(df: DataFrame) -> int:
    return df.where("offset = 0").count()


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """Each piece with sequence_id and offset."""
    whole = pieces.where(F.col("length") == capacity)
    pool = saved(pieces.where(F.col("length") < capacity).withColumn(ROW, F.monotonically_increasing_id()), "pool")
    count, done, k, before = pool.count(), [], 0, None
    while count:
        packed = saved(_deal(pool, count, k).groupBy("part").applyInPandas(_pack(k, capacity), PACKED), "packed")
        if before is not None and _sequences(packed) >= before:  # no better: what was there stays
            break
        again = (F.col("gap") > 0) & (F.col("fill") < capacity) | (F.col("fill") * 2 < capacity)
        final, rest = packed.where(~again), packed.where(again)
        done.append(final)
        last, pool = rest, rest
        before, count, k = _sequences(rest), rest.count(), k + 1
    if count:
        done.append(last)
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    result = whole.select(*out[:5], (F.lit(FULL) + F.monotonically_increasing_id()).alias("sequence_id"),
                          F.lit(0).cast("long").alias("offset"))
    for d in done:
        result = result.unionByName(d.select(*out))
    return result


# -- documents to pieces -----------------------------------------------------------------
def _cut(path: str, kind: str, capacity: int, end_id: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, kind), np.array([end_id], "<u4").tobytes()
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for i, j, texts in texts_of(b, "_q_text"):
                rows = []
                for d, raw in zip(ids[i:j], enc.encode(texts)):
                    raw += end
                    n = len(raw) // 4
                    at, size, k = 0, (n - 1) % capacity + 1, 0  # the first piece takes the remainder
                    while at < n:
                        rows.append((d, k, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                        at, size, k = at + size, capacity, k + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pack_documents(docs: DataFrame, path: str | None = None, kind: str = "byte", capacity: int = SEQUENCE,
                   end_id: int = END_ID) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_q_text"))
    pieces = saved(rows.mapInArrow(_cut(path or default_path("byte_bpe_50k.json"), kind, capacity, end_id), PIECE), "pieces")
    return pack_pieces(pieces, capacity)


def op10_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))
