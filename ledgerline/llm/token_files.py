"""Token-id files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds
the first chunk of every id and a bitmap that says whether the id goes on; level
k holds the next chunk of those that do. A rank directory stores the number of
set bits before each block of 512, so the chunk of any token at the next level
is found by one look-up and one population count: a token is read without
decoding its neighbours.

A file set is a Parquet folder in the shared place, one row a segment: whole
documents in ascending doc_id, about ``SEGMENT_IDS`` ids (a longer document
has a segment of its own), with the documents' ids and lengths beside the codes.
Parquet's commit protocol makes the write safe when executors are lost.

Defined cases: a null text is empty and still has the end id; a null doc_id
sorts first; rows of one doc_id follow each other in the order of their texts;
an empty table writes no segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, text_of, texts_of
from ledgerline.llm.tokens import default_path, encoder
from ledgerline.session import scratch_dir

CHUNK_BITS = 8
RANK_BLOCK = 512
SEGMENT_IDS = 1 << 20
END_ID = 1


class Codes:
    """Directly addressable codes of an array of unsigned 32-bit ids."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int):
        self.levels, self.n = levels, n  # (chunks, continuation bits packed, ranks)

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            chunk = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
            rest = rest >> np.uint32(CHUNK_BITS)
            more = rest > 0
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BLOCK // 8), np.uint8)])
            per_block = np.bitwise_count(bits.reshape(-1, RANK_BLOCK // 8)).sum(axis=1, dtype=np.uint32)
            ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(per_block, dtype=np.uint32)])
            levels.append((chunk, bits, ranks))
            rest = rest[more]
            if not len(rest):
                return cls(levels, len(ids))

    def to_bytes(self) -> bytes:
        out = [struct.pack("<4sQB", b"DAC1", self.n, len(self.levels))]
        for chunk, bits, ranks in self.levels:
            out += [struct.pack("<QQQ", len(chunk), len(bits), len(ranks)), chunk.tobytes(), bits.tobytes(),
                    ranks.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Codes:
        magic, n, count = struct.unpack_from("<4sQB", raw)
        if magic != b"DAC1":
            raise ValueError("not a code segment")
        at, levels = 13, []
        for _ in range(count):
            a, b, c = struct.unpack_from("<QQQ", raw, at)
            at += 24
            levels.append((np.frombuffer(raw, np.uint8, a, at), np.frombuffer(raw, np.uint8, b, at + a),
                           np.frombuffer(raw, "<u4", c, at + a + b)))
            at += a + b + 4 * c
        return cls(levels, n)

    def decode(self) -> np.ndarray:
        """All ids, level by level."""
        out = np.zeros(self.n, np.uint32)
        where = np.arange(self.n)
        for k, (chunk, bits, _) in enumerate(self.levels):
            out[where] |= chunk.astype(np.uint32) << np.uint32(k * CHUNK_BITS)
            where = where[np.unpackbits(bits, count=len(chunk), bitorder="little").view(bool)]
        return out

    def access(self, positions: np.ndarray) -> np.ndarray:
        """Ids at ``positions``, each by its own path through the levels."""
        pos = np.asarray(positions, np.int64)
        if len(pos) and (pos.min() < 0 or pos.max() >= self.n):
            raise IndexError("position outside the segment")
        out = np.zeros(len(pos), np.uint32)
        live = np.arange(len(pos))
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            if not len(live):
                break
            out[live] |= chunk[pos].astype(np.uint32) << np.uint32(k * CHUNK_BITS)
            on = (bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1
            pos, live = pos[on], live[on]
            block = pos // RANK_BLOCK
            words = bits.reshape(-1, RANK_BLOCK // 64, 8).view("<u8")[..., 0]  # (blocks, 8)
            upto = pos % RANK_BLOCK
            full = np.clip(upto[:, None] - 64 * np.arange(RANK_BLOCK // 64), 0, 64).astype(np.uint64)
            mask = np.where(full == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (full & np.uint64(63))) - np.uint64(1))
            pos = ranks[block] + np.bitwise_count(words[block] & mask).sum(axis=1)
            pos = pos.astype(np.int64)
        return out


_SEGMENT = ("part int, seg int, first_doc long, last_doc long, n_docs int, n_ids long, doc_ids binary, "
            "doc_nulls binary, lengths binary, codes binary")


def _pack(path: str, kind: str, end_id: int):
    """Rows sorted by doc_id to segments."""
    def segment(part, seg, docs, raws):
        ids = np.frombuffer(b"".join(raws), "<u4")
        known = [d for d in docs if d is not None]
        return pa.RecordBatch.from_pylist([{
            "part": part, "seg": seg, "first_doc": known[0] if known else None, "last_doc": known[-1] if known else None,
            "n_docs": len(docs), "n_ids": len(ids), "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
            "doc_nulls": np.packbits(np.array([d is None for d in docs])).tobytes(),
            "lengths": np.array([len(r) // 4 for r in raws], "<i8").tobytes(), "codes": Codes.of(ids).to_bytes()}],
            schema=pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                              ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()),
                              ("doc_nulls", pa.binary()), ("lengths", pa.binary()), ("codes", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, kind), np.array([end_id], "<u4").tobytes()
        part, seg, docs, raws, held = TaskContext.get().partitionId(), 0, [], [], 0
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for i, j, texts in texts_of(b, "_q_text"):
                for d, raw in zip(ids[i:j], enc.encode(texts)):
                    docs.append(d)
                    raws.append(raw + end)
                    held += len(raw) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield segment(part, seg, docs, raws)
                        seg, docs, raws, held = seg + 1, [], [], 0
        if docs:
            yield segment(part, seg, docs, raws)

    return run


def write_tokens(docs: DataFrame, out: str, path: str | None = None, kind: str = "word", end_id: int = END_ID) -> None:
    """Token ids of all documents, each with ``end_id`` appended, as segments under ``out``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_q_text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_q_text")
    (ordered.mapInArrow(_pack(path or default_path("word_bpe_49k.json"), kind, end_id), _SEGMENT)
     .write.option("compression", "zstd").parquet(out))


def segments(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def segment_starts(seg: DataFrame) -> DataFrame:
    """part, seg, base: ids before each segment; sums within parts, then over parts
    (the only ordering without a key is over one row a part)."""
    sizes = seg.select("part", "seg", "n_ids")
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_q_before"))
    return (sizes.withColumn("_q_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(before, "part")
            .select("part", "seg", (F.col("_q_before") + F.col("_q_in")).cast("long").alias("base")))


def _doc_ids(raw: bytes, nulls: bytes, n: int) -> list:
    gone = np.unpackbits(np.frombuffer(nulls, np.uint8), count=n)
    return [None if g else d for d, g in zip(np.frombuffer(raw, "<i8").tolist(), gone)]


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            ids = Codes.from_bytes(r["codes"]).decode().astype("<u4")
            lens = np.frombuffer(r["lengths"], "<i8")
            ends = np.cumsum(lens)
            n = len(lens)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["part"]] * n, pa.int32()), pa.array([r["seg"]] * n, pa.int32()),
                 pa.array(_doc_ids(r["doc_ids"], r["doc_nulls"], n), pa.int64()), pa.array(ends - lens), pa.array(lens),
                 pa.array([zlib.crc32(ids[e - k:e].tobytes()) for e, k in zip(ends.tolist(), lens.tolist())], pa.int64())],
                ["part", "seg", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the files."""
    seg = segments(spark, out)
    rows = seg.mapInArrow(_unpack, "part int, seg int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return (rows.join(segment_starts(seg), ["part", "seg"])
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def read_tokens(spark: SparkSession, out: str, wanted: DataFrame) -> DataFrame:
    """Random access: ``wanted(pos)`` are global positions; returns (pos, token).
    Positions go to their segments by a range join on few segments, and only the
    wanted tokens' chunks are touched."""
    seg = segments(spark, out)
    spans = (segment_starts(seg).join(seg.select("part", "seg", "n_ids"), ["part", "seg"])
             .withColumn("stop", F.col("base") + F.col("n_ids")))
    cell = SEGMENT_IDS  # equi-join on coarse cells instead of a range comparison of all with all
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("base") / cell), F.floor((F.col("stop") - 1) / cell))))
    asked = wanted.select(F.col("pos").cast("long").alias("pos"), F.floor(F.col("pos") / cell).alias("cell"))
    placed = (asked.join(cells, "cell").where("pos >= base AND pos < stop")
              .select("part", "seg", "pos", (F.col("pos") - F.col("base")).alias("inside")))

    def pick(batches):
        for b in batches:
            for r in b.to_pylist():
                got = Codes.from_bytes(r["codes"]).access(np.array([x["inside"] for x in r["asked"]], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([x["pos"] for x in r["asked"]], pa.int64()),
                                                  pa.array(got.astype(np.int64))], ["pos", "token"])

    lists = placed.groupBy("part", "seg").agg(F.collect_list(F.struct("pos", "inside")).alias("asked"))
    return lists.join(seg.select("part", "seg", "codes"), ["part", "seg"]).mapInArrow(pick, "pos long, token long")


def op9_token_files(spark, sf_dir):
    out = scratch_dir(spark, "token-files")
    write_tokens(documents(spark, sf_dir), out)
    return read_documents(spark, out)
