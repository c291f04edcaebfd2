"""Benchmark decontamination by Wu-Manber search over words.

Test strings are runs of ``n`` words of the benchmark items (a shorter item is
one run). All runs of one length m form a pattern set with three tables:

* shift, by block of the last B words looked at: how far the window may move
  because no pattern has that block nearer to its end (m - B + 1 if none has it);
* buckets, by the same block where the shift is 0: the patterns that end in it;
* the patterns, compared word by word to confirm an occurrence.

The benchmark is a query set held against all rows in blocks: patterns are sent
to tasks ``BLOCK_PATTERNS`` at a time, and each block is one pass over the
documents' rows, chained without a shuffle. A document is searched whole.

Defined cases: a null or empty text has no words and no hits; items without
words match nothing; repeated items report each distinct id once; repeated
document rows each get their own result; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import released, table, text_of, texts_of

WINDOW = 13
BLOCK_PATTERNS = 200_000

# word bytes: digits, letters (A-Z as a-z) and every byte from 0x80 on
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class PatternSet:
    """Wu-Manber tables of patterns of one length."""

    def __init__(self, m: int, patterns: dict[tuple, list]):
        self.m, self.b = m, min(2, m)
        self.most = m - self.b + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for p, items in patterns.items():
            for end in range(self.b, m + 1):
                block = self.block(p, end)
                self.shift[block] = min(self.shift.get(block, self.most), m - end)
            self.bucket.setdefault(self.block(p, m), []).append((p, items))

    def block(self, words, end: int):
        return (words[end - 2], words[end - 1]) if self.b == 2 else words[end - 1]

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """Start and items of each occurrence."""
        m, n, shift, most = self.m, len(words), self.shift, self.most
        end = m
        two = self.b == 2
        while end <= n:
            block = (words[end - 2], words[end - 1]) if two else words[end - 1]
            s = shift.get(block, most)
            if s:
                end += s
                continue
            for p, items in self.bucket[block]:
                if tuple(words[end - m:end]) == p:
                    yield end - m, items
            end += 1


def windows(items: list[tuple], n: int = WINDOW) -> dict[int, dict[tuple, list]]:
    """length -> pattern -> item ids."""
    out: dict[int, dict[tuple, list]] = {}
    for item, text in items:
        w = words_of(text)
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            ids = out.setdefault(m, {}).setdefault(tuple(w[i:i + m]), [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return out


def pattern_blocks(benchmark: DataFrame, n: int, limit: int) -> Iterator[list[PatternSet]]:
    """Pattern sets of at most ``limit`` windows (one item more at most), item by item in id order."""
    held, size = [], 0
    for r in benchmark.select("item_id", text_of().alias("text")).orderBy("item_id").toLocalIterator():
        held.append((r.item_id, r.text))
        size += max(1, len(r.text) // 2)
        if size >= limit:
            yield [PatternSet(m, p) for m, p in sorted(windows(held, n).items())]
            held, size = [], 0
    if held:
        yield [PatternSet(m, p) for m, p in sorted(windows(held, n).items())]


def _search(sets: list[PatternSet], first: bool):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ns, starts, ends, items = [], [], [], []
            for text in (t for _, _, part in texts_of(b, "_q_text") for t in part):
                words = words_of(text)
                spans, found = [], set()
                for s in sets:
                    for start, ids in s.find(words):
                        if spans and start <= spans[-1][1] and start >= spans[-1][0]:
                            spans[-1][1] = max(spans[-1][1], start + s.m)
                        else:
                            spans.append([start, start + s.m])
                        found.update(map(str, ids))
                ns.append(len(words))
                starts.append([s[0] for s in spans])
                ends.append([s[1] for s in spans])
                items.append(sorted(found))
            new = {"_q_n": pa.array(ns, pa.int64()), "_q_starts": pa.array(starts, pa.list_(pa.int32())),
                   "_q_ends": pa.array(ends, pa.list_(pa.int32())), "_q_items": pa.array(items, pa.list_(pa.string()))}
            if not first:  # added to what the passes before found
                for c in ("_q_starts", "_q_ends", "_q_items"):
                    old = b.column(c).to_pylist()
                    new[c] = pa.array([list(chain(x or [], y)) for x, y in zip(old, new[c].to_pylist())], new[c].type)
            keep = [c for c in b.schema.names if c not in new]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *new.values()], [*keep, *new])

    return run


def _judge(min_share: int):
    """Spans and items to the measures of a document."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits, count, sha, bad = [], [], [], []
            for n, starts, ends, items in zip(*(b.column(c).to_pylist() for c in ("_q_n", "_q_starts", "_q_ends", "_q_items"))):
                hit, top = 0, 0
                for s, e in sorted(zip(starts, ends)):
                    hit += max(0, e - max(s, top))
                    top = max(top, e)
                ids = sorted(set(items))
                hits.append(hit)
                count.append(len(ids))
                sha.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                bad.append(hit > 0 and min_share * hit >= n)
            new = {"_q_hit": pa.array(hits, pa.int64()), "_q_count": pa.array(count, pa.int64()),
                   "_q_sha": pa.array(sha, pa.string()), "_q_bad": pa.array(bad, pa.bool_())}
            keep = [c for c in b.schema.names if c not in ("_q_text", "_q_starts", "_q_ends", "_q_items")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *new.values()], [*keep, *new])

    return run


def search(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, min_share: int = 20,
           block: int = BLOCK_PATTERNS) -> DataFrame:
    """``docs`` with _q_n (words), _q_hit, _q_count (items), _q_sha and _q_bad (contaminated)."""
    from pyspark.sql import types as T

    df = docs.withColumn("_q_text", text_of())
    spans = [T.StructField("_q_n", T.LongType()), T.StructField("_q_starts", T.ArrayType(T.IntegerType())),
             T.StructField("_q_ends", T.ArrayType(T.IntegerType())), T.StructField("_q_items", T.ArrayType(T.StringType()))]
    with_spans = T.StructType([*df.schema.fields, *spans])
    judged = T.StructType([*docs.schema.fields, spans[0], T.StructField("_q_hit", T.LongType()),
                           T.StructField("_q_count", T.LongType()), T.StructField("_q_sha", T.StringType()),
                           T.StructField("_q_bad", T.BooleanType())])
    first, waiting = True, []
    for sets in pattern_blocks(benchmark, n, block):
        if waiting:  # a block before the last
            df = df.mapInArrow(_search(waiting, first), with_spans)
            first = False
        waiting = sets
    search_last, judge = _search(waiting, first), _judge(min_share)
    return df.mapInArrow(lambda batches: judge(search_last(batches)), judged)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    return search(docs, benchmark).where(~F.col("_q_bad")).select(*docs.columns)


def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.col("_q_n").alias("n_words"), F.col("_q_hit").alias("n_hit"), F.col("_q_count").alias("n_items"),
        F.col("_q_sha").alias("items_sha256"), F.col("_q_bad").alias("contaminated"))


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {"op4_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
runs AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, list_slice(w, i, i + least(13, len(w)) - 1) AS words
         FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
places AS (SELECT r, m, i, list_slice(w, i, i + m - 1) AS words
           FROM (SELECT r, w, m FROM d, (SELECT DISTINCT m FROM runs) WHERE len(w) >= m), unnest(range(1, len(w) - m + 2)) AS t(i)),
found AS (SELECT r, m, i, item_id FROM places JOIN runs USING (m, words)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, m, i FROM found), unnest(range(i, i + m)) AS t(p) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""}
