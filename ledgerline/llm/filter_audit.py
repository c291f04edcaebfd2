"""Interaction of filters: what each removes in every order of application.

Four filters look at a text alone (words, distinct words, capitals, symbols), the fifth
at all others: a text is a duplicate if a smaller doc_id holds the same one.
Duplicates come from compressed radix tries over whole texts:

1. ``bounds`` draws a hash sample of the distinct texts and cuts it into ranges of equal
   bytes; a bound is the shortest prefix that parts two neighbours, and the
   prefixes fetched grow while two neighbours agree on them.
2. Map tasks judge each text, give it its range, and combine equal texts: only the
   smallest id of a text can still be no duplicate, so all other rows are decided on the
   spot and travel without their text. A text that a third of all rows hold
   leaves each map task once.
3. A range's task inserts the texts, sorted by Spark, into a compressed trie whose
   terminals hold the smallest id seen; ids that are not the smallest are duplicates at
   once. In sorted order nothing can be added left of the path to the last text, so
   finished branches are traversed and released: memory holds one path.
4. The masks of failed filters are counted by part and mask (at most 32 a part);
   all orders and steps are sums over these counts.

Defined cases: a null text is empty, so it fails A alone of the first four; a null source is the
part ``""``, as is an empty one; a null doc_id is no duplicate and makes none; rows of
one doc_id do not duplicate each other; labels of one id count by their greatest
value, ids without a label count in no label column; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, saved, table, text_of, texts_of

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
RANGE_BYTES = 16 << 20     # texts in a range
MAX_RANGES = 1 << 15       # beyond, ranges grow; a task's memory does not
SAMPLE = 16                # sampled texts for each range
COMBINE_BYTES = 16 << 20   # texts a map task holds while it combines equal ones
FIRST_PREFIX = 64          # bytes of a text looked at first

_SYMBOL = re.compile(rb"[#$%&*|]")
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)


def judge(raw: bytes) -> int:
    """Bits of the filters A to D that a text (in UTF-8) fails."""
    words = raw.split()  # bytes are split at the space and at 0x09 to 0x0D
    n = len(words)
    points = len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace"))
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1
            | (100 * len(raw.translate(None, _NOT_CAPITAL)) > 5 * points) << 2 | (_SYMBOL.search(raw) is not None) << 3)


# -- 1. ranges ------------------------------------------------------------------------------
def cuts(sample: list[tuple[bytes, int]], ranges: int, length: int) -> tuple[list[bytes], set[bytes]]:
    """Bounds from sorted (prefix, bytes) of texts, and the prefixes that are too short to part neighbours."""
    total, run, out, short = sum(n for _, n in sample), 0, [], set()
    for k, (p, n) in enumerate(sample):
        if k and run * ranges >= (len(out) + 1) * total:
            last = sample[k - 1][0]
            if p == last:
                if len(p) >= length:
                    short.add(p)
            else:
                same = next((i for i, (a, b) in enumerate(zip(last, p)) if a != b), min(len(last), len(p)))
                if not out or p[:same + 1] > out[-1]:
                    out.append(p[:same + 1])
        run += n
    return out, short


def bounds(docs: DataFrame, range_bytes: int = RANGE_BYTES, first: int = FIRST_PREFIX) -> list[bytes]:
    """First prefix of each range but the lowest; fewer than ``MAX_RANGES``."""
    texts = docs.select(text_of().cast("binary").alias("t"))
    size = texts.agg(F.sum(F.octet_length("t")), F.count("*"), F.max(F.octet_length("t"))).first()
    ranges = min(MAX_RANGES, -(-(size[0] or 0) // range_bytes))
    if ranges < 2:
        return []
    every = max(1, size[1] // (SAMPLE * ranges))
    picked = (texts.select("t", F.xxhash64("t").alias("h")).where(F.pmod(F.col("h"), F.lit(every)) == 0))
    length, short, held = first, None, {}
    while True:  # SAMPLE * MAX_RANGES prefixes on the driver; only those that agree are fetched again
        part = picked if short is None else picked.where(F.substring("t", 1, length // 8).isin([bytearray(p) for p in short]))
        one = part.select("h", F.octet_length("t").alias("n"), F.substring("t", 1, length).alias("p")).distinct()
        held |= {r.h: (bytes(r.p), r.n) for r in one.collect()}
        out, short = cuts(sorted(held.values()), ranges, length)
        if not short or length >= size[2]:
            return out
        length *= 8


# -- 2. map side ----------------------------------------------------------------------------
_ROUTED = "range int, text binary, doc_id long, part string, mask int, n long"
_NAMES = ["range", "text", "doc_id", "part", "mask", "n"]
_KINDS = [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, _KINDS)], _NAMES)


def least(held: list, doc_id: int, part: str, n: int) -> Iterator[tuple[int, str, int]]:
    """Put an id into ``held`` ([smallest id, {part: rows}]); what is no longer the smallest comes out."""
    if doc_id < held[0]:
        yield from ((held[0], p, k) for p, k in held[1].items())
        held[:] = doc_id, {part: n}
    elif doc_id == held[0]:
        held[1][part] = held[1].get(part, 0) + n
    else:
        yield doc_id, part, n


def _route(limits: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}  # text -> [smallest id, {part: rows}, mask]
        size = 0

        def flush():
            return _batch([(bisect_right(limits, t), t, h[0][0], p, h[1], n) for t, h in seen.items() for p, n in h[0][1].items()])

        for b in batches:
            ids, parts = b.column("doc_id").to_pylist(), b.column("part").to_pylist()
            for i, _, texts in texts_of(b, "text"):
                decided = []
                for k, t in enumerate(texts, i):
                    raw, d = t.encode(), ids[k]
                    got = seen.get(raw)
                    mask = got[1] if got else judge(raw)
                    if d is None:
                        decided.append((k % (len(limits) + 1), None, d, parts[k], mask, 1))
                    elif got is None:
                        seen[raw] = [[d, {parts[k]: 1}], mask]
                        size += len(raw) + 400
                    else:
                        decided += [(x % (len(limits) + 1), None, x, p, mask | DUPLICATE, n) for x, p, n in least(got[0], d, parts[k], 1)]
                    if size > COMBINE_BYTES:
                        yield flush()
                        seen, size = {}, 0
                if decided:
                    yield _batch(decided)
        if seen:
            yield flush()

    return run


# -- 3. tries -------------------------------------------------------------------------------
def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Trie:
    """A compressed trie that texts enter in sorted order.

    ``path`` holds the nodes from the root to the last text as [depth, terminal]: an edge
    spells the bytes between two depths, and a terminal is [smallest id, {part: rows}, mask].
    """

    def __init__(self):
        self.path: list[list] = [[0, None]]
        self.last = b""

    def insert(self, text: bytes, doc_id: int, part: str, mask: int, n: int) -> Iterator[tuple]:
        """Rows (id, part, mask, n) decided by this text: its duplicates, and branches that are done."""
        at = shared(self.last, text)
        yield from self.leave(at)
        if self.path[-1][0] < at:  # an edge is split where the texts part
            self.path.append([at, None])
        if len(text) > at:
            self.path.append([len(text), None])
        self.last, node = text, self.path[-1]
        if node[1] is None:
            node[1] = [[doc_id, {part: n}], mask]
        else:
            yield from ((x, p, mask | DUPLICATE, k) for x, p, k in least(node[1][0], doc_id, part, n))

    def leave(self, depth: int = -1) -> Iterator[tuple]:
        """Traverse and release what lies deeper than ``depth``."""
        while self.path and self.path[-1][0] > depth:
            _, end = self.path.pop()
            if end:
                yield from ((end[0][0], p, end[1], n) for p, n in end[0][1].items())


def _duplicates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie()

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS[2:])], _NAMES[2:])

    for b in batches:
        rows = []
        for _, text, *row in zip(*(b.column(c).to_pylist() for c in _NAMES)):
            if text is None:
                rows.append(row)
            else:
                rows += trie.insert(text, *row)
        if rows:
            yield pack(rows)
    if rows := list(trie.leave()):
        yield pack(rows)


def masks(docs: DataFrame, part: str = "source", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, part, mask (bit k: the k-th filter fails) and n, the number of such rows."""
    limits = bounds(docs, range_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    routed = rows.mapInArrow(_route(limits), _ROUTED)
    if limits:
        routed = routed.repartition(len(limits) + 1, "range")
    else:
        routed = routed.repartition(1)
    return saved(routed.sortWithinPartitions("text").mapInArrow(_duplicates, "doc_id long, part string, mask int, n long"), "masks")


# -- 4. orders ------------------------------------------------------------------------------
def histogram(found: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
             .where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("q").alias("q"), F.max("t").alias("t")))
    rows = found.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))  # repeated ids meet their label once
    return (rows.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("q") == 1, F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("t") == 1, F.col("n"))), F.lit(0)).alias("toxic")))


def audit(counts: DataFrame) -> DataFrame:
    """Every order and step of every part, from the counts by mask."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = [(o, k + 1, bit[o[k]], sum(bit[f] for f in o[:k])) for o in orders for k in range(len(FILTERS))]
    listed = F.arrays_zip(*[F.lit(list(c)).alias(n) for c, n in zip(zip(*steps), ("filter_order", "step", "bit", "before"))])
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held"))  # 32 entries at most
    each = parts.select("part", "held", F.explode(listed).alias("s")).select("part", "held", "s.*")
    own, earlier = F.col("bit"), F.col("before")

    def total(cond, value=lambda x: x["n"]):
        return F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + F.when(cond(x["mask"]), value(x)).otherwise(0))

    fails = lambda m: m.bitwiseAND(own) != 0
    early = lambda m: m.bitwiseAND(earlier) != 0
    here = lambda m: fails(m) & ~early(m)
    # a filter comes first among the k filters that a row fails in a share 1 / k of the orders
    share = lambda x: (x["n"] * (len(orders) / F.bit_count(x["mask"]))).cast("long")
    return each.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), total(lambda m: ~fails(m) & ~early(m)).alias("kept"),
        total(here).alias("removed"), total(lambda m: fails(m) & early(m)).alias("redundant"), total(lambda m: m == own).alias("unique_fails"),
        total(here, lambda x: x["good"]).alias("good_lost"), total(here, lambda x: x["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"))


def op12_filter_audit(spark, sf_dir):
    return audit(histogram(masks(documents(spark, sf_dir)), table(spark, sf_dir, "labels")))


SQL = {"op12_filter_audit": r"""
WITH judged AS (
    SELECT coalesce(source, '') AS part, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS capitals,
           length(coalesce(text, '')) AS points, regexp_matches(coalesce(text, ''), '[#$%&*|]') AS symbols,
           doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS repeated
    FROM documents
),
fails AS (
    SELECT part, len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B, 100 * capitals > 5 * points AS C,
           symbols AS D, coalesce(repeated, false) AS E, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
    FROM judged LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
    JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step FROM orders, unnest(range(1, 6)) AS t(step)),
failed AS (
    SELECT part, good, bad, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END) AS fs,
           count(*) AS n
    FROM fails GROUP BY ALL
),
met AS (
    SELECT part, filter_order, step, good, bad, n, len(fs) AS k, list_contains(fs, filter_order[step]) AS own,
           len(list_filter(fs, lambda f: instr(filter_order, f) < step)) > 0 AS early
    FROM failed, steps
)
SELECT part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (NOT own AND NOT early), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (own AND NOT early), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (own AND early), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (own AND k = 1), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n) FILTER (own AND NOT early AND good), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(n) FILTER (own AND NOT early AND bad), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(k, 1))) FILTER (own), 0) AS BIGINT) AS shapley
FROM met GROUP BY part, filter_order, step
"""}
