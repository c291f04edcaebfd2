"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else. Doubling every byte position over Spark would move at least 16 bytes a
position in each round, many times the input, so the ranks of the first round
are taken at chosen positions only and every round keeps only what is not
unique yet:

* Round 50: a string of 400 bytes has one anchor, the leftmost of its 50-byte
  grams of least hash. Equal strings have equal anchors at equal offsets, so the
  starts of a text's strings fall into runs, each owned by an anchor. Spark
  counts the anchors' ranks (hashes of their 50 bytes); anchors of a unique
  rank are done, and with them all strings they own.
* Round 100 to 200: pairs (rank of 100 bytes, rank of the 100 bytes after it)
  to the right and to the left of what is left. A string that starts at most
  200 bytes before its anchor holds the right 200, any other the left 200;
  where that side is unique, those strings are done.
* Whole contexts: anchors whose owned strings all agree with another anchor's
  are settled by one count, so a passage that a third of all texts share costs
  one row a map task.
* Round 393: strings of 8 neighbouring starts (a cell) share 393 bytes, found at
  a fixed place beside the anchor; where those are unique, all 8 are done.
* Round 400: what an anchor's repeated strings cover is one range, as they
  overlap, so only its outermost open cells are looked at (and the same cells of
  others, so that both sides of a match are there): their strings, as pairs
  (rank of 200 bytes, rank of the 200 bytes after it); Spark finds the pairs that
  several contexts hold. Anchors whose outermost cells hold no such string are
  looked at once more, with all their cells.

Ranks are 64-bit hashes of the bytes (a rank is a name here, equal exactly if the
bytes are, up to hash collisions; round 400 and the contexts use 128 bits).
What is unique needs no exact set: each scan skips anchors by a bitmap of at
most 2^``FILTER_BITS`` bits of the ranks still open; a fuller bitmap only lets
more rows through. Only texts that lose something are shuffled, in the last step.

Beside what is removed, ``shared_passages`` finds the texts of which ``PASSAGE`` words on
end (words as op12 takes them) stand in another row too, whatever their bytes: 51 words are
some 320 bytes here, mostly too short to be removed. It goes the same way over words: round 8
at the anchors of all runs of 51 words, whole contexts, which settle copies and near copies,
and round 51 for what the texts left over share. It changes nothing that is removed.

Defined cases: null and shorter texts lose nothing; matches never cross texts;
rows that repeat a text count as other places; an empty table gives an empty
result. A passage that stands twice in one row only is not shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import buffers, documents, mix64, released, saved, slices, text_of

LENGTH = 400
GRAM = 50
FILTER_BITS = 27         # a bitmap of 16 MB at most
CELL = 8                 # neighbouring starts of round 393
CONTEXT_MEMO = 200_000   # contexts a task remembers to have emitted
BLOCK = 1 << 17          # bytes of texts that are looked at together
PASSAGE = 51             # words of a passage: over 50
WORDS = 8                # words of the first round over words
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64), 0x9E3779B97F4A7C15)
_LETTER2 = mix64(np.arange(1, 257, dtype=np.uint64), 0x52DCE729DA3ED2A9)
_BASE = (np.uint64(0x9E3779B97F4A7C15) | np.uint64(1), np.uint64(0xD1342543DE82EF95) | np.uint64(1))


_POWERS: dict = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse; those for a block are kept per worker."""
    if which in _POWERS and n < len(_POWERS[which][0]):
        return _POWERS[which]
    both = []
    for b in (int(_BASE[which]), pow(int(_BASE[which]), -1, 1 << 64)):
        x = np.full(max(n, BLOCK) + 1, b, np.uint64)
        x[0] = 1
        with np.errstate(over="ignore"):
            both.append(np.multiply.accumulate(x))
    if n <= BLOCK:
        _POWERS[which] = tuple(both)
    return tuple(both)


class Ranks:
    """Hash of any range of a buffer of bytes, or of words given by their ranks, from running
    sums (64-bit arithmetic wraps)."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _powers(which, len(data))
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            letters = (_LETTER, _LETTER2)[which][data] if data.dtype == np.uint8 else mix64(data, 43 + which)
            np.cumsum(letters * up[:len(data)], out=self.sums[1:])
        self.seed = 7 + which

    def of(self, start: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[start + size] - self.sums[start]) * self.down[start], self.seed)

    def all(self, size: int) -> np.ndarray:
        """Of every range of that size."""
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return mix64((self.sums[size:] - self.sums[:n]) * self.down[:n], self.seed)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values, by doubling."""
    out, have = h, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, ranks: Ranks, length: int, gram: int):
    """Positions of anchors, and the first and last string start each owns, of
    all texts in the buffer; strings never cross a text's end."""
    none = (np.zeros(0, np.int64),) * 3
    if len(data) < length:
        return none
    # the upper half of the hash, then the position: the least is the leftmost of the least hash
    key = ranks.all(gram)
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(len(key), dtype=np.uint64)
    low = _least(key, length - gram + 1)
    end = np.repeat(offsets[1:], np.diff(offsets))[:len(low)]
    starts = np.flatnonzero(np.arange(len(low)) + length <= end)
    if not len(starts):
        return none
    owner = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[cut[1:], len(starts)] - 1
    return owner[cut], starts[cut], starts[last]


# -- bitmaps of open ranks -----------------------------------------------------------------
def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three cells of a bitmap for each hash."""
    return [x >> np.uint64(64 - bits) for x in (hashes, mix64(hashes, 37), mix64(hashes, 41))]


def _mark(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_places(h, bits))).astype(np.int64) + 1)], ["cell"])

    return run


class Open:
    """A bitmap of hashes; no false negatives. Its size is chosen from the count, up to the bound."""

    def __init__(self, hashes: DataFrame):
        n = max(1, hashes.count())
        self.bits = int(min(FILTER_BITS, max(10, np.ceil(np.log2(n)) + 6)))
        field = np.zeros(1 << self.bits, bool)
        # cells as bitmaps by slice of 2^15 cells, or'ed in Spark: at most 2^FILTER_BITS bits come back
        cell = hashes.toDF("h").mapInArrow(_mark(self.bits), "cell long").select(
            F.bitmap_bucket_number("cell").alias("k"), F.bitmap_bit_position("cell").alias("p"))
        for r in cell.groupBy("k").agg(F.bitmap_construct_agg("p").alias("m")).collect():
            on = np.flatnonzero(np.unpackbits(np.frombuffer(r.m, np.uint8), bitorder="little"))
            field[(r.k - 1) * 32768 + on] = True
        # sent once for all scans that read it, and held once by a worker
        self.sent = hashes.sparkSession.sparkContext.broadcast(np.packbits(field, bitorder="little"))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out, field = np.ones(len(hashes), bool), self.sent.value
        for x in _places(hashes, self.bits):
            out &= (field[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


# -- scans ------------------------------------------------------------------------------------
def _blocks(batches, column="t", least=LENGTH):
    """Small buffers of whole texts: data, offsets, first row, last row, batch."""
    for b in batches:
        data, offsets = buffers(b.column(column))
        for i, j in slices(offsets, BLOCK):
            if offsets[j] - offsets[i] >= least:
                yield data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i, j, b


def _scan_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for data, offsets, *_ in _blocks(batches):
        r = Ranks(data)
        q, _, _ = anchors(data, offsets, r, LENGTH, GRAM)
        yield pa.RecordBatch.from_arrays([pa.array(r.of(q, GRAM).view(np.int64))], ["g"])


def _context(r: Ranks, r2: Ranks, q, lo, hi, length: int = LENGTH):
    """128-bit rank of an anchor's context: its owned strings, and where it lies in them."""
    size = hi + length - lo
    with np.errstate(over="ignore"):
        tail = (q - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)
    return mix64(r.of(lo, size) ^ tail, 11), mix64(r2.of(lo, size) ^ tail, 13)


ANCHOR = "k1 long, k2 long, q int, lo int, hi int, r long, l long, c1 long, c2 long"


def _scan_anchors(open_grams: Open):
    half = LENGTH // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, offsets, i, j, b in _blocks(batches):
            r = Ranks(data)
            q, lo, hi = anchors(data, offsets, r, LENGTH, GRAM)
            keep = open_grams.has(r.of(q, GRAM))
            q, lo, hi = q[keep], lo[keep], hi[keep]
            if not len(q):
                continue
            text = np.searchsorted(offsets, lo, side="right") - 1
            begin, end = offsets[text], offsets[text + 1]
            # pairs of 100-byte ranks on either side, 0 where the text has not so many bytes
            def pair(start, ok):
                out = np.zeros(len(q), np.uint64)
                s = start[ok]
                out[ok] = mix64(r.of(s, half // 2) ^ mix64(r.of(s + half // 2, half - half // 2), 3), 5)
                return out
            right, left = pair(q, q + half <= end), pair(q - half, q - half >= begin)
            c1, c2 = _context(r, Ranks(data, 1), q, lo, hi)
            rows = i + text
            cols = [b.column("k1").take(pa.array(rows)), b.column("k2").take(pa.array(rows)),
                    *(pa.array(x.astype(np.int32)) for x in (q - begin, lo - begin, hi - begin)),
                    *(pa.array(x.view(np.int64)) for x in (right, left, c1, c2))]
            yield pa.RecordBatch.from_arrays(cols, ["k1", "k2", "q", "lo", "hi", "r", "l", "c1", "c2"])

    return run


def _sides(c1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix64(c1, 17), mix64(c1, 19)


def _side(tag: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = np.asarray(b.column(0).to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(mix64(c, tag).view(np.int64))], ["h"])

    return run


STRING = "w1 long, w2 long, c1 long, c2 long, d int"


def _open_contexts(batches, open_grams: Open, open_sides: Open):
    """For each buffer the open contexts, each once in a task: ranks, anchor, first and
    last open start, rank of the context, and the texts' bounds."""
    half = LENGTH // 2
    done: set[int] = set()
    for data, offsets, *_ in _blocks(batches):
        r = Ranks(data)
        q, lo, hi = anchors(data, offsets, r, LENGTH, GRAM)
        keep = open_grams.has(r.of(q, GRAM))
        q, lo, hi = q[keep], lo[keep], hi[keep]
        if not len(q):
            continue
        r2 = Ranks(data, 1)
        c1, c2 = _context(r, r2, q, lo, hi)
        right, left = (open_sides.has(x) for x in _sides(c1))
        # a string at most ``half`` before its anchor needs the right side open, another one the left
        first = np.where(right & ~left, np.maximum(lo, q - half), lo)
        last = np.where(left & ~right, np.minimum(hi, q - half - 1), hi)
        new = []
        for k in np.flatnonzero((right | left) & (first <= last)).tolist():
            c = int(c1[k])
            if c not in done:
                if len(done) >= CONTEXT_MEMO:
                    done.clear()
                done.add(c)
                new.append(k)
        if new:
            new = np.array(new)
            yield r, r2, q[new], first[new], last[new], c1[new], c2[new]


def _expand(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and number within the owner, for ``size`` items of each."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)


def _cells(r: Ranks, q: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Cells of each context (owner, number), and the rank of the bytes all strings of a cell share."""
    low, high = (q - last) // CELL, (q - first) // CELL
    of, k = _expand(high - low + 1)
    cell = low[of] + k
    with np.errstate(over="ignore"):
        return of, cell, r.of(q[of] - CELL * cell, LENGTH - CELL + 1) ^ mix64(cell.astype(np.uint64), 31)


def _scan_cells(open_grams: Open, open_sides: Open):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, q, first, last, c1, _ in _open_contexts(batches, open_grams, open_sides):
            of, _, rank = _cells(r, q, first, last)
            yield pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), pa.array(c1[of].view(np.int64))], ["w", "c1"])

    return run


ENDS = "w long, c1 long, c2 long, low int, high int"


def _scan_ends(open_grams: Open, open_sides: Open, open_cells: Open, only: Open | None = None):
    """Ranks of the outermost open cells of each context, or of all open cells of the contexts in ``only``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, q, first, last, c1, c2 in _open_contexts(batches, open_grams, open_sides):
            of, cell, rank = _cells(r, q, first, last)
            some = open_cells.has(rank)
            if only is not None:
                some &= only.has(c1)[of]
            of, cell, rank = of[some], cell[some], rank[some]
            if not len(of):
                continue
            lead = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            tail = np.r_[lead[1:], len(of)] - 1
            group = np.repeat(np.arange(len(lead)), tail - lead + 1)
            pick = np.unique(np.r_[lead, tail]) if only is None else np.arange(len(of))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.view(np.int64)) for x in (rank[pick], c1[of[pick]], c2[of[pick]])),
                 *(pa.array(cell[x[group[pick]]].astype(np.int32)) for x in (lead, tail))], ["w", "c1", "c2", "low", "high"])

    return run


def _scan_strings(open_grams: Open, open_sides: Open, wanted: Open):
    """The strings of the wanted cells."""
    half = LENGTH // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, r2, q, first, last, c1, c2 in _open_contexts(batches, open_grams, open_sides):
            of, cell, rank = _cells(r, q, first, last)
            some = wanted.has(rank)
            of, cell = of[some], cell[some]
            if not len(of):
                continue
            top = np.minimum(q[of] - CELL * cell, last[of])                 # the cell's last start
            low = np.maximum(q[of] - CELL * cell - (CELL - 1), first[of])   # and its first
            at, k = _expand(top - low + 1)
            p, of = low[at] + k, of[at]
            w = [mix64(x.of(p, half) ^ mix64(x.of(p + half, LENGTH - half), 23), 29) for x in (r, r2)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.view(np.int64)) for x in (*w, c1[of], c2[of])), pa.array((q[of] - p).astype(np.int32))],
                ["w1", "w2", "c1", "c2", "d"])

    return run


def _matches(keyed: DataFrame, open_grams: Open, open_sides: Open, wanted: DataFrame) -> DataFrame:
    """c1, c2, lo_d, hi_d: outermost repeated strings in the cells of the ranks in ``wanted``."""
    strings = saved(keyed.select("t").mapInArrow(_scan_strings(open_grams, open_sides, Open(wanted)), STRING), "strings")
    equal = strings.groupBy("w1", "w2").agg(F.min("c1").alias("a"), F.max("c1").alias("b")).where("a <> b").select("w1", "w2")
    return saved(strings.join(equal, ["w1", "w2"], "left_semi").groupBy("c1", "c2")
                 .agg(F.min("d").alias("lo_d"), F.max("d").alias("hi_d")), "matches")


# -- passages of words ------------------------------------------------------------------------
def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all words of the texts in a buffer, and the offsets of the texts in words."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (np.r_[True, ~word[:-1]] | edge[:-1]))
    stop = np.flatnonzero(word & (np.r_[~word[1:], True] | edge[1:])) + 1
    return Ranks(data).of(start, stop - start), np.searchsorted(start, offsets)


def _passage_anchors(batches):
    """For each buffer: ranks over words, anchors, first and last start of their runs, the
    texts' keys; a text is looked at once in a task."""
    done: set[int] = set()
    for data, offsets, i, j, b in _blocks(batches, least=2 * PASSAGE - 1):
        words, first = _words(data, offsets)
        r = Ranks(words)
        q, lo, hi = anchors(words, first, r, PASSAGE, WORDS)
        text = np.searchsorted(first, lo, side="right") - 1
        new = np.zeros(j - i, bool)
        for k, key in enumerate(b.column("k1").slice(i, j - i).to_pylist()):
            if key not in done:
                if len(done) >= CONTEXT_MEMO:
                    done.clear()
                done.add(key)
                new[k] = True
        keep = new[text]
        if keep.any():
            yield words, r, q[keep], lo[keep], hi[keep], pa.array(i + text[keep]), b


PASSAGES = "k1 long, k2 long, g long, c1 long, c2 long"


@released
def _scan_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words, r, q, lo, hi, rows, b in _passage_anchors(batches):
        ranks = r.of(q, WORDS), *_context(r, Ranks(words, 1), q, lo, hi, PASSAGE)
        yield pa.RecordBatch.from_arrays([b.column("k1").take(rows), b.column("k2").take(rows),
                                          *(pa.array(x.view(np.int64)) for x in ranks)], ["k1", "k2", "g", "c1", "c2"])


def _scan_windows(loose: Open):
    """The runs of ``PASSAGE`` words of the anchors in ``loose``."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, r, q, lo, hi, rows, b in _passage_anchors(batches):
            some = np.flatnonzero(loose.has(r.of(q, WORDS)))
            if not len(some):
                continue
            of, k = _expand(hi[some] - lo[some] + 1)
            p, rows = lo[some][of] + k, rows.take(pa.array(some[of]))
            yield pa.RecordBatch.from_arrays(
                [b.column("k1").take(rows), b.column("k2").take(rows),
                 *(pa.array(x.of(p, PASSAGE).view(np.int64)) for x in (r, Ranks(words, 1)))], ["k1", "k2", "w1", "w2"])

    return run


def shared_passages(docs: DataFrame) -> DataFrame:
    """k1, k2 (the text's key) of each text with ``PASSAGE`` words on end that another row holds too."""
    t = text_of()
    keyed = docs.select(F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(42)).alias("k2"), t.alias("t")) \
        .where(F.octet_length("t") >= 2 * PASSAGE - 1)

    def of_several(df: DataFrame, *by: str) -> DataFrame:
        """What different texts hold; written first, so that Spark may split its joins where many texts hold the same."""
        return saved(df.groupBy(*by).agg(F.min("k1").alias("a"), F.max("k1").alias("b")).where("a <> b").select(*by), "several")

    # round 8
    found = saved(keyed.mapInArrow(_scan_passages, PASSAGES), "passages")
    # whole contexts
    settled = saved(found.join(of_several(found, "c1", "c2"), ["c1", "c2"], "left_semi").select("k1", "k2").distinct(), "settled")
    # round 51: the anchors of texts not yet settled, in all texts
    loose = saved(found.join(of_several(found, "g"), "g", "left_semi").join(settled, ["k1", "k2"], "left_anti")
                  .select("g").distinct(), "loose")
    windows = saved(keyed.mapInArrow(_scan_windows(Open(loose)), "k1 long, k2 long, w1 long, w2 long"), "windows")
    shared = windows.join(of_several(windows, "w1", "w2"), ["w1", "w2"], "left_semi").select("k1", "k2").distinct()
    copies = keyed.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    copies = copies.join(found.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    return settled.unionByName(shared).unionByName(copies).distinct()


# -- the texts without their repeats ------------------------------------------------------------
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, gone, runs, sha = [], [], [], []
        for t, spans in zip(b.column("t").to_pylist(), b.column("spans").to_pylist()):
            raw = t.encode("utf-8")
            kept, top, n = [], 0, 0
            for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                if n and s[0] <= top:
                    top = max(top, s[1])
                else:
                    kept.append(raw[top:s[0]])
                    top, n = s[1], n + 1
            kept.append(raw[top:])
            rest = b"".join(kept)
            sizes.append(len(raw))
            gone.append(len(raw) - len(rest))
            runs.append(n)
            sha.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(sha, pa.string()), b.column("shared_passage")], COLUMNS)


def _only(some: Open):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.asarray(b.column("k1").to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            yield b.filter(pa.array(some.has(k)))

    return run


def _whole(some: Open):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.asarray(b.column("k1").to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            b = b.filter(pa.array(~some.has(k)))
            raws = [t.encode("utf-8") for t in b.column("t").to_pylist()]
            none = pa.array(np.zeros(len(raws), np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in raws], pa.int64()), none, none,
                 pa.array([hashlib.sha256(x).hexdigest() for x in raws], pa.string()), pa.array(np.zeros(len(raws), bool))], COLUMNS)

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shared_passage boolean"
COLUMNS = [x.split()[0] for x in RESULT.split(", ")]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """k1, k2 (the text's key) and spans: the byte ranges [start, stop) to remove."""
    t = text_of()
    keyed = docs.select(F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(42)).alias("k2"), t.alias("t")) \
        .where(F.octet_length("t") >= LENGTH)
    # round 50
    grams = keyed.select("t").mapInArrow(_scan_grams, "g long")
    shared = saved(grams.groupBy("g").count().where("count > 1").select("g"), "grams")
    open_grams = Open(shared)
    found = saved(keyed.mapInArrow(_scan_anchors(open_grams), ANCHOR), "anchors")
    # rounds 100 to 200, and whole contexts, on distinct contexts
    contexts = saved(found.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.first("r").alias("r"), F.first("l").alias("l"),
                                                   F.first(F.col("q") - F.col("lo")).alias("d_max"),
                                                   F.first(F.col("q") - F.col("hi")).alias("d_min")), "contexts")
    sides = []
    for side, tag in (("r", 17), ("l", 19)):
        twice = (contexts.where(F.col(side) != 0).groupBy(side).agg(F.count("*").alias("m"), F.min("n").alias("least"))
                 .where("m > 1 AND least = 1").select(side))
        sides.append(contexts.join(twice, side, "left_semi").select("c1").mapInArrow(_side(tag), "h long"))
    open_sides = Open(saved(sides[0].unionByName(sides[1]), "sides"))
    # round 393
    cells = keyed.select("t").mapInArrow(_scan_cells(open_grams, open_sides), "w long, c1 long")
    open_cells = Open(saved(cells.groupBy("w").agg(F.min("c1").alias("a"), F.max("c1").alias("b")).where("a <> b").select("w"),
                            "cells"))
    # round 400
    ends = saved(keyed.select("t").mapInArrow(_scan_ends(open_grams, open_sides, open_cells), ENDS), "ends")
    partly = _matches(keyed, open_grams, open_sides, ends.select("w"))
    held = ends.groupBy("c1", "c2").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    unsettled = saved(held.join(partly, ["c1", "c2"], "left").where(
        f"lo_d IS NULL OR floor(lo_d / {CELL}) <> low OR floor(hi_d / {CELL}) <> high").select("c1"), "unsettled")
    if not unsettled.isEmpty():
        again = saved(keyed.select("t").mapInArrow(_scan_ends(open_grams, open_sides, open_cells, Open(unsettled)), ENDS)
                      .select("w").distinct(), "ends")
        partly = partly.unionByName(_matches(keyed, open_grams, open_sides, again))
    # strings of one anchor overlap, so what goes around it is one range
    whole = contexts.where("n > 1").select("c1", "c2", F.col("d_min").alias("lo_d"), F.col("d_max").alias("hi_d"))
    ranges = (partly.unionByName(whole).groupBy("c1", "c2").agg(F.min("lo_d").alias("lo_d"), F.max("hi_d").alias("hi_d")))
    spans = (found.select("k1", "k2", "q", "c1", "c2").distinct().join(ranges, ["c1", "c2"])
             .select("k1", "k2", F.struct((F.col("q") - F.col("hi_d")).alias("start"),
                                          (F.col("q") - F.col("lo_d") + LENGTH).alias("stop")).alias("s")))
    return spans.groupBy("k1", "k2").agg(F.collect_list("s").alias("spans"))


def remove_repeats(docs: DataFrame, passages: DataFrame | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; with the keys that
    :func:`shared_passages` gives also shared_passage, whether the text is one of these."""
    spans = repeated_spans(docs)
    if passages is None:
        spans = spans.withColumn("shared_passage", F.lit(False))
    else:
        spans = spans.join(passages.withColumn("shared_passage", F.lit(True)), ["k1", "k2"], "full")
    spans = saved(spans, "spans")
    t = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("t"), F.xxhash64(t).alias("k1"),
                       F.xxhash64(t, F.lit(42)).alias("k2"))
    # only texts that lose something or share a passage move; the bitmap may send a few others along
    some = Open(spans.select("k1"))
    cut = (rows.mapInArrow(_only(some), rows.schema).join(spans, ["k1", "k2"], "left")
           .select("doc_id", "t", "spans", F.coalesce("shared_passage", F.lit(False)).alias("shared_passage")).mapInArrow(_cut, RESULT))
    whole = rows.select("doc_id", "t", "k1").mapInArrow(_whole(some), RESULT)
    out = whole.unionByName(cut)
    return out.drop("shared_passage") if passages is None else out


def op7_suffix_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = remove_repeats(docs, saved(shared_passages(docs), "shared"))
    # whether a string of the text is removed; whether over 50 words of it on end stand in another row
    return out.select(*COLUMNS[:-1], (F.col("n_removed") > 0).alias("repeated"), "shared_passage")
