"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all shingles of all documents, counted in 2^21 hashed
   features as the usual hashed TF-IDF does. Every map task counts densely and
   sends compressed slices, owners of slices add them up, and the counts (at most
   16 MB whatever the data) weigh every shingle: tf * log(1 + N / df). A shingle
   in a given share of documents weighs alike at every corpus size.
2. Two sets of ``BANDS`` x ``ROWS`` consistent weighted samples of each text, one with
   and one without the IDF factor: two texts agree in a sample with the probability
   of their weighted Jaccard similarity under the weights of its set.
3. Texts with an equal band are candidates. Candidates whose samples agree too rarely in
   both sets to reach the similarity (22 of 40, 4 standard deviations below it) are
   passed over before any text moves; the others are verified by the exact weighted Jaccard
   similarity, ``SIMILARITY`` or more. A large group of copies makes
   its own shingles common and its members' edits weigh more, so the similarity
   is taken with and without the IDF factor and the greater one counts.
4. Buckets are contracted step by step, so that a group of n near copies costs about n
   comparisons however many bands its members share. First each text is held against one
   leader, the smallest one of all its buckets. Then, where the leader of a bucket and a member are not
   yet in one class, against that leader.
5. In buckets that still hold different classes, members are compared with all members of
   other classes, in blocks of signatures without texts; only members with a promising
   partner go on with their texts to be verified, block by block in the task; a pair that shares
   many buckets is looked at in the first. This runs in
   ``WAVES``, and what one wave has joined is one class to the next: first within the blocks
   of a few bands, at last between all blocks of all bands. No bucket is
   capped; only links come out.

Equal texts share one node (the text's digest), so copies cost no comparison.
Classes are the components; a class's id is its smallest doc_id.

Defined cases: a null text is empty; texts without words are near-duplicates only
of equal texts; a null doc_id takes part and is the id only of a class without
numbers; repeated rows are of one class; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Sent, buffers, components, documents, mix64, released, saved, slices, text_of
from ledgerline.llm.shingles import shingles

BANDS, ROWS = 10, 4
SETS = 2                 # samples with and without the IDF factor
SIMILARITY = 0.8
FEATURE_BITS = 21
SLICE = 1 << 13          # features in a slice of the counts
WAVES = ((0, 1, False), (1, 4, False), (0, SETS * BANDS, True))  # first band, last band + 1, blocks meet other blocks
SCREEN = 2048            # members of a block whose signatures are compared
BLOCK = 2048             # members of a block whose texts are compared
BLOCK_BYTES = 1 << 21    # and about so many bytes of their texts
COMPARED = 1 << 18       # shingles of partners that are looked up at once
AGREE = 0.55             # share of equal samples, of either set, below which a pair is not verified
_SEEDS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64), 0xD6E8FEB86659FD93)


# -- 1. document frequencies -------------------------------------------------------------
@released
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << FEATURE_BITS, np.int64)
    for b in batches:
        data, offsets = buffers(b.column(0))
        for i, j in slices(offsets):
            s, _, at = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            # a document counts once for each feature
            doc = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(at))
            cell = s >> np.uint64(64 - FEATURE_BITS)
            same = np.zeros(len(s), bool)
            same[1:] = (cell[1:] == cell[:-1]) & (doc[1:] == doc[:-1])  # shingles are in order
            total += np.bincount(cell[~same].astype(np.int64), minlength=len(total))
    parts = [(k, zlib.compress(c.astype("<i8").tobytes(), 1)) for k, c in enumerate(total.reshape(-1, SLICE)) if c.any()]
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())],
                                         ["slice", "counts"])


@released
def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x = np.frombuffer(zlib.decompress(c), "<i8")
            held[k] = held[k] + x if k in held else x
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                          pa.array([zlib.compress(c.tobytes(), 1) for c in held.values()], pa.binary())],
                                         ["slice", "counts"])


def idf_table(docs: DataFrame) -> np.ndarray:
    """Weight of each hashed feature, from all documents."""
    kind = "slice int, counts binary"
    sums = (docs.select(text_of().alias("t")).mapInArrow(_count, kind).repartition("slice").mapInArrow(_add, kind))
    df = np.zeros(1 << FEATURE_BITS, np.int64)
    for r in sums.collect():  # 2^21 counts at most
        df[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(zlib.decompress(r.counts), "<i8")
    n = docs.count()
    return np.log1p(n / np.maximum(df, 1)).astype(np.float32)


# -- 2. samples ----------------------------------------------------------------------------
def weights(s: np.ndarray, times: np.ndarray, idf: np.ndarray | Sent) -> np.ndarray:
    return times.astype(np.float32) * idf[(s >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)]


def samples(s: np.ndarray, w: np.ndarray, at: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) consistent weighted samples, and as many columns again
    for each of ``more`` weights; every text has a shingle."""
    starts, counts = at[:-1], np.diff(at)
    out = np.zeros((len(starts), 1 + len(more), len(_SEEDS)), np.uint32)
    logs = [np.log(x) for x in (w, *more)]
    low, mid = np.uint64((1 << 21) - 1), np.uint64(0xFFFFFFFF)
    for d, seed in enumerate(_SEEDS):
        x = mix64(s, int(seed))
        y = mix64(x, 0x2545F4914F6CDD1D)
        u12 = ((x & low).astype(np.float32) + np.float32(0.5)) * (((x >> np.uint64(21)) & low).astype(np.float32) + np.float32(0.5))
        u34 = ((y & mid).astype(np.float32) + np.float32(0.5)) * ((y >> np.uint64(32)).astype(np.float32) + np.float32(0.5))
        beta = (x >> np.uint64(42)).astype(np.float32) * np.float32(2.0**-22)
        r = np.maximum(-np.log(np.minimum(u12 * np.float32(2.0**-42), np.float32(1))), np.float32(1e-6))  # Gamma(2, 1)
        c = np.maximum(-np.log(np.minimum(u34 * np.float32(2.0**-64), np.float32(1))), np.float32(1e-6))
        c = np.log(c)
        for e, ln in enumerate(logs):  # one set's random numbers serve every set
            t = np.floor(ln / r + beta)
            a = c - r * (t - beta + np.float32(1))
            least = np.minimum.reduceat(a, starts)
            hit = np.flatnonzero(a == np.repeat(least, counts))
            k = hit[np.searchsorted(hit, starts)]
            out[:, e, d] = mix64(s[k] ^ t[k].astype(np.int64).view(np.uint64), int(seed)).astype(np.uint32)
    return out.reshape(len(starts), -1)


def _sample(idf: np.ndarray | Sent):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column("t"))
            for i, j in slices(offsets, 1 << 18):
                s, times, at = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                some = np.flatnonzero(np.diff(at))
                if not len(some):
                    continue
                sig = samples(s, weights(s, times, idf), at[np.append(some, j - i)], times.astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").slice(i, j - i).take(pa.array(some)),
                     pa.array([x.tobytes() for x in sig.astype("<u4")], pa.binary())], ["node", "sig"])

    return run


def band_keys(sig: np.ndarray) -> np.ndarray:
    """The key of each band of signatures (texts, bands, ROWS)."""
    with np.errstate(over="ignore"):
        key = np.zeros(sig.shape[:2], np.uint64) + np.arange(1, sig.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            key = mix64(key ^ sig[:, :, r].astype(np.uint64), r + 1)
    return key


@released
def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, _ = buffers(b.column("sig"))
        bands = SETS * BANDS
        key = band_keys(raw.view("<u4").reshape(b.num_rows, bands, ROWS))
        nodes = b.column("node").take(pa.array(np.repeat(np.arange(b.num_rows), bands)))
        # the sets take turns, so that every wave has bands of both
        turn = np.arange(bands) % BANDS * SETS + np.arange(bands) // BANDS
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.tile(turn, b.num_rows).astype(np.int32)), nodes],
                                         ["key", "band", "node"])


# -- 3. verification -------------------------------------------------------------------------
def _verify(idf: np.ndarray | Sent, least: float):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = [buffers(b.column(c)) for c in ("ta", "tb")]
            good = np.zeros(b.num_rows, bool)
            for i, j in slices(sides[0][1] + sides[1][1]):
                (sa, ka, aa), (sb, kb, ab) = [shingles(x[o[i]:o[j]], o[i:j + 1] - o[i]) for x, o in sides]
                wa, wb = weights(sa, ka, idf), weights(sb, kb, idf)
                for k in range(j - i):
                    x, y = slice(aa[k], aa[k + 1]), slice(ab[k], ab[k + 1])
                    good[i + k] = _similar(sa[x], (wa[x], ka[x]), sb[y], (wb[y], kb[y]), least)
            keep = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], ["a", "b"])

    return run


@released
def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        one, two = (buffers(b.column(c))[0].view("<u4").reshape(b.num_rows, SETS, BANDS * ROWS) for c in ("sa", "sb"))
        keep = pa.array(np.flatnonzero(((one == two).sum(axis=2) >= int(AGREE * BANDS * ROWS)).any(axis=1)))
        yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], ["a", "b"])


def verified(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, idf: np.ndarray | Sent, least: float) -> DataFrame:
    """The pairs (a, b) of similar texts. ``sigs``, ``texts``: one row of each node."""
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))
    left = saved(both.mapInArrow(_promising, "a binary, b binary"), "promising")
    one = left.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return saved(two.select("a", "b", "ta", "tb").mapInArrow(_verify(idf, least), "a binary, b binary"), "links")


# -- 5. open buckets ---------------------------------------------------------------------------
def _similar(x: np.ndarray, wx: tuple, y: np.ndarray, wy: tuple, least: float) -> bool:
    """Weighted Jaccard of ``least`` or more, with or without the IDF factor."""
    if not len(x) or not len(y):
        return False
    pos = np.minimum(np.searchsorted(y, x), len(y) - 1)
    hit = y[pos] == x
    for u, v in zip(wx, wy):
        total = float(u.sum(dtype=np.float64) + v.sum(dtype=np.float64))
        both = float(np.minimum(u[hit], v[pos[hit]]).sum(dtype=np.float64))
        if both >= least * (total - both) - 1e-9:
            return True
    return False


GROUP = ("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block pair; they come sorted by it."""
    held, at = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in GROUP]
        new = np.ones(b.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        cuts = [*np.flatnonzero(new).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            name = tuple(c[a] for c in cols)
            if held and name != at:
                yield pa.Table.from_batches(held)
                held = []
            at = name
            held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def _members(t: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, signatures, numbers of their classes, sides, and who is the leader."""
    nodes, seen = t.column("node").to_pylist(), {}
    root = np.array([seen.setdefault(r, len(seen)) for r in t.column("root").to_pylist()])
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u4").reshape(len(nodes), -1, BANDS * ROWS)
    return nodes, sig, root, t.column("side").to_numpy(), t.column("lead").to_numpy()


def _partners(sig: np.ndarray, root: np.ndarray, side: np.ndarray, lead: np.ndarray, k: int, agree: int) -> np.ndarray:
    """Members of other classes, of the other block or of the one block, whose samples agree often
    enough; not the leader, whom all have met."""
    if lead[k]:
        return np.zeros(0, np.int64)
    other = np.flatnonzero((root != root[k]) & ~lead & ((side == 2) | (side != side[k])))
    return other[((sig[other] == sig[k]).sum(axis=2) >= agree).any(axis=1)]


def _first_here(keys: np.ndarray | None, here: np.uint64, k: int, near: np.ndarray) -> np.ndarray:
    """Of the partners of a member in this bucket those that it meets in no bucket of an earlier band."""
    if keys is None or not len(near) or not (keys[k] == here).any():
        return near
    return near[keys[k][(keys[near] == keys[k]).argmax(axis=1)] == here]


def _bucket(t: pa.Table, sig: np.ndarray, across: bool) -> tuple[np.ndarray | None, np.uint64]:
    """Keys of all bands of the members, in a wave of all bands, and the key of this bucket."""
    keys = band_keys(sig.reshape(len(sig), -1, ROWS)) if across else None
    return keys, np.uint64(t.column("key")[0].as_py() & 0xFFFFFFFFFFFFFFFF)


FOUND = "key long, node binary, root binary, lead boolean, bytes long"


def _screen(agree: int, across: bool):
    """Members of a block pair with a promising partner in another class, by signatures alone.
    ``across``, a wave of all bands: a pair counts in the first of the buckets that it shares."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            if t.num_rows < 2:
                continue
            nodes, sig, root, side, lead = _members(t)
            keys, here = _bucket(t, sig, across)
            hit = np.zeros(len(nodes), bool)
            # a member of the largest class is found from its partner's side
            for k in np.flatnonzero(root != np.bincount(root).argmax()).tolist():
                near = _first_here(keys, here, k, _partners(sig, root, side, lead, k, agree))
                hit[near] = True
                hit[k] |= len(near) > 0
            if hit.any():
                keep = pa.array(np.flatnonzero(hit))
                yield from t.select(["key", "node", "root", "lead", "bytes"]).take(keep).to_batches()

    return run


class _Bags:
    """Shingles of a block's texts with both weights, to compare one text with many at once."""

    def __init__(self, s: np.ndarray, off: np.ndarray, *weights: np.ndarray):
        every, self.ids = np.unique(s, return_inverse=True)
        self.off, self.weights = off, [w.astype(np.float32) for w in weights]
        self.marks = [np.zeros(len(every), np.float32) for _ in weights]
        sums = [np.concatenate([np.zeros(1), np.cumsum(w, dtype=np.float64)])[off] for w in self.weights]
        self.sums = [np.diff(x) for x in sums]

    def alike(self, k: int, near: np.ndarray, least: float) -> np.ndarray:
        """Of ``near`` those as similar to text ``k``, up to rounding, as ``least`` with either weight."""
        good, own = np.zeros(len(near), bool), slice(self.off[k], self.off[k + 1])
        size = self.off[near + 1] - self.off[near]
        for i, j in slices(np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]), COMPARED):
            some, n = near[i:j], size[i:j]
            starts = np.cumsum(n) - n
            at = np.repeat(self.off[some] - starts, n) + np.arange(n.sum())
            ids = self.ids[at]
            for mark, w, sums in zip(self.marks, self.weights, self.sums):
                mark[self.ids[own]] = w[own]
                both = np.add.reduceat(np.minimum(mark[ids], w[at]), starts, dtype=np.float64)
                mark[self.ids[own]] = 0
                good[i:j] |= both >= least * (sums[k] + sums[some] - both) - 1e-6 * sums[k]
        return near[good]


def _between(agree: int, idf: np.ndarray | Sent, least: float, across: bool):
    """Links of one block pair that join what is not in one class yet. ``across``, a wave of all
    bands: two texts meet in every bucket that they share, so only the first one verifies them."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            if t.num_rows < 2:
                continue
            nodes, sig, root, side, lead = _members(t)
            data, at = buffers(t.column("t"))
            s, times, off = shingles(data, at)
            w = weights(s, times, idf)
            part = [slice(off[k], off[k + 1]) for k in range(len(nodes))]
            bags = _Bags(s, off, w, times)
            keys, here = _bucket(t, sig, across)
            out = []
            for k in range(len(nodes)):
                near = _first_here(keys, here, k, _partners(sig, root, side, lead, k, agree))
                for m in bags.alike(k, near, least).tolist():
                    if root[m] != root[k] and _similar(s[part[k]], (w[part[k]], times[part[k]]), s[part[m]], (w[part[m]], times[part[m]]), least):
                        root[root == root[k]] = root[m]
                        out.append((min(nodes[k], nodes[m]), max(nodes[k], nodes[m])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], ["a", "b"])

    return run


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def _blocks(members: DataFrame, across: bool) -> DataFrame:
    """Every block of a bucket's members, dealt to ``blocks``, meets itself and, ``across`` blocks, every other block once."""
    rows = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    if not across:
        return rows.withColumns({"i": F.col("block"), "j": F.col("block"), "side": F.lit(2)}).drop("block", "blocks")
    return (rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with"),
                          "side": F.when(F.col("block") == F.col("with"), 2).when(F.col("block") < F.col("with"), 0).otherwise(1)})
            .drop("block", "with", "blocks"))


def rooted(rows: DataFrame, labels: DataFrame, node: str, root: str) -> DataFrame:
    """``rows`` with the class of ``node``: itself where it has none yet."""
    named = labels.select(F.col("node").alias(node), F.col("root").alias("_q_root"))
    return rows.join(named, node, "left").withColumn(root, F.coalesce("_q_root", node)).drop("_q_root")


def more_links(members: DataFrame, labels: DataFrame, sigs: DataFrame, texts: DataFrame, idf: np.ndarray | Sent, least: float,
               across: bool = True) -> DataFrame:
    """Links between classes (``labels``) within buckets (key, node, leader) beyond those with the leader."""
    lead = (F.col("node") == F.col("leader")).alias("lead")
    classed = saved(rooted(members, labels, "node", "root").select("key", "node", "root", lead), "members")
    other = F.when(~F.col("lead"), F.col("root"))
    still = (classed.groupBy("key").agg(F.min(other).alias("lo"), F.max(other).alias("hi"), F.ceil(F.count("*") / SCREEN).cast("int").alias("blocks"))
             .where("lo <> hi").select("key", "blocks"))
    agree = int(AGREE * BANDS * ROWS)
    # written, so that what is small is known to be small: then the tables of signatures and texts need not move
    opened = saved(classed.join(still, "key"), "open")
    if opened.isEmpty():
        return opened.select(F.col("node").alias("a"), F.col("node").alias("b"))
    # signatures and texts join the nodes once, not once a bucket
    marked = (opened.select("node").distinct().join(sigs, "node")
              .join(texts.select("node", F.octet_length("t").cast("long").alias("bytes")), "node"))
    seen = _blocks(opened, across).join(marked, "node").select("key", "node", "root", "lead", "sig", "bytes", "i", "j", "side")
    found = saved(_by_block(seen).mapInArrow(_screen(agree, across), FOUND).distinct(), "contenders")
    if found.isEmpty():
        return opened.where("false").select(F.col("node").alias("a"), F.col("node").alias("b"))
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    bodies = found.select("node").distinct().join(sigs, "node").join(texts, "node")
    held = saved(_blocks(found.join(found.groupBy("key").agg(parts), "key"), across), "blocks").join(bodies, "node")
    return (_by_block(held.select("key", "node", "root", "lead", "sig", "t", "i", "j", "side"))
            .mapInArrow(_between(agree, idf, least, across), "a binary, b binary").distinct())


# -- classes -----------------------------------------------------------------------------------
def node_of():
    return F.unhex(F.md5(text_of().cast("binary")))


def node_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(node, root) of texts that are in a class with a different text."""
    idf = Sent(docs.sparkSession, idf_table(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t"), node_of().alias("node"))
    sigs = saved(rows.select("node", "t").mapInArrow(_sample(idf), "node binary, sig binary").dropDuplicates(["node"]), "samples")
    members = sigs.mapInArrow(_bands, "key long, band int, node binary")
    shared = members.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("hi")).where("leader <> hi")
    members = saved(members.join(shared.select("key", "leader"), "key"), "buckets")
    needed = members.select("node").distinct()
    # one text of each needed node, from the row of its smallest id
    first = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of().alias("node"))
             .groupBy("node").agg(F.min("doc_id").alias("first")).join(needed, "node"))
    texts = rows.join(first, "node").where("doc_id <=> first").select("node", "t")
    # repeated rows of one id; sorted out once, where the join has dealt by node
    texts = saved(texts.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy("node"))).where("_n = 1").drop("_n"), "texts")
    apart = members.where("node <> leader")
    # one leader a text, then only leaders of other classes
    first = saved(apart.groupBy(F.col("node").alias("b")).agg(F.min("leader").alias("a")).select("a", "b"), "pairs")
    edges = verified(first, sigs, texts, idf, least)
    labels = components(edges)
    left = rooted(rooted(apart.select("leader", "node").distinct(), labels, "node", "own"), labels, "leader", "other").where("own <> other")
    left = left.select(F.col("leader").alias("a"), F.col("node").alias("b")).join(first, ["a", "b"], "left_anti")
    edges = edges.unionByName(verified(saved(left, "pairs"), sigs, texts, idf, least))
    labels = components(edges)
    for at, upto, across in WAVES:
        wave = members.where((F.col("band") >= at) & (F.col("band") < upto))
        more = saved(more_links(wave, labels, sigs, texts, idf, least, across), "links")
        if not more.isEmpty():  # classes are joined, not texts: what is one class stays one node
            new = components(rooted(rooted(more, labels, "a", "ra"), labels, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
            ends = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
            known = rooted(ends.join(labels, "node", "left_anti").withColumn("root", F.col("node")).unionByName(labels), new.select("node", F.col("root")), "root", "top")
            labels = saved(known.select("node", F.col("top").alias("root")), "labels")
    return labels


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size: one row for each row of ``docs``."""
    labels = node_classes(docs, least)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of().alias("node"))
    rooted = rows.join(labels, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rooted.join(classes, "root").select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, that of the smallest doc_id, with all columns."""
    labels = node_classes(docs, least)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of().alias("node"))
    rooted = rows.join(labels, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    # nulls last: a null id stays only where there is no other
    stay = (rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("s"))
            .select(F.col("s.doc_id").alias("_q_id"), F.col("s.node").alias("_q_node")))
    named = docs.withColumn("_q_own", node_of())
    won = named.join(stay, (F.col("_q_own") == F.col("_q_node")) & F.col("doc_id").eqNullSafe(F.col("_q_id")))
    first = F.row_number().over(Window.partitionBy("_q_own").orderBy("doc_id"))  # repeated rows of one id
    return won.withColumn("_q_n", first).where("_q_n = 1").select(*docs.columns)


def op8_minhash(spark, sf_dir):
    return near_classes(documents(spark, sf_dir).select("doc_id", "text"))
