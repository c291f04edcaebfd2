"""Quality of texts by a generalised additive model with pairwise interactions.

Every text is measured once (``FEATURES``: shares of kinds of characters, lengths of words
and lines, repetition). A measure has a lookup table over its bins (quantiles
of the training rows), and so have the ``PAIRS`` strongest pairs of measures; a score is
the logistic function of an intercept and one entry of each table, added by
vectorised look-ups, so each part of a score can be read off.

Tables are learned by cyclic boosting: in each round every measure in turn gets one
shallow tree (at most ``LEAVES`` leaves over its bins, fitted to the log-loss by Newton
steps at a small rate), whose leaves are added to its table. Then the pairs are
ranked by what one tree over both measures gains on what is left, and the
best are boosted the same way, a tree cutting one measure and then the other within
each side. A part of the training rows (``VALIDATION``) decides how many rounds stay.

Training takes at most ``TRAIN_ROWS`` labelled documents outside the held-out fold (those of
the smallest hash of the id); their texts are measured by Spark, and only the
measures, one row an id, reach the driver. Scoring covers every row.

Defined cases: a null text is empty and has the measures of no words; labels
that are neither 0 nor 1, without a document or without an id are not trained on; with labels of
one kind the score is their smoothed rate, without any 0.5; repeated rows get equal scores;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import buffers, slices, table, text_of
from ledgerline.llm.toxicity import FOLDS, fold

TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, RATE, LEAVES = 400, 0.1, 3
PAIRS, PAIR_ROUNDS = 8, 100
VALIDATION = 5            # one training row in so many is kept for validation
RIDGE, LEAST = 1.0, 4     # of a leaf: weight of zero, and rows
ACCEPT = 0.3

#: Kinds of characters (bytes of UTF-8) that are counted.
KINDS = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "other_letter": range(128, 256), "space": [32, 9],
         "line": [10], "bang": b"!", "stop": b".", "comma": b",", "bar": b"|", "star": b"*", "hash": b"#", "money": b"$%&",
         "bracket": b"()[]{}<>", "mark": b"\"'`:;?", "sign": b"=+-_/\\@^~"}
FEATURES = ("bytes", *KINDS, "words", "word_length", "long_words", "distinct_words", "top_word", "marked_words", "capital_words",
            "lines", "line_length", "repeated_lines", "sentence_length", "bigram_repeats")
_KIND_OF = np.zeros(256, np.uint8)
for _k, _bytes in enumerate(KINDS.values(), 1):
    _KIND_OF[list(_bytes)] = _k
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,") | frozenset(range(128, 256))


# -- measures -------------------------------------------------------------------------------
def _words(raw: bytes) -> list[float]:
    """Measures of words and lines of one text."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    if not n:
        return [0.0] * 12
    size, distinct = sum(map(len, words)), len(set(words))
    count: dict = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    pairs = set(zip(words, words[1:]))
    return [np.log1p(n), size / n, sum(len(w) > 12 for w in words) / n, distinct / n, max(count.values()) / n,
            sum(w[-1] not in _ALNUM for w in words) / n, sum(w[:1].isupper() for w in words) / n, np.log1p(len(lines)),
            np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
            np.log1p(n / (1 + raw.count(b". ") + raw.count(b".\n") + raw.endswith(b"."))), 1 - len(pairs) / max(1, n - 1)]


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of texts in UTF-8 with their n+1 offsets."""
    n, size = len(offsets) - 1, np.diff(offsets)
    kinds = _KIND_OF[data]
    text, k = np.repeat(np.arange(n), size), len(KINDS) + 1
    share = np.bincount(text * k + kinds, minlength=n * k).reshape(n, k)[:, 1:] / np.maximum(size, 1)[:, None]
    raw = data.tobytes()
    words = np.array([_words(raw[a:b]) for a, b in zip(offsets, offsets[1:])], float).reshape(n, 12)
    return np.column_stack([np.log1p(size), share, words])


# -- the model ------------------------------------------------------------------------------
@dataclass
class Model:
    """Lookup tables: ``cuts[f]`` are the inner bounds of the bins of a measure, ``coarse`` those of pairs."""

    intercept: float
    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    coarse: list = field(default_factory=list)
    pairs: dict = field(default_factory=dict)  # (f, g) -> table over coarse bins

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (cut, t) in enumerate(zip(self.cuts, self.tables)):
            z += t[np.searchsorted(cut, x[:, f], side="right")]
        if self.pairs:
            low = {f: np.searchsorted(self.coarse[f], x[:, f], side="right") for f in {f for p in self.pairs for f in p}}
            for (f, g), t in self.pairs.items():
                z += t[low[f], low[g]]
        return sigmoid(z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bounds of at most ``bins`` bins of about as many rows each."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _gain(g, h):
    return g * g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of bins with these sums; place 0 for none."""
    lg, lh, ln = g.cumsum()[:-1], h.cumsum()[:-1], n.cumsum()[:-1]
    total, weight, rows = g.sum(), h.sum(), n.sum()
    if not len(lg):
        return 0.0, 0
    gain = np.where((ln >= LEAST) & (rows - ln >= LEAST), _gain(lg, lh) + _gain(total - lg, weight - lh) - _gain(total, weight), 0.0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1 if gain[k] > 1e-12 else 0


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A step for each bin: best-first cuts into at most ``leaves`` leaves, a Newton step each."""
    spans = [(0, len(g), *best_cut(g, h, n))]
    while len(spans) < leaves:
        k = max(range(len(spans)), key=lambda i: spans[i][2])
        a, b, gain, at = spans[k]
        if not at:
            break
        spans[k:k + 1] = [(lo, hi, *best_cut(g[lo:hi], h[lo:hi], n[lo:hi])) for lo, hi in ((a, a + at), (a + at, b))]
    out = np.zeros(len(g))
    for a, b, *_ in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the better of two trees over a grid: one measure is cut, then the other within each side."""
    best, base = (0.0, np.zeros(g.shape)), _gain(g.sum(), h.sum())
    for turned in (False, True):
        gg, hh, nn = (x.T if turned else x for x in (g, h, n))
        for at in range(1, gg.shape[0]):
            gain, step = -base, np.zeros(gg.shape)
            for a, b in ((0, at), (at, gg.shape[0])):
                sg, sh, sn = (x[a:b].sum(axis=0) for x in (gg, hh, nn))
                step[a:b] = shallow_tree(sg, sh, sn, 2)
                _, cut = best_cut(sg, sh, sn)
                gain += sum(_gain(sg[i:j].sum(), sh[i:j].sum()) for i, j in ((0, cut), (cut, len(sg))) if j > i)
            if gain > best[0]:
                best = gain, step.T if turned else step
    return best


def _loss(z, y):
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean()) if len(y) else 0.0


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """``x``: (rows, measures); ``y``: 0 or 1."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(rate / (1 - rate)))
    if len(set(y.tolist())) < 2:
        return Model(intercept)
    m = Model(intercept, [quantiles(c, BINS) for c in x.T], coarse=[quantiles(c, PAIR_BINS) for c in x.T])
    bins = np.column_stack([np.searchsorted(c, v, side="right") for c, v in zip(m.cuts, x.T)])
    low = np.column_stack([np.searchsorted(c, v, side="right") for c, v in zip(m.coarse, x.T)])
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    held = np.arange(len(y)) % VALIDATION == 0
    own = ~held
    z = np.full(len(y), intercept)

    def boost(rounds, parts, cells, tables, tree):
        """Rounds over all ``parts``; the tables of the round of the least validation loss stay."""
        nonlocal z
        best = _loss(z[held], y[held]), [t.copy() for t in tables], z.copy()
        since = 0
        for _ in range(rounds):
            for k in parts:
                p = sigmoid(z[own])
                sums = [np.bincount(cells[k][own], w, tables[k].size).reshape(tables[k].shape) for w in (y[own] - p, p * (1 - p), np.ones(len(p)))]
                step = RATE * tree(*sums)
                tables[k] += step
                z += step.reshape(-1)[cells[k]]
            now, since = _loss(z[held], y[held]), since + 1
            if now < best[0] - 1e-6:
                best, since = (now, [t.copy() for t in tables], z.copy()), 0
            if since > 40:
                break
        z = best[2]
        return best[1]

    m.tables = boost(ROUNDS, range(x.shape[1]), bins.T, m.tables, shallow_tree)
    # pairs by the gain of one tree on what the single measures leave
    p = sigmoid(z[own])
    ranked, cells = [], {}
    for f, g in combinations(range(x.shape[1]), 2):
        shape = len(m.coarse[f]) + 1, len(m.coarse[g]) + 1
        if min(shape) > 1:
            cell = low[:, f] * shape[1] + low[:, g]
            sums = [np.bincount(cell[own], w, shape[0] * shape[1]).reshape(shape) for w in (y[own] - p, p * (1 - p), np.ones(len(p)))]
            ranked.append((pair_tree(*sums)[0], (f, g)))
            cells[f, g] = cell, shape
    chosen = [k for gain, k in sorted(ranked, reverse=True)[:PAIRS] if gain > 0]
    grids = boost(PAIR_ROUNDS, range(len(chosen)), [cells[k][0] for k in chosen], [np.zeros(cells[k][1]) for k in chosen], lambda *s: pair_tree(*s)[1])
    m.pairs = {k: t for k, t in zip(chosen, grids) if t.any()}
    return m


# -- on Spark -------------------------------------------------------------------------------
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = buffers(b.column("text"))
        for i, j in slices(offsets):
            x = measures(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("y").slice(i, j - i), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             ["doc_id", "y", "x"])


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of at most ``limit`` ids outside the held-out fold, in the order of a hash of the id."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & (fold() != 0)).groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # ids and labels only: at most 16 bytes a row
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = rows.mapInArrow(_measure, "doc_id long, y int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r"))
    got = one.orderBy(F.xxhash64("doc_id"), "doc_id").select("r.*").collect()
    return np.array([r.x for r in got], float).reshape(len(got), len(FEATURES)), np.array([r.y for r in got], float)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column("text"))
            out = np.zeros(b.num_rows)
            for i, j in slices(offsets):
                out[i:j] = model.score(measures(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .mapInArrow(_score(model), "doc_id long, score double"))


def op13_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(*training_rows(docs, table(spark, sf_dir, "labels")))
    return scores(docs, model).select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                                      (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
