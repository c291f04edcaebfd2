"""Toxic spans by a linear-chain conditional random field.

Two states (clean, toxic) over the words of a text. A word's emission is the sum
of the weights of its features (the word, its first four to seven letters, its
last three); the transition weights tie neighbours. Training words get their
labels from labelled documents: a feature is evidence when nearly all labelled
training documents that hold it are toxic, and in a toxic document the words
with evidence are the toxic tokens. The field is fitted to such windows of tokens
by gradient ascent on the likelihood, with forward-backward in numpy.

A text is scored whole: forward and backward passes give the probability of
the toxic state at every word; the document's score is a logistic function of
the two largest probabilities, the expected number of toxic words and the
length, fitted on training documents. Words over 0.5 are the offending spans.

Training takes at most ``TRAIN_ROWS`` labelled documents (those of the smallest
hash of the id, a sample that does not depend on the table's order; one row an id) and at most
``TRAIN_WORDS`` words of windows; scoring covers every row.

Defined cases: a null or empty text has no words, and its score is that of no
toxic word; labels without a document, null labels and null ids are not trained
on; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Memo, released, table, text_of, texts_of

TRAIN_ROWS = 6000
TRAIN_WORDS = 150_000
FOLDS = 5
KEEP = 100_000
CONTEXT = 8
_WORD = re.compile(r"\w+")
L2 = 1e-4


def features(word: str) -> tuple[str, ...]:
    return ("w:" + word, "4:" + word[:4], "5:" + word[:5], "6:" + word[:6], "7:" + word[:7], "s:" + word[-3:])


EVIDENCE = 5  # of these, the first so many may be evidence


class Field:
    """Weights of the features for the toxic state, and transitions."""

    def __init__(self, weights: dict[str, float], bias: float, trans: list[list[float]], calibration: list[float]):
        self.weights, self.bias, self.trans, self.calibration = weights, bias, trans, calibration
        self.memo = Memo(self.odds, KEEP)

    def __getstate__(self):
        return self.weights, self.bias, self.trans, self.calibration

    def __setstate__(self, state):
        self.__init__(*state)

    def odds(self, word: str) -> float:
        """exp(emission of toxic - emission of clean)."""
        w = self.weights
        return math.exp(max(-40.0, min(40.0, self.bias + sum([w.get(f, 0.0) for f in features(word)]))))

    def marginals(self, words: list[str]) -> list[float]:
        """Probability of the toxic state at each word, by forward-backward on
        the ratio of the two states (so that long texts neither over- nor underflow)."""
        (t00, t01), (t10, t11) = [[math.exp(x) for x in row] for row in self.trans]
        odds = list(map(self.memo.__getitem__, words))
        forward, r = [], None
        for e in odds:
            r = e if r is None else e * (t01 + r * t11) / (t00 + r * t10)
            forward.append(r)
        out, b = [0.0] * len(odds), 1.0  # b: backward toxic over clean
        for k in range(len(odds) - 1, -1, -1):
            x = forward[k] * b
            out[k] = x / (1.0 + x)
            x = odds[k] * b
            b = (t10 + x * t11) / (t00 + x * t01)
        return out

    def score(self, marginals: list[float]) -> float:
        z = sum([a * x for a, x in zip(self.calibration, (*summary(marginals), 1.0))])
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def summary(marginals: list[float]) -> tuple[float, float, float, float]:
    """The two largest probabilities, the expected number of toxic words, and the length."""
    top = heapq.nlargest(2, marginals)
    return (*top, *[0.0] * (2 - len(top)), math.log1p(sum(marginals)), 0.1 * math.log1p(len(marginals)))


# -- training -------------------------------------------------------------------------
def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def places(text: str) -> list[tuple[int, int]]:
    """Start and end in ``text`` of each of its :func:`words_of`."""
    low = text.lower()
    at = [m.span() for m in _WORD.finditer(low)]
    if len(low) == len(text):
        return at
    source = [k for k, c in enumerate(text) for _ in c.lower()]  # lower case may be longer
    return [(source[a], source[e - 1] + 1) for a, e in at]


def evidence(docs: list[tuple[list[str], int]]) -> set[str]:
    """Features found (nearly) only in toxic documents."""
    seen, toxic = Counter(), Counter()
    for words, y in docs:
        own = {f for w in set(words) for f in features(w)[:EVIDENCE]}
        seen.update(own)
        if y:
            toxic.update(own)
    base = sum(y for _, y in docs) / max(1, len(docs))
    need = max(0.6, min(0.9, 3 * base))  # well above the share of toxic documents
    # lower end of the share: pseudo-counts at the base rate
    out = {f for f, n in seen.items() if n >= 6 and (toxic[f] + 2 * base) / (n + 2) >= need}
    return out


def _sequences(docs, toxic_features, rng) -> list[tuple[list[str], list[int]]]:
    """Windows around labelled tokens, and as many words of other places."""
    near, other = [], []
    for words, y in docs:
        if not words:
            continue
        tags = [int(y and any(f in toxic_features for f in features(w)[:EVIDENCE])) for w in words] if y else [0] * len(words)
        hit = [k for k, t in enumerate(tags) if t]
        k = 0
        while k < len(hit):
            a = max(0, hit[k] - CONTEXT)
            b = hit[k] + CONTEXT + 1
            while k + 1 < len(hit) and hit[k + 1] < b and hit[k + 1] + CONTEXT < a + 5 * CONTEXT:
                k += 1
                b = hit[k] + CONTEXT + 1
            near.append((words[a:b], tags[a:b]))
            k += 1
        if not y:
            a = int(rng.integers(0, len(words)))
            other.append((words[a:a + 4 * CONTEXT], [0] * len(words[a:a + 4 * CONTEXT])))
    out, size = [], 0
    for s in [x for pair in zip(near + [None] * len(other), other + [None] * len(near)) for x in pair if x]:
        if size + len(s[0]) > TRAIN_WORDS:
            break
        out.append(s)
        size += len(s[0])
    return out


def _fit_chain(seqs, rounds: int = 60, rate: float = 0.3):
    """Gradient ascent (Adagrad) on the mean log-likelihood of the tags."""
    count = Counter(f for words, _ in seqs for w in words for f in features(w))
    names = [f for f, n in count.items() if n >= 2]
    index = {f: k + 1 for k, f in enumerate(names)}  # 0: unknown, weight 0
    longest = max(len(w) for w, _ in seqs)
    n = len(seqs)
    feats = np.zeros((n, longest, EVIDENCE + 1), np.int32)
    tags = np.zeros((n, longest), np.int8)
    mask = np.zeros((n, longest), bool)
    for k, (words, ts) in enumerate(seqs):
        mask[k, :len(words)] = True
        tags[k, :len(words)] = ts
        feats[k, :len(words)] = [[index.get(f, 0) for f in features(w)] for w in words]
    w, bias, trans = np.zeros(len(names) + 1), -1.0, np.zeros((2, 2))
    gw, gb, gt = np.full(len(w), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    total = mask.sum()
    pairs = mask[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[:, :-1][pairs].astype(int), tags[:, 1:][pairs].astype(int)), 1)
    for _ in range(rounds):
        e = w[feats].sum(axis=2) + bias
        emit = np.stack([np.zeros_like(e), e], axis=2)
        alpha = np.zeros((n, longest, 2))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(alpha[:, t - 1, :1] + trans[0], alpha[:, t - 1, 1:] + trans[1]) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        beta = np.zeros((n, longest, 2))
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            nxt = emit[:, t + 1] + beta[:, t + 1]
            on = mask[:, t + 1]
            step = np.stack([np.logaddexp(trans[i, 0] + nxt[:, 0], trans[i, 1] + nxt[:, 1]) for i in (0, 1)], axis=1)
            beta[:, t] = np.where(on[:, None], step, 0.0)
            for i in (0, 1):
                for j in (0, 1):
                    p = np.exp(alpha[:, t, i] + trans[i, j] + nxt[:, j] - z)
                    expected[i, j] += p[on].sum()
        prob = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])
        diff = np.where(mask, tags - prob, 0.0)
        grad = np.zeros(len(w))
        np.add.at(grad, feats.reshape(-1), np.repeat(diff.reshape(-1), EVIDENCE + 1))
        grad = grad / total - L2 * w
        grad[0] = 0.0
        g_bias, g_trans = diff.sum() / total, (seen - expected) / total - L2 * trans
        gw += grad**2
        gb += g_bias**2
        gt += g_trans**2
        w = w + rate * grad / np.sqrt(gw)
        bias = bias + rate * g_bias / np.sqrt(gb)
        trans = trans + rate * g_trans / np.sqrt(gt)
    return {f: float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-3}, float(bias), trans.tolist()


def _fit_logistic(xs: np.ndarray, ys: np.ndarray, steps: int = 400) -> list[float]:
    """Newton steps on the regularised log-loss."""
    x = np.column_stack([xs, np.ones(len(xs))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (p - ys) / len(ys) + 1e-4 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(ys) + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def train(rows: list[tuple[str, int]]) -> Field:
    """From (text, label) pairs."""
    docs = [(words_of(t or ""), int(y)) for t, y in rows]
    if len({y for _, y in docs}) < 2:
        return Field({}, -40.0, [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0, 0.0, 0.0, -60.0])
    rng = np.random.default_rng(5)
    seqs = _sequences(docs, evidence(docs), rng)
    field = Field(*_fit_chain(seqs), [0.0] * 5)
    xs = []
    for words, _ in docs:
        xs.append(summary(field.marginals(words)))
    field.calibration = _fit_logistic(np.array(xs), np.array([y for _, y in docs], float))
    return field


def fold(col: str = "doc_id"):
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> list[tuple[str, int]]:
    """At most ``limit`` labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & (fold() != 0)).groupBy("doc_id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # one row an id, chosen before any text moves: a repeated id costs one text
    found = texts.join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r"))
    return [(r.text, r.y) for r in one.orderBy("doc_id").select("r.text", "y").toLocalIterator()]


# -- scoring ----------------------------------------------------------------------------
def _score(field: Field, column: str, with_spans: bool):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = [], []
            for _, _, texts in texts_of(b, column):
                for t in texts:
                    p = field.marginals(words_of(t))
                    scores.append(field.score(p))
                    if with_spans:
                        hot = [k for k, x in enumerate(p) if x > 0.5]
                        found = []
                        if hot:
                            at = places(t)  # offsets are those of the text as it stands
                            for k in hot:
                                if found and k == last + 1:
                                    found[-1][1] = at[k][1]
                                else:
                                    found.append(list(at[k]))
                                last = k
                        spans.append(",".join(f"{a}:{e}" for a, e in found))
            new = {"_q_score": pa.array(scores, pa.float64())}
            if with_spans:
                new["_q_spans"] = pa.array(spans, pa.string())
            keep = [c for c in b.schema.names if c != column]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *new.values()], [*keep, *new])

    return run


def toxicity(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with _q_score and _q_spans (start:end of offending runs of words)."""
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("_q_score", T.DoubleType()), T.StructField("_q_spans", T.StringType())])
    return docs.withColumn("_q_text", text_of()).mapInArrow(_score(field, "_q_text", True), schema)


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their columns."""
    field = train(training_rows(docs, labels))
    return toxicity(docs, field).where("_q_score < 0.5").select(*docs.columns)


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity(docs, field).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("_q_score").alias("score"),
        (F.col("_q_score") >= 0.5).cast("int").alias("predicted"), F.col("_q_spans").alias("spans"))
