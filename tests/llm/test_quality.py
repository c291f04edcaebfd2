"""The additive model against plain Python, and on texts made for it."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from ledgerline.llm import quality as Q
from ledgerline.llm.common import buffers

WORDS = ["the", "tion", "erst", "on", "and", "ing", "with", "re", "old", "sh", "ré", "harbour", "quiet"]


def text_of(rng, good):
    words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.randrange(20, 200))]
    if good:
        return " ".join(w + rng.choice(["", "", "", ".", ","]) for w in words)
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in words)
    if kind == 1:
        return "\n".join(["buy now " + words[0]] * len(words))
    return " ".join(w.upper() + "!!" for w in words)


def measured(texts):
    return Q.measures(*buffers(pa.array(texts, pa.string())))


def tables(spark, rng, n=900):
    texts = [(k, text_of(rng, k % 4 > 0)) for k in range(n)]
    docs = spark.createDataFrame([(d, t, 1, "z", 2) for d, t in texts], "doc_id long, text string, y int, x string, score int").repartition(5)
    labels = spark.createDataFrame([(d, int(d % 4 > 0), 0) for d, _ in texts], "doc_id long, quality int, toxic int")
    return texts, docs, labels


def test_measures_of_a_text_by_hand():
    x = dict(zip(Q.FEATURES, measured(["Ab ab! é9\nAb ab!\n\nAb ab!"])[0]))
    assert math.isclose(x["bytes"], math.log1p(25)) and x["upper"] == 3 / 25 and x["bang"] == 3 / 25 and x["line"] == 3 / 25
    assert x["other_letter"] == 2 / 25 and x["distinct_words"] == 3 / 7 and x["top_word"] == 3 / 7 and x["marked_words"] == 3 / 7
    assert math.isclose(x["repeated_lines"], 1 - 2 / 3) and math.isclose(x["bigram_repeats"], 1 - 4 / 6) and x["capital_words"] == 3 / 7
    assert not measured([""]).any() and measured([]).shape == (0, len(Q.FEATURES))


def test_measures_do_not_depend_on_the_batch():
    rng = random.Random(8)
    texts = [text_of(rng, k % 2) for k in range(30)] + ["", "x" * 300_000, "é\n" * 1000]
    assert np.array_equal(measured(texts), np.concatenate([measured([t]) for t in texts]))


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (400, len(Q.FEATURES))).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 2)).astype(float)
    m = Q.fit(x, y)
    assert (0, 1) in m.pairs  # neither measure says anything alone
    assert np.mean((m.score(x) > 0.5) == y) > 0.98
    for row, got in zip(x[:50].tolist(), m.score(x[:50]).tolist()):
        z = m.intercept + sum(t[sum(c <= v for c in cut)] for v, cut, t in zip(row, m.cuts, m.tables))
        z += sum(t[sum(c <= row[f] for c in m.coarse[f]), sum(c <= row[g] for c in m.coarse[g])] for (f, g), t in m.pairs.items())
        assert math.isclose(got, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_shallow_tree_takes_the_best_cuts():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h, n = rng.normal(size=9), rng.random(9) + 0.1, rng.integers(0, 9, 9).astype(float)
        own = [(sum(g[a:b].sum() ** 2 / (h[a:b].sum() + Q.RIDGE) for a, b in ((0, k), (k, 9))), k) for k in range(1, 9)
               if min(n[:k].sum(), n[k:].sum()) >= Q.LEAST]
        gain, at = Q.best_cut(g, h, n)
        if own and max(own)[0] > g.sum() ** 2 / (h.sum() + Q.RIDGE) + 1e-9:
            assert at == max(own)[1]
            steps = Q.shallow_tree(g, h, n, 2)
            assert np.allclose(steps[:at], g[:at].sum() / (h[:at].sum() + Q.RIDGE)) and len(set(steps.tolist())) == 2
        else:
            assert at == 0
        assert len(set(Q.shallow_tree(g, h, n, 3).tolist())) <= 3


def test_held_out_accuracy(spark):
    texts, docs, labels = tables(spark, random.Random(5))
    m = Q.fit(*Q.training_rows(docs, labels))
    got = {r.doc_id: r.score for r in Q.scores(docs, m).collect()}
    held = [d for d, _ in texts if zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean([(got[d] >= Q.ACCEPT) == (d % 4 > 0) for d in held]) > 0.97


def test_held_out_labels_are_not_used(spark):
    _, docs, labels = tables(spark, random.Random(6), 300)
    x, y = Q.training_rows(docs, labels)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    x2, y2 = Q.training_rows(docs, flipped)
    assert np.array_equal(x, x2) and np.array_equal(y, y2)
    few, _ = Q.training_rows(docs, labels, 50)
    assert np.array_equal(few, x[:50])


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, "again"), (None, "no id"), (4, "x " * 100_000), (4, "x " * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (99, 1), (None, 0), (4, None), (3, 7)], "doc_id long, quality int")
    x, y = Q.training_rows(docs, labels)
    assert len(x) == len(y) == len({1, 2} - {d for d in (1, 2) if zlib.crc32(str(d).encode()) % 5 == 0})
    got = Q.scores(docs, Q.fit(x, y)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = Q.fit(*Q.training_rows(docs, labels.where("false")))
    assert {r.score for r in Q.scores(docs, none).collect()} == {0.5}
    assert Q.scores(docs.where("false"), none).collect() == []
