"""Toxicity, exact dedup, decontamination and the pipeline against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ledgerline.llm import decontaminate, exact_dedup, toxicity
from tests.llm.test_minhash import brute_classes

WORDS = ["the", "tion", "erst", "on", "and", "ing", "with", "re", "old", "sh", "ré"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


# -- exact dedup ----------------------------------------------------------------------------
def odd_documents(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, ""), (5, None), (6, "a "), (7, "x" * 100_000), (8, "x" * 100_000), (8, "x" * 100_000), (None, "n"),
            (None, "n"), (None, "b"), *[(100 + k, "hot") for k in range(300)], *[(1000 + k, f"t{k}") for k in range(400)]]
    data = [(d, t, d, "k") for d, t in rows]
    return rows, spark.createDataFrame(data, "doc_id long, text string, keep_id long, h string").repartition(9)


@pytest.mark.parametrize("capacity", [1, 7, 512])
def test_exact_groups(spark, capacity):
    rows, docs = odd_documents(spark)
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    got = [tuple(r) for r in exact_dedup.exact_groups(docs, capacity).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = exact_dedup.deduplicate(docs, capacity)
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text or "") for r in kept.collect()], key=str) == sorted(
        [(max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()], key=str)


def test_exact_groups_of_nothing(spark):
    _, docs = odd_documents(spark)
    assert exact_dedup.exact_groups(docs.where("false")).collect() == []
    assert exact_dedup.deduplicate(docs.where("false")).collect() == []


def test_colliding_hashes_are_chained():
    import pyarrow as pa

    rows = [(0, 5, b"x", 1, 1), (0, 5, b"y", 9, 2), (0, 5, b"x", 4, 3), (0, 6, b"x", 2, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bucket", "h", "text", "keep_id", "n"])
    got = [tuple(r.values())[1:5] for b in exact_dedup._own([batch]) for r in b.to_pylist()]
    assert got == [(5, 0, 4, 4), (5, 1, 9, 2), (6, 0, 2, 1)]


def test_directory_doubles_and_splits():
    rng = np.random.default_rng(0)
    h = rng.integers(-2**63, 2**63, 5000)
    h[:2000] = (h[:2000].view(np.uint64) >> np.uint64(6)).view(np.int64)  # one prefix is crowded
    counts = np.bincount((h.view(np.uint64) >> np.uint64(52)).astype(np.int64), minlength=4096)
    d = exact_dedup.Directory.grow(counts, 100)
    b = d.bucket(h)
    assert max(np.unique(b, return_counts=True)[1]) <= 100 and d.depth > 6
    assert len(np.unique(d.depths)) > 2  # crowded prefixes are deeper than others
    for depth in np.unique(d.depths):  # a bucket of local depth k covers 2^(g - k) slots
        assert (d.depths == depth).sum() % (1 << (d.depth - int(depth))) == 0


# -- decontamination --------------------------------------------------------------------------
def brute_hits(text, items, n=13):
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    w, hit, ids = cut(text), set(), set()
    for item, t in items:
        p = cut(t)
        m = min(n, len(p))
        wins = {tuple(p[i:i + m]) for i in range(len(p) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i:i + m]) in wins:
                hit.update(range(i, i + m))
                ids.add(str(item))
    return (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))


@pytest.mark.parametrize("block", [10**9, 60])
def test_windows_match_brute_force(spark, block):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randrange(14, 40))) for k in range(12)] + [(50, "short one"), (51, ""), (52, None), (53, "Tionold"), (7, "dup item here"),
                                                                            (60, " ".join(["ha"] * 20))]
    docs = []
    for k in range(120):
        t = prose(rng, rng.randrange(0, 200)).split(" ")
        if k % 3 == 0:
            w = (items[rng.randrange(12)][1]).split(" ")
            a = rng.randrange(len(t) + 1)
            t[a:a] = [x.upper() + ("," if rng.random() < 0.3 else "") for x in w[:rng.randrange(10, len(w) + 1)]]
        docs.append((k, " ".join(t)))
    docs += [(3, docs[3][1]), (None, "Short, one!"), (900, None), (901, ""), (902, "ha " * 3000), (903, "...")]
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, n_hit int, item_id string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted([(r.doc_id, r.text or "", r._q_n, r._q_hit, r._q_count, r._q_sha, r._q_bad) for r in decontaminate.search(df, bench, block=block).collect()],
                 key=str)
    assert got == sorted([(d, t or "", *brute_hits(t, items)) for d, t in docs], key=str)
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(not brute_hits(t, items)[-1] for _, t in docs)


def test_no_benchmark_and_no_documents(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r._q_hit for r in decontaminate.search(df, none).collect()] == [0]
    assert decontaminate.search(df.where("false"), none).collect() == []


# -- toxicity -----------------------------------------------------------------------------------
def toxic_corpus(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = prose(rng, rng.randrange(5, 120)).split(" ")
        y = int(k % 7 == 0)
        for _ in range(3 if y else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["moronic", "scumbag", "vlotz" + rng.choice(WORDS)]))
        out.append((k, " ".join(words), y))
    return out


def test_marginals_match_enumeration():
    rng = random.Random(2)
    f = toxicity.Field({"w:" + w: rng.uniform(-2, 2) for w in WORDS}, -0.3, [[0.5, -0.7], [-0.2, 0.9]], [0.0] * 5)
    words = [rng.choice(WORDS) for _ in range(8)]
    from itertools import product

    mass, total = np.zeros(8), 0.0
    for path in product((0, 1), repeat=8):
        s = sum(np.log(f.odds(w)) * y for w, y in zip(words, path)) + sum(f.trans[a][b] for a, b in zip(path, path[1:]))
        total += np.exp(s)
        mass += np.exp(s) * np.array(path)
    assert np.allclose(f.marginals(words), mass / total)


def test_held_out_accuracy_and_spans(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(d, t, "fr", 0.5) for d, t, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in rows] + [(5, 1, None), (None, 0, 1), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    field = toxicity.train(toxicity.training_rows(docs, labels))
    got = toxicity.toxicity(docs, field).collect()
    test = [(r._q_score >= 0.5) == rows[r.doc_id][2] for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(test) > 100 and np.mean(test) > 0.97
    for r in got:
        for s in filter(None, r._q_spans.split(",")):
            a, b = map(int, s.split(":"))
            if rows[r.doc_id][2]:
                assert re.search("moronic|scumbag|vlotz", r.text[a:b])
    kept = toxicity.accept(docs, labels)
    assert kept.columns == docs.columns
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "moronic scumbag moronic"), (3, "...")], "doc_id long, text string")
    score = {r.doc_id: r._q_score for r in toxicity.toxicity(odd, field).collect()}
    assert score[1] == score[2] == score[3] < 0.5 < score[None]
    assert toxicity.toxicity(odd.where("false"), field).count() == 0


def test_held_out_labels_are_not_read(spark):
    rows = toxic_corpus(60)
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    texts = {t for t, _ in toxicity.training_rows(docs, labels)}
    assert texts == {t for d, t, _ in rows if zlib.crc32(str(d).encode()) % 5}
    assert len(toxicity.training_rows(docs, labels, limit=10)) == 10
    one_kind = toxicity.train([(t, 0) for t in texts])
    assert one_kind.score(one_kind.marginals(["moronic"])) < 1e-6


# -- pipeline ---------------------------------------------------------------------------------------
def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = toxic_corpus(400, seed=8)
    docs = [(d, t) for d, t, _ in rows]
    items = [(k, prose(rng, 30)) for k in range(5)]
    base = prose(rng, 150).split(" ")
    for k in range(20):
        docs.append((1000 + k, docs[3][1]))                                     # copies
        t = list(base)
        t[7 * k % 150] = "changed"
        docs.append((2000 + k, " ".join(t)))                                    # near copies
        docs.append((3000 + k, prose(rng, 20) + " " + items[k % 5][1] + " " + prose(rng, 20)))  # benchmark passages
    docs += [(4000, None), (4001, ""), (4002, prose(rng, 3000))]
    labels = [(d, 1, y) for d, _, y in rows]
    table = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf = str(tmp_path)
    # stage by stage, each against what plain Python makes of its input
    d0 = spark.read.parquet(f"{sf}/documents.parquet")
    outs, cur = [], d0
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        cur = stage(spark, cur, sf)
        if k < 4:
            assert cur.columns == d0.columns
        path = f"{tmp_path}/out{k}"
        cur.write.parquet(path)
        cur = spark.read.parquet(path)
        outs.append([tuple(r) for r in cur.collect()])
    toxic = {d for d, _, y in rows if y}
    after = {r[0] for r in outs[0]}
    assert len(toxic & after) <= 2 and len({d for d, _ in docs} - toxic - after) <= 2
    texts = {}
    for r in outs[0]:
        texts[r[1] or ""] = max(r[0], texts.get(r[1] or "", -1))
    assert {r[0] for r in outs[1]} == set(texts.values())
    classes, _ = brute_classes([(r[0], r[1]) for r in outs[1]])
    assert {r[0] for r in outs[2]} == {c for _, c in classes}
    assert {r[0] for r in outs[3]} == {r[0] for r in outs[2] if not brute_hits(r[1], items)[-1]}
    assert {r[0] for r in outs[4]} == {r[0] for r in outs[3]}
    whole = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r[0], r[1], r[4]) for r in outs[4])


def test_spans_stay_where_lower_case_has_more_words():
    field = toxicity.Field({"w:hate": 9.0}, -4.0, [[0.0, 0.0], [0.0, 0.0]], [0.0] * 5)
    texts = ["x İstanbul hate", "hate İİ a HATE, hate aİ", "x y hate", "ΑΣ hate"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    got = [b.column("_q_spans").to_pylist() for b in toxicity._score(field, "t", True)([batch])][0]
    assert got == ["11:15", "0:4,10:20", "4:8", "3:7"]


def test_training_rows_hold_one_text_an_id(spark):
    texts = [(1, f"text {k}") for k in range(300)] + [(k, "clean") for k in range(2, 60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)] * 2, "doc_id long, toxic int")
    kept = [k for k in range(1, 60) if zlib.crc32(str(k).encode()) % 5]
    rows = toxicity.training_rows(docs, labels)
    assert len(rows) == len(kept) and rows == toxicity.training_rows(docs.repartition(3), labels)
    assert len(toxicity.training_rows(docs, labels, 10)) == 10
