"""Near-duplicates against brute force over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import minhash
from ledgerline.llm.common import buffers
from ledgerline.llm.shingles import shingles

WORDS = [a + b for a in ("the", "of", "tion", "er", "an", "ré", "schö", "ing") for b in ("st", "nd", "sh", "le", "on", "ha", "", "2")]


def plain_shingles(text):
    w = [x.decode("latin-1") for x in re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]
    if not w:
        return {}
    out = {}
    for i in range(max(1, len(w) - 4)):
        s = tuple(w[i:i + 5])
        out[s] = out.get(s, 0) + 1
    return out


def similarity(a, b, df, n):
    keys, best = a.keys() | b.keys(), 0.0
    for idf in (lambda s: np.log1p(n / df[s]), lambda s: 1.0):
        top = sum(max(a.get(s, 0), b.get(s, 0)) * idf(s) for s in keys)
        low = sum(min(a.get(s, 0), b.get(s, 0)) * idf(s) for s in keys)
        best = max(best, low / top if top else 0.0)
    return best


def brute_classes(rows, least=0.8):
    """(doc_id, text) rows to the smallest id of each row's component, and pairs near the line."""
    sh = [plain_shingles(t) for _, t in rows]
    df = {}
    for c in sh:
        for s in c:
            df[s] = df.get(s, 0) + 1
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    edgy = 0
    for i in range(len(rows)):
        for j in range(i):
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            if not equal and not (sh[i].keys() & sh[j].keys()):
                continue
            s = similarity(sh[i], sh[j], df, len(rows))
            edgy += not equal and abs(s - least) < 0.02
            if equal or s >= least:
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(k)] = min(d, ids.get(find(k), d))
    return [(d, ids.get(find(k))) for k, (d, _) in enumerate(rows)], edgy


def corpus(seed=0):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]
    common = " ".join(prose(30))
    rows, k = [], 0
    for _ in range(25):  # families of near copies, some chains of growing distance
        base = prose(rng.randrange(60, 200))
        for c in range(rng.randrange(1, 6)):
            t = list(base)
            for _ in range(c):
                t[rng.randrange(len(t))] = "changed"
            rows.append((k, " ".join(t)))
            k += 1
    for _ in range(30):  # a passage that many documents share
        rows.append((k, common + " " + " ".join(prose(25))))
        k += 1
    big = prose(150)
    for c in range(60):  # one large group
        t = list(big)
        t[c] = "other"
        rows.append((k, " ".join(t)))
        k += 1
    rows += [(k, ""), (k + 1, None), (k + 2, "!!!"), (k + 3, "???"), (k + 4, "one two"), (k + 5, "One, two."), (k + 6, "one two three four five"),
             (None, rows[0][1]), (0, rows[0][1]), (k + 7, " ".join(prose(4000))), (k + 8, "x" * 70000)]
    return rows


def test_shingles_match_plain_python():
    texts = [t or "" for _, t in corpus()] + ["a b", "A-b c1 é2", "  ", "x", "a b c d e", "a b c d e a b c d e a"]
    data, at = buffers(pa.array(texts))
    s, times, off = shingles(data, at)
    for k, t in enumerate(texts):
        want = plain_shingles(t)
        assert sorted(times[off[k]:off[k + 1]].tolist()) == sorted(want.values())
    every = {tuple(x) for t in texts for x in plain_shingles(t)}
    assert len(set(s.tolist())) == len(every)


def test_classes_match_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, class_id string, key int").repartition(7)
    want, edgy = brute_classes(rows)
    assert edgy < 12
    got = minhash.near_classes(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, c in want:
        sizes[c] = sizes.get(c, 0) + 1
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == sorted(want, key=str)
    assert all(r.class_size == sizes[r.class_id] for r in got)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({c for _, c in want}) == len(set(ids))


def test_recall_of_similar_pairs(spark):
    """Of all pairs of different texts at 0.8 or more, nine in ten at least end in one class, and no pair of strangers does."""
    rows = [(d, t) for d, t in corpus(7) if d is not None and t]
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bags = {d: plain_shingles(t) for d, t in rows}
    near = met = 0
    for (a, x), (b, y) in combinations(bags.items(), 2):
        both = sum(min(n, y.get(s, 0)) for s, n in x.items())
        if both and both >= 0.8 * (sum(x.values()) + sum(y.values()) - both):
            near, met = near + 1, met + (got[a] == got[b])
    assert near > 1000 and met >= 0.9 * near


def test_one_leader_a_text_then_other_classes(spark, monkeypatch):
    """A group of near copies is compared about once a member, not once a shared band."""
    rng = random.Random(3)
    base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)]
    rows = []
    for k in range(300):
        t = list(base)
        t[k % 200] = f"other{k}"
        rows.append((k, " ".join(t)))
    asked, was = [], minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, *a: asked.append(pairs.count()) or was(pairs, *a))
    got = minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.class_id for r in got} == {0} and {r.class_size for r in got} == {300}
    assert len(asked) == 2 and sum(asked) < 2 * len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_classes(docs).collect() == []
    assert minhash.deduplicate(docs).collect() == []


def test_members_apart_from_the_leader_are_linked(spark, monkeypatch):
    """One bucket of several families: links join each family, across blocks, and nothing else."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "SCREEN", 7)
    rng = random.Random(1)
    rows, family = {}, {}
    for f in range(4):
        base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(80)]
        for k in range(5):
            t = list(base)
            t[k * 9] = "changed"
            node = f"{k}{f}".encode()
            rows[node], family[node] = " ".join(t), f
    nodes = sorted(rows)
    idf = np.ones(1 << minhash.FEATURE_BITS, np.float32)
    data, at = buffers(pa.array([rows[n] for n in nodes]))
    s, times, off = shingles(data, at)
    sig = minhash.samples(s, minhash.weights(s, times, idf), off).astype("<u4")
    members = spark.createDataFrame([(1, n, nodes[0]) for n in nodes], "key long, node binary, leader binary")
    links = spark.createDataFrame([(nodes[0], n) for n in nodes[1:] if family[n] == family[nodes[0]]], "a binary, b binary")
    sigs = spark.createDataFrame([(n, x.tobytes()) for n, x in zip(nodes, sig)], "node binary, sig binary")
    texts = spark.createDataFrame(list(rows.items()), "node binary, t string")
    labels = minhash.components(links)
    got = [(bytes(r.a), bytes(r.b)) for r in minhash.more_links(members, labels, sigs, texts, idf, 0.8).collect()]
    assert all(a < b and family[a] == family[b] for a, b in got)
    every = links.collect()
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in got + [(bytes(r.a), bytes(r.b)) for r in every]:
        root[find(a)] = find(b)
    assert len({find(n) for n in nodes}) == 4


def test_weights_grow_with_rarity(spark):
    docs = spark.createDataFrame([(k, "a b c d e " + (f"u{k} v w x y" if k else "")) for k in range(30)], "doc_id long, text string")
    idf = minhash.idf_table(docs)
    data, at = buffers(pa.array(["a b c d e", "u3 v w x y"]))
    s, t, off = shingles(data, at)
    w = minhash.weights(s, t, idf)
    assert w[0] < w[1]


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_samples_agree_as_often_as_weighted_jaccard_says(share):
    rng = np.random.default_rng(0)
    n = 400
    s = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
    w = rng.uniform(0.5, 8, n).astype(np.float32)
    other = rng.random(n) < share
    agree, want = [], w[other].sum() / w.sum()
    for k in range(20):
        t = minhash.mix64(s, k)
        order = np.argsort(t)
        a = minhash.samples(t[order], w[order], np.array([0, n]))
        o = order[other[order]]
        b = minhash.samples(t[o], w[o], np.array([0, len(o)]))
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - want) < 0.04


@pytest.mark.parametrize("changed", [5, 8, 11])
def test_members_of_a_large_group_far_apart_under_idf_are_found(spark, changed):
    """A third of all rows are edits of one base: their own shingles weigh most with IDF, yet without it each is similar to the base."""
    rng = random.Random(changed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    base = [word() for _ in range(104)]  # 100 shingles
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        t = list(base)
        if changed == 5:
            t[rng.randrange(8, 96)] = word()  # five shingles
        else:
            t[:changed] = [word() for _ in range(changed)]  # the first shingles
        rows.append((k, " ".join(t)))
    rows += [(1000 + k, " ".join(word() for _ in range(104))) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs).collect()}
    assert [got[k] for k in range(60)] == [0] * 60
    assert all(got[k] == k for k, _ in rows[60:])


def test_texts_that_share_many_buckets_are_verified_once(monkeypatch):
    asked = []
    monkeypatch.setattr(minhash, "_similar", lambda *a: asked.append(1) or False)
    bands = minhash.SETS * minhash.BANDS
    sig = np.arange(bands * minhash.ROWS, dtype="<u4")
    keys = minhash.band_keys(sig.reshape(1, bands, minhash.ROWS))[0].view(np.int64)
    nodes = [b"a", b"b", b"c"]
    rows = [(int(k), n, n, False, sig.tobytes(), "some words of a text", 0, 0, 2) for k in keys for n in nodes]
    names = ["key", "node", "root", "lead", "sig", "t", "i", "j", "side"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    idf = np.ones(1 << minhash.FEATURE_BITS, np.float32)
    assert not list(minhash._between(22, idf, 0.8, True)(iter([batch])))
    assert len(asked) == 6  # three pairs from both ends; 120 in all buckets


def test_members_of_an_open_bucket_are_not_copied_for_its_size(spark, monkeypatch):
    """Short texts, all promising and none similar, meet in one block: rows stay as many as members."""
    n, rng = 600, random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    nodes = [f"{k:04d}".encode() for k in range(n)]
    made, was = {}, minhash.saved
    monkeypatch.setattr(minhash, "saved", lambda df, tag: made.setdefault(tag, was(df, tag)))
    twin = " ".join(word() for _ in range(20))
    texts = spark.createDataFrame([(x, twin if k in (7, 599) else " ".join(word() for _ in range(20))) for k, x in enumerate(nodes)], "node binary, t string")
    sig = np.arange(minhash.SETS * minhash.BANDS * minhash.ROWS, dtype="<u4").tobytes()
    sigs = spark.createDataFrame([(x, sig) for x in nodes], "node binary, sig binary")
    members = spark.createDataFrame([(1, x, nodes[0]) for x in nodes], "key long, node binary, leader binary")
    labels = minhash.components(spark.createDataFrame([], "a binary, b binary"))
    got = minhash.more_links(members, labels, sigs, texts, np.ones(1 << minhash.FEATURE_BITS, np.float32), 0.8).collect()
    assert [(bytes(r.a), bytes(r.b)) for r in got] == [(nodes[7], nodes[599])]
    assert made["blocks"].count() == n - 1  # the leader has been met by all


def test_a_pair_is_a_contender_in_one_bucket():
    bands = minhash.SETS * minhash.BANDS
    sig = np.arange(bands * minhash.ROWS, dtype="<u4")
    keys = np.sort(minhash.band_keys(sig.reshape(1, bands, minhash.ROWS))[0].view(np.int64))
    rows = [(int(k), x, x, False, sig.tobytes(), 9, 0, 0, 2) for k in keys for x in (b"a", b"b", b"c")]
    names = ["key", "node", "root", "lead", "sig", "bytes", "i", "j", "side"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    every = lambda across: sum(b.num_rows for b in minhash._screen(22, across)(iter([batch])))
    assert (every(True), every(False)) == (3, 3 * bands)


def test_many_partners_at_once_are_judged_as_one_by_one(monkeypatch):
    monkeypatch.setattr(minhash, "COMPARED", 300)
    rows = [t for _, t in corpus(5) if t and plain_shingles(t)]
    s, times, off = shingles(*buffers(pa.array(rows)))
    w = minhash.weights(s, times, np.random.default_rng(0).uniform(0.5, 8, 1 << minhash.FEATURE_BITS).astype(np.float32))
    bags, part = minhash._Bags(s, off, w, times), [slice(a, b) for a, b in zip(off, off[1:])]
    for k in range(0, len(rows), 7):
        want = [m for m in range(len(rows)) if minhash._similar(s[part[k]], (w[part[k]], times[part[k]]), s[part[m]], (w[part[m]], times[part[m]]), 0.8)]
        assert bags.alike(k, np.arange(len(rows)), 0.8).tolist() == want
    assert bags.alike(0, np.zeros(0, np.int64), 0.8).tolist() == []
