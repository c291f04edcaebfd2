"""Repeated strings against brute force over all positions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import repeats
from ledgerline.llm.common import buffers


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(r)]
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "etaoin shrdlé"
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, line = prose(900), prose(130)
    texts = [prose(rng.randrange(0, 1500)) for _ in range(20)]
    texts += [texts[3], texts[3], passage, prose(300) + passage + prose(200), passage[100:700] + prose(50), prose(90) + passage[200:598],
              prose(10) + passage[200:600], passage[:450] + prose(100) + passage[400:900], prose(500) + line + prose(400)]
    texts += [prose(rng.randrange(300)) + line + prose(rng.randrange(300)) for _ in range(12)]
    base = prose(1600)
    for k in range(8):  # near copies with edits at many distances
        t = list(base)
        for _ in range(k):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += ["ha " * 400, "ha " * 300 + "x", "a" * 1000, "a" * 399, "a" * 400, "", None, prose(400), passage + passage, "é" * 260,
              prose(37) + base[:400] + "é", base[1:401], base[-400:], base[-401:-1] + "z"]
    return texts


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_removal_matches_brute_force(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(k, t, 5, "y") for k, t in enumerate(texts)], "doc_id long, text string, q int, spans string").repartition(6)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs).collect()}
    want = brute(texts, 400)
    assert [got[k] for k in range(len(texts))] == want
    assert sum(w[1] for w in want) > 5000


def test_repeated_rows_null_ids_and_small_memory(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_BITS", 10)  # a full bitmap lets more through, nothing else
    monkeypatch.setattr(repeats, "CONTEXT_MEMO", 2)
    t = corpus(4)[:40]
    rows = [*enumerate(t), (0, t[0]), (None, t[1]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs).collect()), key=str)
    want = brute([x for _, x in rows], 400)
    assert got == sorted(((d, *w) for (d, _), w in zip(rows, want)), key=str)


def test_empty_and_short(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).collect() == []
    short = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id long, text string")
    assert {tuple(r)[:4] for r in repeats.remove_repeats(short).collect()} == {(1, 1, 0, 0), (2, 1, 0, 0), (3, 0, 0, 0)}


def test_every_string_has_one_owner():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (0, 10, 900, 400, 401, 1200)]
    data, offsets = buffers(pa.array(texts))
    q, lo, hi = repeats.anchors(data, offsets, repeats.Ranks(data), 400, 50)
    starts = [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 399)]
    owned = [p for a, b in zip(lo, hi) for p in range(a, b + 1)]
    assert owned == starts and all(a <= x and x + 50 <= b + 400 for x, a, b in zip(q, lo, hi))


def test_filters_travel_beside_the_scans(spark):
    from pyspark import cloudpickle

    some = repeats.Open(spark.range(200_000).toDF("h"))
    assert some.bits == 24 and some.has(np.arange(200_000, dtype=np.int64).view(np.uint64)).all()
    # each scan used to hold copies of its bitmaps, 2 MB each here, 16 MB at size
    assert len(cloudpickle.dumps(repeats._scan_strings(some, some, some))) < 100_000


def words_shared(texts, n):
    rows = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in texts]
    held = Counter(w for r in rows for w in {tuple(r[i:i + n]) for i in range(len(r) - n + 1)})
    return [any(held[tuple(r[i:i + n])] > 1 for i in range(len(r) - n + 1)) for r in rows]


def passages(seed):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("an be éc door it of on so the to us we".split()) + str(rng.randrange(4)) for _ in range(n)]
    p, q = prose(90), prose(51)
    body = [prose(rng.randrange(0, 200)) for _ in range(15)] + [prose(60)] * 2 + [prose(50)] * 2 + [["w"] * 300, ["w"] * 51, ["v"] * 102, []]
    body += [prose(40) + p[k:k + n] + prose(30) for k, n in ((0, 90), (10, 51), (39, 51), (0, 50), (40, 50), (80, 10))]
    body += [prose(70) + q, q + prose(70), prose(5) + q[:50] + prose(5), q[1:] + prose(3), prose(60) * 2]
    body += [[*x[:k], "edit", *x[k + 1:]] for x in [prose(130)] for k in (10, 60, 65, 70, 120)]
    join = lambda x: "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in x)
    return [join(x) for x in body] + [None, "x" * 700, "\u00a0".join(p)]


@pytest.mark.parametrize("seed", [0, 1])
def test_passages_of_over_50_words_are_found_whatever_their_bytes(spark, tmp_path, seed):
    texts = passages(seed)
    rows = [*enumerate(texts), (None, texts[3]), (0, texts[9])]  # a null id, an id used twice
    want = words_shared([t for _, t in rows], 51)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = repeats.op7_suffix_dedup(spark, str(tmp_path)).collect()
    key = lambda x: tuple(map(str, x))
    cut = brute([t for _, t in rows], 400)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((d, *c, c[1] > 0, w) for (d, _), c, w in zip(rows, cut, want)), key=key)
    # passages too short in bytes to be removed: no column showed them before
    assert sum(w and not c[1] for w, c in zip(want, cut)) >= 3 and not all(want)
