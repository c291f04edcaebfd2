"""Filter interactions against plain Python."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from ledgerline.llm import filter_audit as fa


def brute_mask(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(w) < 50) + 2 * (100 * len(set(w)) < 65 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) \
        + 8 * bool(re.search(r"[#$%&*|]", text))


def brute(rows, labels):
    """rows: doc_id, source, text."""
    least = {}
    for d, _, t in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    quality, toxic = {}, {}
    for d, q, x in labels:
        quality[d], toxic[d] = max(q, quality.get(d, q)), max(x, toxic.get(d, x))
    docs = [(s or "", brute_mask(t or "") + 16 * (d is not None and d > least[t or ""]), quality.get(d) == 1, toxic.get(d) == 1) for d, s, t in rows]
    out = []
    for part in {x[0] for x in docs}:
        own, lost, lines = [x for x in docs if x[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                hit = [x for x in left if x[1] & bit]
                left = [x for x in left if not x[1] & bit]
                lost[f] += len(hit)
                lines.append(("".join(order), step, f, len(left), len(hit), sum(1 for x in gone if x[1] & bit), sum(x[1] == bit for x in own),
                              sum(x[2] for x in hit), sum(x[3] for x in hit)))
                gone = gone + hit
        out += [(part, o, k, *rest, lost[f]) for o, k, f, *rest in lines]
    return sorted(out)


def run(spark, rows, labels, **kw):
    docs = spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, source string, text string, n int, mask string").repartition(6)
    found = fa.masks(docs, **kw)
    return sorted(tuple(r) for r in fa.audit(fa.histogram(found, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect())


def corpus(rng):
    texts = ["", "a", "ab", "abc", "ABC def", "$", " \t\n", "é" * 30, "word " * 70, " ".join(f"w{k}" for k in range(60)), "long " + "x" * 200_000,
             " ".join(f"w{k}" for k in range(60)) + " | T", "A\x0bB\x0cC\x1cD", *["licence " * 40 + f"tail {k % 25}" for k in range(60)]]
    rows = [(k, rng.choice(["p", "q", None, ""]), rng.choice(texts)) for k in range(500)]
    rows += [(900 + k, "hot", "copy") for k in range(400)] + [(7, "p", "same id")] * 3 + [(7, "q", "same id"), (3, "p", "same id")] * 2
    rows += [(None, "p", "copy"), (None, None, None), (5, None, None)]
    return rows


@pytest.mark.parametrize("range_bytes", [300, 40_000, 1 << 24])
def test_audit_is_that_of_plain_python(spark, range_bytes):
    rng = random.Random(range_bytes)
    rows = corpus(rng)
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 1300, 3)] + [(3, 1, 0), (3, 0, 1)]
    assert run(spark, rows, labels, range_bytes=range_bytes) == brute(rows, labels)


def test_no_labels_and_no_documents(spark):
    rows = [(1, "s", "x"), (2, "s", "x")]
    assert run(spark, rows, []) == brute(rows, [])
    assert run(spark, [], []) == []


def test_trie_in_sorted_order():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab\x00\xff", k=rng.randrange(6))) for _ in range(600)]
    rows = sorted((t, rng.randrange(300), rng.choice("pq"), rng.randrange(3) * 4, rng.randrange(1, 3)) for t in texts)
    rows = [(t, d, p, 4, n) for t, d, p, _, n in rows]
    trie, got, deepest = fa.Trie(), Counter(), 0
    for r in rows:
        for d, p, m, n in trie.insert(*r):
            got[d, p, m] += n
        deepest = max(deepest, len(trie.path))
        assert [x[0] for x in trie.path] == sorted({x[0] for x in trie.path})
    for d, p, m, n in trie.leave():
        got[d, p, m] += n
    least = {}
    for t, d, *_ in rows:
        least[t] = min(least.get(t, d), d)
    want = Counter()
    for t, d, p, m, n in rows:
        want[d, p, m | 16 * (d > least[t])] += n
    assert got == want and deepest <= 7 and not trie.path


def test_bounds_part_texts_with_a_long_common_start(spark):
    docs = spark.createDataFrame([("licence " * 300 + f"{k:05d}",) for k in range(4000)], "text string")
    limits = fa.bounds(docs, 1 << 20)
    assert len(limits) >= 6 and limits == sorted(set(limits)) and all(len(p) > 2400 for p in limits)
    assert fa.bounds(docs.where("false")) == []


def test_shared_prefix():
    rng = random.Random(4)
    for _ in range(2000):
        a, b = (bytes(rng.choices(b"xy", weights=[9, 1], k=rng.randrange(20))) for _ in "ab")
        n = fa.shared(a, b)
        assert a[:n] == b[:n] and (n in (len(a), len(b)) or a[n] != b[n])


def test_judge(spark):
    for t in {t or "" for _, _, t in corpus(random.Random(2))}:
        assert fa.judge(t.encode()) == brute_mask(t)
