"""Helpers against plain Python."""

import random

import numpy as np
import pyarrow as pa

from ledgerline.llm import common, minhash
from ledgerline.llm.common import Memo, buffers, components, texts_of


def test_components_match_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 260)] + [(300, 300 + k) for k in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(edges + [(b, a) for a, b in edges[:20]] + [(5, 5)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x or any(find(y) == x and y != x for y in root)}
    assert components(df.where("false")).count() == 0


def test_memo_keeps_what_is_used_and_stays_small():
    made = []
    memo = Memo(lambda k: made.append(k) or k.upper(), 3, longest=5)
    for k in ["a", "b", "a", "c", "a", "d", "a", "e", "f", "a", "toolong", "toolong"]:
        assert memo[k] == k.upper() and len(memo) <= 3 and len(memo.old) <= 3
    assert made.count("a") == 1 and made.count("toolong") == 2


def test_buffers_of_sliced_and_null_arrays():
    arr = pa.array(["xx", None, "é", "", "abc"])
    data, at = buffers(arr.slice(1, 3))
    assert bytes(data) == "é".encode() and at.tolist() == [0, 0, 2, 2]
    assert buffers(arr.slice(5))[1].tolist() == [0]
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, "b" * 10, "c"])], ["t"])
    assert [x for _, _, part in texts_of(batch, "t", 12) for x in part] == ["a" * 10, "b" * 10, "c"]
    assert [(i, j) for i, j, _ in texts_of(batch, "t", 12)] == [(0, 1), (1, 3)]


def test_workers_give_freed_memory_back_at_the_end_of_a_task(monkeypatch):
    asked = []
    monkeypatch.setattr(common, "_give_back", lambda: asked.append(1))
    task = common.released(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert (next(task), asked) == (2, [])
    assert (list(task), asked) == ([4], [1])


def test_an_array_is_sent_beside_the_steps_that_read_it(spark):
    from pyspark import cloudpickle

    array = np.arange(1 << 18, dtype=np.float32)
    sent = common.Sent(spark, array)
    assert sent[np.array([3, 5])].tolist() == [3, 5]
    assert len(cloudpickle.dumps(minhash._verify(sent, 0.8))) < 20_000 < len(cloudpickle.dumps(minhash._verify(array, 0.8)))
