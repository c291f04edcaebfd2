"""Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def tree(nodes, fanout):
    """The top and, for each node, the digests left and right of it, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + fanout] for k in range(0, len(nodes), fanout)]
        for p, k in zip(paths, at):
            run, slot = runs[k // fanout], k % fanout
            p.append(("".join(run[:slot]), "".join(run[slot + 1:])))
        at, nodes = [k // fanout for k in at], [h(*r) for r in runs]
    return nodes[0], paths


def brute(rows, fanout=16):
    """rows: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in names:
        placed = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        own[s] = placed, *tree([leaf(r, r[4]) for r in placed], fanout)
    root, upper = tree([own[s][1] for s in names], fanout)
    out = []
    for s, above in zip(names, upper):
        placed, top, paths = own[s]
        for r, p in zip(placed, paths):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            d = leaf(r, text)
            for a, b in p + above:
                d = h(a, d, b)
            out.append((r[0], leaf(r, r[4]), top, root, h(*[a + b for a, b in p + above]), d, d == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def table(sizes, rng):
    rows = []
    for s, n in sizes.items():
        for _ in range(n):
            k = rng.randrange(10**9)
            rows.append((k, s, rng.choice(["en", None, ""]), rng.choice([3, None, 10**12]),
                         rng.choice(["Ab", "ab", "", None, "ÀÉ Z" * rng.randrange(4), "x" * 50_000 + "Q"]) if n < 400 else f"Row {k}"))
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17}, {None: 257, "b": 1, "": 2},
    {f"s{k}": 1 + k % 3 for k in range(18)} | {None: 5, "é": 40, "-": 3, "Z": 33},
])
def test_manifest_is_that_of_plain_python(spark, sizes):
    rows = table(sizes, random.Random(len(sizes)))
    docs = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], SCHEMA + ", idx int, k string, digest int").repartition(5)
    got = sorted([tuple(r) for r in merkle.manifest(docs).collect()], key=str)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) or len(rows) < 10


def test_repeated_and_null_ids(spark):
    rows = [(7, "s", "en", 1, "A")] * 40 + [(7, "s", "en", 1, "B")] * 3 + [(None, "s", None, None, "C")] * 2 + [(1, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted([tuple(r) for r in merkle.manifest(docs).collect()], key=str) == brute(rows)


def test_empty_table(spark):
    out = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_binary_tree_and_any_single_change_is_found(spark):
    rng = random.Random(3)
    rows = table({"a": 21, "b": 9}, rng)
    docs = spark.createDataFrame(rows, SCHEMA)
    m = merkle.build(merkle.leaves(docs), fanout=2)
    got = merkle.proofs(m, fanout=2).select("doc_id", "root", F.size("path").alias("steps"), "leaf", "path",
                                            merkle.fold(F.col("path"), F.col("leaf")).alias("same"),
                                            merkle.fold(F.col("path"), F.sha2(F.col("leaf"), 256)).alias("other")).collect()
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    tops = [tree([leaf(r, r[4]) for r in sorted(by[s], key=lambda r: (r[0], leaf(r, r[4])))], 2)[0] for s in ("a", "b")]
    assert {r.root for r in got} == {h(*tops)} and all(r.same == r.root != r.other for r in got)
    assert max(r.steps for r in got) == 6 and len(got) == 30


def test_a_source_is_numbered_across_partitions(spark):
    rows = spark.range(5000).select(F.lit("s").alias("k"), (F.col("id") * 7919 % 5000).alias("doc_id")).repartition(7)
    got = merkle.numbered(rows.repartition(7), "k", "doc_id").collect()
    assert all(r.idx == r.doc_id and r.n == 5000 for r in got)
    spread = rows.repartitionByRange(8, "k", "doc_id").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 4
