"""Brute-force models of the source semantics, checked on random groups.

Each example builds many groups and runs one Spark job; the model is plain
Python written from the SQL definitions (three-valued ANY/ALL, searched
CASE, element-wise array order with NULL largest, enum declaration order).
"""

import functools

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.functions.domains import MEDIA_TYPE
from ledgerline.functions.enums import with_enum
from ledgerline.operators import labels as L

STATUSES = [None, "unfiltered", "accepted", "rejected", "override"]


def _any(x, arr):
    if any(e == x for e in arr if e is not None):
        return True
    return None if any(e is None for e in arr) else False


def _all(x, arr):
    if any(e != x for e in arr if e is not None):
        return False
    return None if any(e is None for e in arr) else True


def _or(a, b):
    if a is True or b is True:
        return True
    if a is None or b is None:
        return None
    return False


def model_label(statuses):
    if _or(_any("accepted", statuses), _any("override", statuses)) is True:
        return "would_watch"
    if _all("unfiltered", statuses) is True:
        return None
    return "would_not_watch"


def _cmp_elem(a, b):
    if a is None and b is None:
        return 0
    if a is None:
        return 1
    if b is None:
        return -1
    return (a > b) - (a < b)


def _cmp_array(x, y):
    for a, b in zip(x, y):
        c = _cmp_elem(a, b)
        if c:
            return c
    return (len(x) > len(y)) - (len(x) < len(y))


def model_array_max(arrays):
    arrays = [a for a in arrays if a is not None]
    return max(arrays, key=functools.cmp_to_key(_cmp_array)) if arrays else None


groups = st.lists(st.lists(st.sampled_from(STATUSES), min_size=1, max_size=6), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(groups)
def test_label_matches_three_valued_model(spark, gs):
    rows = [(str(i), s) for i, g in enumerate(gs) for s in g]
    df = spark.createDataFrame(rows, "k string, s string")
    got = {r.k: r.label for r in L.derive_label(df, "k", "s").collect()}
    want = {str(i): model_label(g) for i, g in enumerate(gs)}
    assert got == want
    # the array form over the expanded multiset agrees, and the array is the multiset
    c = L.collect_statuses(df, "k", "s")
    arr = c.select("k", L.statuses_as_array("statuses", "s").alias("a"))
    out = {r.k: (r.label, r.a) for r in arr.select("k", "a", L.label_from_statuses("a").alias("label")).collect()}
    assert {k: v[0] for k, v in out.items()} == want
    key = lambda x: (x is None, x or "")
    assert {k: sorted(v[1], key=key) for k, v in out.items()} == \
        {str(i): sorted(g, key=key) for i, g in enumerate(gs)}


elem = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
arrays = st.one_of(st.none(), st.lists(elem, max_size=4))
array_groups = st.lists(st.lists(arrays, min_size=1, max_size=5), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None)
@given(array_groups)
def test_array_max_matches_null_largest_order(spark, gs):
    rows = [(str(i), a) for i, g in enumerate(gs) for a in g]
    df = spark.createDataFrame(rows, "k string, arr array<string>")
    got = {r.k: r.arr for r in L.consolidate_max(df, "k").collect()}
    assert got == {str(i): model_array_max(g) for i, g in enumerate(gs)}


enum_groups = st.lists(st.lists(st.one_of(st.none(), st.sampled_from(list(MEDIA_TYPE.values))),
                                min_size=1, max_size=5), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None)
@given(enum_groups)
def test_enum_max_matches_declaration_order(spark, gs):
    rows = [(str(i), v) for i, g in enumerate(gs) for v in g]
    df = with_enum(spark.createDataFrame(rows, "k string, media_type string"), "media_type", MEDIA_TYPE)
    got = {r.k: r.media_type for r in L.consolidate_max(df, "k").collect()}
    order = {v: i for i, v in enumerate(MEDIA_TYPE.values)}

    def best(g):
        vals = [v for v in g if v is not None]
        return max(vals, key=order.__getitem__) if vals else None

    assert got == {str(i): best(g) for i, g in enumerate(gs)}
