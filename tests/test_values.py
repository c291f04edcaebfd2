"""Row digests, CHAR columns, element constraints, collated maxima, the list of days."""

import datetime as dt
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import chars
from ledgerline.functions.digest import canonical, row_digest
from ledgerline.operators import labels as L
from ledgerline.operators import quality as Q
from ledgerline.operators import restore as R
from ledgerline.operators import snapshot as S
from ledgerline.sources import fs
from ledgerline.sources.spec import check_expression, schema_from_spec

# -- digests -----------------------------------------------------------------------------
DAY = dt.datetime(2024, 2, 29, 23, 59, 59)
EVERY = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("i", T.IntegerType()), T.StructField("h", T.ShortType()), T.StructField("b", T.BooleanType()),
    T.StructField("f", T.DoubleType()), T.StructField("g", T.FloatType()), T.StructField("n", T.DecimalType(12, 3)), T.StructField("s", T.StringType()),
    T.StructField("x", T.BinaryType()), T.StructField("d", T.DateType()), T.StructField("z", T.TimestampType()), T.StructField("u", T.TimestampNTZType()),
    T.StructField("a", T.ArrayType(T.StringType())), T.StructField("aa", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("r", T.StructType([T.StructField("p", T.StringType()), T.StructField("q", T.TimestampNTZType())])),
])
VALUES = {
    "i": [0, 1, -1, None], "h": [0, 7, None], "b": [True, False, None], "f": [0.0, -0.0, 0.1, math.nan, -math.nan, math.inf, 1e300, None],
    "g": [0.0, -0.0, 0.5, math.nan, None], "n": [decimal.Decimal("1.000"), decimal.Decimal("1.001"), decimal.Decimal("10.010"), None],
    "s": ["", "~", "1:a", "a", "a ", None, "é"], "x": [b"", b"\x00", b"0", None], "d": [dt.date(1, 1, 1), dt.date(2024, 2, 29), None],
    "z": [DAY.replace(microsecond=m, tzinfo=dt.timezone.utc) for m in (123456, 123999, 0)] + [None],
    "u": [DAY.replace(microsecond=m) for m in (123456, 123999, 0)] + [None],
    "a": [[], [None], [""], ["a", "b"], ["ab"], ["a", None], ["1:a"], None], "aa": [[], [[]], [[0.0]], [[-0.0]], [[math.nan]], [[], []], [None], [[None]], None],
    "r": [(None, None), ("", None), (None, DAY), ("x", DAY.replace(microsecond=1)), None],
}


def random_rows(rng, n):
    return [(k, *[rng.choice(VALUES[f.name]) for f in EVERY.fields[1:]]) for k in range(n)]


def test_digests_are_equal_just_where_group_by_is(spark):
    rng = random.Random(11)
    rows = random_rows(rng, 60)
    rows += [(k, *[rng.choice(VALUES[f.name]) if rng.random() < 0.05 else v for f, v in zip(EVERY.fields[1:], rng.choice(rows)[1:])]) for k in range(60, 400)]
    df = spark.createDataFrame(rows, EVERY).drop("k")
    groups = df.withColumn("__d", row_digest(df)).groupBy(*df.columns).agg(F.count_distinct("__d").alias("per"), F.min("__d").alias("digest"))
    got = groups.agg(F.count("*").alias("rows"), F.max("per").alias("most"), F.count_distinct("digest").alias("digests")).first()
    assert got["rows"] == got["digests"] > 100 and got["most"] == 1


def test_each_type_alone(spark):
    for name, values in VALUES.items():
        field = EVERY[name]
        df = spark.createDataFrame([(v,) for v in values], T.StructType([field]))
        text = df.select(name, canonical(F.col(name), field.dataType).alias("t"))
        assert text.where("t IS NULL").isEmpty()
        assert text.select("t").distinct().count() == df.distinct().count() == text.distinct().count(), name


def test_maps_and_void(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, NULL AS v UNION ALL SELECT map('b', 2, 'a', 1), NULL UNION ALL SELECT map('b', 1, 'a', 2), NULL "
                   "UNION ALL SELECT map(), NULL UNION ALL SELECT NULL, NULL")
    assert df.select(row_digest(df).alias("d")).distinct().count() == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_the_three_diffs_agree(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 150)
    after = [(r[0], *[rng.choice(VALUES[f.name]) if rng.random() < 0.03 else v for f, v in zip(EVERY.fields[1:], r[1:])]) for r in rows if rng.random() < 0.9]
    after += [(1000 + r[0], *r[1:]) for r in rows[:7]]
    a, b = spark.createDataFrame(rows, EVERY), spark.createDataFrame(after, EVERY)
    want = R.round_trip_diff(a, b).first()
    assert want.lost > 10 and R.keyed_diff(a, b, ["k"]).first() == want and R.digest_diff(a, b).first() == want


def test_microseconds_count(spark):
    a = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS t, TIMESTAMP'2024-01-01 00:00:00.5' AS z")
    b = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00.123999' AS t, TIMESTAMP'2024-01-01 00:00:00.5' AS z")
    for diff in (R.keyed_diff(a, b, ["k"]), R.digest_diff(a, b), R.round_trip_diff(a, b)):
        assert tuple(diff.first()) == (1, 1, 1, 1)
    # types that a union widens are compared as the union holds them
    wide = a.withColumn("k", F.col("k").cast("decimal(20,2)"))
    assert tuple(R.digest_diff(a, wide).first()) == tuple(R.round_trip_diff(a, wide).first()) == (1, 1, 0, 0)


def test_digest_diff_moves_digests_only(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("wide"), F.lit(1.5).alias("w"))
    plan = R.digest_diff(df, df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "__digest" in exchanges[0] and "wide" not in exchanges[0]


# -- CHAR ----------------------------------------------------------------------------------
def char(name, n, kind="CHAR", **md):
    return T.StructField(name, T.StringType(), True, {"char_length": n, "char_kind": kind, **md})


def test_char_is_stored_padded_and_compared_without(spark, store):
    store.create("s", "t", T.StructType([char("c", 4), char("v", 4, "VARCHAR"), T.StructField("n", T.IntegerType())]))
    df = spark.createDataFrame([("ab", "ab", 1), ("ab  ", "ab  ", 2), ("abc      ", "ab      ", 3), ("", "", 4), (None, None, 5), ("a\t", "a", 6)], "c string, v string, n int")
    store.append(df, "s", "t")
    live = store.read("s", "t")
    assert [tuple(r) for r in live.orderBy("n").collect()] == [("ab  ", "ab", 1), ("ab  ", "ab  ", 2), ("abc ", "ab  ", 3), ("    ", "", 4), (None, None, 5), ("a\t  ", "a", 6)]
    with pytest.raises(Exception, match="too long for c"):
        store.append(spark.createDataFrame([("abcde", "", 1)], "c string, v string, n int"), "s", "t")
    # keys: one group for what differs in blanks at the end, stored form out
    grouped = {r.c: (r.v, r.n) for r in L.consolidate_max(live, "c").collect()}
    assert grouped == {"ab  ": ("ab  ", 2), "abc ": ("ab  ", 3), "    ": ("", 4), "a\t  ": ("a", 6)}
    # MAX: 'a' < 'a<tab>', although the padded 'a   ' sorts behind it
    more = spark.createDataFrame([(1, "a   "), (1, "a\t  ")], T.StructType([T.StructField("k", T.IntegerType()), char("c", 4)]))
    assert L.consolidate_max(more, "k").first().c == "a\t  "
    assert L.consolidate_max(more, "k", collation="UNICODE").first().c in ("a\t  ", "a   ")
    # anti-join with another length, and with plain text, where blanks at the end count
    other = T.StructType([char("c", 9)])
    keys = spark.createDataFrame([("ab       ",)], other)
    assert sorted(r.n for r in L.new_keys_only(live.where("n < 5"), keys, "c").collect()) == [3, 4]
    text = spark.createDataFrame([("ab  ",), ("abc",)], "c string")
    assert sorted(r.n for r in L.new_keys_only(live.where("n < 5"), text, "c").collect()) == [1, 2, 4]
    assert {(r.n, r.l) for r in chars.text_view(live).select("n", F.length("c").alias("l")).where("n < 5").collect()} == {(1, 2), (2, 2), (3, 3), (4, 0)}
    assert {r.c for r in L.derive_label(live.withColumn("s", F.lit("accepted")), "c", "s").collect()} == set(grouped)


def test_rules_see_char_without_padding_and_patterns_with(spark, store):
    spec = {"s": {"tables": {"t": {"columns": [
        {"name": "code", "type": "CHAR(5)", "constraints": ["PRIMARY KEY"], "check": "length(code) = 3 AND code <> 'xyz'"},
        {"name": "tag", "type": "CHAR(3)", "check": "tag ~ '^[a-z]{2} $' OR tag LIKE 'Q__'"}]}}}}
    table = schema_from_spec(spec, "t")
    store.create("s", "t", table.schema)
    df = lambda *r: spark.createDataFrame(list(r), "code string, tag string")
    assert store.append(df(("abc", "xy"), ("abd  ", "Q")), "s", "t") == 2
    for row in (("abcd", "xy"), ("xyz", "xy"), ("ab ", None), ("abe", "xyz"), ("abe", "x")):
        with pytest.raises(Exception, match="_check"):
            store.append(df(row), "s", "t")
    rules = Q.rules_from_spec(table)
    assert {r.rule: r.violations for r in Q.check_violations(store.read("s", "t"), rules).collect()} == {"code_check": 0, "tag_check": 0}
    twice = spark.createDataFrame([("abc  ", "xy "), ("abc", "xy")], table.schema)
    assert {r.check_name: r.violations for r in Q.key_violations(twice, ["code"]).collect()}["duplicate_row"] == 1
    assert check_expression("a ~ 'x' AND ab ~ 'y'", {"a": 2}) == "rpad(a, 2, ' ') RLIKE 'x' AND ab RLIKE 'y'"


# -- constraints inside arrays ---------------------------------------------------------------
ARRAYS = {"s": {"enums": [{"name": "mood", "values": ["calm", "loud"]}], "tables": {"t": {"columns": [
    {"name": "c", "type": "CHAR(2)[]"}, {"name": "v", "type": "VARCHAR(3)[]"}, {"name": "m", "type": "mood[]"}, {"name": "n", "type": "VARCHAR(2)[][]"}]}}}}


def test_elements_hold_their_types(spark, store):
    struct = schema_from_spec(ARRAYS, "t").schema
    store.create("s", "t", struct)
    plain = "c array<string>, v array<string>, m array<string>, n array<array<string>>"
    df = lambda *r: spark.createDataFrame(list(r), plain)
    assert store.append(df((["U", "US", None, "U   "], ["abc", "abc  ", None], ["loud", None], [["ab", None], None, []]), (None, [], None, None)), "s", "t") == 2
    first = store.read("s", "t").where("c IS NOT NULL").first()
    assert first.c == ["U ", "US", None, "U "] and first.v == ["abc", "abc", None] and first.m == ["loud", None] and first.n == [["ab", None], None, []]
    for row, what in (((["USA"], None, None, None), "an element of c"), ((None, ["abcd"], None, None), "an element of v"),
                      ((None, None, ["quiet"], None), "invalid input value for enum mood"), ((None, None, None, [["ab"], ["abc"]]), "an element of n")):
        with pytest.raises(Exception, match=what):
            store.append(df(row), "s", "t")
    assert store.read("s", "t").count() == 2
    # the maximum of CHAR arrays compares unpadded elements, NULL largest, and is stored padded
    both = spark.createDataFrame([(1, ["a "]), (1, ["a\t"]), (2, ["z "]), (2, [None])], T.StructType([T.StructField("k", T.IntegerType()), struct["c"]]))
    assert {r.k: r.c for r in L.consolidate_max(both, "k").collect()} == {1: ["a\t"], 2: [None]}


# -- collations --------------------------------------------------------------------------------
def test_arrays_and_text_follow_one_collation(spark):
    words = ["cote", "coté", "côte", "côté", "Cote", "zebra", "Zebra", "äpfel", "apfel"]
    rng = random.Random(2)
    rows = [(k, rng.choice(words), [rng.choice([*words, None]) for _ in range(rng.randrange(1, 3))]) for k in range(12) for _ in range(4)]
    df = spark.createDataFrame(rows, "k int, t string, a array<string>")
    order = {r.w: n for n, r in enumerate(spark.createDataFrame([(w,) for w in words], "w string").orderBy(F.collate("w", "UNICODE"), "w").collect())}
    assert order["apfel"] < order["äpfel"] < order["cote"] < order["coté"] < order["zebra"] < order["Zebra"]
    got = {r.k: (r.t, r.a) for r in L.consolidate_max(df, "k", collation="UNICODE").collect()}
    rank = lambda a: [(w is None, order.get(w, 0)) for w in a]
    for k in range(12):
        own = [r for r in rows if r[0] == k]
        assert got[k] == (max((r[1] for r in own), key=order.get), max((r[2] for r in own), key=rank))
    # what a collation holds equal is told apart by code points, in text and in arrays alike
    ties = spark.createDataFrame([(1, "b", ["b"]), (1, "B", ["B"]), (1, "a", ["a"])], "k int, t string, a array<string>")
    one = L.consolidate_max(ties, "k", collation="UNICODE_CI").first()
    assert (one.t, one.a) == ("b", ["b"])


# -- the list of days ---------------------------------------------------------------------------
def test_newest_day_with_constant_reads(spark, store, monkeypatch):
    df = spark.range(3).withColumn("v", F.lit("a"))
    store.write(df, "atp", "media")
    names = [S.snapshot_names("atp", "media", f"2{n:03d}0101") for n in range(1000)]
    for n in (998, 999):
        S.backup_table(store, "atp", "media", names[n].date)
    path = S.days_path(store, "atp", "media")
    head = store.head(path)
    assert store.publish(path, head, tuple(n.date for n in names), None)
    reads, lists = [], []
    was_read, was_list = fs.read_text, fs._names
    monkeypatch.setattr(fs, "read_text", lambda *a: reads.append(a) or was_read(*a))
    monkeypatch.setattr(fs, "_names", lambda *a: lists.append(a) or was_list(*a))
    assert R.latest_snapshot(store, "atp", "media").date == names[999].date
    assert len(reads) <= 3 and len(lists) <= 3  # the list, the day (looked up once more for its parts)
    monkeypatch.undo()
    # an announced day that was never published is passed over; a damaged newest day is an error
    S.announce(store, S.snapshot_names("atp", "media", "99990101"))
    assert R.latest_snapshot(store, "atp", "media").date == names[999].date
    store.create("atp", "again", df.schema)
    fs.delete(spark, S.snapshot_path(store, names[999], "data"))
    with pytest.raises(R.SnapshotNotFound):
        R.reload_table(store, "atp", "media", target_table="again")


def test_days_of_before_the_list(spark, store):
    df = spark.range(2)
    store.write(df, "atp", "media")
    for day in ("20240101", "20240201"):
        S.backup_table(store, "atp", "media", day)
    fs.delete(spark, S.days_path(store, "atp", "media"))
    assert S.announced_days(store, "atp", "media") is None
    assert R.latest_snapshot(store, "atp", "media").date == "20240201"
    S.backup_table(store, "atp", "media", "20240115")  # the new list takes over the days there are
    assert S.announced_days(store, "atp", "media") == ["20240101", "20240115", "20240201"]
    assert R.latest_snapshot(store, "atp", "media").date == "20240201"
    assert R.snapshot_dates(store, "atp", "media") == ["20240101", "20240115", "20240201"]
    assert store.tables("bak") == []


def test_a_failed_backup_changes_no_lookup(spark, store, monkeypatch):
    store.write(spark.range(2), "atp", "media")
    S.backup_table(store, "atp", "media", "20240101")
    store.write(spark.range(2).withColumn("x", F.raise_error(F.lit("lost")).cast("string")).limit(0).unionByName(spark.range(2).withColumn("x", F.lit("y"))), "atp", "media")
    real = type(store).publish

    def fail(self, path, *a, **k):
        if "snapshot_date" in path:
            raise OSError("the store is gone")
        return real(self, path, *a, **k)

    monkeypatch.setattr(type(store), "publish", fail)
    with pytest.raises(OSError):
        S.backup_table(store, "atp", "media", "20240301")
    monkeypatch.undo()
    assert R.latest_snapshot(store, "atp", "media").date == "20240101"
