import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.domains import LABEL_TYPE, MEDIA_TYPE
from ledgerline.functions.enums import EnumType, enum_of, with_enum
from ledgerline.operators import labels as L
from samples import MEDIA_SAMPLES, media_df

STATUS_SCHEMA = "k string, s string"


def _labels(spark, rows):
    df = spark.createDataFrame(rows, STATUS_SCHEMA)
    return {r["k"]: r["label"] for r in L.derive_label(df, "k", "s").collect()}


def test_label_truth_table(spark):
    cases = {
        "a": ["accepted", "rejected"],
        "b": ["override"],
        "c": ["unfiltered", "unfiltered"],
        "d": ["unfiltered", "rejected"],
        "e": ["unfiltered", None],
        "f": [None],
        "g": ["accepted", None],
    }
    rows = [(k, s) for k, ss in cases.items() for s in ss]
    got = _labels(spark, rows)
    assert got == {"a": "would_watch", "b": "would_watch", "c": None, "d": "would_not_watch",
                   "e": "would_not_watch", "f": "would_not_watch", "g": "would_watch"}


def test_label_column_is_label_enum(spark):
    df = spark.createDataFrame([("a", "accepted")], STATUS_SCHEMA)
    assert enum_of(L.derive_label(df, "k", "s").schema["label"]) == LABEL_TYPE


def test_keyed_rows_and_key_only_in_null_rows(spark):
    df = spark.createDataFrame([(None, "accepted"), ("x", "accepted")], STATUS_SCHEMA)
    assert [r.k for r in L.keyed_rows(df, "k").collect()] == ["x"]
    assert set(_labels(spark, [(None, "accepted"), ("x", "rejected")])) == {"x"}


def test_consolidate_enum_uses_declaration_order(spark):
    df = spark.createDataFrame([("t", "tv_show"), ("t", "tv_season"), ("u", "movie"), ("u", None),
                                ("v", None)], "k string, media_type string")
    df = with_enum(df, "media_type", MEDIA_TYPE)
    got = {r.k: r.media_type for r in L.consolidate_max(df, "k").collect()}
    assert got == {"t": "tv_season", "u": "movie", "v": None}
    # plain text max would say tv_show
    assert df.where("k = 't'").agg(F.max("media_type")).first()[0] == "tv_show"


def test_consolidate_enum_rejects_out_of_domain(spark):
    df = with_enum(spark.createDataFrame([("t", "film")], "k string, media_type string"),
                   "media_type", MEDIA_TYPE)
    with pytest.raises(Exception, match="invalid input value for enum media_type"):
        L.consolidate_max(df, "k").collect()


def test_consolidate_array_null_element_is_largest(spark):
    df = spark.createDataFrame([("t", ["a", "b"]), ("t", ["a", None]), ("t", ["a"]), ("u", None)],
                               "k string, arr array<string>")
    got = {r.k: r.arr for r in L.consolidate_max(df, "k").collect()}
    assert got == {"t": ["a", None], "u": None}


def test_consolidate_mixes_rows_and_ignores_nulls(spark):
    df = spark.createDataFrame([("t", 1, None, "b"), ("t", None, 5, "a"), ("u", None, None, None)],
                               "k string, x int, y int, z string")
    got = {r.k: (r.x, r.y, r.z) for r in L.consolidate_max(df, "k").collect()}
    assert got == {"t": (1, 5, "b"), "u": (None, None, None)}


def test_consolidate_collation_option(spark):
    df = spark.createDataFrame([("t", "B"), ("t", "a")], "k string, z string")
    assert L.consolidate_max(df, "k").first().z == "a"
    assert L.consolidate_max(df, "k", collation="UNICODE").first().z == "B"


def test_collect_statuses_keeps_nulls_and_repeats(spark):
    from ledgerline.functions.domains import REJECTION_STATUS

    rows = [("a", "accepted"), ("a", "accepted"), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, STATUS_SCHEMA)
    for domain in (REJECTION_STATUS, None):
        got = {r.k: r for r in L.collect_statuses(df, "k", "s", domain).collect()}
        assert got["a"].n_statuses == 3 and got["a"].n_null_statuses == 1
        assert sorted((e[0] or "~", e[1]) for e in got["a"].statuses) == [("accepted", 2), ("~", 1)]
        assert got["b"].n_statuses == 1 and got["b"].n_null_statuses == 1


def test_sync_over_samples_inserts_two_then_nothing(spark, store):
    media = media_df(spark)
    store.write(media, "atp", "media")
    store.create("atp", "training", L.sync_target_schema(media.schema))
    assert L.sync_into(store) == 2
    rows = store.read("atp", "training").collect()
    assert sorted((r.imdb_id, r.label) for r in rows) == [("tt7000011", "would_watch"),
                                                          ("tt7000033", "would_watch")]
    assert all(r.reviewed is False for r in rows)
    assert len({r.created_at for r in rows}) == 1 and rows[0].created_at == rows[0].updated_at
    assert L.sync_into(store) == 0
    assert store.read("atp", "training").count() == 2


def test_sync_consolidates_many_rows_per_title(spark):
    recs = [dict(MEDIA_SAMPLES[1], hash=f"{i:040x}") for i in range(10, 14)]
    recs[0].update(rejection_status="rejected", media_title=None, budget=7)
    recs[1].update(media_title=None, tmdb_id=None, budget=None)
    recs[2].update(media_type="tv_season", media_title=None)
    recs[3].update(media_type="tv_show", media_title=None, genre=["Western", None])
    training = media_df(spark).select("imdb_id").limit(0)
    out = L.sync_media_to_training(media_df(spark, recs), training,
                                   now=dt.datetime(2025, 1, 2, 3, 4, 5)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.label == "would_not_watch"
    assert r.media_title == ""              # all NULL -> filled
    assert r.media_type == "tv_season"      # enum order
    assert r.budget == 7 and r.tmdb_id == 7022
    assert r.genre == ["Western", None]      # NULL element largest
    assert r.created_at == dt.datetime(2025, 1, 2, 3, 4, 5)


def test_sync_plan_is_one_aggregate_and_an_anti_join(spark):
    media = media_df(spark)
    plan = L.sync_media_to_training(media, media.select("imdb_id"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "LeftAnti" in plan
    assert "LeftOuter" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_fill_title_only_touches_title(spark):
    df = spark.createDataFrame([(None, None)], "media_title string, tagline string")
    r = L.fill_title(df).first()
    assert r.media_title == "" and r.tagline is None


def test_stamp_utc_is_zone_less_and_one_value(spark):
    df = spark.range(5).repartition(3)
    out = L.stamp_utc(df)
    assert out.schema["created_at"].dataType == T.TimestampNTZType()
    vals = {(r.created_at, r.updated_at) for r in out.collect()}
    assert len(vals) == 1
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    (c, u), = vals
    assert c == u and abs((now - c).total_seconds()) < 300


def test_align_to_defaults_and_rejects_unknown_columns(spark):
    target = T.StructType([T.StructField("k", T.StringType()),
                           T.StructField("reviewed", T.BooleanType(), True, {"default": "false"}),
                           T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("a",)], "k string")
    r = L.align_to(df, target).first()
    assert (r.k, r.reviewed, r.n) == ("a", False, None)
    with pytest.raises(ValueError):
        L.align_to(spark.createDataFrame([("a", 1)], "k string, extra int"), target)


def test_append_by_name(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    out = L.append_by_name(spark.createDataFrame([("b",)], "k string"), t)
    assert sorted(out.collect()) == [("a", 1), ("b", None)]


def test_set_flag_all_keeps_other_columns(spark, store):
    df = spark.createDataFrame([("a", False, dt.datetime(2024, 1, 1)), ("b", None, None)],
                               "k string, reviewed boolean, updated_at timestamp")
    store.write(df, "atp", "training")
    store.rewrite("atp", "training", lambda d: L.set_flag_all(d, "reviewed", True))
    got = sorted(store.read("atp", "training").collect())
    assert [(r.k, r.reviewed) for r in got] == [("a", True), ("b", True)]
    assert got[0].updated_at == dt.datetime(2024, 1, 1) and got[1].updated_at is None
    out = L.set_flag_all(df, "reviewed", False)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in df.schema]


def test_enum_type_rejects_repeats():
    with pytest.raises(ValueError):
        EnumType("x", ("a", "a"))


def test_array_without_null_elements_uses_plain_max(spark):
    df = spark.createDataFrame([("t", ["a", "b"]), ("t", ["a"])],
                               T.StructType([T.StructField("k", T.StringType()),
                                             T.StructField("arr", T.ArrayType(T.StringType(), False))]))
    out = L.consolidate_max(df, "k")
    assert out.first().arr == ["a", "b"]
    assert "transform" not in out._jdf.queryExecution().executedPlan().toString()


def _with_threshold(spark, value, fn):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        return fn()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("threshold", ["-1", "16", "1g"])
def test_sync_outcome_does_not_depend_on_sizes(spark, threshold):
    """A bad enum value on a known or unjudged title never matters; on a new one it always raises."""
    rows = [("known", "film", "accepted"), ("open", "film", "unfiltered"), ("new", "movie", "accepted")]
    media = with_enum(spark.createDataFrame(rows, "k string, mt string, s string"), "mt", MEDIA_TYPE)
    training = spark.createDataFrame([("known",)], "k string")

    def sync(df):
        return L.sync_media_to_training(df, training, key="k", status="s", columns=["mt"], title=None, stamps=()).collect()

    assert _with_threshold(spark, threshold, lambda: [tuple(r) for r in sync(media)]) == [("new", "would_watch", "movie")]
    bad = with_enum(media.unionByName(spark.createDataFrame([("new", "reel", "accepted")], media.schema)), "mt", MEDIA_TYPE)
    with pytest.raises(Exception, match="invalid input value for enum media_type"):
        _with_threshold(spark, threshold, lambda: sync(bad))


def test_sync_plan_starts_no_job_and_columns_must_exist(spark):
    media = media_df(spark)
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "")
    try:
        L.sync_media_to_training(media, media.select("imdb_id"))
        assert not sc.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ValueError, match="titel"):
        L.sync_media_to_training(media, media.select("imdb_id"), columns=["media_type", "titel"])


def test_statuses_outside_the_domain_stay(spark):
    df = spark.createDataFrame([("a", "accepted"), ("a", "weird"), ("a", None), ("a", "weird")], STATUS_SCHEMA)
    r = L.collect_statuses(df, "k", "s", ("rejected", "accepted")).first()
    assert [tuple(e) for e in r.statuses] == [("accepted", 1), ("weird", 2), (None, 1)]
    assert (r.n_statuses, r.n_null_statuses) == (4, 1)
    assert {tuple(e) for e in L.collect_statuses(df, "k", "s").first().statuses} == {tuple(e) for e in r.statuses}


def test_constraints_hold_for_values_and_defaults(spark):
    def target(**md):
        return T.StructType([T.StructField("k", T.StringType()), T.StructField("a", T.IntegerType(), True, md)])

    rows = spark.createDataFrame([("x",)], "k string")
    with pytest.raises(Exception, match="a_check"):
        L.align_to(rows, target(default="-1", check="a > 0")).collect()
    assert L.align_to(rows, target(default="3", check="a > 0")).first().a == 3
    with pytest.raises(Exception, match="not-null"):
        L.align_to(rows, target(not_null=True)).collect()
    code = T.StructType([T.StructField("k", T.StringType(), True, {"char_length": 3})])
    assert [r.k for r in L.align_to(spark.createDataFrame([("abc",), ("ab  ",), (None,)], "k string"), code).collect()] == ["abc", "ab ", None]
    with pytest.raises(Exception, match="too long"):
        L.align_to(spark.createDataFrame([("abcd",)], "k string"), code).collect()
