import datetime as dt


import pytest
from pyspark.sql import types as T

from ledgerline.functions.enums import enum_columns
from ledgerline.operators import quality as Q
from ledgerline.sources.keys import DuplicateKeys
from ledgerline.sources.spec import check_expression, schema_from_spec
from samples import MEDIA_SAMPLES, media_df, media_spec, spec


def test_media_spec_has_45_columns_and_4_enums():
    ms = media_spec()
    assert len(ms.schema.fields) == 45
    assert set(ms.enums) == {"media_type", "pipeline_status", "rejection_status", "rss_source"}
    assert set(enum_columns(ms.schema)) == set(ms.enums)
    assert ms.primary_key == ["hash"]
    assert {"hash", "media_type", "original_title", "created_at"} <= set(ms.not_null)
    assert len(ms.checks) == 13
    s = ms.schema
    assert s["tmdb_rating"].dataType == T.DecimalType(5, 3)
    assert s["genre"].dataType == T.ArrayType(T.StringType())
    assert s["budget"].dataType == T.LongType()
    assert s["created_at"].dataType == T.TimestampType()
    assert s["hash"].metadata["char_length"] == 40
    assert ms.indexes == [["imdb_id"], ["tmdb_id"], ["pipeline_status"]]
    tr = schema_from_spec(spec(), "training")
    assert tr.schema["training_data"].dataType == T.StringType()


def test_check_expression_translates_regex_match():
    assert check_expression("imdb_id ~ '^tt[0-9]{7,8}$'") == "imdb_id RLIKE '^tt[0-9]{7,8}$'"


def test_defaults_apply_only_to_absent_columns(spark):
    df = media_df(spark)
    r = {x.imdb_id: x for x in df.collect()}
    assert r["tt7000011"].error_condition is None
    # explicit NULL in the records stays NULL; absent column takes its default
    recs = [dict(MEDIA_SAMPLES[0])]
    recs[0].pop("pipeline_status")
    recs[0]["error_status"] = None
    got = media_df(spark, recs).first()
    assert got.pipeline_status == "ingested" and got.error_status is None
    assert got.rejection_status == "accepted"
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - got.created_at).total_seconds()) < 300


def test_samples_dict_becomes_json_text(spark):
    from ledgerline.sources.spec import load_samples

    tr = schema_from_spec(spec(), "training")
    df = load_samples(spark, [{"hash": "a" * 40, "training_data": {"features": ["genre"], "n": 1},
                               "model_version": "v1"}], tr)
    assert df.first().training_data == '{"features": ["genre"], "n": 1}'


def test_check_violations_single_pass_and_null_passes(spark):
    df = media_df(spark)
    recs = [dict(MEDIA_SAMPLES[0], hash="test" + "9" * 36, release_year=1700, imdb_id="x1", tmdb_rating=None,
                 rt_score=101)]
    bad = media_df(spark, recs)
    out = {r.rule: r.violations for r in Q.check_violations(df.unionByName(bad),
                                                             Q.rules_from_spec(media_spec())).collect()}
    assert out["hash_check"] == 1          # letters outside a-f
    assert out["release_year_check"] == 1
    assert out["imdb_id_check"] == 1
    assert out["rt_score_check"] == 1
    assert out["tmdb_rating_check"] == 0   # NULL passes
    assert out["budget_check"] == 0
    plan = Q.check_violations(df, Q.rules_from_spec(media_spec()))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_rule_helpers(spark):
    df = spark.createDataFrame([(1, "ab"), (5, "zz"), (None, None)], "n int, s string")
    out = {r.rule: r.violations for r in Q.check_violations(
        df, [Q.Rule("n_small", Q.between("n", 0, 3)), Q.Rule("s_ab", Q.matches("s", "^[ab]+$"))], "t").collect()}
    assert out == {"n_small": 1, "s_ab": 1}


def test_key_violations(spark):
    df = spark.createDataFrame([("a", "movie"), ("a", "movie"), ("a", "film"), ("b", None), (None, "movie")],
                               "hash string, media_type string")
    from ledgerline.functions.domains import MEDIA_TYPE

    got = {(r.check_name, r.column_name): r.violations
           for r in Q.key_violations(df, ["hash"], ["media_type"], {"media_type": MEDIA_TYPE}).collect()}
    assert got == {("duplicate_key", "hash"): 1, ("duplicate_row", "hash"): 2, ("not_null", "hash"): 1,
                   ("not_null", "media_type"): 1, ("enum_domain", "media_type"): 1}


def test_apply_defaults_orders(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType(), True, {"default": "7"}),
                           T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("x", None)], "b string, a int")
    assert Q.apply_defaults(df, schema).first().a is None
    out = Q.apply_defaults(spark.createDataFrame([("x", 1)], "b string, z int"), schema, order="schema")
    assert out.columns == ["a", "b", "z"] and out.first().a == 7


def test_table_stats_and_missing(spark, store):
    store.write(spark.range(4), "atp", "media")
    got = {r.table_name: (r.table_exists, r.row_count)
           for r in Q.store_table_stats(store, "atp", ["media", "training"]).collect()}
    assert got == {"media": (True, 4), "training": (False, None)}
    assert store.tables("atp") == ["media"]


def test_flag_distribution_counts_nulls(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    assert {r.f: r.n for r in Q.flag_distribution(df, "f").collect()} == {True: 2, False: 1, None: 1}


def test_read_json_records_keeps_objects_as_text(spark, tmp_path):
    from ledgerline.sources.spec import read_json_records

    p = tmp_path / "t.jsonl"
    p.write_text('{"hash": "a", "training_data": {"f": [1, 2]}, "model_version": "v1", '
                 '"created_at": "2024-01-02T03:04:05"}\n{"hash": "b", "training_data": null}\n')
    tr = schema_from_spec(spec(), "training")
    rows = {r.hash: r for r in read_json_records(spark, str(p), tr).collect()}
    assert rows["a"].training_data == '{"f": [1, 2]}'
    assert rows["a"].created_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows["b"].training_data is None and rows["b"].model_version is None
    bad = tmp_path / "m.jsonl"
    bad.write_text('{"hash": "c", "media_type": "film"}\n')
    with pytest.raises(Exception, match="invalid input value for enum media_type"):
        read_json_records(spark, str(bad), media_spec()).collect()


def test_drop_schema(spark, store):
    store.write(spark.range(1), "tmp", "t")
    assert store.drop_schema("tmp") and not store.schema_exists("tmp")


def test_appends_enforce_declared_constraints(spark, store):
    ms = media_spec()
    store.create("atp", "media", ms.schema)
    good = media_df(spark)
    assert store.append(good, "atp", "media") == 3
    cases = [
        (dict(MEDIA_SAMPLES[0], release_year=1700), "release_year_check"),
        (dict(MEDIA_SAMPLES[0], media_type="film"), "invalid input value for enum media_type"),
        (dict(MEDIA_SAMPLES[0], original_title=None), "original_title violates not-null"),
    ]
    for rec, msg in cases:
        with pytest.raises(Exception, match=msg):
            store.append(media_df(spark, [rec]), "atp", "media")
    # NULL passes a CHECK, as in SQL (under a key of its own: the table's is held too)
    other = dict(MEDIA_SAMPLES[0], release_year=None, hash="f" * 40)
    with pytest.raises(DuplicateKeys):
        store.append(media_df(spark, [dict(other, hash=MEDIA_SAMPLES[0]["hash"])]), "atp", "media")
    assert store.append(media_df(spark, [other]), "atp", "media") == 1
    assert store.read("atp", "media").count() == 4


def test_create_is_idempotent_with_if_not_exists(spark, store):
    ms = media_spec()
    assert store.create("atp", "media", ms.schema, if_not_exists=True)
    store.append(media_df(spark), "atp", "media")
    assert not store.create("atp", "media", ms.schema, if_not_exists=True)
    assert store.read("atp", "media").count() == 3
    s = store.schema_of("atp", "media")
    assert [f.name for f in s] == [f.name for f in ms.schema]
    assert s["pipeline_status"].metadata["default"] == "'ingested'"
    assert s["hash"].metadata["not_null"] is True
    assert store.create("atp", "media", ms.schema)          # plain create replaces
    assert store.read("atp", "media").count() == 0


def test_literal_rows_and_empty_frame_keep_the_schema(spark):
    import decimal as _d

    from ledgerline.functions.rows import empty_frame, literal_rows

    s = T.StructType([T.StructField("a", T.StringType(), True, {"default": "'x'"}),
                      T.StructField("d", T.DateType()),
                      T.StructField("t", T.TimestampNTZType()),
                      T.StructField("n", T.DecimalType(5, 3))])
    rows = [("p", dt.date(2025, 1, 2), dt.datetime(2025, 1, 2, 3, 4, 5, 6), _d.Decimal("1.250")),
            (None, None, None, None)]
    df = literal_rows(spark, rows, s)
    assert [f.dataType for f in df.schema] == [f.dataType for f in s]
    assert df.schema["a"].metadata["default"] == "'x'"
    assert [tuple(r) for r in df.collect()] == rows
    e = empty_frame(spark, s)
    assert e.count() == 0 and e.schema["a"].metadata["default"] == "'x'"
