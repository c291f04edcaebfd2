import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.enums import enum_columns, enum_of
from ledgerline.operators import quality as Q
from ledgerline.operators import restore as R
from ledgerline.operators import snapshot as S
from ledgerline.sources.store import TableNotFound
from samples import media_df

DAY1, DAY2 = "20250101", "20250108"


def _media(spark, store):
    store.write(media_df(spark), "atp", "media")
    return store.read("atp", "media")


def test_empty_table_backs_up_with_mapping_and_metadata(spark, store):
    df = media_df(spark).limit(0)
    store.write(df, "atp", "media")
    res = S.backup_table(store, "atp", "media", DAY1)
    names = S.snapshot_names("atp", "media", DAY1)
    assert res.rows == 0 and res.backup_table == "bak.atp_media_20250101"
    assert S.read_snapshot(store, names).count() == 0
    assert S.read_snapshot(store, names, "mapping").count() == 45
    meta = S.read_snapshot(store, names, "metadata").collect()
    assert len(meta) == 1 and meta[0].backup_date == dt.date(2025, 1, 1)
    assert (meta[0].source_schema, meta[0].source_table, meta[0].backup_table) == \
        ("atp", "media", "atp_media_20250101")


def test_snapshot_keeps_columns_and_converts_enums(spark, store):
    df = _media(spark, store)
    res = S.backup_table(store, "atp", "media", DAY1)
    assert res.converted_enums == ["media_type", "pipeline_status", "rejection_status", "rss_source"]
    snap = S.read_snapshot(store, S.snapshot_names("atp", "media", DAY1))
    assert snap.columns == df.columns
    assert enum_columns(snap.schema) == {}
    assert [f.dataType for f in snap.schema] == [f.dataType for f in df.schema]
    assert sorted(snap.collect()) == sorted(df.collect())
    mapping = {r.source_column_name: r for r in
               S.read_snapshot(store, S.snapshot_names("atp", "media", DAY1), "mapping").collect()}
    assert (mapping["media_type"].source_data_type, mapping["media_type"].bak_data_type,
            mapping["media_type"].enum_name) == ("media_type", "string", "media_type")
    assert (mapping["tmdb_rating"].source_data_type, mapping["tmdb_rating"].enum_name) == ("decimal(5,3)", None)
    assert mapping["genre"].bak_data_type == "array<string>"


def test_same_day_backup_replaces(spark, store):
    _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    store.write(media_df(spark).limit(1), "atp", "media")
    S.backup_table(store, "atp", "media", DAY1)
    assert S.read_snapshot(store, S.snapshot_names("atp", "media", DAY1)).count() == 1
    assert R.snapshot_dates(store, "atp", "media") == [DAY1]


def test_backup_of_missing_table_fails(spark, store):
    with pytest.raises(TableNotFound):
        S.backup_table(store, "atp", "nothing", DAY1)


def test_backup_all_reports_each_table(spark, store):
    _media(spark, store)
    rep = {r.source: r for r in S.backup_all(store, ["media", "prediction"], date=DAY1).collect()}
    assert rep["atp.media"].status == "success" and rep["atp.media"].rows == 3
    assert rep["atp.prediction"].status == "failed" and "no table" in rep["atp.prediction"].error


def test_restore_picks_newest_and_round_trips(spark, store):
    store.write(_media(spark, store), "atp", "expected")
    df = store.read("atp", "expected")
    S.backup_table(store, "atp", "media", DAY1)
    store.write(df.unionByName(df), "atp", "media")  # second snapshot holds 6 rows
    S.backup_table(store, "atp", "media", DAY2)
    assert R.latest_snapshot(store, "atp", "media").date == DAY2
    store.truncate("atp", "media")
    with pytest.raises(R.DuplicateKeys, match="snapshot repeats"):
        R.reload_table(store, "atp", "media")
    res = R.reload_table(store, "atp", "media", on_conflict="append")
    assert res.rows == 6 and res.date == DAY2 and res.skipped == []
    after = store.read("atp", "media")
    assert enum_of(after.schema["media_type"]).name == "media_type"
    diff = R.round_trip_diff(df.unionByName(df), after).first()
    assert (diff.rows_before, diff.rows_after, diff.lost, diff.added) == (6, 6, 0, 0)
    # explicit date; a second restore repeats primary keys, which is refused unless asked for
    with pytest.raises(R.DuplicateKeys):
        R.reload_table(store, "atp", "media", date=DAY1)
    assert R.reload_table(store, "atp", "media", date=DAY1, on_conflict="append").rows == 3
    assert store.read("atp", "media").count() == 9


def test_restore_errors(spark, store):
    with pytest.raises(R.SnapshotNotFound):
        R.latest_snapshot(store, "atp", "media")
    _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    with pytest.raises(TableNotFound, match="to restore into"):
        R.reload_table(store, "atp", "media", target_table="absent")
    with pytest.raises(R.SnapshotNotFound):
        R.reload_table(store, "atp", "media", date="20240101")
    # the newest day without its mapping is an error, not a reason to take an older one
    from ledgerline.sources import fs
    S.backup_table(store, "atp", "media", DAY2)
    fs.delete(spark, S.snapshot_path(store, S.snapshot_names("atp", "media", DAY2), "mapping"))
    assert R.latest_snapshot(store, "atp", "media").date == DAY2
    for date in (None, DAY2):
        with pytest.raises(R.MappingNotFound):
            R.reload_table(store, "atp", "media", date=date)


def test_partial_mapping_and_schema_change(spark, store):
    df = _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    names = S.snapshot_names("atp", "media", DAY1)
    snap = S.read_snapshot(store, names)
    full = S.read_snapshot(store, names, "mapping")
    keep = ["hash", "media_type", "media_title", "season", "episode", "release_year",
            "pipeline_status", "error_status", "rejection_status", "rss_source", "original_title"]
    partial = full.where(F.col("source_column_name").isin(keep)).collect()
    # target lost 'season', gained 'note'
    target = T.StructType([f for f in df.schema.fields if f.name != "season"]
                          + [T.StructField("note", T.StringType(), True, {"default": "'restored'"})])
    rec = R.reconcile(snap, partial, target)
    assert rec.columns == sorted(c for c in keep if c != "season")
    assert rec.skipped == [("season", "the target has no such column")]
    store.create("atp", "media_v2", target)
    res = R.reload_table(store, "atp", "media", target_table="media_v2")
    assert res.rows == 3
    # full mapping was used by reload: everything but season restored, note took its default
    out = store.read("atp", "media_v2")
    assert out.columns == [f.name for f in target.fields]
    assert {r.note for r in out.collect()} == {"restored"}
    assert sorted(r.budget for r in out.collect() if r.budget is not None) == [410000]


def test_reconcile_renamed_and_missing_backup_column(spark):
    snap = spark.createDataFrame([(1, "x")], "old_id int, v string")
    mapping = [{"source_column_name": "id", "bak_column_name": "old_id", "bak_data_type": "int"},
               {"source_column_name": "w", "bak_column_name": "w", "bak_data_type": "string"},
               {"source_column_name": None, "bak_column_name": "v"}]
    target = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("w", T.StringType())])
    rec = R.reconcile(snap, mapping, target)
    assert rec.df.collect()[0].id == 1 and rec.columns == ["id"]
    assert rec.skipped == [("w", "the snapshot has no column w")]
    with pytest.raises(R.NoCommonColumns):
        R.reconcile(snap, mapping[1:], target)


def test_restore_rejects_value_outside_enum(spark, store):
    _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    names = S.snapshot_names("atp", "media", DAY1)
    bad = S.read_snapshot(store, names).withColumn("media_type", F.lit("film"))
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    bad.write.mode("overwrite").parquet(S.snapshot_path(store, names))
    store.truncate("atp", "media")
    with pytest.raises(Exception, match="invalid input value for enum media_type"):
        R.reload_table(store, "atp", "media")


def test_on_conflict_error(spark, store):
    _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    with pytest.raises(R.DuplicateKeys):
        R.reload_table(store, "atp", "media", on_conflict="error", key=["hash"])
    store.truncate("atp", "media")
    assert R.reload_table(store, "atp", "media", on_conflict="error", key=["hash"]).rows == 3


SCORES = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("score", T.DecimalType(10, 9)),
    T.StructField("predicted_good", T.BooleanType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("created_at", T.TimestampType()),
])


def test_values_survive_exactly(spark, store):
    ts = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [(f"{i:040x}", decimal.Decimal(v), flag, arr, t) for i, (v, flag, arr, t) in enumerate([
        ("0.123456789", True, ["a", None], ts), ("0.987654321", False, [], None),
        ("0.000000001", None, None, ts), ("0.500000000", True, ["x"], ts)])]
    df = spark.createDataFrame(rows, SCORES)
    store.write(df, "atp", "prediction")
    S.backup_table(store, "atp", "prediction", DAY1)
    store.truncate("atp", "prediction")
    R.reload_table(store, "atp", "prediction")
    assert sorted(store.read("atp", "prediction").collect()) == sorted(df.collect())


def test_many_rows_flag_split_and_null_pattern(spark, store):
    df = spark.range(500).select(F.format_string("%040x", "id").alias("hash"),
                                 (F.col("id") % 2 == 0).alias("predicted_good"),
                                 F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("n"))
    store.write(df, "atp", "prediction")
    S.backup_table(store, "atp", "prediction", DAY1)
    store.truncate("atp", "prediction")
    assert R.reload_table(store, "atp", "prediction").rows == 500
    out = store.read("atp", "prediction")
    assert {r.predicted_good: r.n for r in Q.flag_distribution(out, "predicted_good").collect()} == \
        {True: 250, False: 250}
    assert {r.n_is_null: r.n for r in Q.null_pattern(out, ["n"]).collect()} == {True: 100, False: 400}


def test_round_trip_diff_counts_lost_and_added(spark):
    a = spark.createDataFrame([(1, ["x"]), (1, ["x"]), (2, None)], "k int, v array<string>")
    b = spark.createDataFrame([(1, ["x"]), (2, None), (3, None)], "k int, v array<string>")
    d = R.round_trip_diff(a, b).first()
    assert (d.rows_before, d.rows_after, d.lost, d.added) == (3, 3, 1, 1)
    rows = {r.k: (r.n_before, r.n_after) for r in R.round_trip_rows(a, b).collect()}
    assert rows == {1: (2, 1), 3: (0, 1)}


def test_latest_partition_anchors_the_pattern(spark, tmp_path):
    base = str(tmp_path / "ds")
    spark.range(3).withColumn("snapshot_date", F.lit("20250101")).write.partitionBy("snapshot_date").parquet(base)
    spark.range(5).write.parquet(base + "/snapshot_date=202501019")  # not 8 digits
    spark.range(7).write.parquet(base + "/snapshot_date=20250102.__staged-x")
    value, df = R.latest_partition(spark, base)
    assert value == "20250101" and df.count() == 3
    with pytest.raises(R.SnapshotNotFound):
        R.latest_partition(spark, base, value="20991231")


def test_snapshots_in_a_separate_store(spark, tmp_path):
    from ledgerline.sources.store import TableStore

    live = TableStore(spark, str(tmp_path / "live"))
    bak = TableStore(spark, str(tmp_path / "bak"))
    live.write(media_df(spark), "atp", "media")
    plain = live.read("atp", "media")
    for c in ("media_type", "pipeline_status", "rejection_status", "rss_source"):
        plain = plain.withMetadata(c, {})
    live.write(plain, "atp", "plain")       # like a database read: no enum metadata
    from ledgerline.functions.domains import MEDIA_TYPE

    res = S.backup_table(live, "atp", "plain", DAY1, backup_store=bak, enums={"media_type": MEDIA_TYPE})
    assert res.converted_enums == ["media_type"]
    assert not live.schema_exists("bak") and bak.schema_exists("bak")
    live.truncate("atp", "plain")
    assert R.reload_table(live, "atp", "plain", backup_store=bak).rows == 3
    assert R.reload_all(live, ["plain"], backup_store=bak, on_conflict="append").first().status == "success"


def test_jdbc_store_options_without_a_database(spark):
    from ledgerline.sources.jdbc import JdbcTableStore

    st = JdbcTableStore.from_env(spark, env={"PGHOST": "db", "PGDATABASE": "cat", "PGUSER": "u"},
                                 partitions={"atp.media": {"partitionColumn": "tmdb_id", "numPartitions": "64"}})
    assert st.url == "jdbc:postgresql://db:5432/cat"
    o = st.options(dbtable="atp.media")
    assert o["user"] == "u" and o["stringtype"] == "unspecified" and "password" not in o
    assert st._catalog_query("atp", "o'x").endswith("AND table_name = 'o''x'")
    assert st.partitions["atp.media"]["numPartitions"] == "64"


def test_table_name_extending_another_is_separate(spark, store):
    store.write(spark.range(2), "atp", "media")
    store.write(spark.range(5), "atp", "media_x")
    S.backup_table(store, "atp", "media", DAY1)
    S.backup_table(store, "atp", "media_x", DAY2)
    assert R.snapshot_dates(store, "atp", "media") == [DAY1]
    assert R.latest_snapshot(store, "atp", "media").date == DAY1


def test_failed_write_leaves_the_old_rows(spark, store):
    store.write(spark.range(3), "atp", "t")
    boom = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("boom")).cast("long")).alias("id"))
    for attempt in (lambda: store.write(boom, "atp", "t"), lambda: store.append(boom, "atp", "t"),
                    lambda: store.rewrite("atp", "t", lambda _: boom)):
        with pytest.raises(Exception, match="boom"):
            attempt()
        assert store.read("atp", "t").count() == 3
    assert store.tables("atp") == ["t"]


def test_failed_same_day_backup_leaves_the_old_one(spark, store):
    df = _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)

    class Broken:
        spark = store.spark

        def exists(self, *a):
            return True

        def read(self, *a):
            return df.withColumn("media_title", F.raise_error(F.lit("boom")).cast("string"))

    with pytest.raises(Exception, match="boom"):
        S.backup_table(Broken(), "atp", "media", DAY1, backup_store=store)
    store.truncate("atp", "media")
    assert R.reload_table(store, "atp", "media").rows == 3


def test_failed_reload_appends_nothing(spark, store):
    _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    live = store.schema_of("atp", "media")
    strict = T.StructType([T.StructField(f.name, f.dataType, True, {**f.metadata, "check": "tmdb_id <> 7033"} if f.name == "tmdb_id" else f.metadata)
                           for f in live.fields])
    store.create("atp", "media", strict)
    with pytest.raises(Exception, match="tmdb_id_check"):
        R.reload_table(store, "atp", "media")
    assert store.read("atp", "media").count() == 0


def test_readers_between_the_steps_change_nothing(spark, store):
    """Readers at every point of a replacement see the old or the new rows, and the writer's result stands."""
    from ledgerline.sources.store import TableStore

    store.write(spark.range(3), "atp", "t")
    reader, seen = TableStore(spark, store.root), []

    class Watched(TableStore):
        def _save(self, df, path, observe):
            seen.append(reader.read("atp", "t").count())
            out = super()._save(df, path, observe)
            seen.append(reader.read("atp", "t").count())
            return out

        def publish(self, *a):
            seen.append(reader.read("atp", "t").count())
            return super().publish(*a)

    Watched(spark, store.root).write(spark.range(7), "atp", "t")
    assert seen == [3, 3, 3] and reader.read("atp", "t").count() == 7


def test_writers_do_not_undo_each_other(spark, store):
    from ledgerline.sources.store import ConcurrentWrite

    store.write(spark.range(3), "atp", "t")

    def meanwhile(df):
        store.append(spark.range(2), "atp", "t")
        return df

    with pytest.raises(ConcurrentWrite):
        store.rewrite("atp", "t", meanwhile)
    assert store.read("atp", "t").count() == 5
    head = store.head(store.path("atp", "t"))
    store.append(spark.range(1), "atp", "t")
    with pytest.raises(ConcurrentWrite):
        store.append(spark.range(9), "atp", "t", after=head)
    # two appends from one state: the second goes on top of the first
    old = store._head_of
    store._head_of = lambda *a: (setattr(store, "_head_of", old), head)[1]
    store.append(spark.range(4), "atp", "t")
    assert store.read("atp", "t").count() == 10
    # an unfinished log file is not the published state, and vacuum keeps what is
    from ledgerline.sources import fs
    fs.create_text(spark, f"{store.path('atp', 't')}/_log/0000000099.json", "{")
    store.vacuum(store.path("atp", "t"))
    assert store.read("atp", "t").count() == 10


def test_reload_report_names_skipped_columns(spark, store):
    df = _media(spark, store)
    S.backup_table(store, "atp", "media", DAY1)
    store.create("atp", "media", T.StructType([f for f in df.schema.fields if f.name not in ("season", "budget")]))
    r = R.reload_all(store, ["media"]).first()
    assert r.status == "success" and r.skipped == "budget: the target has no such column; season: the target has no such column"
    again = R.reload_all(store, ["media"]).first()
    assert again.status == "failed" and "DuplicateKeys" in again.error
    assert R.reload_all(store, ["media"], on_conflict="append").first().status == "success"


def test_keyed_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (3, "z", 2.0)], "k int, v string, w double")
    b = spark.createDataFrame([(1, "x", None), (2, "y", 1.5), (4, "z", 2.0)], "k int, v string, w double")
    assert tuple(R.keyed_diff(a, b, ["k"]).first()) == (3, 3, 2, 2)
    assert tuple(R.keyed_diff(a, a, ["k"]).first()) == (3, 3, 0, 0)
    with pytest.raises(Exception, match="not unique"):
        R.keyed_diff(a.union(a), b, ["k"]).collect()


def test_jdbc_reads_go_through_load(spark):
    """A stub reader in the place of the database: catalog, enums, and the row read."""
    from ledgerline.sources.jdbc import JdbcTableStore

    asked = []

    class Stub(JdbcTableStore):
        def _reader(self, **extra):
            asked.append(extra)

            class Reader:
                def load(self):
                    q = extra.get("query", "")
                    if "pg_enum" in q:
                        return spark.createDataFrame([("s", "state", 2.0, "b"), ("s", "state", 1.0, "a")],
                                                     "column_name string, type_name string, place double, label string")
                    if q:
                        return spark.createDataFrame([("media",)] if "'media'" in q or "table_name =" not in q else [], "table_name string")
                    return spark.createDataFrame([(1, "b")], "id int, s string")

            return Reader()

    st = Stub.from_env(spark, env={}, partitions={"atp.media": {"partitionColumn": "id", "numPartitions": "8"}})
    assert st.exists("atp", "media") and not st.exists("atp", "other") and st.tables("atp") == ["media"]
    df = st.read("atp", "media")
    assert enum_of(df.schema["s"]).values == ("a", "b") and df.count() == 1
    assert any(x.get("dbtable") == "atp.media" and x.get("numPartitions") == "8" for x in asked)
    with pytest.raises(NotImplementedError):
        st.rewrite("atp", "media", lambda d: d)
    from ledgerline.plans.jobs import jdbc_partitions
    assert jdbc_partitions(["media:id:0:100:8"], "atp")["atp.media"]["numPartitions"] == "8"


def test_thousand_scores_back_up_exactly(spark, store):
    scores = T.StructType([T.StructField("hash", T.StringType()),
                           T.StructField("prediction_score", T.DecimalType(5, 3))])
    df = spark.range(1000).select(F.format_string("%040x", "id").alias("hash"),
                                  (F.col("id") / F.lit(1000)).cast(T.DecimalType(5, 3)).alias("prediction_score"))
    store.write(df, "atp", "prediction")
    assert S.backup_table(store, "atp", "prediction", DAY1).rows == 1000
    snap = S.read_snapshot(store, S.snapshot_names("atp", "prediction", DAY1))
    assert snap.schema["prediction_score"].dataType == scores["prediction_score"].dataType
    got = {r.hash: r.prediction_score for r in snap.collect()}
    assert len(got) == 1000
    assert all(got[f"{i:040x}"] == decimal.Decimal(i) / 1000 for i in range(1000))


def test_on_conflict_error_for_repeated_snapshot_keys(spark, store):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "hash string, v int")
    store.write(df, "atp", "prediction")
    S.backup_table(store, "atp", "prediction", DAY1)
    store.truncate("atp", "prediction")
    with pytest.raises(R.DuplicateKeys, match="snapshot repeats"):
        R.reload_table(store, "atp", "prediction", on_conflict="error", key=["hash"])
    assert store.read("atp", "prediction").count() == 0   # nothing appended
