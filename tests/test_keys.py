"""Primary keys and concurrent appends of a table store."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import labels as L
from ledgerline.sources import store as store_module
from ledgerline.sources.keys import DuplicateKeys, KeyIndex
from ledgerline.sources.store import ConcurrentWrite
from tests.samples import media_df

KEYED = T.StructType([T.StructField("k", T.LongType(), True, {"primary_key": True, "not_null": True}), T.StructField("v", T.StringType())])
PAIR = T.StructType([T.StructField("a", T.StringType(), True, {"primary_key": True, "char_length": 4, "char_kind": "CHAR"}),
                     T.StructField("b", T.IntegerType(), True, {"primary_key": True}), T.StructField("v", T.StringType())])


def rows(spark, keys, v="x"):
    return spark.createDataFrame([(k, v) for k in keys], "k long, v string")


def read(store):
    return sorted(r.k for r in store.read("s", "t").collect())


def test_repeated_keys_are_refused_and_leave_nothing(spark, store):
    store.create("s", "t", KEYED)
    assert store.append(rows(spark, range(50)), "s", "t") == 50
    with pytest.raises(DuplicateKeys, match="repeat") as e:
        store.append(rows(spark, [100, 101, 100]), "s", "t")
    assert e.value.repeated
    with pytest.raises(DuplicateKeys, match="already holds") as e:
        store.append(rows(spark, [100, 49]), "s", "t")
    assert not e.value.repeated
    with pytest.raises(Exception, match="not-null"):
        store.append(rows(spark, [None]), "s", "t")
    assert read(store) == list(range(50))
    path = store.path("s", "t")
    assert len(store_module.fs.list_dirs(spark, path)) == 3  # _keys, _log and one folder
    assert store.append(rows(spark, [100]), "s", "t") == 1
    assert store.append(rows(spark, [100, 100]), "s", "t", unique=False) == 2


def test_composite_keys_and_padding(spark, store):
    store.create("s", "p", PAIR)
    df = lambda r: spark.createDataFrame(r, "a string, b int, v string")
    assert store.append(df([("x", 1, "1"), ("x", 2, "2"), ("y", 1, "3")]), "s", "p") == 3
    assert store.append(df([("y", 2, "4")]), "s", "p") == 1
    with pytest.raises(DuplicateKeys):
        store.append(df([("x  ", 2, "5")]), "s", "p")
    with pytest.raises(DuplicateKeys):
        store.append(df([("z", 2, "5"), ("z ", 2, "5")]), "s", "p")
    assert store.read("s", "p").count() == 4


def test_only_folders_that_may_hold_a_key_are_opened(spark, store, monkeypatch):
    store.create("s", "t", KEYED)
    for n in range(4):
        store.append(rows(spark, range(1000 * n, 1000 * n + 300 * n + 20)), "s", "t")
    opened = []
    was = KeyIndex.held
    monkeypatch.setattr(KeyIndex, "held", lambda self, *a: opened.append(was(self, *a)) or opened[-1])
    folders = list(store.head(store.path("s", "t")).folders)
    store.append(rows(spark, [50_000, 50_001]), "s", "t")
    assert opened[-1][1] == [] or len(opened[-1][1]) < 4  # a filter may err on the side of a look
    with pytest.raises(DuplicateKeys):
        store.append(rows(spark, [60_000, 2001]), "s", "t")
    assert folders[2] in opened[-1][1] and len(opened[-1][1]) < 5
    plan = opened[-1][0]._jdf.queryExecution().toString()
    assert folders[0] not in plan or folders[0] in opened[-1][1]


def test_filters_never_miss_and_rarely_err(spark, store, tmp_path):
    rng = random.Random(5)
    keys = rng.sample(range(10**9), 6000)
    index = KeyIndex(spark, str(tmp_path / "t"), ["k"])
    depth = index.add("v-1", rows(spark, keys[:3000]))
    assert depth == 6
    index.add("v-2", rows(spark, keys))
    asked = spark.read.parquet(index.files("v-2", "keys"))
    hits = {r.k for r in index.candidates(asked, {"v-1": depth}).collect()}
    assert set(keys[:3000]) <= hits and len(hits - set(keys[:3000])) < 150
    held, opened = index.held("v-2", {"v-1": depth})
    assert {r.k for r in held.collect()} == set(keys[:3000]) and opened == ["v-1"]


def test_folders_of_a_replacement_get_their_key_files_when_needed(spark, store):
    store.create("s", "t", KEYED)
    store.append(rows(spark, range(10)), "s", "t")
    store.rewrite("s", "t", lambda df: df.withColumn("v", F.lit("y")))
    with pytest.raises(DuplicateKeys):
        store.append(rows(spark, [3]), "s", "t")
    assert store.append(rows(spark, [10]), "s", "t") == 1
    store.truncate("s", "t")
    assert store.append(rows(spark, [3]), "s", "t") == 1
    path = store.path("s", "t")
    store.vacuum(path)
    assert store_module.fs.list_dirs(spark, f"{path}/_keys") == list(store.head(path).folders)


def test_two_appends_may_build_the_key_files_of_one_folder(spark, store, monkeypatch):
    store.write(spark.createDataFrame([(k, "x") for k in range(5)], KEYED), "s", "t")
    overtaken(store, monkeypatch, lambda n: store.append(rows(spark, [7]), "s", "t"))
    assert store.append(rows(spark, [8]), "s", "t") == 1
    with pytest.raises(DuplicateKeys):
        store.append(rows(spark, [4]), "s", "t")
    assert read(store) == [0, 1, 2, 3, 4, 7, 8]


def overtaken(store, monkeypatch, between, times=1):
    """Before the next publications, ``between(n)`` runs once each: another writer comes first."""
    left, was = list(range(times)), store_module.TableStore.publish

    def publish(self, *a, **k):
        if left:
            n = left.pop(0)
            monkeypatch.setattr(store_module.TableStore, "publish", was)
            between(n)
            monkeypatch.setattr(store_module.TableStore, "publish", publish)
        return was(self, *a, **k)

    monkeypatch.setattr(store_module.TableStore, "publish", publish)


def test_a_key_that_is_appended_meanwhile_is_refused(spark, store, monkeypatch):
    store.create("s", "t", KEYED)
    overtaken(store, monkeypatch, lambda n: store.append(rows(spark, [2, 3]), "s", "t"))
    with pytest.raises(DuplicateKeys):
        store.append(rows(spark, [1, 2]), "s", "t")
    assert read(store) == [2, 3]
    overtaken(store, monkeypatch, lambda n: store.append(rows(spark, [5]), "s", "t"))
    assert store.append(rows(spark, [6]), "s", "t") == 1
    assert read(store) == [2, 3, 5, 6]


def catalogue(spark, store, keyed=False):
    media = media_df(spark)
    schema = L.sync_target_schema(media.schema)
    if keyed:
        first = schema["imdb_id"]
        schema = T.StructType([T.StructField(f.name, f.dataType, True, {**f.metadata, "primary_key": True} if f is first else f.metadata) for f in schema])
    store.write(media, "atp", "media")
    store.create("atp", "training", schema)


@pytest.mark.parametrize("keyed", [False, True])
def test_two_interleaved_syncs_leave_each_title_once(spark, store, monkeypatch, keyed):
    catalogue(spark, store, keyed)
    overtaken(store, monkeypatch, lambda n: L.sync_into(store))
    assert L.sync_into(store) == 0  # the other one had them all
    titles = [r.imdb_id for r in store.read("atp", "training").collect()]
    assert len(titles) == len(set(titles)) == 2
    assert L.sync_into(store) == 0


def test_rows_left_over_after_others_append_are_kept(spark, store, monkeypatch):
    store.create("s", "t", T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())]))
    plans = []

    def new(keys):
        def plan(t):
            plans.append(keys)
            return L.new_keys_only(rows(spark, keys), t, "k")
        return plan

    overtaken(store, monkeypatch, lambda n: store.append(rows(spark, [n, 7], "other"), "s", "t"), 2)
    assert store.append_planned(new([0, 1, 2, 7]), "s", "t", new_by=["k"]) == 1
    assert len(plans) == 1  # staged rows were held against what came, the plan ran once
    assert sorted((r.k, r.v) for r in store.read("s", "t").collect()) == [(0, "other"), (1, "other"), (2, "x"), (7, "other"), (7, "other")]


def test_a_replaced_table_is_planned_again(spark, store, monkeypatch):
    store.create("s", "t", KEYED)
    store.append(rows(spark, [1]), "s", "t")
    plans = []

    def plan(t):
        plans.append(1)
        return L.new_keys_only(rows(spark, [1, 2]), t, "k")

    overtaken(store, monkeypatch, lambda n: store.truncate("s", "t"))
    assert store.append_planned(plan, "s", "t", new_by=["k"]) == 2
    assert len(plans) == 2 and read(store) == [1, 2]


def test_an_append_bound_to_a_state_still_raises(spark, store):
    store.create("s", "t", KEYED)
    head = store.head(store.path("s", "t"))
    store.append(rows(spark, [1]), "s", "t")
    with pytest.raises(ConcurrentWrite):
        store.append(rows(spark, [2]), "s", "t", after=head)
    assert read(store) == [1]


def test_syncs_in_threads(spark, store):
    catalogue(spark, store)
    got, threads = [], []
    for _ in range(3):
        threads.append(threading.Thread(target=lambda: got.append(L.sync_into(store))))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    titles = [r.imdb_id for r in store.read("atp", "training").collect()]
    assert sum(got) == len(titles) == len(set(titles)) == 2


def test_a_log_cleaned_up_while_it_is_read_is_read_again(spark, store, monkeypatch):
    store.create("s", "t", KEYED)
    path, was, reads = store.path("s", "t"), store_module.fs.read_text, []

    def read_text(session, file):
        reads.append(file)
        if len(reads) == 1:  # another writer publishes and cleans up between our listing and our read
            monkeypatch.setattr(store_module.fs, "read_text", was)
            store.truncate("s", "t")
            store.vacuum(path)
            monkeypatch.setattr(store_module.fs, "read_text", read_text)
        return was(session, file)

    monkeypatch.setattr(store_module.fs, "read_text", read_text)
    assert store.head(path).number == 2 and len(reads) == 2
    monkeypatch.setattr(store_module.fs, "read_text", lambda *a: (_ for _ in ()).throw(OSError("unreachable")))
    with pytest.raises(OSError, match="unreachable"):
        store.head(path)
