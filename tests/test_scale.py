"""Skew and plan-shape checks: a key holding a third of all rows, partial
aggregation before every exchange, no unbounded collections, pushdown."""

from pyspark.sql import functions as F

from ledgerline.functions.domains import REJECTION_STATUS
from ledgerline.operators import labels as L
from ledgerline.operators import quality as Q
from ledgerline.operators import restore as R

N = 30000
STATUSES = ("unfiltered", "accepted", "rejected", "override")


def _skewed(spark):
    """Every third row belongs to title 0; statuses cycle, with some NULLs."""
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 97 == 5, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (F.col("id") % 4 + 1).cast("int")))
         .alias("s"),
        F.col("id").alias("v"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
        F.array(F.lit("x"), F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("y"))).alias("tags"),
    )
    return df.repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sync_on_hot_key_is_exact_and_combines_map_side(spark):
    df = _skewed(spark)
    target = spark.createDataFrame([(7,)], "k long")
    out = L.sync_media_to_training(df, target, key="k", status="s", columns=["v", "title", "tags"],
                                   title="title", stamps=())
    hot = out.where("k = 0").first()
    assert hot.label == "would_watch"
    assert hot.v == max(range(0, N, 3))
    assert hot.tags == ["x", None]
    assert out.where("k = 7").count() == 0
    plan = _plan(out)
    assert "partial_max" in plan and "partial_count" in plan
    assert "collect_list" not in plan and "collect_set" not in plan


def test_collect_statuses_on_hot_key_is_bounded(spark):
    df = _skewed(spark)
    for domain in (REJECTION_STATUS, None):
        hot = L.collect_statuses(df, "k", "s", domain).where("k = 0").first()
        assert hot.n_statuses == N // 3
        assert len(hot.statuses) <= len(STATUSES) + 1
        assert sum(e["n"] for e in hot.statuses) == N // 3


def test_key_violations_on_hot_key(spark):
    df = _skewed(spark)
    got = {r.check_name: r.violations for r in Q.key_violations(df, ["k"]).collect()}
    assert got["duplicate_key"] == 1 and got["duplicate_row"] == N // 3 - 1


def test_round_trip_diff_with_many_identical_rows(spark):
    a = spark.range(N).select((F.col("id") % 3 == 0).alias("f"),
                              F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    b = a.union(a.where("k = 0").limit(5))
    d = R.round_trip_diff(a, b).first()
    assert (d.rows_before, d.lost, d.added) == (N, 0, 5)
    assert "partial_count" in _plan(R.round_trip_diff(a, b))


def test_scan_prunes_columns_and_pushes_key_filter(spark, tmp_path):
    p = str(tmp_path / "m")
    _skewed(spark).write.parquet(p)
    df = L.keyed_rows(spark.read.parquet(p), "k").select("k", "v")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(k)]" in plan
    assert "ReadSchema: struct<k:bigint,v:bigint>" in plan


def test_session_defaults_enable_aqe_and_utc(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_key_violations_is_one_scan(spark, tmp_path):
    p = str(tmp_path / "kv")
    _skewed(spark).write.parquet(p)
    plan = _plan(Q.key_violations(spark.read.parquet(p), ["k"], ["title"]))
    assert plan.count("FileScan parquet") == 1
    assert "partial_count" in plan


def test_no_local_scratch_folder_on_a_cluster():
    import pytest

    from ledgerline.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    Context.getCheckpointDir = lambda self: "hdfs:///shared/ckpt/"
    assert checkpoint_root(Session()) == "hdfs:///shared/ckpt"
