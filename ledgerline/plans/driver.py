"""Driver queries: one per operator of the inventory, over the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. Queries that write do so under a fresh folder of the shared
checkpoint root (``spark.checkpoint.dir``) and read the result back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.chars import KIND_KEY, LENGTH_KEY, as_text
from ledgerline.functions.enums import EnumType, with_enum
from ledgerline.operators import labels as L
from ledgerline.operators import quality as Q
from ledgerline.operators import restore as R
from ledgerline.operators import snapshot as S
from ledgerline.plans.catalogue import (
    MEDIA_MAX_COLUMNS, ORDER_PRIORITY, ORDER_STATUS, TABLES, media_rows, table,
    tags_text, training_keys,
)
from ledgerline.session import apply_session_defaults, scratch_dir
from ledgerline.sources.keys import PRIMARY_KEY, DuplicateKeys
from ledgerline.sources.spec import read_json_records, schema_from_spec
from ledgerline.sources.store import TableStore

FIXED_NOW = _dt.datetime(2025, 1, 1, 0, 0, 0)
SNAPSHOT_DAY = "20250101"
# fixed value of the adaptation: line statuses as a two-value domain
LINE_STATUS = EnumType("line_status", ("O", "F"))


def _media(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_session_defaults(spark)
    return media_rows(table(spark, sf_dir, "lineitem"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with its priority and status declared as enumerated columns."""
    apply_session_defaults(spark)
    o = table(spark, sf_dir, "orders")
    return with_enum(with_enum(o, "o_orderpriority", ORDER_PRIORITY), "o_orderstatus", ORDER_STATUS)


def _store(spark: SparkSession, tag: str) -> TableStore:
    return TableStore(spark, scratch_dir(spark, tag))


def _media_out(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", tags_text("tags")) if "tags" in df.columns else df


# -- Group A: label sync ------------------------------------------------------
def q_sync_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New training rows from the media rows (stamps left out: clock values)."""
    media = _media(spark, sf_dir)
    training = training_keys(table(spark, sf_dir, "orders"))
    out = L.sync_media_to_training(media, training, key="title_key", status="status",
                                   columns=MEDIA_MAX_COLUMNS, title="title", now=FIXED_NOW)
    return _media_out(out.drop("created_at", "updated_at"))


def q_keyed_rows(spark, sf_dir):
    """O1."""
    return _media_out(L.keyed_rows(_media(spark, sf_dir), "title_key"))


def q_consolidate_max(spark, sf_dir):
    """O2 over numeric, text and timestamp columns."""
    m = _media(spark, sf_dir).select("title_key", "title", "l_partkey", "l_quantity",
                                     "l_extendedprice", "l_linestatus", "l_shipdate")
    return L.consolidate_max(m, "title_key")


def q_consolidate_enum(spark, sf_dir):
    """O2 over an enumerated column: greatest by declaration order, not text."""
    o = _orders(spark, sf_dir).select("o_custkey", "o_orderpriority", "o_orderstatus")
    return L.consolidate_max(o, "o_custkey")


def q_consolidate_array(spark, sf_dir):
    """O2 over an array column with NULL elements (NULL sorts largest)."""
    p = table(spark, sf_dir, "part")
    words = F.transform(F.split(F.col("p_name"), " "), lambda x: F.nullif(x, F.lit("red")))
    a = p.select("p_brand", words.alias("words"))
    return L.consolidate_max(a, "p_brand").select("p_brand", tags_text("words").alias("words"))


def q_collect_statuses(spark, sf_dir):
    """O3: the status multiset per title, NULLs and repeats kept. The domain given
    lacks ``override``, which must stay all the same."""
    c = L.collect_statuses(_media(spark, sf_dir).where(F.col("title_key").isNotNull()),
                           "title_key", "status", ("unfiltered", "accepted", "rejected"))
    text = F.transform("statuses", lambda e: F.concat_ws("=", F.coalesce(e.getField("status"), F.lit("~")), e.getField("n")))
    return c.select("title_key", F.col("n_statuses").cast("long").alias("n_statuses"),
                    F.col("n_null_statuses").cast("long").alias("n_null_statuses"),
                    F.array_join(F.array_sort(text), "|").alias("statuses"))


def q_derive_label(spark, sf_dir):
    """Label per title (NULL = not judged), with NULL statuses present."""
    return L.derive_label(_media(spark, sf_dir), "title_key", "status")


def q_new_keys_only(spark, sf_dir):
    """Orders with no line items."""
    o = table(spark, sf_dir, "orders")
    return L.new_keys_only(o, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


def q_labelled_only(spark, sf_dir):
    """Judged titles only."""
    return L.labelled_only(L.derive_label(_media(spark, sf_dir), "title_key", "status"))


def q_fill_title(spark, sf_dir):
    """Missing titles become ''."""
    m = _media(spark, sf_dir).select("title_key", "l_partkey", "l_linenumber", "title")
    return L.fill_title(m, "title")


def q_stamp_utc(spark, sf_dir):
    """O8 with an injected statement time, on the judged titles."""
    labelled = L.labelled_only(L.derive_label(_media(spark, sf_dir), "title_key", "status"))
    return L.stamp_utc(labelled, now=FIXED_NOW)


def _training_schema(orders: DataFrame) -> T.StructType:
    """``orders`` plus a ``reviewed`` flag declared with default ``false``."""
    return T.StructType([*orders.schema.fields,
                         T.StructField("reviewed", T.BooleanType(), True, {"default": "false"})])


def q_append_by_name(spark, sf_dir):
    """Append existing rows, then new rows lacking a column; read back."""
    o = _orders(spark, sf_dir)
    store = _store(spark, "append")
    store.create("atp", "training", _training_schema(o))
    is_f = F.col("o_orderstatus").eqNullSafe("F")
    store.append(o.where(is_f), "atp", "training")
    store.append(o.where(~is_f).drop("o_orderpriority"), "atp", "training")
    return store.read("atp", "training")


def _keyed(struct: T.StructType, key: str) -> T.StructType:
    """``struct`` with ``key`` declared as its primary key."""
    mark = {PRIMARY_KEY: True, "not_null": True}
    return T.StructType([T.StructField(f.name, f.dataType, True, {**f.metadata, **mark} if f.name == key else f.metadata) for f in struct.fields])


def q_append_unique(spark, sf_dir):
    """O9 with a primary key: batches of orders, two of which repeat keys (one the
    table's, one its own) and are refused; what each left in the table."""
    o = _orders(spark, sf_dir)
    store = _store(spark, "unique")
    store.create("atp", "orders", _keyed(o.schema, "o_orderkey"))
    status = F.col("o_orderstatus")
    out = None
    for step, batch in (("finished", o.where(status == "F")), ("all", o), ("others", o.where(~status.eqNullSafe("F"))), ("again", o.unionByName(o))):
        try:
            store.append(batch, "atp", "orders")
            outcome = "appended"
        except DuplicateKeys as e:
            outcome = "repeats itself" if e.repeated else "repeats the table"
        row = store.read("atp", "orders").agg(F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("rows"),
                                              F.count_distinct("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"))
        out = row if out is None else out.unionByName(row)
    return out


class _OvertakenStore(TableStore):
    """A store in which someone else syncs between the first sync's read and its append."""

    def __init__(self, spark: SparkSession, root: str, other):
        super().__init__(spark, root)
        self.other = other

    def publish(self, path, *args, **kwargs):
        if self.other and path.endswith("/training"):
            other, self.other = self.other, None
            other()
        return super().publish(path, *args, **kwargs)


def q_sync_concurrent(spark, sf_dir):
    """O10 as an append under concurrency: a sync is overtaken by one over half of the rows; each title
    stands once, with the values of whoever came first."""
    media = _media(spark, sf_dir)
    how = {"key": "title_key", "status": "status", "columns": MEDIA_MAX_COLUMNS, "title": "title", "now": FIXED_NOW}
    root = scratch_dir(spark, "concurrent")
    plain = TableStore(spark, root)
    plain.write(media, "atp", "media")
    plain.write(media.where("l_linenumber <= 2"), "atp", "part")
    fields = L.sync_media_to_training(media, training_keys(table(spark, sf_dir, "orders")), **how).schema.fields

    def other():
        L.sync_into(plain, media="part", **how)

    store = _OvertakenStore(spark, root, None)
    store.create("atp", "training", _keyed(T.StructType(fields), "title_key"))
    store.other = other
    L.sync_into(store, **how)
    return _media_out(store.read("atp", "training").drop("created_at", "updated_at"))


ELEMENT_LENGTH = 5


def q_append_elements(spark, sf_dir):
    """O9 with ``VARCHAR(5)[]``: blanks beyond the length are cut, a longer element refuses the batch."""
    p = table(spark, sf_dir, "part")
    words = F.transform(F.split("p_name", " "), lambda w: F.when(w != "red", F.concat(w, F.lit("   "))))
    rows = p.select("p_partkey", words.alias("words"))
    store = _store(spark, "elements")
    md = {"element_char_length": ELEMENT_LENGTH, "element_char_kind": "VARCHAR"}
    store.create("atp", "part", T.StructType([rows.schema["p_partkey"], T.StructField("words", T.ArrayType(T.StringType()), True, md)]))
    fits = F.coalesce(F.forall("words", lambda w: F.length(F.rtrim(w)) <= ELEMENT_LENGTH), F.lit(True))
    store.append(rows.where(fits), "atp", "part")
    try:
        store.append(rows.where(~fits), "atp", "part")
    except Exception as e:  # noqa: BLE001 -- the refusal is what the query shows; anything else is raised
        if "value too long for an element of words" not in str(e):
            raise
    return store.read("atp", "part").select("p_partkey", tags_text("words").alias("words"))


def q_consolidate_char(spark, sf_dir):
    """O2, O5 and O9 over ``CHAR(12)`` keys and values whose blanks at the end differ: groups, maxima,
    lengths and joins do not see them."""
    c = table(spark, sf_dir, "customer").withColumn(
        "segment", F.concat("c_mktsegment", F.repeat(F.lit(" "), (F.col("c_custkey") % 3).cast("int"))))
    md = {LENGTH_KEY: 12, KIND_KEY: "CHAR"}
    struct = T.StructType([T.StructField("segment", T.StringType(), True, md), T.StructField("greatest", T.StringType(), True, md),
                           T.StructField("c_acctbal", T.DoubleType())])
    store = _store(spark, "char")
    store.create("atp", "customer", struct)
    store.append(c.select("segment", F.col("segment").alias("greatest"), "c_acctbal"), "atp", "customer")
    live = store.read("atp", "customer")
    taken = c.where("c_nationkey = 3").select(F.concat("c_mktsegment", F.lit("      ")).alias("segment", metadata={LENGTH_KEY: 20, KIND_KEY: "CHAR"}))
    out = L.new_keys_only(L.consolidate_max(live, "segment"), taken.where("segment LIKE 'B%'"), "segment")
    return out.withColumn("letters", F.length(as_text(struct["segment"])))


def q_consolidate_collated(spark, sf_dir):
    """O2 under a collation that does not tell capitals apart: text and arrays with NULL elements alike."""
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    words = F.transform(F.split(name, " "), lambda x: F.nullif(x, F.lit("red")))
    a = p.select("p_brand", name.alias("name"), words.alias("words"))
    return L.consolidate_max(a, "p_brand", collation="UTF8_LCASE").withColumn("words", tags_text("words"))


def q_set_flag_all(spark, sf_dir):
    """Every row marked reviewed, by a staged rewrite of the table."""
    o = _orders(spark, sf_dir)
    store = _store(spark, "flag")
    store.write(Q.apply_defaults(o, _training_schema(o)), "atp", "training")
    store.rewrite("atp", "training", lambda df: L.set_flag_all(df, "reviewed", True))
    return store.read("atp", "training")


# -- Group B/C: snapshot and restore -----------------------------------------
def _backed_up_orders(spark, sf_dir, tag):
    store = _store(spark, tag)
    store.write(_orders(spark, sf_dir), "atp", "orders")
    S.backup_table(store, "atp", "orders", SNAPSHOT_DAY, created_at=FIXED_NOW)
    return store


def q_snapshot_copy(spark, sf_dir):
    """O12 + O16: back up orders (enums become text), read the snapshot back."""
    store = _backed_up_orders(spark, sf_dir, "snapshot")
    return S.read_snapshot(store, S.snapshot_names("atp", "orders", SNAPSHOT_DAY))


def q_snapshot_mapping(spark, sf_dir):
    """The column mapping kept with the snapshot."""
    store = _backed_up_orders(spark, sf_dir, "mapping")
    return S.read_snapshot(store, S.snapshot_names("atp", "orders", SNAPSHOT_DAY), "mapping")


def q_snapshot_metadata(spark, sf_dir):
    """The metadata row kept with the snapshot, beside the rows it stands for."""
    store = _backed_up_orders(spark, sf_dir, "metadata")
    names = S.snapshot_names("atp", "orders", SNAPSHOT_DAY)
    rows = S.read_snapshot(store, names).groupBy(F.lit(names.dated).alias("backup_table")).agg(F.count(F.lit(1)).alias("snapshot_rows"))
    return S.read_snapshot(store, names, "metadata").join(rows, "backup_table")


def q_latest_snapshot(spark, sf_dir):
    """Orders written as monthly snapshots; only the newest month is read."""
    o = table(spark, sf_dir, "orders")
    path = scratch_dir(spark, "monthly") + "/atp_orders"
    # rebalanced first: each day's rows go to as many files as their size asks for, not one a task
    (o.withColumn(S.PARTITION, F.date_format("o_orderdate", "yyyyMM01")).hint("rebalance", F.col(S.PARTITION))
      .write.partitionBy(S.PARTITION).parquet(path))
    _, df = R.latest_partition(spark, path)
    return df


def q_restore_newest(spark, sf_dir):
    """O16 + O18 + O22: backups of three days, the middle one last; the list of days finds the newest,
    and its rows are restored under the primary key."""
    o = _orders(spark, sf_dir)
    store = _store(spark, "newest")
    for day, rest in (("20250101", 0), ("20250103", 1), ("20250102", 2)):
        store.write(o.where(F.col("o_orderkey") % 3 <= rest), "atp", "orders")
        S.backup_table(store, "atp", "orders", day, created_at=FIXED_NOW)
    store.create("atp", "orders", _keyed(o.schema, "o_orderkey"))
    day = R.reload_table(store, "atp", "orders").date
    return store.read("atp", "orders").withColumn("day", F.lit(day))


def _target_schema(o: DataFrame) -> T.StructType:
    """The live table after a schema change: lost ``o_totalprice``, gained ``o_comment``."""
    fields = [f for f in o.schema.fields if f.name != "o_totalprice"]
    return T.StructType([*fields, T.StructField("o_comment", T.StringType())])


def q_reconcile_columns(spark, sf_dir):
    """Columns mapped in the snapshot and present in the target, by name."""
    store = _backed_up_orders(spark, sf_dir, "reconcile")
    names = S.snapshot_names("atp", "orders", SNAPSHOT_DAY)
    rec = R.reconcile(S.read_snapshot(store, names), S.read_snapshot(store, names, "mapping"),
                      _target_schema(_orders(spark, sf_dir)))
    return rec.df


def q_restore_enums(spark, sf_dir):
    """O21 (+O19, O20): the rows a restore appends, enums re-checked, target-aligned."""
    store = _backed_up_orders(spark, sf_dir, "enums")
    store.create("atp", "orders_v2", _target_schema(_orders(spark, sf_dir)))
    df, _, _ = R.restored_rows(store, "atp", "orders", target_table="orders_v2")
    return df


def q_reload_round_trip(spark, sf_dir):
    """O16 + O22 + O24: back up, empty the table, restore; compare the source with
    what was restored, and with the restored table after some rows went and others came twice."""
    store = _backed_up_orders(spark, sf_dir, "roundtrip")
    store.truncate("atp", "orders")
    res = R.reload_table(store, "atp", "orders")
    source, live = _orders(spark, sf_dir), store.read("atp", "orders")
    changed = live.where("o_orderkey % 7 <> 0").unionByName(live.where("o_custkey % 11 = 0"))
    out = R.round_trip_diff(source, live).withColumn("compared", F.lit("restored")).unionByName(
        R.round_trip_diff(source, changed).withColumn("compared", F.lit("changed"))).unionByName(
        R.keyed_diff(source, changed.distinct(), ["o_orderkey"]).withColumn("compared", F.lit("by key"))).unionByName(
        R.digest_diff(source, changed).withColumn("compared", F.lit("by digest")))
    # a microsecond more on some rows: different to every form
    late = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_orderdate") + F.expr("INTERVAL '0.000001' SECOND")).otherwise(F.col("o_orderdate"))
    later = live.withColumn("o_orderdate", late)
    for name, diff in (("a microsecond, by key", R.keyed_diff(source, later, ["o_orderkey"])), ("a microsecond, by digest", R.digest_diff(source, later))):
        out = out.unionByName(diff.withColumn("compared", F.lit(name)))
    return out.withColumn("rows_inserted", F.lit(res.rows).cast("long"))


def q_backup_reload_all(spark, sf_dir):
    """O17 + O23 + O32: back up three tables and a missing one, empty them (one
    loses a column), reload all; the two batch reports, failures and skipped
    columns reported rather than raised."""
    store = _store(spark, "batch")
    store.write(_orders(spark, sf_dir), "atp", "orders")
    store.write(table(spark, sf_dir, "customer"), "atp", "customer")
    store.write(table(spark, sf_dir, "part"), "atp", "part")
    names = ["orders", "customer", "part", "absent"]
    backed = S.backup_all(store, names, "atp", SNAPSHOT_DAY)
    for t in names[:2]:
        store.truncate("atp", t)
    part = store.schema_of("atp", "part")
    store.create("atp", "part", T.StructType([f for f in part.fields if f.name != "p_size"]))
    reloaded = R.reload_all(store, names, "atp")
    return backed.unionByName(reloaded)  # one report row per table and action


# -- Group D: checks ------------------------------------------------------------
LINEITEM_RULES = (
    ("quantity_range", "l_quantity BETWEEN 1 AND 50"),
    ("quantity_whole", "l_quantity = floor(l_quantity)"),
    ("discount_range", "l_discount BETWEEN 0 AND 0.05"),
    ("tax_nonnegative", "l_tax >= 0"),
    ("price_positive", "l_extendedprice > 0"),
    ("flag_code", "l_returnflag RLIKE '^[AR]$'"),
)
PART_RULES = (
    ("size_range", "p_size BETWEEN 1 AND 40"),
    ("price_at_least_1000", "p_retailprice >= 1000"),
    ("brand_format", "p_brand RLIKE '^Brand#[0-9]{1,2}$'"),
    ("name_two_words", "length(p_name) - length(replace(p_name, ' ', '')) = 1"),
)


def q_check_violations(spark, sf_dir):
    """Violations per rule, all rules of a table in one pass."""
    li = Q.check_violations(table(spark, sf_dir, "lineitem"),
                            [Q.Rule.sql(n, t) for n, t in LINEITEM_RULES], "lineitem")
    pa = Q.check_violations(table(spark, sf_dir, "part"),
                            [Q.Rule.sql(n, t) for n, t in PART_RULES], "part")
    return li.unionByName(pa)


def q_key_violations(spark, sf_dir):
    """Duplicate keys, NULLs in required columns, values outside enum domains."""
    m = _media(spark, sf_dir)  # its keys, titles and statuses have NULLs; one domain is too narrow
    return Q.key_violations(m, ["title_key"], ["title", "status", "l_shipdate"],
                            {"l_returnflag": EnumType("narrow_flag", ("R", "A")), "l_linestatus": LINE_STATUS})


ORDERS_SPEC = {"atp": {
    "enums": [{"name": e.name, "values": list(e.values)} for e in (ORDER_PRIORITY, ORDER_STATUS)],
    "tables": {"orders": {"columns": [
        {"name": "o_orderkey", "type": "BIGINT", "constraints": ["PRIMARY KEY"]}, {"name": "o_custkey", "type": "BIGINT"},
        {"name": "o_orderstatus", "type": "order_status"}, {"name": "o_totalprice", "type": "DOUBLE PRECISION", "check": "o_totalprice >= 0"},
        {"name": "o_orderdate", "type": "TIMESTAMP"}, {"name": "o_orderpriority", "type": "order_priority"},
        {"name": "o_comment", "type": "VARCHAR(20)", "default": "'none'"}]}}}}


def q_spec_json_load(spark, sf_dir):
    """O25 + O26: orders as JSON lines, read back under a declared spec, defaults filled on append."""
    o = table(spark, sf_dir, "orders")
    path = scratch_dir(spark, "json")
    o.write.json(path)
    spec = schema_from_spec(ORDERS_SPEC, "orders")
    store = _store(spark, "spec")
    store.create("atp", "orders", spec.schema)
    store.append(read_json_records(spark, path, spec).drop("o_comment"), "atp", "orders")
    return store.read("atp", "orders")


EVENT_DEFAULTS = T.StructType([
    T.StructField("value", T.DoubleType(), True, {"default": "0.0"}),
    T.StructField("status", T.StringType(), True, {"default": "'ingested'"}),
    T.StructField("error_status", T.BooleanType(), True, {"default": "false"}),
    T.StructField("weight", T.IntegerType(), True, {"default": "1"}),
    T.StructField("note", T.StringType(), True),
])


def q_apply_defaults(spark, sf_dir):
    """Absent columns take defaults; present ones (even NULL) stay."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    return Q.apply_defaults(events, EVENT_DEFAULTS)


def q_table_stats(spark, sf_dir):
    """Existence and row count of every driver table (and one absent name)."""
    paths = {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES}
    paths["media"] = f"{sf_dir.rstrip('/')}/media.parquet"
    return Q.table_stats(spark, paths)


def q_flag_distribution(spark, sf_dir):
    """Rows per flag combination."""
    return Q.flag_distribution(table(spark, sf_dir, "labels"), ["quality", "toxic"])


def q_null_pattern(spark, sf_dir):
    """NULL pattern of the labels over all documents."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels")
    return Q.null_pattern(d.join(lab, "doc_id", "left"), ["quality", "toxic"])


QUERIES = {
    "sync_new_rows": q_sync_new_rows,
    "keyed_rows": q_keyed_rows,
    "consolidate_max": q_consolidate_max,
    "consolidate_enum": q_consolidate_enum,
    "consolidate_array": q_consolidate_array,
    "collect_statuses": q_collect_statuses,
    "derive_label": q_derive_label,
    "new_keys_only": q_new_keys_only,
    "labelled_only": q_labelled_only,
    "fill_title": q_fill_title,
    "stamp_utc": q_stamp_utc,
    "append_by_name": q_append_by_name,
    "append_unique": q_append_unique,
    "append_elements": q_append_elements,
    "sync_concurrent": q_sync_concurrent,
    "consolidate_char": q_consolidate_char,
    "consolidate_collated": q_consolidate_collated,
    "set_flag_all": q_set_flag_all,
    "snapshot_copy": q_snapshot_copy,
    "snapshot_mapping": q_snapshot_mapping,
    "snapshot_metadata": q_snapshot_metadata,
    "latest_snapshot": q_latest_snapshot,
    "reconcile_columns": q_reconcile_columns,
    "restore_enums": q_restore_enums,
    "reload_round_trip": q_reload_round_trip,
    "restore_newest": q_restore_newest,
    "spec_json_load": q_spec_json_load,
    "backup_reload_all": q_backup_reload_all,
    "check_violations": q_check_violations,
    "key_violations": q_key_violations,
    "apply_defaults": q_apply_defaults,
    "table_stats": q_table_stats,
    "flag_distribution": q_flag_distribution,
    "null_pattern": q_null_pattern,
}
