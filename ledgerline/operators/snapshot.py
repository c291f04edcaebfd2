"""Typed, dated snapshots of a table.

Layout in the store's backup schema (default ``bak``), one folder a day::

    bak/<schema>_<table>/snapshot_date=YYYYMMDD/v-<id>/data      the rows
                                                      /metadata  one row
                                                      /mapping   one row per column
    bak/<schema>_<table>/snapshot_date=YYYYMMDD/_log/<n>.json    names the folder in force
    bak/<schema>_<table>/_days/_log/<n>.json                     names the days

Each day's rows keep their own schema (snapshots of different schema ages
sit side by side). All three parts are written to a new folder first; the small
log file, written last, makes them the day's snapshot at once. A backup that
fails leaves the day as it was. A new day goes on the list of days before it is
published, so the list may name a day that never was, but lacks none.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass, field
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.functions.enums import EnumType, enum_columns, with_enum, without_enum
from ledgerline.functions.rows import literal_rows
from ledgerline.functions.time import yyyymmdd
from ledgerline.sources import fs
from ledgerline.sources.store import RETRIES, ConcurrentWrite, TableNotFound, TableStore

BACKUP_SCHEMA = "bak"
PARTITION = "snapshot_date"
TEXT_TYPE = "string"

# fixed values: column names of the mapping and metadata tables
MAPPING_SCHEMA = T.StructType([
    T.StructField("source_column_name", T.StringType()),
    T.StructField("bak_column_name", T.StringType()),
    T.StructField("source_data_type", T.StringType()),
    T.StructField("bak_data_type", T.StringType()),
    T.StructField("enum_name", T.StringType()),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("backup_date", T.DateType()),
    T.StructField("source_schema", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("backup_table", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


# O12 ----------------------------------------------------------------------
def snapshot(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Full copy in ordinal column order; enumerated columns become plain text.

    Returns the projection and the names of the converted columns. Every
    other column keeps its type exactly (decimals, arrays, timestamps, JSON
    text). One scan, no shuffle.
    """
    enums = enum_columns(df.schema)
    return without_enum(df.select(*df.columns), enums), list(enums)


# O13 ----------------------------------------------------------------------
def column_mapping_rows(schema: T.StructType) -> list[tuple]:
    rows = []
    enums = enum_columns(schema)
    for f in schema.fields:
        e = enums.get(f.name)
        if e is not None:
            rows.append((f.name, f.name, e.name, TEXT_TYPE, e.name))
        else:
            t = f.dataType.simpleString()
            rows.append((f.name, f.name, t, t, None))
    return rows


def column_mapping(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per source column (schema-sized, built on the driver)."""
    return literal_rows(spark, column_mapping_rows(schema), MAPPING_SCHEMA)


# O14 ----------------------------------------------------------------------
def backup_metadata(spark: SparkSession, day: _dt.date, source_schema: str, source_table: str,
                    backup_table: str, created_at: _dt.datetime | None = None) -> DataFrame:
    created_at = created_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return literal_rows(spark, [(day, source_schema, source_table, backup_table, created_at)],
                        METADATA_SCHEMA)


# O15 ----------------------------------------------------------------------
@dataclass(frozen=True)
class SnapshotNames:
    schema: str
    table: str
    date: str
    backup_schema: str = BACKUP_SCHEMA

    @property
    def base(self) -> str:
        return f"{self.schema}_{self.table}"

    @property
    def dated(self) -> str:
        """The dated name of the snapshot, ``<schema>_<table>_<YYYYMMDD>``."""
        return f"{self.base}_{self.date}"

    @property
    def partition(self) -> str:
        return f"{PARTITION}={self.date}"


def snapshot_names(schema: str, table: str, date: str | _dt.date | None = None,
                   backup_schema: str = BACKUP_SCHEMA) -> SnapshotNames:
    d = date if isinstance(date, str) else yyyymmdd(date)
    if not (len(d) == 8 and d.isdigit()):
        raise ValueError(f"snapshot date must be YYYYMMDD, got {d!r}")
    return SnapshotNames(schema, table, d, backup_schema)


def day_path(store: TableStore, names: SnapshotNames) -> str:
    return f"{store.path(names.backup_schema, names.base)}/{names.partition}"


def snapshot_path(store: TableStore, names: SnapshotNames, kind: str = "data") -> str | None:
    """Folder of one part of the snapshot in force; None if the day has none."""
    day = day_path(store, names)
    head = store.head(day)
    return f"{day}/{head.folders[0]}/{kind}" if head.folders else None


def days_path(store: TableStore, schema: str, table: str, backup_schema: str = BACKUP_SCHEMA) -> str:
    return f"{store.path(backup_schema, snapshot_names(schema, table, '00000000', backup_schema).base)}/_days"


def announced_days(store: TableStore, schema: str, table: str, backup_schema: str = BACKUP_SCHEMA) -> list[str] | None:
    """The list of days, oldest first: one listing and one small file. None if there is no list."""
    head = store.head(days_path(store, schema, table, backup_schema))
    return sorted(head.folders) if head.number else None


def announce(store: TableStore, names: SnapshotNames) -> None:
    """Put a day on the list; the first time, with the days that are there already."""
    path = days_path(store, names.schema, names.table, names.backup_schema)
    for _ in range(RETRIES):
        head = store.head(path)
        days = set(head.folders)
        if not head.number:
            base = fs.list_dirs(store.spark, store.path(names.backup_schema, names.base))
            days = {d.removeprefix(f"{PARTITION}=") for d in base if re.fullmatch(rf"{PARTITION}=\d{{8}}", d)}
        if names.date in days and head.number or store.publish(path, head, tuple(sorted(days | {names.date})), None):
            store.vacuum(path)
            return
    raise ConcurrentWrite(f"the list of days of {names.schema}.{names.table} was changed by other backups {RETRIES} times")


# O16 ----------------------------------------------------------------------
@dataclass
class BackupResult:
    source: str
    backup_table: str
    date: str
    rows: int
    converted_enums: list[str] = field(default_factory=list)


def backup_table(store, schema: str, table: str, date: str | _dt.date | None = None,
                 backup_schema: str = BACKUP_SCHEMA,
                 created_at: _dt.datetime | None = None,
                 backup_store: TableStore | None = None,
                 enums: Mapping[str, EnumType] | None = None) -> BackupResult:
    """Snapshot ``schema.table`` for one day, replacing that day's snapshot.

    ``store`` holds the live table (a :class:`TableStore` or a
    :class:`~ledgerline.sources.jdbc.JdbcTableStore`); the snapshot goes to
    ``backup_store`` (default: the same store), which must be file-based.
    ``enums`` declares enumerated columns a source does not describe itself.
    Rows, metadata and mapping are published together; the snapshot they
    replace is deleted last.
    """
    bs = backup_store or store
    if not store.exists(schema, table):
        raise TableNotFound(f"no table {schema}.{table} to back up")
    names = snapshot_names(schema, table, date, backup_schema)
    spark = bs.spark
    bs.create_schema(backup_schema)
    src = store.read(schema, table)
    for c, e in (enums or {}).items():
        src = with_enum(src, c, e)
    snap, converted = snapshot(src)
    path, folder = day_path(bs, names), bs.new_folder()
    head = bs.head(path)
    rows = bs._save(snap, f"{path}/{folder}/data", True)
    day = _dt.date(int(names.date[:4]), int(names.date[4:6]), int(names.date[6:]))
    meta = backup_metadata(spark, day, schema, table, names.dated, created_at)
    bs._save(meta.coalesce(1), f"{path}/{folder}/metadata", False)
    bs._save(column_mapping(spark, src.schema).coalesce(1), f"{path}/{folder}/mapping", False)
    announce(bs, names)
    if not bs.publish(path, head, (folder,), None):
        raise ConcurrentWrite(f"another backup of {schema}.{table} for {names.date} was published meanwhile")
    bs.vacuum(path)
    return BackupResult(f"{schema}.{table}", f"{backup_schema}.{names.dated}", names.date, rows or 0,
                        converted)


# O17 ----------------------------------------------------------------------
def backup_all(store, tables: Iterable[str] = ("media", "prediction", "training"),
               schema: str = "atp", date: str | _dt.date | None = None,
               backup_schema: str = BACKUP_SCHEMA, backup_store: TableStore | None = None) -> DataFrame:
    """Back up the tables side by side; one failure does not stop the others."""
    from ledgerline.plans.report import ActionResult, run_each

    def one(t: str) -> ActionResult:
        r = backup_table(store, schema, t, date, backup_schema, backup_store=backup_store)
        return ActionResult("backup", f"{schema}.{t}", "success", r.rows, None, r.backup_table)

    return run_each(store.spark, "backup", schema, tables, one)


def read_snapshot(store: TableStore, names: SnapshotNames, kind: str = "data") -> DataFrame:
    path = snapshot_path(store, names, kind)
    if path is None or not fs.exists(store.spark, path):
        raise TableNotFound(f"{kind} of snapshot {names.backup_schema}.{names.dated} does not exist")
    return store.spark.read.format(store.fmt).load(path)
