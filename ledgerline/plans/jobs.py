"""Batch jobs over a table store, and a command line to run them.

    python -m ledgerline.plans.jobs --root <store root> sync
    python -m ledgerline.plans.jobs --root <store root> backup [--tables media,training] [--date YYYYMMDD]
    python -m ledgerline.plans.jobs --root <store root> reload [--tables ...] [--date YYYYMMDD]
    python -m ledgerline.plans.jobs --root <store root> review [--value false]

``--live-jdbc`` keeps the live tables in PostgreSQL (connection from the
standard PG* environment variables) with snapshots under ``--root``.

Batch jobs report per table and keep going after a failure (a report row
with ``status='failed'``); the single-table functions they call raise.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import labels as L
from ledgerline.operators import restore as R
from ledgerline.operators import snapshot as S
from ledgerline.plans.report import ActionResult, run_report
from ledgerline.session import apply_session_defaults, build_session
from ledgerline.sources.store import TableStore

LIVE_SCHEMA = "atp"
TABLES = ("media", "training", "prediction")


def sync_job(store: TableStore, schema: str = LIVE_SCHEMA, now: _dt.datetime | None = None) -> DataFrame:
    """Label sync: append newly judged titles from ``media`` to ``training``."""
    try:
        rows = L.sync_into(store, schema, "media", "training", now=now)
        res = ActionResult("sync", f"{schema}.media", "success", rows, None, f"{schema}.training")
    except Exception as e:  # noqa: BLE001 -- job boundary: report
        res = ActionResult("sync", f"{schema}.media", "failed", None, f"{type(e).__name__}: {e}", None)
    return run_report(store.spark, [res])


def backup_job(store, tables: Sequence[str] = TABLES, schema: str = LIVE_SCHEMA,
               date: str | None = None, backup_store: TableStore | None = None) -> DataFrame:
    return S.backup_all(store, tables, schema, date, backup_store=backup_store)


def reload_job(store, tables: Sequence[str] = TABLES, schema: str = LIVE_SCHEMA,
               date: str | None = None, backup_store: TableStore | None = None,
               on_conflict: str | None = None, key: Sequence[str] | None = None) -> DataFrame:
    return R.reload_all(store, tables, schema, date, backup_store=backup_store, on_conflict=on_conflict, key=key)


def review_job(store: TableStore, schema: str = LIVE_SCHEMA, table: str = "training",
               column: str = "reviewed", value: bool = True) -> DataFrame:
    """Set the review flag on every training row (a rewrite of the table)."""
    try:
        rows = store.rewrite(schema, table, lambda df: L.set_flag_all(df, column, value))
        res = ActionResult("review", f"{schema}.{table}", "success", rows, None, f"{schema}.{table}")
    except Exception as e:  # noqa: BLE001
        res = ActionResult("review", f"{schema}.{table}", "failed", None, f"{type(e).__name__}: {e}", None)
    return run_report(store.spark, [res])


def jdbc_partitions(texts: Sequence[str], schema: str) -> dict[str, dict[str, str]]:
    """``table:column:lower:upper:n`` to Spark's JDBC read options by table."""
    out = {}
    for text in texts:
        table, column, lower, upper, n = text.split(":")
        out[f"{schema}.{table}"] = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": n}
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    p = argparse.ArgumentParser(prog="ledgerline.plans.jobs")
    p.add_argument("--root", required=True, help="table store root (any Hadoop file system URI)")
    p.add_argument("--schema", default=LIVE_SCHEMA)
    p.add_argument("--live-jdbc", action="store_true",
                   help="live tables in PostgreSQL (PG* environment variables); snapshots under --root")
    p.add_argument("--partition", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:N",
                   help="read a database table in N tasks over a numeric or date column")
    sub = p.add_subparsers(dest="job", required=True)
    sub.add_parser("sync")
    for name in ("backup", "reload"):
        sp = sub.add_parser(name)
        sp.add_argument("--tables", default=",".join(TABLES))
        sp.add_argument("--date", default=None)
        if name == "reload":
            sp.add_argument("--on-conflict", default=None, choices=("error", "append"))
            sp.add_argument("--key", default=None, help="key columns, comma-separated (default: the declared primary key)")
    rv = sub.add_parser("review")
    rv.add_argument("--table", default="training")
    rv.add_argument("--column", default="reviewed")
    rv.add_argument("--value", default="true", choices=("true", "false"))
    a = p.parse_args(argv)
    spark = spark or build_session(app=f"ledgerline-{a.job}")
    apply_session_defaults(spark)
    files = TableStore(spark, a.root)
    if a.live_jdbc:
        from ledgerline.sources.jdbc import JdbcTableStore

        store = JdbcTableStore.from_env(spark, partitions=jdbc_partitions(a.partition, a.schema))
    else:
        store = files
    if a.job == "sync":
        rep = sync_job(store, a.schema)
    elif a.job == "backup":
        rep = backup_job(store, a.tables.split(","), a.schema, a.date, files)
    elif a.job == "reload":
        rep = reload_job(store, a.tables.split(","), a.schema, a.date, files, a.on_conflict,
                         a.key.split(",") if a.key else None)
    else:
        rep = review_job(store, a.schema, a.table, a.column, a.value == "true")
    rows = [r.asDict() for r in rep.collect()]  # one row per table: a small report
    for r in rows:
        print(json.dumps(r))
    return rows


if __name__ == "__main__":
    main()
