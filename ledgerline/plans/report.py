"""Batch run report: one row per action, failures captured rather than raised."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("skipped", T.StringType()),
])
PARALLEL = 4  # tables of a batch worked on at a time


@dataclass
class ActionResult:
    action: str
    source: str
    status: str  # "success" | "failed"
    rows: int | None
    error: str | None
    target: str | None
    skipped: str | None = None  # columns a reload left out, with the reasons


def run_report(spark: SparkSession, results: list[ActionResult]) -> DataFrame:
    """The results of a batch entry point as a small DataFrame (one row per table)."""
    from ledgerline.functions.rows import literal_rows

    return literal_rows(spark, [astuple(r) for r in results], REPORT_SCHEMA)


def run_each(spark: SparkSession, action: str, schema: str, tables: Iterable[str],
             one: Callable[[str], ActionResult]) -> DataFrame:
    """``one`` for every table, a few at a time; a failure becomes a report row."""
    def safe(t: str) -> ActionResult:
        try:
            return one(t)
        except Exception as e:  # noqa: BLE001 -- batch entry point: report, do not raise
            return ActionResult(action, f"{schema}.{t}", "failed", None, f"{type(e).__name__}: {e}", None)

    with ThreadPoolExecutor(PARALLEL) as pool:  # results stay in the order of the tables
        return run_report(spark, list(pool.map(safe, tables)))
