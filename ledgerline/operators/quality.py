"""Declared-schema and data-quality checks, each a single pass where possible."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.chars import text_view
from ledgerline.functions.defaults import default_column
from ledgerline.functions.enums import EnumType, enum_columns
from ledgerline.functions.rows import empty_frame, literal_rows
from ledgerline.sources import fs



# O27 ----------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """A named CHECK predicate. Like a SQL CHECK, a NULL (unknown) result passes."""

    name: str
    predicate: Column
    column: str | None = None

    @staticmethod
    def sql(name: str, text: str, column: str | None = None) -> "Rule":
        return Rule(name, F.expr(text), column)


def between(c: str, lo, hi) -> Column:
    return F.col(c).between(F.lit(lo), F.lit(hi))


def matches(c: str, regex: str) -> Column:
    return F.col(c).rlike(regex)


def rules_from_spec(spec) -> list[Rule]:
    """The CHECK rules of a :class:`~ledgerline.sources.spec.TableSpec`, named ``<column>_check``."""
    return [Rule.sql(f"{c}_check", text, c) for c, text in spec.checks]


def check_violations(df: DataFrame, rules: Sequence[Rule], table: str | None = None) -> DataFrame:
    """Rows breaking each rule: ``(rule, violations)`` (plus ``table_name``).

    All rules are counted in one aggregate over one scan, then turned into
    one row per rule with ``inline``. Rules see ``CHAR`` values without their padding.
    """
    if not rules:
        raise ValueError("no rules")
    df = text_view(df)
    aggs = [F.count_if(~r.predicate).alias(f"__r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(r.name).alias("rule"), F.col(f"__r{i}").cast("long").alias("violations"))
               for i, r in enumerate(rules)]
    out = wide.select(F.inline(F.array(*entries)))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "rule", "violations")
    return out


# O28 ----------------------------------------------------------------------
def key_violations(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = (),
                   enums: Mapping[str, EnumType] | None = None) -> DataFrame:
    """Primary-key, NOT NULL and enum-domain violations as ``(check_name, column_name, violations)``.

    * ``duplicate_key``: key values held by more than one row, and
      ``duplicate_row``: the rows beyond the first of each such key (NULL
      keys excluded; they are ``not_null`` violations);
    * ``not_null``: NULLs in key and NOT NULL columns, and ``enum_domain``:
      values outside each enum's domain.

    One scan and one shuffle: a ``groupBy(key)`` carries the row count and
    the per-key NULL / out-of-domain counts, all combined map-side (a key
    held by a third of the table is one partial row per task), and a final
    single-row aggregate over the per-key rows turns them into totals.
    """
    key = list(key)
    df = text_view(df)  # CHAR keys that differ in blanks at the end are equal
    key_name = ",".join(key)
    nn = list(dict.fromkeys([*key, *not_null]))
    doms = dict(enum_columns(df.schema))
    doms.update(enums or {})
    per_key_aggs = [F.count(F.lit(1)).alias("__n")]
    per_key_aggs += [F.count_if(F.col(c).isNull()).alias(f"__nn{i}") for i, c in enumerate(nn)]
    per_key_aggs += [F.count_if(e.out_of_domain(c)).alias(f"__en{i}") for i, (c, e) in enumerate(doms.items())]
    per_key = df.groupBy(*key).agg(*per_key_aggs)
    keyed = F.lit(True)
    for k in key:
        keyed = keyed & F.col(k).isNotNull()
    dup = keyed & (F.col("__n") > 1)
    totals = per_key.agg(
        F.count_if(dup).alias("__keys"),
        F.coalesce(F.sum(F.when(dup, F.col("__n") - 1)), F.lit(0)).alias("__rows"),
        *[F.coalesce(F.sum(f"__nn{i}"), F.lit(0)).alias(f"__nn{i}") for i in range(len(nn))],
        *[F.coalesce(F.sum(f"__en{i}"), F.lit(0)).alias(f"__en{i}") for i in range(len(doms))],
    )

    def entry(check: str, column: str, value: str) -> Column:
        return F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
                        F.col(value).cast("long").alias("violations"))

    entries = [entry("duplicate_key", key_name, "__keys"), entry("duplicate_row", key_name, "__rows")]
    entries += [entry("not_null", c, f"__nn{i}") for i, c in enumerate(nn)]
    entries += [entry("enum_domain", c, f"__en{i}") for i, c in enumerate(doms)]
    return totals.select(F.inline(F.array(*entries)))


# O29 ----------------------------------------------------------------------
def apply_defaults(df: DataFrame, schema: T.StructType, order: str = "input") -> DataFrame:
    """Columns of ``schema`` absent from ``df`` take their declared default (or NULL).

    A column that is present keeps its values -- an explicit NULL stays NULL.
    ``order='input'`` appends the added columns after the input's own;
    ``order='schema'`` returns the schema's columns first, in its order, then
    any extra input columns.
    """
    have = set(df.columns)
    added = [default_column(f) for f in schema.fields if f.name not in have]
    if order == "schema":
        cols = [F.col(f.name) if f.name in have else default_column(f) for f in schema.fields]
        cols += [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
        return df.select(*cols)
    return df.select(*[F.col(c) for c in df.columns], *added)


# O30 ----------------------------------------------------------------------
STATS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("table_exists", T.BooleanType()),
    T.StructField("row_count", T.LongType()),
])


def table_stats(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Existence and row count per named table path, as one DataFrame.

    Counts are ordinary aggregates (Parquet answers them from row-group
    metadata); the tables are unioned into one job.
    """
    return _stats(spark, {n: spark.read.format(fmt).load(p) if fs.exists(spark, p) else None for n, p in tables.items()})


def _stats(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    parts = []
    missing = []
    for name, df in tables.items():
        if df is not None:
            parts.append(df.agg(F.lit(name).alias("table_name"), F.lit(True).alias("table_exists"),
                                F.count(F.lit(1)).alias("row_count")))
        else:
            missing.append((name, False, None))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    if missing:
        m = literal_rows(spark, missing, STATS_SCHEMA)
        out = m if out is None else out.unionByName(m)
    if out is None:
        out = empty_frame(spark, STATS_SCHEMA)
    return out


def store_table_stats(store, schema: str, tables: Iterable[str]) -> DataFrame:
    return _stats(store.spark, {t: store.read(schema, t) if store.exists(schema, t) else None for t in tables})


# O31 ----------------------------------------------------------------------
def flag_distribution(df: DataFrame, flags: str | Sequence[str]) -> DataFrame:
    """Rows per value combination of the flag column(s) (NULL is its own value)."""
    flags = [flags] if isinstance(flags, str) else list(flags)
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def null_pattern(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per pattern of NULL/non-NULL over ``columns``."""
    return df.groupBy(*[F.col(c).isNull().alias(f"{c}_is_null") for c in columns]).agg(
        F.count(F.lit(1)).alias("n"))
