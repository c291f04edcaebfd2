"""Small DataFrames built from JVM-side literals.

Schema-sized frames (a column mapping, a metadata row, a run report, an empty
table) are built as ``inline(array(struct(lit, ...)))`` over ``range(1)``: the
rows are constants in the plan, so no Python worker is started to turn Python
objects into rows, and field metadata is attached by ``alias``.
"""

from __future__ import annotations

import datetime as _dt
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value: Any, dtype: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, _dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """A DataFrame of a few literal rows with exactly ``schema`` (names, types, metadata)."""
    if not rows:
        return empty_frame(spark, schema)
    structs = [F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    out = spark.range(1).select(F.inline(F.array(*structs)))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata or {})
                        for f in schema.fields])


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, exactly ``schema`` (field metadata included)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {})
                                   for f in schema.fields])
