"""Exact digests of rows.

:func:`canonical` writes a value of any type that Spark can group by as text, so that two
values have the same text just when ``GROUP BY`` puts them together: NULL differs from an
empty text, an empty array and a struct of NULLs; instants and zone-less times keep their
microseconds; -0.0 is 0.0 and NaN equals NaN; the order of a map's entries means nothing.
Every part carries its length, so parts cannot run into each other. The digest of a
row is the MD5 of its columns' texts: two different rows pass for equal with a
probability of 2^-128.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "~"


def _sized(text: Column) -> Column:
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def _number(c: Column) -> Column:
    zero = F.lit(0.0)
    return F.when(F.isnan(c), F.lit("NaN")).when(c == zero, F.lit("0")).otherwise(c.cast("string"))


def _plain(c: Column, dtype: T.DataType) -> Column:
    """Text of a value that is not NULL."""
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.size(c).cast("string"), F.lit("["), F.array_join(F.transform(c, lambda x: canonical(x, dtype.elementType)), ""))
    if isinstance(dtype, T.StructType):
        return F.concat(F.lit("{"), *[canonical(c.getField(f.name), f.dataType) for f in dtype.fields])
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(canonical(e["key"], dtype.keyType), canonical(e["value"], dtype.valueType)))
        return F.concat(F.size(c).cast("string"), F.lit("<"), F.array_join(F.array_sort(entries), ""))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _number(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("string")
    # a zone-less time is its own text, microseconds included: no zone of the session comes in
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, T.NullType):
        return F.lit("")
    return c.cast("string")


def canonical(c: Column, dtype: T.DataType) -> Column:
    """Never NULL; equal just for values that are equal to ``GROUP BY``."""
    if isinstance(dtype, T.NullType):
        return F.lit(NULL)
    return F.when(c.isNull(), F.lit(NULL)).otherwise(_sized(_plain(c, dtype)))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """16 bytes of the given columns (all by default), in that order."""
    fields = {f.name: f for f in df.schema.fields}
    parts = [canonical(F.col(f"`{c}`"), fields[c].dataType) for c in (columns or df.columns)]
    return F.unhex(F.md5(F.concat(*parts) if parts else F.lit("")))


def same_types(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``columns`` in the types that a union gives them."""
    cols = [F.col(f"`{c}`") for c in columns]
    a, b = left.select(*cols), right.select(*cols)
    wide = a.unionByName(b).schema

    def cast(df: DataFrame) -> DataFrame:
        if [f.dataType for f in df.schema.fields] == [f.dataType for f in wide.fields]:
            return df
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wide.fields])

    return cast(a), cast(b)
