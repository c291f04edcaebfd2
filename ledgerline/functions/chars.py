"""Blank-padded text (``CHAR(n)``).

A ``CHAR(n)`` column is a ``StringType`` column whose field metadata names its
length and kind. Stored values are padded with blanks to n characters. Blanks at the
end of such a value mean nothing in comparisons, in ``length`` and where it becomes plain
text, so comparisons, MAX and rules work on the stripped value and results are
padded again. Pattern matches alone see the padding. Arrays keep the same of their
elements under ``element_...``. All helpers are plain Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH_KEY = "char_length"
KIND_KEY = "char_kind"
ELEMENT = "element_"
BLANK_PADDED = ("CHAR", "CHARACTER")


def element_metadata(md: dict | None) -> dict:
    """What the metadata of an array column says of its elements."""
    return {k[len(ELEMENT):]: v for k, v in (md or {}).items() if k.startswith(ELEMENT)}


def char_width(dtype: T.DataType, md: dict | None) -> int | None:
    """n of a ``CHAR(n)``, None for any other type."""
    md = md or {}
    if isinstance(dtype, T.StringType) and md.get(KIND_KEY) in BLANK_PADDED and md.get(LENGTH_KEY):
        return int(md[LENGTH_KEY])
    return None


def _each(c: Column, dtype: T.DataType, md: dict | None, fn) -> Column | None:
    """``fn(value, n)`` on a CHAR column or on the elements of an array of them; None for others."""
    n = char_width(dtype, md)
    if n is not None:
        return fn(c, n)
    if isinstance(dtype, T.ArrayType):
        inner = element_metadata(md)
        if _holds_char(dtype.elementType, inner):
            return F.transform(c, lambda x: _each(x, dtype.elementType, inner, fn))
    return None


def _holds_char(dtype: T.DataType, md: dict) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_char(dtype.elementType, element_metadata(md))
    return char_width(dtype, md) is not None


def is_char(field: T.StructField) -> bool:
    return _holds_char(field.dataType, field.metadata or {})


def as_text(field: T.StructField, c: Column | None = None) -> Column:
    """The value as plain text, which is also the form that is compared: blanks at the end are gone."""
    c = F.col(field.name) if c is None else c
    out = _each(c, field.dataType, field.metadata, lambda x, n: F.rtrim(x))
    return c if out is None else out


def padded(field: T.StructField, c: Column | None = None) -> Column:
    """The value as it is stored. It must not be longer than the column."""
    c = F.col(field.name) if c is None else c
    out = _each(c, field.dataType, field.metadata, lambda x, n: F.rpad(x, n, " "))
    return c if out is None else out


def text_view(df: DataFrame) -> DataFrame:
    """``df`` with its CHAR columns in the form that is compared; itself where it has none."""
    if not any(is_char(f) for f in df.schema.fields):
        return df
    return df.select(*[as_text(f).alias(f.name, metadata=f.metadata or {}) if is_char(f) else F.col(f.name) for f in df.schema.fields])


def stored_view(df: DataFrame) -> DataFrame:
    """The opposite of :func:`text_view`."""
    if not any(is_char(f) for f in df.schema.fields):
        return df
    return df.select(*[padded(f).alias(f.name, metadata=f.metadata or {}) if is_char(f) else F.col(f.name) for f in df.schema.fields])
