"""Enumerated string columns.

Spark has no enum type. An enumerated column here is a ``StringType`` column
whose ``StructField.metadata`` carries ``{"enum": name, "values": [...]}``.
Parquet keeps field metadata in its footer, so the domain survives a
write/read cycle. All helpers build plain Catalyst expressions: no UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENUM_KEY = "enum"
VALUES_KEY = "values"


class EnumDomainError(ValueError):
    """A value outside an enumerated domain was found."""


@dataclass(frozen=True)
class EnumType:
    name: str
    values: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(set(self.values)) != len(self.values):
            raise ValueError(f"enum {self.name} has repeated values")

    # -- schema --------------------------------------------------------------
    @property
    def metadata(self) -> dict:
        return {ENUM_KEY: self.name, VALUES_KEY: list(self.values)}

    def field(self, column: str, nullable: bool = True, extra: dict | None = None) -> T.StructField:
        md = dict(extra or {})
        md.update(self.metadata)
        return T.StructField(column, T.StringType(), nullable, md)

    # -- expressions ---------------------------------------------------------
    def _domain(self) -> Column:
        return F.array(*[F.lit(v) for v in self.values])

    def position(self, c: Column | str) -> Column:
        """1-based declaration position; 0 when outside the domain, NULL for NULL."""
        return F.array_position(self._domain(), _col(c)).cast("int")

    def checked(self, c: Column | str, what: str | None = None) -> Column:
        """The value itself, or a runtime error when it is outside the domain."""
        c = _col(c)
        msg = F.concat(
            F.lit(f"invalid input value for enum {self.name}"
                  + (f" in column {what}" if what else "") + ": "),
            c,
        )
        return F.when(c.isNull() | c.isin(*self.values), c).otherwise(F.raise_error(msg).cast("string"))

    def checked_position(self, c: Column | str, what: str | None = None) -> Column:
        c = _col(c)
        pos = self.position(c)
        msg = F.concat(
            F.lit(f"invalid input value for enum {self.name}"
                  + (f" in column {what}" if what else "") + ": "),
            c,
        )
        return F.when(c.isNull(), F.lit(None).cast("int")).when(pos > 0, pos).otherwise(
            F.raise_error(msg).cast("int"))

    def max(self, c: Column | str, what: str | None = None) -> Column:
        """Aggregate: greatest value by declaration order; NULLs ignored.

        Reduced to ``max`` of an integer position, so the aggregate stays a
        fixed-width, map-side-combinable HashAggregate buffer.
        """
        return self.value_at(F.max(self.checked_position(c, what)))

    def max_known(self, c: Column | str) -> Column:
        """Like :meth:`max`, with values outside the domain left out instead of an error."""
        pos = self.position(c)
        return self.value_at(F.max(F.when(pos > 0, pos)))

    def value_at(self, pos: Column) -> Column:
        """The value at a 1-based declaration position; NULL for NULL."""
        return F.when(pos.isNotNull(), F.element_at(self._domain(), pos)).cast("string")

    def out_of_domain(self, c: Column | str) -> Column:
        """Predicate: non-NULL and not a member of the domain."""
        c = _col(c)
        return c.isNotNull() & ~c.isin(*self.values)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def enum_of(field: T.StructField) -> EnumType | None:
    md = field.metadata or {}
    if ENUM_KEY in md and VALUES_KEY in md and isinstance(field.dataType, T.StringType):
        return EnumType(md[ENUM_KEY], tuple(md[VALUES_KEY]))
    return None


def enum_columns(schema: T.StructType) -> dict[str, EnumType]:
    """Enumerated columns of a schema, in ordinal order."""
    out = {}
    for f in schema.fields:
        e = enum_of(f)
        if e is not None:
            out[f.name] = e
    return out


def with_enum(df: DataFrame, column: str, enum: EnumType, check: bool = False) -> DataFrame:
    """Declare ``column`` as enumerated; with ``check`` each value is validated."""
    if check:
        df = df.withColumn(column, enum.checked(column, column))
    md = dict(_field(df, column).metadata or {})
    md.update(enum.metadata)
    return df.withMetadata(column, md)


def without_enum(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the enum declaration of ``columns`` (the value becomes plain text)."""
    for c in columns:
        md = {k: v for k, v in (_field(df, c).metadata or {}).items() if k not in (ENUM_KEY, VALUES_KEY)}
        df = df.withMetadata(c, md)
    return df


def _field(df: DataFrame, column: str) -> T.StructField:
    for f in df.schema.fields:
        if f.name == column:
            return f
    raise KeyError(column)
