"""Declared table specs (JSON) -> typed Spark schemas, and sample loading.

A spec lists columns with a database type name, constraints, an optional
default and an optional CHECK rule, plus enumerated types. The result keeps
everything a Spark schema can carry in ``StructField`` metadata: enum domain,
default (as a Spark SQL expression), declared character length and the rule.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import json
import re
from dataclasses import dataclass, field
from typing import Any, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.functions.chars import ELEMENT, KIND_KEY, LENGTH_KEY, char_width
from ledgerline.functions.enums import EnumType
from ledgerline.sources.keys import PRIMARY_KEY

DEFAULT_KEY = "default"
CHECK_KEY = "check"
NOT_NULL_KEY = "not_null"

# fixed values: database type names and their Spark types
_SIMPLE_TYPES = {
    "TEXT": T.StringType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "SMALLINT": T.ShortType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP WITHOUT TIME ZONE": T.TimestampNTZType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "TIMESTAMPTZ": T.TimestampType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "REAL": T.FloatType(),
    "JSONB": T.StringType(),
    "JSON": T.StringType(),
}
# fixed values: default expressions the database writes differently from Spark SQL
_DEFAULT_EXPRESSIONS = {
    "(CURRENT_TIMESTAMP AT TIME ZONE 'UTC')": "current_timestamp()",
    "CURRENT_TIMESTAMP": "current_timestamp()",
    "NOW()": "current_timestamp()",
    "CURRENT_DATE": "current_date()",
}
_SIZED = re.compile(r"^(CHAR|CHARACTER|VARCHAR|CHARACTER VARYING)\((\d+)\)$")
_DECIMAL = re.compile(r"^(DECIMAL|NUMERIC)\((\d+),\s*(\d+)\)$")


@dataclass
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    checks: list[tuple[str, str]] = field(default_factory=list)  # (column, Spark SQL predicate)
    enums: dict[str, EnumType] = field(default_factory=dict)    # column -> domain
    indexes: list[list[str]] = field(default_factory=list)


def spark_type(type_name: str, enums: Mapping[str, EnumType]) -> tuple[T.DataType, dict]:
    """Spark type and extra field metadata for a database type name."""
    t = type_name.strip()
    if t.endswith("[]"):
        inner, md = spark_type(t[:-2], enums)
        return T.ArrayType(inner), ({ELEMENT + k: v for k, v in md.items()} if md else {})
    if t in enums:
        return T.StringType(), enums[t].metadata
    u = t.upper()
    if u in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[u], {}
    m = _SIZED.match(u)
    if m:
        return T.StringType(), {LENGTH_KEY: int(m.group(2)), KIND_KEY: m.group(1)}
    m = _DECIMAL.match(u)
    if m:
        return T.DecimalType(int(m.group(2)), int(m.group(3))), {}
    raise ValueError(f"unsupported column type {type_name!r}")


def default_expression(text: str) -> str:
    """The Spark SQL form of a declared default (literals are the same)."""
    return _DEFAULT_EXPRESSIONS.get(text.strip(), _DEFAULT_EXPRESSIONS.get(text.strip().upper(), text.strip()))


def check_expression(text: str, widths: Mapping[str, int] | None = None) -> str:
    """The Spark SQL form of a CHECK rule: the regex-match operator becomes RLIKE.

    Rules are given ``CHAR`` values without their padding, which is right for all but
    pattern matches: ``widths`` names such columns, which are padded there.
    """
    for column, n in (widths or {}).items():
        text = re.sub(rf"\b{re.escape(column)}(?=\s+(?:~|(?:NOT\s+)?LIKE\b))", f"rpad({column}, {n}, ' ')", text)
    return re.sub(r"\s~\s", " RLIKE ", text)


# O25 ----------------------------------------------------------------------
def schema_from_spec(spec: Mapping[str, Any], table: str, schema_key: str | None = None) -> TableSpec:
    """Typed schema of one table of a spec (``{"<schema>": {"tables", "enums"}}``)."""
    block = spec[schema_key] if schema_key else _first_schema_with(spec, table)
    enums = {e["name"]: EnumType(e["name"], tuple(e["values"])) for e in block.get("enums", [])}
    tdef = block["tables"][table]
    types = {c["name"]: spark_type(c["type"], enums) for c in tdef["columns"]}
    widths = {name: n for name, (dtype, md) in types.items() if (n := char_width(dtype, md)) is not None}
    fields, pk, nn, checks, enum_cols = [], [], [], [], {}
    for c in tdef["columns"]:
        dtype, md = types[c["name"]]
        md = dict(md)
        cons = [x.upper() for x in c.get("constraints", [])]
        if "PRIMARY KEY" in cons:
            pk.append(c["name"])
            md[PRIMARY_KEY] = True
        not_null = "NOT NULL" in cons or "PRIMARY KEY" in cons
        if not_null:
            nn.append(c["name"])
            md[NOT_NULL_KEY] = True
        if "default" in c:
            md[DEFAULT_KEY] = default_expression(c["default"])
        if "check" in c:
            md[CHECK_KEY] = check_expression(c["check"], widths)
            checks.append((c["name"], md[CHECK_KEY]))
        if c["type"] in enums:
            enum_cols[c["name"]] = enums[c["type"]]
        # Spark does not enforce NOT NULL on file tables: fields stay nullable,
        # the flag in the metadata is enforced on appends (labels.align_to)
        # and counted by quality.key_violations.
        fields.append(T.StructField(c["name"], dtype, True, md))
    indexes = [list(i["columns"]) for i in tdef.get("indexes", [])]
    return TableSpec(table, T.StructType(fields), pk, nn, checks, enum_cols, indexes)


def _first_schema_with(spec: Mapping[str, Any], table: str) -> Mapping[str, Any]:
    for v in spec.values():
        if isinstance(v, Mapping) and table in v.get("tables", {}):
            return v
    raise KeyError(table)


# fixed values: texts a database reads as booleans
_TRUTH = {"true": True, "t": True, "yes": True, "on": True, "1": True,
          "false": False, "f": False, "no": False, "off": False, "0": False}


# O26 ----------------------------------------------------------------------
def _convert(value: Any, dtype: T.DataType) -> Any:
    if value is None:
        return None
    if isinstance(dtype, T.StringType):
        return json.dumps(value, sort_keys=False) if isinstance(value, (dict, list)) else str(value)
    if isinstance(dtype, T.ArrayType):
        return [_convert(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.DecimalType):
        return decimal.Decimal(str(value))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value if isinstance(value, _dt.datetime) else _dt.datetime.fromisoformat(str(value))
    if isinstance(dtype, T.DateType):
        return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(str(value))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return int(value)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float(value)
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, str):
            if value.strip().lower() not in _TRUTH:
                raise ValueError(f"not a boolean: {value!r}")
            return _TRUTH[value.strip().lower()]
        return bool(value)
    return value


def load_samples(spark: SparkSession, records: Iterable[Mapping[str, Any]], spec: TableSpec,
                 fill_defaults: bool = True) -> DataFrame:
    """Sample records -> typed rows: None -> NULL, list -> array, dict -> JSON text.

    Columns no record names are absent from the insert, so they take their
    declared default (or NULL), as an INSERT with a column list would.
    """
    from ledgerline.operators.quality import apply_defaults

    records = list(records)
    present = [f for f in spec.schema.fields if any(f.name in r for r in records)]
    struct = T.StructType(present)
    rows = [tuple(_convert(r.get(f.name), f.dataType) for f in present) for r in records]
    df = spark.createDataFrame(rows, struct)
    if fill_defaults:
        df = apply_defaults(df, spec.schema, order="schema")
    return df


def read_json_records(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """JSON-lines records read by Spark with the declared schema (no inference).

    The distributed form of :func:`load_samples`: a JSON object or array in a
    text column is kept as its JSON text, numbers and timestamps are parsed
    into the declared types, and enumerated values are checked against their
    domain. A JSON reader cannot tell an absent key from ``null``, so both
    read as NULL here; use :func:`load_samples` when defaults must apply to
    absent keys.
    """
    from ledgerline.functions.enums import enum_columns

    df = spark.read.schema(spec.schema).option("mode", "FAILFAST").json(path)
    for c, e in enum_columns(spec.schema).items():
        df = df.withColumn(c, e.checked(c, c)).withMetadata(c, e.metadata)
    return df
