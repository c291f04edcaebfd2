"""Declared column defaults.

A default is a Spark SQL expression kept in ``StructField.metadata["default"]``
(for example ``'ingested'``, ``false`` or ``current_timestamp()``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_KEY = "default"


def default_column(f: T.StructField) -> Column:
    """The field's default value (or a typed NULL), named and annotated like the field."""
    default = (f.metadata or {}).get(DEFAULT_KEY)
    c = F.expr(default).cast(f.dataType) if default is not None else F.lit(None).cast(f.dataType)
    return c.alias(f.name, metadata=f.metadata or {})
