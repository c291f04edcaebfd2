"""Array ordering with NULL elements sorted last.

The source database orders arrays element by element with a NULL element
greater than any value; Spark orders a NULL element smallest. Wrapping each
element as ``struct(is_null, value)`` gives the source order with Spark's own
struct comparison, so ``max`` stays a built-in aggregate. A collation adds the
element under it to the struct, before the element itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collated(c: Column, collation: str) -> Column:
    """A sort key of text: by the collation, what it holds equal by code points; the text is field ``v``."""
    return F.struct(F.collate(c, collation).alias("k"), c.alias("v"))


def nulls_last_key(c: Column | str, collation: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    by = [] if collation is None else [collation]
    return F.transform(c, lambda x: F.struct(x.isNull().alias("n"), *[F.collate(x, k).alias("k") for k in by], x.alias("v")))


def unwrap(c: Column) -> Column:
    return F.transform(c, lambda s: s.getField("v"))


def array_max_nulls_last(c: Column | str, collation: str | None = None) -> Column:
    """Aggregate: greatest array under NULL-largest element order; text elements under
    ``collation`` if one is given."""
    return unwrap(F.max(nulls_last_key(c, collation)))
