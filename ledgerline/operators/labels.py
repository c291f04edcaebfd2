"""Label sync: consolidate raw rows per title, derive a label, append new titles.

Every operator is a DataFrame expression. The composition
:func:`sync_media_to_training` is one partial/final aggregate on the key
(every aggregate is reducible, so a hot key collapses map-side before the
shuffle), one anti-join against the key column of the target, and a
projection. Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.arrays import array_max_nulls_last, collated
from ledgerline.functions.chars import LENGTH_KEY, as_text, char_width, element_metadata, is_char, padded
from ledgerline.functions.defaults import default_column
from ledgerline.functions.domains import (
    LABEL_TYPE, NEGATIVE_LABEL, POSITIVE_LABEL, POSITIVE_STATUSES, UNJUDGED_STATUS,
)
from ledgerline.functions.enums import EnumType, enum_of
from ledgerline.functions.time import utc_now

# Columns of the training table the sync writes, in its column-list order
# (fixed values: the target column list of the sync).
SYNC_TARGET_COLUMNS = (
    "imdb_id", "tmdb_id", "label", "media_type", "media_title", "season", "episode",
    "release_year", "budget", "revenue", "runtime", "origin_country",
    "production_companies", "production_countries", "production_status",
    "original_language", "spoken_languages", "genre", "original_media_title",
    "tagline", "overview", "tmdb_rating", "tmdb_votes", "rt_score", "metascore",
    "imdb_rating", "imdb_votes", "created_at", "updated_at",
)
# The consolidated (MAX) columns are the target columns minus key, label and stamps.
SYNC_MAX_COLUMNS = tuple(c for c in SYNC_TARGET_COLUMNS
                         if c not in ("imdb_id", "label", "created_at", "updated_at"))

_ANY_POSITIVE = "__any_positive"
_N_UNJUDGED = "__n_unjudged"
_N_ROWS = "__n_rows"
_BAD = "__bad_"


# O1 -----------------------------------------------------------------------
def keyed_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not NULL (pushed into the Parquet scan as IsNotNull)."""
    return df.where(F.col(key).isNotNull())


# O2 -----------------------------------------------------------------------
def max_of(df: DataFrame, column: str, enums: Mapping[str, EnumType] | None = None,
           collation: str | None = None) -> Column:
    """The MAX aggregate of one column under the source's ordering rules.

    * enumerated column (field metadata or ``enums``): declaration order;
    * array column: element-wise with NULL elements largest;
    * text, and text in arrays, with ``collation``: compared under that collation, what it
      holds equal by code points;
    * ``CHAR(n)``, and arrays of it: compared without its padding;
    * everything else: Spark's ``max`` (NULLs ignored, all-NULL -> NULL).
    """
    field = df.schema[column]
    enum = (enums or {}).get(column) or enum_of(field)
    if enum is not None:
        return enum.max(column, column).alias(column)
    value = as_text(field)
    if isinstance(field.dataType, T.ArrayType):
        by = collation if _holds_text(field.dataType) else None
        if not field.dataType.containsNull and not by:  # no NULL elements: Spark's order is the same
            return padded(field, F.max(value)).alias(column)
        return padded(field, array_max_nulls_last(value, by)).alias(column)
    if collation and isinstance(field.dataType, T.StringType):
        return padded(field, F.max(collated(value, collation)).getField("v")).alias(column)
    return padded(field, F.max(value)).alias(column)


def _holds_text(dtype: T.DataType) -> bool:
    return _holds_text(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, T.StringType)


def keyed_by(df: DataFrame, key: str) -> Column:
    """The key in the form that is compared (``CHAR`` without its padding)."""
    return as_text(df.schema[key]).alias(key)


def _stored_key(out: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """The key as the source stores it."""
    return out.withColumn(key, padded(src.schema[key])) if is_char(src.schema[key]) else out


def consolidate_max(df: DataFrame, key: str, columns: Sequence[str] | None = None,
                    enums: Mapping[str, EnumType] | None = None,
                    collation: str | None = None) -> DataFrame:
    """One row per key; each column is its own MAX (so a row may mix sources)."""
    cols = [c for c in (columns or df.columns) if c != key]
    out = keyed_rows(df, key).groupBy(keyed_by(df, key)).agg(*[max_of(df, c, enums, collation) for c in cols])
    return _keep_metadata(_stored_key(out, df, key), df, [key, *cols])


# O3 -----------------------------------------------------------------------
def collect_statuses(df: DataFrame, key: str, status: str,
                     domain: EnumType | Sequence[str] | None = None) -> DataFrame:
    """The multiset of statuses per key, NULLs and duplicates kept.

    Returned as ``statuses: array<struct<status, n>>`` (one entry per distinct
    status, NULL included) plus ``n_statuses`` and ``n_null_statuses``. Counts
    per (key, status) combine map-side, so an array is as long as a key has
    different statuses, however many rows it has. With a ``domain`` the entries
    stand in its order; values outside it follow, then NULL: none is dropped.
    """
    values = domain.values if isinstance(domain, EnumType) else tuple(domain or ())
    place = F.when(F.col(status).isNull(), F.lit(len(values) + 1)).otherwise(F.lit(len(values)))
    for i, v in reversed(list(enumerate(values))):
        place = F.when(F.col(status) == F.lit(v), F.lit(i)).otherwise(place)
    per = df.groupBy(keyed_by(df, key), status).agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(place.alias("place"), F.col(status), F.col("n"))
    return _stored_key(per.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(entry)),
                    lambda e: F.struct(e.getField(status).alias(status), e.getField("n").alias("n"))).alias("statuses"),
        F.sum("n").alias("n_statuses"),
        F.coalesce(F.sum(F.when(F.col(status).isNull(), F.col("n"))), F.lit(0)).alias("n_null_statuses"),
    ), df, key)


def statuses_as_array(statuses: Column | str = "statuses", status: str = "status") -> Column:
    """The literal status array (repeats and NULLs kept, grouped by value)
    from the multiset of :func:`collect_statuses`.

    The array has one element per source row of the key: call it only where
    that is small (reports, fixtures); the label itself never needs it.
    """
    c = F.col(statuses) if isinstance(statuses, str) else statuses
    return F.flatten(F.transform(c, lambda e: F.array_repeat(e.getField(status), e.getField("n").cast("int"))))


# O4 -----------------------------------------------------------------------
def label_from_statuses(statuses: Column | str, positive: Iterable[str] = POSITIVE_STATUSES,
                        unjudged: str = UNJUDGED_STATUS) -> Column:
    """The label rule over a status array, in its array form.

    ``exists`` and ``forall`` are three-valued like the source's
    ``x = ANY(array)`` / ``x = ALL(array)``: a NULL element with no match
    makes ``exists`` NULL and ``forall`` NULL, so those arrays fall through
    to the ELSE branch exactly as in the source.
    """
    arr = F.col(statuses) if isinstance(statuses, str) else statuses
    pos = list(positive)
    return (F.when(F.exists(arr, lambda x: x.isin(*pos)), F.lit(POSITIVE_LABEL))
            .when(F.forall(arr, lambda x: x == F.lit(unjudged)), F.lit(None).cast("string"))
            .otherwise(F.lit(NEGATIVE_LABEL)))



def label_aggregates(status: str | Column, positive: Iterable[str] = POSITIVE_STATUSES,
                     unjudged: str = UNJUDGED_STATUS) -> list[Column]:
    """Constant-size aggregate state for the label rule.

    ``any(status in positive)`` and ``count(status = unjudged) = count(*)``
    are the source's ``= ANY(array)`` / ``= ALL(array)`` tests over the
    collected statuses, with the same three-valued results, but they combine
    map-side instead of buffering every status of a key.
    """
    s = F.col(status) if isinstance(status, str) else status
    return [
        F.bool_or(s.isin(*positive)).alias(_ANY_POSITIVE),
        F.count_if(s == F.lit(unjudged)).alias(_N_UNJUDGED),
        F.count(F.lit(1)).alias(_N_ROWS),
    ]


def label_from_aggregates(any_positive: Column | str = _ANY_POSITIVE,
                          n_unjudged: Column | str = _N_UNJUDGED,
                          n_rows: Column | str = _N_ROWS) -> Column:
    """would_watch if any positive; NULL if all unjudged; else would_not_watch.

    A NULL status makes "all unjudged" false (NULL counts in ``n_rows`` only),
    so it lands in the ELSE branch, as in the source.
    """
    a = F.col(any_positive) if isinstance(any_positive, str) else any_positive
    u = F.col(n_unjudged) if isinstance(n_unjudged, str) else n_unjudged
    n = F.col(n_rows) if isinstance(n_rows, str) else n_rows
    return (F.when(a, F.lit(POSITIVE_LABEL))
            .when(u == n, F.lit(None).cast("string"))
            .otherwise(F.lit(NEGATIVE_LABEL)))


def derive_label(df: DataFrame, key: str, status: str, label: str = "label") -> DataFrame:
    """Per key: the derived label (NULL = not judged yet)."""
    g = _stored_key(keyed_rows(df, key).groupBy(keyed_by(df, key)).agg(*label_aggregates(status)), df, key)
    return g.select(key, label_from_aggregates().alias(label)).withMetadata(label, LABEL_TYPE.metadata)


# O5 -----------------------------------------------------------------------
def new_keys_only(df: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``target`` (NULL or repeated target keys are harmless).

    Written as a left anti-join on the target's key column only. The key
    set is de-duplicated first (a map-side partial aggregate), so a key
    repeated across a third of the target cannot pile up in one join task,
    and the join reuses that aggregate's hash partitioning. The planner (AQE)
    broadcasts the key set only when its measured size is under the
    broadcast threshold and sort-merges otherwise. ``CHAR`` keys meet without their padding.
    """
    tk = target_key or key
    keys = target.select(as_text(target.schema[tk]).alias("__tkey")).distinct()
    return df.join(keys, as_text(df.schema[key], df[key]) == keys["__tkey"], "left_anti")


# O6 -----------------------------------------------------------------------
def labelled_only(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label).isNotNull())


# O7 -----------------------------------------------------------------------
def fill_title(df: DataFrame, column: str = "media_title", fill: str = "") -> DataFrame:
    md = df.schema[column].metadata
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(fill))).withMetadata(column, md)


# O8 -----------------------------------------------------------------------
def stamp_utc(df: DataFrame, columns: Sequence[str] = ("created_at", "updated_at"),
              now: _dt.datetime | None = None) -> DataFrame:
    """Set every stamp column to the statement-time UTC (one value for all rows)."""
    ts = utc_now(now)
    return df.withColumns({c: ts for c in columns})


# O9 -----------------------------------------------------------------------
def align_to(df: DataFrame, target_schema: T.StructType, strict: bool = True,
             enforce: bool = True) -> DataFrame:
    """``df`` in the target's column order and types, for an append by name.

    Target columns missing from ``df`` take their declared default (field
    metadata ``default``, a Spark SQL expression) or NULL. A column of ``df``
    the target lacks is an error, as in an INSERT with a column list. With
    ``enforce`` the target's declared constraints hold as in the database, for
    given values and defaults alike: a value outside an enum domain, a NULL in
    a ``not_null`` column, a text longer than the declared length (blanks at
    its end are cut), or a row failing a column's ``check`` (NULL passes)
    aborts the write. Domains and lengths hold for the elements of arrays too.
    ``CHAR`` values are stored padded, and rules see them without the padding.
    """
    have = set(df.columns)
    extra = [c for c in df.columns if c not in {f.name for f in target_schema.fields}]
    if extra and strict:
        raise ValueError(f"columns not in target: {extra}")
    cols = []
    for f in target_schema.fields:
        if f.name in have:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.cast(f.dataType)
        else:
            c = default_column(f)
        cols.append(c.alias(f.name, metadata=f.metadata or {}))
    out = df.select(*cols)
    if enforce:  # on the rows as they will stand, defaults included
        fields = target_schema.fields
        out = out.select(*[_typed(F.col(f.name), f.dataType, f.metadata, f.name).alias(f.name) for f in fields])
        out = out.select(*[padded(f, _ruled(f)).alias(f.name, metadata=f.metadata or {}) for f in fields])
    return out


NOT_NULL_KEY = "not_null"
CHECK_KEY = "check"


def _not_null(c: Column, name: str) -> Column:
    msg = F.lit(f"null value in column {name} violates not-null constraint")
    return F.when(c.isNull(), F.raise_error(msg)).otherwise(c)


def _limited(c: Column, n: int, name: str, blank_padded: bool) -> Column:
    """Text of at most ``n`` characters: blanks beyond them are cut, those of ``CHAR`` mean nothing."""
    long = F.raise_error(F.lit(f"value too long for {name}: at most {n} characters")).cast("string")
    short = F.rtrim(c)
    if blank_padded:
        return F.when(F.length(short) <= n, short).when(c.isNotNull(), long)
    return F.when(F.length(c) <= n, c).when(F.length(short) <= n, F.substring(c, 1, n)).when(c.isNotNull(), long)


def _typed(c: Column, dtype: T.DataType, metadata: dict | None, name: str) -> Column:
    """The value if its declared type admits it (enum domain, text length), ``CHAR`` unpadded;
    the same for each element of an array, where NULL passes."""
    md = metadata or {}
    if isinstance(dtype, T.ArrayType):
        inner = element_metadata(md)
        return F.transform(c, lambda x: _typed(x, dtype.elementType, inner, f"an element of {name}")) if inner else c
    e = enum_of(T.StructField(name, dtype, True, md))
    if e is not None:  # metadata on the input does not prove its values
        c = e.checked(c, name)
    if md.get(LENGTH_KEY) and isinstance(dtype, T.StringType):
        c = _limited(c, int(md[LENGTH_KEY]), name, char_width(dtype, md) is not None)
    return c


def _ruled(target: T.StructField) -> Column:
    """The value if NOT NULL and the column's rule admit it."""
    md, c = target.metadata or {}, F.col(target.name)
    if md.get(NOT_NULL_KEY):
        c = _not_null(c, target.name)
    if md.get(CHECK_KEY):
        msg = F.lit(f"new row violates check constraint {target.name}_check")
        c = F.when(F.expr(md[CHECK_KEY]) == F.lit(False), F.raise_error(msg)).otherwise(c)
    return c


def append_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """``target`` followed by ``df`` aligned to it by column name."""
    return target.unionByName(align_to(df, target.schema))


# O10 ----------------------------------------------------------------------
def sync_media_to_training(media: DataFrame, training: DataFrame, *, key: str = "imdb_id",
                           status: str = "rejection_status",
                           columns: Sequence[str] | None = SYNC_MAX_COLUMNS,
                           title: str | None = "media_title",
                           stamps: Sequence[str] = ("created_at", "updated_at"),
                           enums: Mapping[str, EnumType] | None = None,
                           now: _dt.datetime | None = None,
                           collation: str | None = None) -> DataFrame:
    """New training rows: one per title not yet in ``training`` and judged.

    keyed_rows -> consolidate (MAX per column) + label state in the same
    aggregate -> label -> labelled_only -> new_keys_only -> fill_title ->
    stamp_utc, in the target's column order. Existing target rows are never
    touched, so a second run over the same input yields nothing.

    There is one plan whatever the sizes: an anti-join on the key, for which
    Spark picks the join. An enumerated value outside its domain is carried
    through the aggregate beside the maximum and raises only if its title is
    one of the new rows, so where the join runs cannot change the outcome.
    Every requested column must exist. Building the plan starts no job.
    """
    wanted = columns if columns is not None else [c for c in media.columns if c not in stamps]
    cols = [c for c in wanted if c not in (key, status)]
    absent = [c for c in (key, status, *cols) if c not in media.columns]
    if absent:
        raise ValueError(f"columns not in media: {absent}")
    domains = {c: (enums or {}).get(c) or enum_of(media.schema[c]) for c in cols}
    domains = {c: e for c, e in domains.items() if e is not None}
    grouped = keyed_rows(media, key).groupBy(keyed_by(media, key)).agg(
        *[domains[c].max_known(c).alias(c) if c in domains else max_of(media, c, enums, collation) for c in cols],
        *[F.max(F.when(e.out_of_domain(c), F.col(c))).alias(_BAD + c) for c, e in domains.items()],
        *label_aggregates(status),
    )
    grouped = _keep_metadata(_stored_key(grouped, media, key), media, [key])
    labelled = grouped.withColumn("label", label_from_aggregates()).drop(_ANY_POSITIVE, _N_UNJUDGED, _N_ROWS)
    fresh = new_keys_only(labelled_only(labelled), training, key)
    fresh = fresh.withColumns({c: F.when(F.col(_BAD + c).isNull(), F.col(c)).otherwise(e.checked(_BAD + c, c))
                               for c, e in domains.items()})
    if title and title in cols:
        fresh = fill_title(fresh, title)
    if stamps:
        fresh = stamp_utc(fresh, stamps, now)
    order = [key, "label", *cols, *stamps]
    if columns is SYNC_MAX_COLUMNS:
        order = [c for c in SYNC_TARGET_COLUMNS if c in set(order)]
    out = fresh.select(*order).withMetadata("label", LABEL_TYPE.metadata)
    return _keep_metadata(out, media, [key, *cols])


# O11 ----------------------------------------------------------------------
def set_flag_all(df: DataFrame, column: str = "reviewed", value: object = True) -> DataFrame:
    """Every row with ``column`` set to ``value``; other columns unchanged."""
    if column in df.columns:
        dtype = df.schema[column].dataType
        md = df.schema[column].metadata
        return df.withColumn(column, F.lit(value).cast(dtype)).withMetadata(column, md)
    return df.withColumn(column, F.lit(value))


def _keep_metadata(out: DataFrame, src: DataFrame, columns: Iterable[str]) -> DataFrame:
    names = set(out.columns)
    for c in columns:
        if c in names and c in src.columns:
            md = src.schema[c].metadata
            if md and out.schema[c].metadata != md:
                out = out.withMetadata(c, md)
    return out


def sync_target_schema(media_schema: T.StructType, key: str = "imdb_id",
                       columns: Sequence[str] = SYNC_MAX_COLUMNS,
                       stamps: Sequence[str] = ("created_at", "updated_at"),
                       flag: str | None = "reviewed") -> T.StructType:
    """Schema of the training table the sync fills, derived from the media schema.

    Key, label (``label_type`` enum), the consolidated columns with their
    media types and metadata, zone-less UTC stamps, and the review flag
    (default ``false``), which the sync never names.
    """
    by_name = {f.name: f for f in media_schema.fields}
    fields = [T.StructField(key, by_name[key].dataType, True, by_name[key].metadata),
              LABEL_TYPE.field("label")]
    fields += [T.StructField(c, by_name[c].dataType, True, by_name[c].metadata) for c in columns if c in by_name]
    fields += [T.StructField(s, T.TimestampNTZType(), True) for s in stamps]
    if flag:
        fields.append(T.StructField(flag, T.BooleanType(), True, {"default": "false"}))
    order = {c: i for i, c in enumerate(SYNC_TARGET_COLUMNS)}
    head = sorted((f for f in fields if f.name in order), key=lambda f: order[f.name])
    return T.StructType(head + [f for f in fields if f.name not in order])


def sync_into(store, schema: str = "atp", media: str = "media", training: str = "training",
              **kwargs) -> int:
    """The sync as an INSERT: append the new rows to ``schema.training``; returns the count.

    Only the key column of the target is read; the append is one job whose
    row count comes from an Observation. The append lands on just the state the
    anti-join read: a title that another sync brings meanwhile is left out, so two
    syncs at once leave each title once, as two in a row would. (A database
    table has its own constraints for that.)
    """
    key = kwargs.get("key", "imdb_id")

    def plan(target: DataFrame) -> DataFrame:
        return sync_media_to_training(store.read(schema, media), target.select(key), **kwargs)

    if hasattr(store, "append_planned"):
        return store.append_planned(plan, schema, training, new_by=[key]) or 0
    return store.append(plan(store.read(schema, training)), schema, training) or 0
