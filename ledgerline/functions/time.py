"""Statement-time timestamps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now(now: _dt.datetime | None = None) -> Column:
    """Zone-less UTC time of the statement; one value for every row.

    ``current_timestamp()`` is evaluated once per query, so all rows agree.
    A fixed ``now`` (naive, taken as UTC) makes results reproducible.
    """
    if now is not None:
        if now.tzinfo is not None:
            now = now.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()).cast("timestamp_ntz")


def yyyymmdd(day: _dt.date | None = None) -> str:
    day = day or _dt.datetime.now(_dt.timezone.utc).date()
    return day.strftime("%Y%m%d")
