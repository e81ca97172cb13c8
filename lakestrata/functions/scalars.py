"""Column expressions built from Spark's own functions, all inside codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def joined_key(*parts: Column, sep: str = "-") -> Column:
    """Text key of all parts; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def zero_if_null(col: Column, dtype: DataType) -> Column:
    """``coalesce(col, 0)`` with the zero in the column's own type, so it never widens."""
    return F.coalesce(col, F.lit(0).cast(dtype))


def to_millis(col: Column) -> Column:
    """Cut a zone-less timestamp to milliseconds.

    ``date_trunc`` goes through the session time zone, where a wall time inside
    a daylight-saving gap would move; taking off the microseconds stays zone-less.
    """
    ntz = col.cast("timestamp_ntz")
    micros = (F.extract(F.lit("SECOND"), ntz) * F.lit(1_000_000)).cast("bigint")
    return ntz - (micros % F.lit(1000)) * F.expr("INTERVAL '0.000001' SECOND")


def audit_clock(as_of: dt.datetime | None = None, tz: str = "UTC") -> Column:
    """Wall time in ``tz`` as a millisecond timestamp.

    Spark fixes the clock once per query or micro-batch. ``as_of`` replaces it
    for reruns that must give the same rows.
    """
    if as_of is not None:
        return to_millis(F.lit(as_of.isoformat(sep=" ")))
    now = F.current_timestamp().cast("timestamp_ntz")
    return to_millis(F.convert_timezone(None, F.lit(tz), now))
