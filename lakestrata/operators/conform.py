"""Rename raw columns to a fixed schema and stamp the audit columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from lakestrata.functions import audit_clock, to_millis


def conform(
    df: DataFrame,
    mapping: Mapping[str, str],
    target_schema: StructType,
    partition_col: str,
    audit_cols: Sequence[str] = ("dwd_create_at", "dwd_update_at"),
    as_of: dt.datetime | None = None,
    tz: str = "UTC",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``df`` that have a partition, in ``target_schema``'s names, order and types.

    ``mapping`` is target column to source column. ``carry`` keeps further
    source columns, such as row kind and sequence, behind the schema's own.
    One filter and one projection, so the scan reads only mapped columns and a
    stream stays stateless.
    """
    clock = audit_clock(as_of, tz)
    columns = []
    for field in target_schema:
        if field.name in audit_cols:
            columns.append(clock.alias(field.name))
            continue
        value = F.col(f"`{mapping[field.name]}`")
        if isinstance(field.dataType, TimestampNTZType):
            value = to_millis(value)
        columns.append(value.cast(field.dataType).alias(field.name, metadata=field.metadata))
    partition = F.col(f"`{mapping[partition_col]}`")
    return df.filter(partition.isNotNull()).select(*columns, *[F.col(c) for c in carry])


REJECTS = "rejects"
_GOOD = "_good"


def conform_with_rejects(
    df: DataFrame,
    mapping: Mapping[str, str],
    target_schema: StructType,
    partition_col: str,
    place: str,
    audit_cols: Sequence[str] = ("dwd_create_at", "dwd_update_at"),
    as_of: dt.datetime | None = None,
    tz: str = "UTC",
    carry: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``conform`` that puts rows aside which do not fit, instead of stopping: (good rows, rejected values).

    A value that is there but does not become the target type, and a missing
    partition, rejects its row. The second table has a row for each such value:
    column, raw_value, reason, and the whole raw row as JSON. One pass over the
    input writes both to the folder ``place``; every input row is in one of them.
    """
    clock = audit_clock(as_of, tz)
    columns, checks = [], []
    for field in target_schema:
        if field.name in audit_cols:
            columns.append(clock.alias(field.name))
            continue
        raw = F.col(f"`{mapping[field.name]}`")
        value = raw.try_cast(field.dataType)
        fits = raw.isNull() | value.isNotNull()
        if isinstance(field.dataType, TimestampNTZType):
            value = to_millis(value)
        kind = field.dataType.simpleString()
        if field.name == partition_col:
            reason = F.when(raw.isNull(), "missing partition").when(~fits, f"not {kind}")
        else:
            reason = F.when(~fits, f"not {kind}")
        columns.append(value.alias(field.name, metadata=field.metadata))
        found = F.struct(F.lit(field.name).alias("column"), raw.cast("string").alias("raw_value"), reason.alias("reason"))
        checks.append(F.when(reason.isNotNull(), found))
    rejects = F.array_compact(F.array(*checks))
    raw_row = F.when(F.size(rejects) > 0, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    checked = df.select(
        F.struct(*columns, *[F.col(c) for c in carry]).alias("row"),
        rejects.alias(REJECTS),
        raw_row.alias("raw_row"),
        (F.size(rejects) == 0).alias(_GOOD),
    )
    checked.write.mode("overwrite").partitionBy(_GOOD).parquet(place)
    stored = df.sparkSession.read.schema(checked.schema).parquet(place)
    good = stored.filter(_GOOD).select("row.*")
    bad = stored.filter(f"NOT {_GOOD}").select(F.explode(REJECTS).alias("value"), "raw_row").select("value.*", "raw_row")
    return good, bad
