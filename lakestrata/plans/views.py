"""Page views per minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def page_views_per_minute(
    events: DataFrame, ts: str = "ts", kind: str = "event_type", lateness: str | None = None
) -> DataFrame:
    """Number of views in each minute that has one.

    Counts are combined before the shuffle, so a busy minute sends one row per
    task. A stream sets ``lateness``, after which a minute is closed; its
    watermark needs an instant, so wall times are read in the session zone.
    """
    views = events.filter(F.col(kind) == "view")
    if lateness:
        views = views.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    counted = views.groupBy(F.window(ts, "1 minute")).agg(F.count("*").alias("views"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "views")


def late_minutes(query: StreamingQuery) -> int:
    """How many minutes got views that came behind the watermark, batch by batch, and were not counted.

    Views of one minute and batch are put together before the watermark is looked at.
    """
    operators = (operator for progress in query.recentProgress for operator in progress["stateOperators"])
    return sum(operator["numRowsDroppedByWatermark"] for operator in operators)
