"""Backward as-of join on an equal key."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str,
                  value: str) -> DataFrame:
    """Add to ``left`` the ``value`` of the latest right row with ``right_on <= left_on``.

    Both inputs are laid on one time line per key and the last value is carried forward: one
    shuffle and one sort, with no pairs formed. A key's time line is sorted by one task and
    spills; inputs unique per key and day keep it within the calendar.
    """
    events = left.select("*", F.col(left_on).alias("_at"), F.lit(1).alias("_left"),
                         F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    ticks = right.select(by, F.col(right_on).alias("_at"), F.lit(0).alias("_left"),
                         F.col(value).alias("_v"))
    line = (
        Window.partitionBy(by).orderBy("_at", "_left")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        events.unionByName(ticks, allowMissingColumns=True)
        .withColumn(value, F.last("_v", ignorenulls=True).over(line))
        .where("_left = 1").drop("_at", "_left", "_v")
    )
