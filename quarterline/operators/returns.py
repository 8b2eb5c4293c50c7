"""Quarterly total returns per ticker."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.cleaning import finite


def on_calendar(panel: DataFrame, min_q: int, max_q: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per ticker and quarter of [min_q, max_q]; filler rows have NULL values.

    A row is expanded up to the next one of its ticker (the first one back to ``min_q``), so
    there is no cross join with a calendar, and one shuffle on the ticker.
    """
    w = Window.partitionBy("ticker").orderBy("qidx")
    cols = ["px_adj", "div_adj", *carried]
    rows = (
        panel.where(F.col("qidx").between(min_q, max_q)).select("ticker", "qidx", *cols)
        .withColumn("_prev", F.lag("qidx").over(w))
        .where("_prev is null or _prev <> qidx")
        .withColumn("_next", F.lead("qidx").over(w))
    )
    first = F.when(F.col("_prev").isNull(), F.lit(min_q)).otherwise(F.col("qidx"))
    last = F.coalesce(F.col("_next") - 1, F.lit(max_q))
    own = F.col("_q") == F.col("qidx")
    return rows.withColumn("_q", F.explode(F.sequence(first, last))).select(
        "ticker", F.col("_q").alias("qidx"), *[F.when(own, F.col(c)).alias(c) for c in cols]
    )


def with_returns(rows: DataFrame, delist_mode: str) -> DataFrame:
    """Add ``r`` to calendar rows: (price + dividend) / previous price - 1, missing is 0.

    ``carry`` keeps the last price through gaps. ``writeoff`` books a total loss at the first
    quarter without a price after one with a price, and nothing afterwards.
    """
    w = Window.partitionBy("ticker").orderBy("qidx")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    px = finite(F.col("px_adj"))
    rows = rows.withColumn("_px", px).withColumn("_prev", F.last("_px", ignorenulls=True).over(before))
    paid = F.coalesce(F.col("_px"), F.col("_prev")) + F.coalesce(finite(F.col("div_adj")), F.lit(0.0))
    r = F.coalesce(paid / F.nullif("_prev", F.lit(0.0)) - 1, F.lit(0.0))
    drop = ["_px", "_prev"]
    if delist_mode == "writeoff":
        lost = F.col("_px").isNull() & F.lag("_px").over(w).isNotNull()
        rows = rows.withColumn("_lost", F.when(lost, F.col("qidx")))
        rows = rows.withColumn("_gone", F.min("_lost").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        r = (F.when(F.col("qidx") == F.col("_gone"), -1.0)
             .when(F.col("qidx") > F.col("_gone"), 0.0).otherwise(r))
        drop += ["_lost", "_gone"]
    return rows.withColumn("r", r).drop(*drop)


def ticker_returns(panel: DataFrame, min_q: int, max_q: int, delist_mode: str = "carry") -> DataFrame:
    return with_returns(on_calendar(panel, min_q, max_q), delist_mode).select("ticker", "qidx", "r")
