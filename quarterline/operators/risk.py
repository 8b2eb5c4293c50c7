"""Trailing risk of daily closes, sampled at the last day of every quarter."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import (
    PRICE_CEILING, PRICE_FLOOR, RISK_MIN_CLOSES, RISK_MIN_RETURNS, RISK_WINDOW,
)
from quarterline.functions.quarters import quarter_label


def _masked_close() -> Column:
    c = F.col("close")
    return F.when((c > PRICE_FLOOR) & (c < PRICE_CEILING), c)


def stock_risk_quarter(price_daily: DataFrame) -> DataFrame:
    """``ticker_yahoo, quarter, price_date, vol_252d, ret_252d, off_high_252d``.

    Frames are rows of available days, not calendar days: volatility is the annualised
    sample deviation of the daily returns in the last 252 rows (at least 120 of them), the
    return compares with 252 rows earlier, the high is that of the last 252 rows (at least
    60 closes). An implausible close counts as missing but keeps its row.

    ``price_daily`` has one row per ticker and day. A moving frame would be evaluated anew
    for each row, 252 updates per aggregate. Instead a ticker's rows are cut into blocks of
    252: a frame is the head of its own block plus the tail of the block before, and both are
    running aggregates. Counts, means and squared deviations of the two parts are merged by
    the pairwise variance formula, so no large sums are subtracted from each other. All
    windows share one shuffle on the ticker.
    """
    n = RISK_WINDOW
    by_day = Window.partitionBy("ticker_yahoo").orderBy("date")
    days = (
        price_daily.where(F.col("close").isNotNull() & ~F.isnan("close"))
        .select("ticker_yahoo", "date", _masked_close().alias("c"))
        .withColumn("quarter", quarter_label(F.col("date")))
        .select(
            "ticker_yahoo", "date", "quarter", "c",
            (F.row_number().over(by_day) - 1).alias("i"),
            (F.col("c") / F.lag("c").over(by_day) - 1).alias("r"),
            (F.col("c") / F.lag("c", n).over(by_day) - 1).alias("ret_252d"),
            F.lead("quarter").over(by_day).alias("next_quarter"),
        )
        .withColumn("block", F.floor(F.col("i") / n).cast("int"))
    )
    parts = Window.partitionBy("ticker_yahoo", "block")
    running = (Window.unboundedPreceding, Window.currentRow)

    def with_parts(df: DataFrame, prefix: str, w) -> DataFrame:
        over = w.rowsBetween(*running)
        return df.select(
            "*",
            F.count("r").over(over).alias(prefix + "n"),
            F.avg("r").over(over).alias(prefix + "mean"),
            F.var_pop("r").over(over).alias(prefix + "var"),
            F.max("c").over(over).alias(prefix + "high"),
            F.count("c").over(over).alias(prefix + "closes"),
        )

    days = with_parts(days, "t_", parts.orderBy(F.col("date").desc()))
    days = with_parts(days, "h_", parts.orderBy("date"))
    # the frame of row i starts at i-251; in the last row of a block that is the block itself
    along = Window.partitionBy("ticker_yahoo").orderBy("block", "date")
    spans = F.pmod(F.col("i"), F.lit(n)) != n - 1
    tail = ("t_n", "t_mean", "t_var", "t_high", "t_closes")
    days = days.select(
        "ticker_yahoo", "date", "quarter", "next_quarter", "c", "ret_252d",
        "h_n", "h_mean", "h_var", "h_high", "h_closes", spans.alias("spans"),
        *[F.lag(t, n - 1).over(along).alias(t) for t in tail],
    ).where(F.col("next_quarter").isNull() | (F.col("next_quarter") != F.col("quarter")))
    part = {t: F.when(F.col("spans"), F.col(t)) for t in tail}

    hn, tn = F.col("h_n"), F.coalesce(part["t_n"], F.lit(0))
    count = hn + tn
    between = part["t_mean"] - F.col("h_mean")
    squares = (
        F.coalesce(F.col("h_var") * hn, F.lit(0.0))
        + F.coalesce(part["t_var"] * tn, F.lit(0.0))
        + F.coalesce(between * between * hn * tn / F.when(count > 0, count), F.lit(0.0))
    )
    vol = F.when(count >= RISK_MIN_RETURNS, F.sqrt(squares / (count - 1)) * F.sqrt(F.lit(float(n))))
    closes = F.col("h_closes") + F.coalesce(part["t_closes"], F.lit(0))
    high = F.greatest(F.col("h_high"), part["t_high"])
    off_high = F.when(closes >= RISK_MIN_CLOSES, F.col("c") / high - 1)
    # a ticker without any plausible close yields nothing; a quarter is shorter than the
    # frame, so every close is seen by the sampled row of its own quarter
    ever = F.max(high.isNotNull()).over(Window.partitionBy("ticker_yahoo"))
    return (
        days.select(
            "ticker_yahoo", "quarter", F.col("date").alias("price_date"),
            vol.alias("vol_252d"), "ret_252d", off_high.alias("off_high_252d"),
            ever.alias("ever"),
        )
        .where("ever").drop("ever")
    )
