"""Repairs after both loads: implausible prices, corrupt tickers and the share-count basis.

Order matters: corrupt tickers go before share counts are normalised, because the ticker that
stands for a company is its smallest remaining one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import JUMP_DOWN, JUMP_UP, PRICE_FLOOR, SHARES_MAX
from quarterline.operators.splits import with_factor_between


def drop_tiny_prices(price_quarterly: DataFrame) -> DataFrame:
    """An unknown as-traded price stays."""
    return price_quarterly.where(
        F.col("close_as_traded").isNull() | (F.col("close_as_traded") >= PRICE_FLOOR)
    )


def corrupt_jumps(price_quarterly: DataFrame) -> DataFrame:
    """Quarter closes that jump by more than 100x, or below 1/100, from the ticker's previous
    available quarter. A ticker has one row per quarter, so its window stays small."""
    w = Window.partitionBy("ticker_yahoo").orderBy("quarter")
    r = F.col("close_raw") / F.col("prev")
    return (
        price_quarterly.where("close_raw > 0")
        .select("ticker_yahoo", "quarter", F.lag("close_raw").over(w).alias("prev"), "close_raw")
        .where((F.col("prev") > 0) & ((r > JUMP_UP) | (r < JUMP_DOWN)))
    )


def corrupt_tickers(price_quarterly: DataFrame) -> DataFrame:
    return corrupt_jumps(price_quarterly).select("ticker_yahoo").distinct()


def with_corrupt_mark(price_quarterly: DataFrame) -> DataFrame:
    """``corrupt``: whether the ticker is one of ``corrupt_tickers``. One shuffle on the ticker."""
    line = Window.partitionBy("ticker_yahoo").orderBy("quarter")
    back = line.rowsBetween(Window.unboundedPreceding, -1)
    close = F.when(F.col("close_raw") > 0, F.col("close_raw"))
    r = close / F.last(close, ignorenulls=True).over(back)
    jump = F.coalesce((r > JUMP_UP) | (r < JUMP_DOWN), F.lit(False))
    marked = price_quarterly.withColumn("_jump", jump)
    return marked.withColumn("corrupt", F.max("_jump").over(Window.partitionBy("ticker_yahoo"))).drop("_jump")


def purge(tables: dict[str, DataFrame], corrupt: DataFrame) -> dict[str, DataFrame]:
    """Remove corrupt tickers from every table that names tickers."""
    out = {}
    for name, df in tables.items():
        key = "ticker_yahoo" if "ticker_yahoo" in df.columns else "ticker"
        gone = corrupt.select(F.col("ticker_yahoo").alias(key))
        out[name] = df.join(gone, key, "left_anti")
    return out


def company_ticker(ticker_map: DataFrame) -> DataFrame:
    """The one ticker that stands for a company: its smallest."""
    return ticker_map.groupBy("cik").agg(F.min("ticker_yahoo").alias("ticker_yahoo"))


def shares_with_price_date(shares_quarterly: DataFrame, ticker_map: DataFrame,
                           price_quarterly: DataFrame) -> DataFrame:
    """Share counts with ``ticker_yahoo`` and the date of their quarter's price."""
    prices = company_ticker(ticker_map).join(
        price_quarterly.select("ticker_yahoo", "quarter", "price_date"), "ticker_yahoo"
    ).select("cik", "quarter", "ticker_yahoo", "price_date")
    return shares_quarterly.join(prices, ["cik", "quarter"], "left")


def normalise_shares(shares_quarterly: DataFrame, ticker_map: DataFrame,
                     price_quarterly: DataFrame, splits: DataFrame) -> DataFrame:
    """Add ``shares_at_price_basis``: the count on the split basis of its quarter's price.

    Splits between count date and price date multiply or divide the count. What is not a
    plausible count afterwards falls back to the reported one.
    """
    rows = shares_with_price_date(shares_quarterly, ticker_map, price_quarterly)
    rows = rows.withColumn("_lo", F.least("as_of", "price_date")).withColumn(
        "_hi", F.greatest("as_of", "price_date"))
    rows = rows.withColumn("_lo", F.when(F.col("price_date").isNotNull(), F.col("_lo")))
    rows = with_factor_between(rows, splits, "ticker_yahoo", "_lo", "_hi", "_f")
    shares = F.col("shares").cast("double")
    moved = F.when(F.col("price_date") > F.col("as_of"), shares * F.col("_f")).when(
        F.col("as_of") > F.col("price_date"), shares / F.col("_f")
    ).otherwise(shares)
    n = F.col("_n")
    return (
        rows.withColumn("_n", F.round(moved, 0))
        .withColumn("fallback", F.coalesce(~((n > 0) & (n <= SHARES_MAX)), F.lit(True)))
        .withColumn("shares_at_price_basis",
                    F.when(F.col("fallback"), F.col("shares")).otherwise(n.cast("long")))
        .select(*shares_quarterly.columns, "shares_at_price_basis", "fallback")
    )


def normalisation_counts(normalised: DataFrame) -> DataFrame:
    changed = ~F.col("fallback") & ~F.col("shares_at_price_basis").eqNullSafe(F.col("shares"))
    return normalised.agg(
        F.count("*").alias("total"), F.count_if(changed).alias("normalized_changed"),
        F.count_if("fallback").alias("fallbacks"),
    )
