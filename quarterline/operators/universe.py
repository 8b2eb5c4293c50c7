"""Tickers and company names."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.cleaning import norm_ticker

PLACEHOLDER = "NONE-"


def ticker_map(source: DataFrame, excluded: DataFrame) -> DataFrame:
    """``cik, ticker_edgar, ticker_yahoo, exchange``: first row per company and ticker.

    ``source`` is in the order of its ``pos``. Excluded tickers never enter.
    """
    rows = (
        source.select("cik", F.upper(F.trim("ticker")).alias("ticker_edgar"),
                      norm_ticker(F.col("ticker")).alias("ticker_yahoo"), "exchange", "pos")
        .where(F.col("ticker_edgar") != "")
        .where((F.col("ticker_yahoo") != "") & (F.col("ticker_yahoo") != PLACEHOLDER))
        .join(excluded.select(F.col("ticker").alias("ticker_yahoo")), "ticker_yahoo", "left_anti")
    )
    first = Window.partitionBy("cik", "ticker_edgar").orderBy("pos")
    return (
        rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
        .select("cik", "ticker_edgar", "ticker_yahoo", "exchange")
    )


def company(source: DataFrame, filing_names: DataFrame) -> DataFrame:
    """``cik, entity_name``: the map's first non-empty name; filings only fill what is missing."""
    names = source.where("name <> ''").select(
        "cik", F.col("name").alias("entity_name"), F.lit(0).alias("prio"), "pos"
    ).unionByName(filing_names.select("cik", "entity_name", F.lit(1).alias("prio"), "pos"))
    first = Window.partitionBy("cik").orderBy("prio", "pos", "entity_name")
    return (
        names.withColumn("_n", F.row_number().over(first)).where("_n = 1")
        .select("cik", "entity_name")
    )


def universe(tickers: DataFrame, excluded: DataFrame) -> DataFrame:
    """Sorted tickers to load: usable and not excluded."""
    return candidates(tickers).join(excluded.select("ticker"), "ticker", "left_anti").orderBy("ticker")


def candidates(tickers: DataFrame) -> DataFrame:
    return tickers.select(norm_ticker(F.col("ticker")).alias("ticker")).where(
        (F.col("ticker") != "") & (F.col("ticker") != PLACEHOLDER)
    ).distinct()


def explicit_universe(spark, tickers: str, excluded: DataFrame) -> DataFrame:
    """Universe of a comma-separated list given by the caller."""
    listed = spark.range(1).select(F.explode(F.split(F.lit(tickers), ",")).alias("ticker"))
    return universe(listed, excluded)


def excluded_found(tickers: DataFrame, excluded: DataFrame) -> DataFrame:
    """Excluded tickers that the universe would have held, for the report."""
    return candidates(tickers).intersect(excluded.select("ticker"))
