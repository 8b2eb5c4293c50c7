"""Daily vendor history to price, split, dividend and quarter-close tables.

Two shuffles in all: one on ticker and day, which keeps a single row for each, and one on the
ticker. After the first, a ticker holds at most one row per calendar day, whatever the input size.
Given the number of ``tasks`` for the rows (``tasks_for``), both deal the rows out to that many, so
that no task's tables and sorts grow with the input; without it, days are combined before they travel.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarterline.constants import DIVIDEND_MAX, NUMERIC_MAX, PRICE_CEILING, PRICE_FLOOR
from quarterline.functions.cleaning import finite, sane_long, sane_number
from quarterline.functions.quarters import quarter_label

#: Rows of a task; most days have one row, so that combining them first would hold a whole split.
TASK_ROWS = 200_000

_VALUES = ("open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits")


def tasks_for(rows: int) -> int:
    return 1 + rows // TASK_ROWS


def several(tasks: int | None) -> bool:
    """One task needs no dealing: few rows go by the session's partitions."""
    return tasks is not None and tasks > 1


def daily_rows(history: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per ticker and day, the last one ingested; days without a close are dropped.

    All values are numbers, so this is a hash aggregation.
    """
    rows = history.withColumn("date", F.to_date("ts"))
    return (
        (rows.repartition(tasks, "ticker", "date") if several(tasks) else rows)
        .groupBy("ticker", "date")
        .agg(*[F.max_by(c, "pos").alias(c) for c in _VALUES])
        .where(F.col("close").isNotNull() & ~F.isnan("close"))
    )


def enriched_history(history: DataFrame, tasks: int | None = None) -> DataFrame:
    """Daily rows with ``ratio`` (usable split of the day), ``factor`` (product of the splits
    strictly after the day) and ``as_traded`` (close on the basis of its own day)."""
    later = (
        Window.partitionBy("ticker").orderBy(F.col("date").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    usable = F.when((sane_number(F.col("stock_splits")) > 0), F.col("stock_splits"))
    cand = F.col("close_ok") * F.col("factor")
    days = daily_rows(history, tasks)
    return (
        (days.repartition(tasks, "ticker") if several(tasks) else days)
        .withColumn("ratio", usable)
        .withColumn("factor", F.coalesce(F.product("ratio").over(later), F.lit(1.0)))
        .withColumn("close_ok", sane_number(F.col("close")))
        .withColumn("as_traded", F.when(
            (F.col("close_ok") > 0) & (cand > 0) & (cand < NUMERIC_MAX), cand))
    )


def price_daily(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        F.col("ticker").alias("ticker_yahoo"), "date",
        *[sane_number(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "adj_close")],
        sane_long(F.col("volume")).alias("volume"),
    )


def stock_split(enriched: DataFrame) -> DataFrame:
    return enriched.where("ratio is not null").select(
        F.col("ticker").alias("ticker_yahoo"), F.col("date").alias("split_date"), "ratio"
    )


def _with_currency(df: DataFrame, currency: DataFrame | None) -> DataFrame:
    if currency is None:
        return df.withColumn("currency", F.lit(None).cast("string"))
    return df.join(currency.select(F.col("ticker").alias("ticker_yahoo"), "currency"),
                   "ticker_yahoo", "left")


def quarter_closes(enriched: DataFrame) -> DataFrame:
    """Last row of every calendar quarter, valid or not; no further shuffle."""
    return enriched.groupBy("ticker", quarter_label(F.col("date")).alias("quarter")).agg(
        F.max_by("close_ok", "date").alias("close_raw"),
        F.max_by(sane_number(F.col("adj_close")), "date").alias("close_adj"),
        F.max_by("as_traded", "date").alias("close_as_traded"),
        F.max("date").alias("price_date"),
    )


def _valid_close():
    return F.coalesce(
        F.col("close_as_traded").between(PRICE_FLOOR, PRICE_CEILING), F.lit(False)
    )


def price_quarterly(enriched: DataFrame, currency: DataFrame | None = None) -> DataFrame:
    """Quarter closes. An implausible last row clears the quarter; no earlier day steps in."""
    return _kept_quarters(quarter_closes(enriched), currency)


def _kept_quarters(closes: DataFrame, currency: DataFrame | None) -> DataFrame:
    kept = closes.where(_valid_close()).select(
        F.col("ticker").alias("ticker_yahoo"), "quarter", "close_raw", "close_adj",
        "close_as_traded", "price_date",
    )
    return _with_currency(kept, currency).select(
        "ticker_yahoo", "quarter", "close_raw", "close_adj", "close_as_traded", "currency",
        "price_date",
    )


#: Zero marks a day without a dividend.
_PAYING = "dividends is null or dividends <> 0"


def _with_keep(enriched: DataFrame) -> DataFrame:
    """All rows with ``as_paid`` and whether the dividend is one to ``keep``."""
    amount = finite(F.col("dividends"))
    as_paid = F.col("dividends") * F.col("factor")
    keep = (
        amount.isNotNull() & (F.col("dividends") > 0) & (as_paid > 0) & (as_paid <= DIVIDEND_MAX)
        & (F.col("as_traded").isNull() | (as_paid <= F.col("as_traded")))
        & (F.col("dividends") < NUMERIC_MAX)
    )
    return enriched.withColumn("as_paid", as_paid).withColumn("keep", F.coalesce(keep, F.lit(False)))


def dividend(enriched: DataFrame, currency: DataFrame | None = None) -> DataFrame:
    """Cash dividends, split-adjusted and as paid; capital gains are not among them."""
    kept = _with_keep(enriched.where(_PAYING)).where("keep").select(
        F.col("ticker").alias("ticker_yahoo"), F.col("date").alias("ex_date"),
        F.col("dividends").alias("amount"), F.col("as_paid").alias("amount_as_reported"),
        quarter_label(F.col("date")).alias("quarter"),
    )
    return _with_currency(kept, currency)


def fetch_status(enriched: DataFrame, universe: DataFrame) -> DataFrame:
    """``ticker, status, rows``: ok with rows, else empty, for the whole universe."""
    found = enriched.groupBy("ticker").agg(F.count("*").alias("rows"))
    return universe.join(found, "ticker", "left").select(
        "ticker", F.when(F.col("rows") > 0, "ok").otherwise("empty").alias("status"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
    )


def load_counters(enriched: DataFrame) -> DataFrame:
    """Rows and skips of one load. Everything is counted per ticker and quarter, which the
    windowed input is partitioned for, in one pass; the sums follow."""
    rows = _with_keep(enriched)
    by_quarter = rows.groupBy("ticker", quarter_label(F.col("date")).alias("quarter")).agg(
        F.count("*").alias("n"), F.count("ratio").alias("splits"), F.count_if("keep").alias("kept"),
        F.count_if(F.expr(_PAYING) & ~F.col("keep")).alias("skipped"),
        F.max_by("as_traded", "date").alias("close_as_traded"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_quarter.agg(
        total("n").alias("prices"), total("splits").alias("splits"), F.count_distinct("ticker").alias("tickers"),
        F.count_if(_valid_close()).alias("quarters"), F.count_if(~_valid_close()).alias("quarters_skipped"),
        total("kept").alias("dividends"), total("skipped").alias("dividends_skipped"),
        F.count_distinct(F.when(F.col("kept") > 0, F.col("ticker"))).alias("dividend_tickers"),
    )


def observed_daily(enriched: DataFrame, counts: Observation) -> DataFrame:
    """Daily rows with ``as_paid`` and ``keep``, counted on their way to wherever they are written.
    Tickers are counted at their last day, which the split factors' window has at hand."""
    down = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    rows = _with_keep(enriched).withColumns({
        "_day": F.row_number().over(down),
        "_kept": F.count_if("keep").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    return rows.observe(
        counts, F.count(F.lit(1)).alias("prices"), F.count("ratio").alias("splits"),
        F.count_if(F.col("_day") == 1).alias("tickers"), F.count_if("keep").alias("dividends"),
        F.count_if(F.expr(_PAYING) & ~F.col("keep")).alias("dividends_skipped"),
        F.count_if(F.col("keep") & (F.col("_kept") == 1)).alias("dividend_tickers")).drop("_day", "_kept")


def observed_quarters(enriched: DataFrame, counts: Observation, currency: DataFrame | None = None) -> DataFrame:
    """``price_quarterly``, counting the quarters it keeps and clears."""
    closes = quarter_closes(enriched).observe(
        counts, F.count_if(_valid_close()).alias("quarters"), F.count_if(~_valid_close()).alias("quarters_skipped"))
    return _kept_quarters(closes, currency)
