"""Data-quality checks. Each is a frame of one row per violation or a one-row summary."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import (
    DIVIDEND_MAX, EPS_ABS_MAX, NUMERIC_MAX, PRICE_FLOOR, QUARTER_LABEL_PATTERN, SHARES_MAX,
    TIER3_DAYS_AROUND, VIEW_COLUMNS, VIEW_TYPES,
)
from quarterline.functions.cleaning import finite
from quarterline.functions.quarters import quarter_end, quarter_label
from quarterline.operators.asof import asof_backward
from quarterline.operators.quality import company_ticker, corrupt_jumps, corrupt_tickers, shares_with_price_date
from quarterline.operators.splits import with_factor_after

TICKER = "`ticker symbol`"


def anchors(actual: DataFrame, expected: DataFrame, keys: list[str], value: str,
            tolerance: float = 1e-6) -> DataFrame:
    """Expected values that are missing or differ."""
    want = expected.select(*keys, F.col(value).cast("double").alias("expected"))
    got = actual.select(*keys, F.col(value).cast("double").alias("actual"))
    return want.join(got, keys, "left").where(
        F.col("actual").isNull() | (F.abs(F.col("actual") - F.col("expected")) > tolerance))


def unlike(actual: DataFrame, expected: DataFrame, keys: list[str], value: str, relative: float = 1e-9) -> DataFrame:
    """Rows whose value is not the expected one, or that nothing is expected for."""
    got = actual.select(*keys, F.col(value).cast("double").alias("actual"))
    want = expected.select(*keys, F.col(value).cast("double").alias("expected"))
    return got.join(want, keys, "left").where(F.col("actual").isNotNull() & (
        F.col("expected").isNull() | (F.abs(F.col("actual") - F.col("expected")) > relative * F.abs("expected"))))


def fourth_quarters(quarters: DataFrame, years: DataFrame) -> DataFrame:
    """``cik, year, amount`` of fourth quarters: the year's amount less that of three quarters
    (``cik, year, q, amount``), where all are there; a fourth quarter that was filed itself counts
    as it is."""
    of = lambda q: F.max(F.when(F.col("q") == q, F.col("amount")))
    by_year = quarters.groupBy("cik", "year").agg(
        F.count_if(F.col("q") < 4).alias("n"), F.sum(F.when(F.col("q") < 4, F.col("amount"))).alias("three"), of(4).alias("filed"))
    rest = by_year.join(years.select("cik", "year", F.col("amount").alias("whole")), ["cik", "year"], "left")
    left = F.when(F.col("n") == 3, F.col("whole") - F.col("three"))
    return rest.select("cik", "year", F.coalesce("filed", left).alias("amount")).where("amount is not null")


def forward_basis(raw: DataFrame) -> DataFrame:
    """Each day's close and dividend on that day's own basis, by the chain of splits read forwards
    from the raw rows: what all splits make together, over what those up to the day make.

    ``raw`` has ``ticker, date, pos, close, dividends, stock_splits``; the last row of a day counts,
    and days without a close do not."""
    last = raw.groupBy("ticker", "date").agg(F.max_by(F.struct("close", "dividends", "stock_splits"), "pos").alias("r")).select(
        "ticker", "date", "r.*").where(finite(F.col("close")).isNotNull())
    ratio = F.when((F.col("stock_splits") > 0) & (F.col("stock_splits") < NUMERIC_MAX), F.col("stock_splits")).otherwise(1.0)
    chain = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = last.withColumn("so_far", F.exp(F.sum(F.log(ratio)).over(chain)))
    factor = F.last("so_far").over(whole) / F.col("so_far")
    return so_far.withColumn("factor", factor).select(
        F.col("ticker").alias("ticker_yahoo"), "date", (F.col("close") * F.col("factor")).alias("traded"), (F.col("dividends") * F.col("factor")).alias("paid"))


def basis_mismatches(prices: DataFrame, dividends: DataFrame, raw: DataFrame) -> DataFrame:
    """Stored as-traded closes and as-paid dividends that the forward chain does not give:
    ``kind, ticker_yahoo, date, actual, expected``."""
    basis = forward_basis(raw)
    closes = unlike(prices.withColumnRenamed("price_date", "date"), basis.withColumnRenamed("traded", "close_as_traded"),
                    ["ticker_yahoo", "date"], "close_as_traded")
    paid = unlike(dividends.withColumnRenamed("ex_date", "date"), basis.withColumnRenamed("paid", "amount_as_reported"),
                  ["ticker_yahoo", "date"], "amount_as_reported")
    return closes.select(F.lit("close").alias("kind"), "*").unionByName(paid.select(F.lit("dividend").alias("kind"), "*"))


def market_caps(view_rows: DataFrame, shares: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """Price times count where a split lies between the two: the count as filed, on the price's
    basis, and the market value in billions."""
    moved = shares.where("shares_at_price_basis <> shares").join(company_ticker(ticker_map), "cik")
    return moved.join(view_rows.select(F.col("ticker").alias("ticker_yahoo"), "quarter", "price"), ["ticker_yahoo", "quarter"]).where(
        "price is not null").select("ticker_yahoo", "quarter", "price", "shares", "shares_at_price_basis",
                                    F.round(F.col("price") * F.col("shares_at_price_basis") / 1e9, 4).alias("market_cap_b"))


def stale_rows(stored: DataFrame, purged_keys: DataFrame) -> DataFrame:
    """Two counts of rows that a purge should have taken from the stored quarter closes: those of
    a list of keys that the load kept, and those of tickers that the jump rule finds among the
    stored rows themselves. Neither asks the purge what it has done."""
    listed = stored.join(purged_keys.select("ticker_yahoo", "quarter").distinct(), ["ticker_yahoo", "quarter"], "left_semi")
    jumping = stored.join(corrupt_tickers(stored), "ticker_yahoo", "left_semi")
    return listed.agg(F.count("*").alias("n")).join(F.broadcast(jumping.agg(F.count("*").alias("jumping"))))


def unnormalised_straddles(shares: DataFrame, ticker_map: DataFrame, price_quarterly: DataFrame,
                           splits: DataFrame) -> DataFrame:
    """Counts left as reported although a split lies between count and price date."""
    rows = shares_with_price_date(shares, ticker_map, price_quarterly).where(
        "price_date is not null and shares_at_price_basis = shares")
    lo, hi = F.least("as_of", "price_date"), F.greatest("as_of", "price_date")
    s = splits.select("ticker_yahoo", "split_date")
    on = (
        (rows["ticker_yahoo"] == s["ticker_yahoo"]) & (s["split_date"] > lo) & (s["split_date"] <= hi)
    )
    return rows.join(s, on, "left_semi").select(
        "cik", "quarter", "ticker_yahoo", "as_of", "price_date", "shares")


def missing_basis(shares: DataFrame) -> DataFrame:
    return shares.where("shares_at_price_basis is null")


def concept_coverage(eps: DataFrame) -> DataFrame:
    return eps.groupBy("concept").agg(F.count("*").alias("n"))


def implausible_eps(eps: DataFrame) -> DataFrame:
    return eps.where(F.abs("eps") > EPS_ABS_MAX)


def malformed_quarters(table: DataFrame) -> DataFrame:
    return table.where(~F.col("quarter").rlike(QUARTER_LABEL_PATTERN)).groupBy("quarter").agg(
        F.count("*").alias("n"))


def shares_out_of_window(shares: DataFrame) -> DataFrame:
    gap = F.abs(F.datediff("as_of", quarter_end(F.col("quarter"))))
    return shares.where(gap > TIER3_DAYS_AROUND)


def implausible_shares(shares: DataFrame) -> DataFrame:
    return shares.where((F.col("shares") <= 0) | (F.col("shares") > SHARES_MAX))


def view_contract(view: DataFrame) -> DataFrame:
    """The view's columns against those agreed on, as rows: position, names and types of both, how
    many values the column has and whether it is as agreed. A column too many or too few is a row
    as well."""
    spark = view.sparkSession
    schema = "position int, name string, type string"
    has = spark.createDataFrame([(k, f.name, f.dataType.simpleString()) for k, f in enumerate(view.schema.fields, 1)], schema)
    wanted = spark.createDataFrame([(k, *c) for k, c in enumerate(zip(VIEW_COLUMNS, VIEW_TYPES), 1)],
                                   "position int, wanted_name string, wanted_type string")
    counted = view.agg(*[F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(view.columns, 1)]).select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("position"), F.col(str(k)).alias("n_values")) for k in range(1, len(view.columns) + 1)])))
    return has.join(wanted, "position", "full").join(counted, "position", "left").withColumn(
        "ok", F.col("name").eqNullSafe(F.col("wanted_name")) & F.col("type").eqNullSafe(F.col("wanted_type")))


def duplicates(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def coverage_summary(eps: DataFrame, shares: DataFrame, price_daily: DataFrame,
                     dividend: DataFrame, price_quarterly: DataFrame) -> DataFrame:
    """Rows and distinct keys of the main tables in one row, from one row of each table."""
    basic = F.col("concept").contains("Basic")
    parts = [
        eps.agg(F.count("*").alias("eps_rows"), F.count_if("is_derived").alias("eps_derived_rows"),
                F.count_if(basic).alias("eps_basic_rows"), F.count_distinct("cik").alias("eps_ciks")),
        shares.agg(F.count("*").alias("shares_rows"), F.count_distinct("cik").alias("shares_ciks")),
        price_daily.agg(F.count_distinct("ticker_yahoo").alias("price_tickers")),
        dividend.agg(F.count_distinct("ticker_yahoo").alias("dividend_tickers")),
        price_quarterly.agg(F.count_distinct("ticker_yahoo").alias("price_quarter_tickers")),
    ]
    out = parts[0]
    for one_row in parts[1:]:
        out = out.join(F.broadcast(one_row))
    return out


def empty_view_rows(view: DataFrame) -> DataFrame:
    return view.where(
        F.col("price").isNull() & F.col("`shares outstanding`").isNull()
        & F.col("EPS").isNull() & F.col("Dividends").isNull())


def dividend_bounds(dividend: DataFrame) -> DataFrame:
    paid = F.col("amount_as_reported")
    return dividend.agg(F.count_if(paid > DIVIDEND_MAX).alias("over_max"),
                        F.max(paid).alias("max_amount_as_reported"))


def price_bounds(price_quarterly: DataFrame) -> DataFrame:
    at = F.col("close_as_traded")
    return price_quarterly.agg(
        F.count_if(at.isNull() | (at <= 0)).alias("invalid"),
        F.count_if(at < PRICE_FLOOR).alias("below_floor"),
        F.count_if(at > 1e6).alias("over_1e6"), F.min(at).alias("min_at"), F.max(at).alias("max_at"),
    )


def future_quarters(view: DataFrame, as_of: dt.date) -> DataFrame:
    return view.where(F.col("quarter") > quarter_label(F.lit(as_of)))


def class_coverage(view: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """View rows per ticker of companies with more than one ticker."""
    pairs = ticker_map.select("cik", F.col("ticker_yahoo").alias("ticker symbol")).distinct()
    many = pairs.groupBy("cik").agg(F.count("*").alias("classes")).where("classes > 1")
    rows = view.groupBy(TICKER).agg(F.count("*").alias("n"))
    return pairs.join(many, "cik").join(rows, "ticker symbol", "left").select(
        "cik", TICKER, "classes", F.coalesce("n", F.lit(0)).alias("n"))


def glitch_dividends(dividend: DataFrame, price_daily: DataFrame, splits: DataFrame) -> DataFrame:
    """Dividends above the bound or above the as-traded close on or before their date."""
    closes = price_daily.where((F.col("close") > 0) & (F.col("close") < NUMERIC_MAX)).select(
        "ticker_yahoo", "date", "close")
    closes = with_factor_after(closes, splits, "ticker_yahoo", {"f": "date"}).select(
        "ticker_yahoo", "date", (F.col("close") * F.col("f")).alias("at_close"))
    rows = asof_backward(dividend, closes, "ticker_yahoo", "ex_date", "date", "at_close")
    paid = F.col("amount_as_reported")
    return rows.where((paid > DIVIDEND_MAX) | (paid > F.round("at_close", 10)))


def event_buckets(dividend: DataFrame, buckets: list[tuple[str, str, str, str]]) -> DataFrame:
    """Dividend events per named (bucket, ticker, from, to), both days included."""
    hit = F.array_compact(F.array(*[
        F.when((F.col("ticker_yahoo") == t) & F.col("ex_date").between(F.lit(a).cast("date"),
                                                                      F.lit(b).cast("date")), name)
        for name, t, a, b in buckets
    ]))
    found = dividend.select(F.explode(hit).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    names = dividend.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(b[0]) for b in buckets])).alias("bucket"))
    return names.join(found, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def both_bases(dividend: DataFrame) -> DataFrame:
    """Events whose split-adjusted and as-paid amounts differ."""
    return dividend.where("amount <> amount_as_reported").select(
        "ticker_yahoo", "ex_date", "amount", "amount_as_reported")


def coverage_percent(view: DataFrame) -> DataFrame:
    n = F.count("*")
    return view.agg(
        n.alias("view_rows"), F.count("price").alias("price_not_null"),
        F.round(F.count("price") * 100.0 / n, 2).alias("price_pct_not_null"),
        F.count("`shares outstanding`").alias("shares_not_null"),
        F.count("Dividends").alias("dividends_not_null"),
    )


def dividend_mismatches(view_rows: DataFrame, dividend: DataFrame) -> DataFrame:
    """View dividends that are not the sum of the events. A ticker of two companies shows its
    dividends in both rows."""
    seen = view_rows.groupBy("ticker", "quarter").agg(F.max("dividends").alias("in_view"))
    paid = dividend.groupBy(F.col("ticker_yahoo").alias("ticker"), "quarter").agg(
        F.sum(F.coalesce("amount_as_reported", "amount")).alias("paid"))
    return seen.where("in_view is not null").join(paid, ["ticker", "quarter"], "full").where(
        F.col("in_view").isNull() | F.col("paid").isNull()
        | (F.abs(F.col("in_view") - F.col("paid")) > 1e-9))


def violation_report(eps: DataFrame, shares: DataFrame, price_quarterly: DataFrame,
                     dividend: DataFrame, view: DataFrame, as_of: dt.date) -> DataFrame:
    """``check, violations`` for the invariants that need no named company; one pass a table."""
    bad_label = F.count_distinct(F.when(~F.col("quarter").rlike(QUARTER_LABEL_PATTERN), F.col("quarter")))
    of_eps = eps.agg(F.count_if(F.abs("eps") > EPS_ABS_MAX).alias("eps_over_max"),
                     bad_label.alias("eps_malformed_quarter"))
    gap = F.abs(F.datediff("as_of", quarter_end(F.col("quarter"))))
    of_shares = shares.agg(
        bad_label.alias("shares_malformed_quarter"), F.count_if(gap > TIER3_DAYS_AROUND).alias("shares_out_of_window"),
        F.count_if((F.col("shares") <= 0) | (F.col("shares") > SHARES_MAX)).alias("shares_implausible"),
        F.count_if(F.col("shares_at_price_basis").isNull()).alias("shares_missing_basis"))
    nothing = (F.col("price").isNull() & F.col("`shares outstanding`").isNull()
               & F.col("EPS").isNull() & F.col("Dividends").isNull())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    of_view = view.groupBy("quarter", TICKER).agg(F.count("*").alias("n"), F.count_if(nothing).alias("empty")).agg(
        F.count_if(F.col("n") > 1).alias("view_duplicates"), total("empty").alias("view_empty_rows"),
        total(F.when(F.col("quarter") > quarter_label(F.lit(as_of)), F.col("n"))).alias("view_future_quarters"))
    of_dividends = duplicates(dividend, "ticker_yahoo", "ex_date").agg(F.count("*").alias("dividend_duplicates"))
    of_prices = corrupt_jumps(price_quarterly).agg(F.count("*").alias("price_corrupt_jumps"))
    out = None
    for one_row in (of_eps, of_shares, of_view, of_dividends, of_prices):
        listed = F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations"))
                                    for c in one_row.columns]))
        part = one_row.select(listed)
        out = part if out is None else out.unionByName(part)
    return out
