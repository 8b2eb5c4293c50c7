"""The registered queries: every operator over the whole given tables.

``q(name)`` registers the Spark side; ``oracle/finals.py`` holds the SQL under the same name.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline import fixtures as fx
from quarterline.functions import cleaning, quarters as Q
from quarterline.operators import earnings, facts, market, quality, risk, screen, shares, splits, universe
from quarterline.operators.returns import ticker_returns
from quarterline.params import ScreenParams
from quarterline.plans import backtest as bt
from quarterline.plans import fundamentals as fn
from quarterline.plans import load
from quarterline.plans import panel as pn
from quarterline.plans import validation as dq
from quarterline.plans.domain import Domain
from quarterline.plans.lineage import new_path
from quarterline.sources import filings, reference_lists, tables as tb
from quarterline.sources.ledger import Ledger
from quarterline.sources.market_history import read_history
from quarterline.sources.versions import TableSet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCREEN = ScreenParams.screen(pe_max=60.0, vol_max=45.0)
ANNUAL = ScreenParams.screen(pe_max=60.0, vol_max=45.0, freq="annual")
SEMIANNUAL = ScreenParams.screen(pe_max=60.0, vol_max=45.0, freq="semiannual")
WRITEOFF = ScreenParams.screen(pe_max=60.0, vol_max=45.0, delist_mode="writeoff")
DEFAULT = ScreenParams.backtest()
LIMITS = ScreenParams.backtest(pe_max=60.0, mcap_min_b=0.2, mcap_max_b=6.0, min_div_yield=0.0005, min_ret_12m=-0.5)


def q(name: str):
    def register(f: Callable[[Domain], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Domain.of(spark, sf_dir))
        return f
    return register


def _r(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round for comparison. Scaling first leaves a rounding to whole numbers, which engines
    agree on; rounding a double to n digits they do not define alike."""
    scale = 10.0 ** digits
    return df.withColumns({c: F.round(F.col(c) * scale, 0) / scale for c in cols})


# --- scalar functions ----------------------------------------------------------------

@q("quarter_labels")
def _(d):
    day = F.col("l_shipdate").cast("date")
    return fx.table(d.spark, d.sf_dir, "lineitem").groupBy(
        Q.quarter_label(day).alias("quarter")
    ).agg(F.count("*").alias("n")).select("quarter", Q.quarter_end(F.col("quarter")).alias("quarter_end"), "n")


@q("snap_quarters")
def _(d):
    day = F.col("o_orderdate").cast("date")
    return fx.table(d.spark, d.sf_dir, "orders").groupBy(
        Q.quarter_label(day).alias("calendar_quarter"), Q.snap_quarter(day).alias("filing_quarter")
    ).agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@q("qidx_roundtrip")
def _(d):
    i = Q.qidx(F.col("label"))
    return fx.table(d.spark, d.sf_dir, "lineitem").groupBy(
        Q.quarter_label(F.col("l_shipdate").cast("date")).alias("label")
    ).agg(F.count("*").alias("n")).select(
        "label", i.cast("long").alias("qidx"), Q.quarter_from_idx(i).alias("back"),
        Q.quarter_end_from_idx(i).alias("end_date"), "n")


@q("clean_numbers")
def _(d):
    h = d.history
    return h.groupBy("ticker").agg(
        F.count(cleaning.sane_long(F.col("volume"))).alias("volumes"),
        F.sum(cleaning.sane_long(F.col("volume"))).alias("volume"),
        F.count(cleaning.sane_number(F.col("stock_splits"))).alias("split_cells"),
        F.count(cleaning.finite(F.col("dividends"))).alias("dividend_cells"),
    )


# --- reference lists -------------------------------------------------------------------

@q("ticker_norm_dedup")
def _(d):
    return d.loaded_ticker_map


@q("company_first_name")
def _(d):
    return d.company


@q("universe_minus_excluded")
def _(d):
    return universe.universe(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir))


@q("excluded_found")
def _(d):
    return universe.excluded_found(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir))


@q("ticker_map_files")
def _(d):
    """The map's rows out of JSON documents of both layouts; a number that is none drops its row."""
    folder = new_path(d.spark, "ticker_map")
    fx.ticker_files(d.spark, d.sf_dir, folder)
    return reference_lists.read_ticker_map(d.spark, folder).select("cik", "name", "ticker", "exchange")


@q("exclusion_file")
def _(d):
    folder = new_path(d.spark, "exclusions")
    fx.exclusion_file(d.spark, d.sf_dir, folder)
    return universe.excluded_found(fx.ticker_source(d.spark, d.sf_dir), reference_lists.read_exclusions(d.spark, folder))


# --- filings -----------------------------------------------------------------------------

@q("facts_registry_filter")
def _(d):
    both = fx.eps_source(d.spark, d.sf_dir).unionByName(fx.shares_source(d.spark, d.sf_dir))
    parsed = facts.parse_facts(facts.registry_filter(both), fx.AS_OF)
    return parsed.groupBy("kind", "concept", "unit", "is_instant").agg(
        F.count("*").alias("facts"), F.count_if(~F.col("in_range")).alias("skipped"),
        F.min("period_end").alias("first_end"), F.sum(F.col("duration_days").cast("long")).alias("days"))


@q("facts_dedup_earliest")
def _(d):
    return d.eps_facts.select(
        "cik", "concept", "period_start", "period_end", "duration_days", "is_instant", "value", "accn", "form", "filed")


@q("public_float_facts")
def _(d):
    return facts.fact_tables(d.float_facts)["public_float_facts"].select(
        "cik", "concept", "period_end", F.col("value").cast("long").alias("value"), "accn", "form", "filed")


@q("filing_documents_exploded")
def _(d):
    """Facts out of nested documents, the earliest filed of each period."""
    parsed = facts.parse_facts(filings.explode_facts(fx.documents(d.spark, d.sf_dir)), fx.AS_OF)
    return facts.earliest_filed(parsed).select("cik", "kind", "concept", "period_start", "period_end", "value", "accn", "filed")


@q("filings_round_trip")
def _(d):
    """The same facts out of files: nested documents written and read back, some of them broken,
    some without their company's number."""
    folder = new_path(d.spark, "filings")
    filings.write_documents(fx.filing_texts(d.spark, d.sf_dir), folder)
    parsed = facts.parse_facts(filings.explode_facts(filings.read_documents(d.spark, folder)), fx.AS_OF)
    return facts.earliest_filed(parsed).select("cik", "kind", "concept", "period_start", "period_end", "value", "accn", "filed")


@q("filings_subset")
def _(d):
    """Files, errors and companies of every third number, many of which have no file."""
    folder = new_path(d.spark, "filings")
    filings.write_documents(fx.filing_texts(d.spark, d.sf_dir), folder)
    asked = range(0, 2 * fx.table(d.spark, d.sf_dir, "supplier").count(), 3)
    return filings.load_counts(filings.read_documents(d.spark, folder, list(asked)))


@q("eps_concept_preference")
def _(d):
    reported = earnings.prefer_diluted(earnings.eps_candidates(d.eps_facts)).where("not is_derived")
    return reported.select("cik", "quarter", "period_start", "period_end", "concept", "eps")


@q("eps_q4_derived")
def _(d):
    rows = earnings.eps_candidates(d.eps_facts).where("is_derived").select(
        "cik", "concept", "quarter", "period_start", "period_end", "eps", "filed", "accn")
    return _r(rows, 6, "eps")


@q("eps_quarterly")
def _(d):
    return _r(d.eps_quarterly, 6, "eps")


@q("eps_collisions")
def _(d):
    rows = earnings.eps_collisions(d.eps_facts).select(
        "cik", "quarter", "n_candidates", "chosen_concept", "chosen_is_derived", "chosen_period_end",
        "chosen_filed", "chosen_accn", "chosen_eps", "all_candidates")
    return _r(rows, 6, "chosen_eps")


@q("eps_load_counts")
def _(d):
    return earnings.eps_load_counts(d.eps_facts)


@q("shares_spine")
def _(d):
    return shares.shares_spine(d.eps_quarterly, d.shares_facts)


@q("shares_quarterly")
def _(d):
    return shares.shares_quarterly(d.eps_quarterly, d.shares_facts)


# --- market --------------------------------------------------------------------------------

@q("daily_last_row")
def _(d):
    return market.price_daily(d.enriched)


def _from_files(d, fmt):
    folder = new_path(d.spark, "history_files")
    fx.history_files(d.spark, d.sf_dir, folder, fmt)
    return market.daily_rows(read_history(d.spark, folder, fmt)).select("ticker", "date", "close", F.col("volume").cast("long").alias("volume"))


@q("history_csv_days")
def _(d):
    """Days of a CSV history whose times carry offsets, the last row of the file for each."""
    return _from_files(d, "csv")


@q("history_parquet_days")
def _(d):
    """The same out of instants with the exchange's zone."""
    return _from_files(d, "parquet")


@q("stock_splits")
def _(d):
    return market.stock_split(d.enriched)


@q("split_factor_after")
def _(d):
    s = splits.clean_splits(fx.order_splits(d.spark, d.sf_dir))
    days = fx.table(d.spark, d.sf_dir, "orders").groupBy(
        F.expr("concat('S', o_custkey, '-A')").alias("ticker"), F.col("o_orderdate").cast("date").alias("day")
    ).agg(F.count("*").alias("n"))
    return splits.with_factor_after(days, s, "ticker", {"factor": "day"})


@q("split_factor_between")
def _(d):
    s = splits.clean_splits(fx.order_splits(d.spark, d.sf_dir))
    rows = fx.table(d.spark, d.sf_dir, "orders").selectExpr(
        "concat('S', o_custkey, '-A') as ticker", "o_orderkey", "cast(o_orderdate as date) as lo",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 400 as int)) as hi")
    return splits.with_factor_between(rows, s, "ticker", "lo", "hi")


@q("price_as_traded")
def _(d):
    return d.enriched.select("ticker", "date", "close", "factor", "as_traded")


@q("price_quarterly")
def _(d):
    return market.price_quarterly(d.enriched, d.currency)


@q("dividends_as_paid")
def _(d):
    return market.dividend(d.enriched, d.currency)


@q("fetch_status")
def _(d):
    u = universe.universe(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir))
    return market.fetch_status(market.daily_rows(d.history, d.tasks), u)


@q("market_load_counters")
def _(d):
    return market.load_counters(d.enriched)


@q("load_observed_counts")
def _(d):
    """Counters of three loads, taken from the writes themselves."""
    raw = fx.eps_source(d.spark, d.sf_dir).unionByName(fx.shares_source(d.spark, d.sf_dir))
    eps = load.load_eps(d.eps_facts)
    counts = {**load.load_market(d.history, tasks=d.tasks).counts, **load.load_facts(raw, fx.AS_OF).counts, **eps.counts}
    return d.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


# --- repairs ----------------------------------------------------------------------------------

@q("corrupt_tickers")
def _(d):
    return quality.corrupt_tickers(quality.drop_tiny_prices(market.price_quarterly(d.enriched)))


@q("prices_purged")
def _(d):
    return d.price_quarterly.select("ticker_yahoo", "quarter", "close_raw", "price_date")


@q("shares_price_basis")
def _(d):
    return d.shares_quarterly.select(
        "cik", "quarter", "shares", "as_of", "shares_at_price_basis", "fallback")


@q("shares_normalisation_counts")
def _(d):
    return quality.normalisation_counts(d.shares_quarterly)


# --- view ----------------------------------------------------------------------------------------

@q("quarterly_fundamentals")
def _(d):
    return _r(d.view, 8, "EPS", "Dividends")


@q("fundamentals_named")
def _(d):
    return fn.named_rows(d.view, d.ticker_map, d.stored_company)


@q("ticker_series")
def _(d):
    return _r(fn.ticker_series(d.view, "S1-A"), 8, "EPS", "Dividends")


@q("latest_quarters")
def _(d):
    return _r(fn.latest_quarters(d.view_rows, "S2-A"), 8, "EPS", "Dividends")


@q("top_dividend_payers")
def _(d):
    return _r(fn.top_dividend_payers(d.view, "1998Q4"), 8, "Dividends")


@q("valuation_ratios")
def _(d):
    rows = fn.valuation_ratios(d.view)
    return _r(rows, 8, "EPS", "Dividends")


@q("column_coverage")
def _(d):
    return fn.column_coverage(d.view)


@q("status_counts")
def _(d):
    return fn.status_counts(tb.ledger_latest(
        fx.fetch_log(d.spark, d.sf_dir, 1), fx.fetch_log(d.spark, d.sf_dir, 2)))


@q("latest_dividends")
def _(d):
    return fn.latest_dividends(market.dividend(d.enriched, d.currency), "S2-A")


# --- risk and panel ----------------------------------------------------------------------------------

def _risk_rounded(df):
    return _r(df, 8, "vol_252d", "ret_252d", "off_high_252d")


@q("stock_risk_quarter")
def _(d):
    return _risk_rounded(risk.stock_risk_quarter(market.price_daily(d.enriched)))


@q("raw_panel")
def _(d):
    return _r(_risk_rounded(d.raw_panel.drop("view_cik")), 8, "eps", "div_adj")


@q("dense_panel")
def _(d):
    return pn.dense_panel(d.raw_panel).select(
        "qidx", "quarter", "ticker", "px_adj", "price_date", "eps_is_derived", "cik", "name")


@q("eps_shares_present")
def _(d):
    rows = pn.with_present_basis(pn.dense_panel(d.raw_panel), d.stock_split).select(
        "ticker", "quarter", "eps_present", "shares_present")
    return _r(_r(rows, 9, "eps_present"), 4, "shares_present")


@q("value_panel")
def _(d):
    rows = _risk_rounded(d.stored_panel).withColumn("mktcap", F.col("mktcap") / 1e6)
    rows = _r(rows, 8, "eps", "div_adj", "eps_present", "ttm_eps", "eps4_min", "ttm_div", "div_yield")
    return _r(_r(_r(rows, 4, "shares_present", "shares_lag"), 10, "pe"), 8, "mktcap")


# --- screen and backtest -------------------------------------------------------------------------------

@q("screen_holdings")
def _(d):
    rows = screen.in_order(screen.select_holdings(d.stored_panel, SCREEN)).select(
        "quarter", "ticker", "weight", "pe")
    return _r(rows, 10, "weight", "pe")


@q("count_matching")
def _(d):
    return screen.matching_counts(d.stored_panel, SCREEN).select(
        Q.quarter_from_idx(F.col("qidx")).alias("quarter"), "matching")


def _returns(d, mode):
    s = bt.make_schedule(d.stored_panel, SCREEN)
    rows = ticker_returns(d.stored_panel, s.first, s.last, mode)
    return _r(rows.withColumn("qidx", F.col("qidx").cast("long")), 8, "r")


@q("ticker_returns_carry")
def _(d):
    return _returns(d, "carry")


@q("ticker_returns_writeoff")
def _(d):
    return _returns(d, "writeoff")


@q("panel_trimmed")
def _(d):
    """The stored panel as a run on a given day reads it: complete quarters only."""
    last = Q.last_complete_qidx(dt.date(1997, 6, 30))
    return pn.trim_partial(d.stored_panel, last).groupBy("quarter").agg(
        F.count("*").alias("n"), F.count("px_adj").alias("prices"), F.max("qidx").cast("long").alias("qidx"))


@q("backtest_series")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, SCREEN).series, 4, "portfolio", "benchmark")


@q("backtest_series_annual")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, ANNUAL).series, 4, "portfolio", "benchmark")


@q("backtest_series_semiannual")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, SEMIANNUAL).series, 4, "portfolio", "benchmark")


@q("backtest_series_writeoff")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, WRITEOFF).series, 4, "portfolio", "benchmark")


@q("backtest_series_default")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, DEFAULT).series, 4, "portfolio", "benchmark")


@q("backtest_series_limits")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, LIMITS).series, 4, "portfolio", "benchmark")


@q("backtest_holdings_default")
def _(d):
    rows = bt.run_backtest(d.stored_panel, DEFAULT).holdings
    return _r(rows.select("rebalance_quarter", "ticker", "weight", "mktcap_b"), 8, "weight", "mktcap_b")


@q("backtest_holdings")
def _(d):
    rows = bt.run_backtest(d.stored_panel, SCREEN).holdings
    return _r(_r(_r(rows, 8, "div_yield", "vol_252d", "ret_252d", "weight"), 10, "pe"), 11, "mktcap_b")


@q("backtest_comparison")
def _(d):
    return _r(bt.run_backtest(d.stored_panel, SCREEN).comparison, 8,
              "portfolio_return", "benchmark_return", "difference")


@q("backtest_stats")
def _(d):
    return _r(_r(bt.run_backtest(d.stored_panel, SCREEN).stats.select(
        "start_quarter", "end_quarter", "years", "portfolio_total_return", "benchmark_total_return", "n_rebalances", "avg_holdings", "min_holdings",
        "portfolio_final", "benchmark_final", "portfolio_cagr", "benchmark_cagr", "excess_cagr",
        "portfolio_max_dd", "benchmark_max_dd", "value_win_quarters", "benchmark_win_quarters",
        "tie_quarters", "comparison_quarters", "portfolio_mean_quarterly_return",
        "benchmark_mean_quarterly_return", "portfolio_median_quarterly_return",
        "benchmark_median_quarterly_return",
    ), 7, "years", "portfolio_total_return", "benchmark_total_return", "avg_holdings", "portfolio_cagr", "benchmark_cagr", "excess_cagr", "portfolio_max_dd",
        "benchmark_max_dd", "portfolio_mean_quarterly_return", "benchmark_mean_quarterly_return",
        "portfolio_median_quarterly_return", "benchmark_median_quarterly_return"),
        4, "portfolio_final", "benchmark_final")


@q("drawdown")
def _(d):
    return _r(bt.drawdowns(bt.run_backtest(d.stored_panel, SCREEN).series), 8,
              "portfolio_dd", "benchmark_dd")


@q("rebalance_history")
def _(d):
    return bt.rebalance_history(bt.run_backtest(d.stored_panel, SCREEN).holdings)


@q("latest_holdings")
def _(d):
    return bt.latest_holdings(bt.run_backtest(d.stored_panel, SCREEN).holdings).select(
        "rebalance_quarter", "ticker", "name", "weight_pct", "pe", "mktcap_b", "yield_pct", "vol_pct", "ret_pct")


@q("comparison_summary")
def _(d):
    return bt.comparison_summary(bt.run_backtest(d.stored_panel, SCREEN).stats)


@q("data_options")
def _(d):
    return bt.data_options(d.stored_panel, fx.AS_OF).select(
        "first_quarter", "last_quarter", F.array_join(F.col("start_years").cast("array<string>"), ",").alias("start_years"))


# --- load semantics ---------------------------------------------------------------------------------------

def _logs(d):
    return fx.fetch_log(d.spark, d.sf_dir, 1), fx.fetch_log(d.spark, d.sf_dir, 2)


@q("load_upsert_absent")
def _(d):
    stored, new = fx.filing_names(d.spark, d.sf_dir).where("cik >= 0 and cik % 3 = 0"), \
        fx.filing_names(d.spark, d.sf_dir)
    return tb.absent_rows(new, stored, ["cik"], ["pos"]).select("cik", "entity_name")


@q("load_resume_todo")
def _(d):
    u = universe.universe(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir))
    return tb.todo(u, tb.ledger_latest(*_logs(d)))


@q("load_replace")
def _(d):
    old, new = _logs(d)
    return tb.replaced_rows(old, new, new.select("ticker_yahoo")).select("ticker_yahoo", "status", "rows")


def _replacement(d):
    """The tables of a load, the rows that come anew, and the tickers they replace."""
    since = {"price_daily": "date >= '1996-01-01'", "dividend": "ex_date >= '1996-01-01'", "stock_split": "split_date >= '1996-01-01'",
             "price_quarterly": "quarter >= '1996Q1'", "yahoo_fetch_log": "true"}
    stored = {n: d.purged[n] for n in since}
    return stored, {n: stored[n].where(since[n]) for n in since}, _logs(d)[1].select("ticker_yahoo")


@q("load_replace_all")
def _(d):
    """Every third company's tickers loaded anew, from 1996 on, into the five tables of a load."""
    return dq.row_counts(tb.replaced_tables(*_replacement(d)))


@q("load_replace_committed")
def _(d):
    """The same replacement in a stored set of tables, by one commit."""
    stored, new, tickers = _replacement(d)
    tables = TableSet(d.spark, new_path(d.spark, "tables"), 16)
    tables.load(stored)
    tables.replace(new, tickers)
    return dq.row_counts(tables.read_all())


@q("load_replace_todo")
def _(d):
    u = universe.universe(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir))
    return tb.todo(u, tb.ledger_latest(*_logs(d)), _logs(d)[1])


@q("purged_tables")
def _(d):
    before = dq.row_counts(d.loaded).withColumnRenamed("n", "before")
    return before.join(dq.row_counts(d.purged).withColumnRenamed("n", "after"), "table_name")


@q("dq_stored_price_bounds")
def _(d):
    """The bounds on the stored quarter closes."""
    return dq.price_bounds(d.price_quarterly)


@q("dq_stored_corrupt_jumps")
def _(d):
    return quality.corrupt_jumps(d.price_quarterly).agg(F.count("*").alias("n"))


@q("dq_stored_dividend_bounds")
def _(d):
    return dq.dividend_bounds(d.dividend)


@q("load_ledger_latest")
def _(d):
    return tb.ledger_latest(*_logs(d)).select("ticker_yahoo", "status", "rows", "error")


def _folded(d):
    """The attempts come in four parts, which two folds take into snapshots."""
    ledger = Ledger(d.spark, new_path(d.spark, "ledger"), fold_after=2)
    first, second = _logs(d)
    for part in (*(first.where(f"pmod(xxhash64(ticker_yahoo), 3) = {k}") for k in range(3)), second):
        ledger.append(part)
    return ledger


@q("load_ledger_folded")
def _(d):
    return _folded(d).latest().select("ticker_yahoo", "status", "rows", "error")


@q("load_todo_folded")
def _(d):
    return _folded(d).todo(universe.universe(fx.ticker_source(d.spark, d.sf_dir), fx.exclusions(d.spark, d.sf_dir)))


def _catalog(d):
    """Daily prices and splits as bucketed tables: refreshed, appended to, and filled up with rows of
    which many are there already."""
    names = [f"quarterline_{n}_{uuid.uuid4().hex}" for n in ("price_daily", "stock_split")]
    prices, splits = market.price_daily(d.enriched), market.stock_split(d.enriched)
    by_date, by_split = tb.Buckets(8, "ticker_yahoo", ("ticker_yahoo", "date")), tb.Buckets(8, "ticker_yahoo", ("ticker_yahoo", "split_date"))
    tb.full_refresh(prices.where("date < '1995-01-01'"), names[0], layout=by_date, path=new_path(d.spark, names[0]))
    tb.bulk_append(prices.where("date >= '1995-01-01' and date < '1997-01-01'"), names[0], layout=by_date)
    tb.insert_absent(prices.where("date >= '1996-01-01'"), names[0], ["ticker_yahoo", "date"], ["close"], by_date)
    tb.full_refresh(splits, names[1], layout=by_split, path=new_path(d.spark, names[1]))
    return d.spark.table(names[0]), d.spark.table(names[1])


@q("catalog_prices")
def _(d):
    prices, _ = _catalog(d)
    return prices.groupBy("ticker_yahoo").agg(
        F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.sum("volume").alias("volume"))


@q("catalog_days_after_split")
def _(d):
    """Days that follow each split; both tables are read as they lie in their buckets."""
    prices, splits = _catalog(d)
    after = prices.join(splits.hint("merge"), "ticker_yahoo").where("date > split_date")
    return after.groupBy("ticker_yahoo", "split_date", "ratio").agg(F.count("*").alias("n"), F.max("close").alias("top_close"))


@q("export_round_trip")
def _(d):
    """The vendor's rows as JSON lines, with values that JSON does not have, read by their schema."""
    path = new_path(d.spark, "export")
    rows = d.history.selectExpr("ticker", "ts as day", "pos", "if(close = 0, double('-Infinity'), close) as close", "volume", "dividends", "stock_splits")
    return tb.read_json(d.spark, path, tb.export_json(rows, path))


@q("export_series")
def _(d):
    path = new_path(d.spark, "export")
    return tb.read_json(d.spark, path, tb.export_json(QUERIES["backtest_series"](d.spark, d.sf_dir), path))


@q("load_failures")
def _(d):
    return tb.failures(tb.ledger_latest(*_logs(d)))


# --- data quality ---------------------------------------------------------------------------------------------

@q("dq_eps_anchors")
def _(d):
    """Every diluted quarter's figure worked out from the order lines, without facts, filing
    dates or slots: where the stored figure is missing or another."""
    lines = fx.observations(d.spark, d.sf_dir).where("l_linenumber % 2 = 1").groupBy(
        F.col("l_suppkey").alias("cik"), Q.quarter_label(F.col("d")).alias("quarter")).agg(
        F.expr("(sum(cents) div (sum(qty) * 1000) - 195) / 100D").alias("eps"))
    return dq.anchors(d.stored_eps, lines.where("quarter not like '%Q4'"), ["cik", "quarter"], "eps").select("cik", "quarter")


@q("dq_share_anchors")
def _(d):
    """Cover-page counts on their quarter's end worked out from the order lines."""
    lines = fx.observations(d.spark, d.sf_dir).groupBy(
        F.col("l_suppkey").alias("cik"), Q.quarter_label(F.col("d")).alias("quarter")).agg(
        F.expr("(l_suppkey % 50 + 1) * 1000000 + sum(qty)").alias("shares"))
    want = lines.where("cik % 3 <> 2 and cik % 9 <> 0")
    return dq.anchors(d.reported_shares, want, ["cik", "quarter"], "shares").groupBy("cik").agg(F.count("*").alias("n"))


@q("dq_benchmark_anchors")
def _(d):
    """The benchmark's quarter closes and dividends worked out from the order lines."""
    by_day = fx.observations(d.spark, d.sf_dir).groupBy("d").agg(F.expr(
        "cast(sum(cents) div (sum(qty) * 100) + 2000 as double) / 100D").alias("close"))
    want = by_day.groupBy(F.lit("SPY").alias("ticker_yahoo"), Q.quarter_label(F.col("d")).alias("quarter")).agg(
        F.max_by("close", "d").alias("close_raw"))
    paid = by_day.where("month(d) % 3 = 0 and day(d) = 15").select(
        F.lit("SPY").alias("ticker_yahoo"), F.col("d").alias("ex_date"), F.lit(0.5).alias("amount"))
    missed = dq.anchors(d.price_quarterly, want, ["ticker_yahoo", "quarter"], "close_raw").agg(F.count("*").alias("closes"))
    return missed.join(dq.anchors(d.dividend, paid, ["ticker_yahoo", "ex_date"], "amount").agg(F.count("*").alias("dividends")))


@q("dq_q4_anchors")
def _(d):
    """Fourth quarters worked out from the order lines: the year's amount less three quarters, or
    the one a company files itself. Companies whose annual figure is of no annual form have none."""
    cents = fx.observations(d.spark, d.sf_dir).where("l_linenumber % 2 = 1").groupBy(
        F.col("l_suppkey").alias("cik"), F.year("d").alias("year"), F.quarter("d").alias("q")).agg(
        F.expr("sum(cents) div (sum(qty) * 1000) - 195").alias("v"))
    quarters = cents.where("q < 4 or (cik + year) % 3 = 0").select("cik", "year", "q", (F.col("v") / 100).alias("amount"))
    years = cents.groupBy("cik", "year").agg(((F.sum("v") + 1) / 100).alias("amount"), F.count("*").alias("n")).where(
        "n = 4 and cik % 7 <> 0 and cik % 13 <> 0")
    want = dq.fourth_quarters(quarters, years).select("cik", F.concat("year", F.lit("Q4")).alias("quarter"), F.col("amount").alias("eps"))
    return dq.anchors(d.stored_eps, want, ["cik", "quarter"], "eps").select("cik", "quarter")


@q("dq_basis_anchors")
def _(d):
    """As-traded closes and as-paid dividends as stored, against the chain of splits read forwards from
    the vendor's rows: how many, and how many are not as they should be."""
    raw = d.history.select("ticker", F.to_date("ts").alias("date"), "pos", "close", "dividends", "stock_splits")
    wrong = dq.basis_mismatches(d.price_quarterly, d.dividend, raw).groupBy("kind").agg(F.count("*").alias("mismatches"))
    both = d.price_quarterly.agg(F.lit("close").alias("kind"), F.count("close_as_traded").alias("n")).unionAll(
        d.dividend.agg(F.lit("dividend").alias("kind"), F.count("amount_as_reported").alias("n")))
    return both.join(wrong, "kind", "left").select("kind", "n", F.coalesce("mismatches", F.lit(0)).alias("mismatches"))


@q("dq_market_caps")
def _(d):
    return dq.market_caps(d.view_rows, d.shares_quarterly, d.ticker_map)


@q("dq_view_contract")
def _(d):
    return dq.view_contract(d.view)


@q("dq_split_straddles")
def _(d):
    raw = d.shares_quarterly.withColumn("shares_at_price_basis", F.col("shares"))
    return dq.unnormalised_straddles(raw, d.ticker_map, d.price_quarterly, d.stock_split)


@q("dq_straddles_left")
def _(d):
    return dq.unnormalised_straddles(d.shares_quarterly, d.ticker_map, d.price_quarterly, d.stock_split).agg(
        F.count("*").alias("n"))


@q("dq_missing_basis")
def _(d):
    return dq.missing_basis(d.shares_quarterly).agg(F.count("*").alias("n"))


@q("dq_concept_coverage")
def _(d):
    return dq.concept_coverage(d.eps_quarterly)


@q("dq_implausible_eps")
def _(d):
    winners = earnings.slot_winners(earnings.eps_candidates(d.eps_facts))
    return dq.implausible_eps(winners).select("cik", "quarter", "eps")


@q("dq_malformed_quarters")
def _(d):
    labels = fx.table(d.spark, d.sf_dir, "orders").selectExpr(
        "concat(o_orderkey % 3000, 'Q', o_custkey % 6) as quarter")
    return dq.malformed_quarters(labels)


@q("dq_shares_window")
def _(d):
    every = d.shares_facts.where("is_instant").select(
        "cik", Q.snap_quarter(F.date_add("period_end", 60)).alias("quarter"), F.col("period_end").alias("as_of"))
    return dq.shares_out_of_window(every).groupBy("cik").agg(F.count("*").alias("n"))


@q("dq_implausible_shares")
def _(d):
    rows = d.shares_facts.withColumnRenamed("value", "shares")
    return dq.implausible_shares(rows).select("cik", "concept", "period_end", "shares")


@q("dq_duplicate_view_rows")
def _(d):
    return dq.duplicates(d.view, "quarter", "ticker symbol")


@q("dq_duplicate_dividends")
def _(d):
    raw = d.history.where("dividends > 0 and not isnan(dividends)").selectExpr(
        "ticker as ticker_yahoo", "cast(ts as date) as ex_date")
    return dq.duplicates(raw, "ticker_yahoo", "ex_date")


@q("dq_row_counts")
def _(d):
    return dq.row_counts({
        "company": d.company, "ticker_map": d.ticker_map, "eps_facts": d.eps_facts,
        "shares_facts": d.shares_facts, "public_float_facts": d.float_facts, "yahoo_fetch_log": d.purged["yahoo_fetch_log"], "eps_quarterly": d.stored_eps,
        "shares_quarterly": d.reported_shares, "price_daily": d.price_daily, "dividend": d.dividend,
        "stock_split": d.stock_split, "price_quarterly": d.price_quarterly,
        "quarterly_fundamentals": d.view,
    })


@q("dq_coverage_summary")
def _(d):
    return dq.coverage_summary(d.stored_eps, d.reported_shares, d.price_daily, d.dividend, d.price_quarterly)


@q("dq_empty_view_rows")
def _(d):
    return dq.empty_view_rows(d.view).agg(F.count("*").alias("n"))


@q("dq_dividend_bounds")
def _(d):
    return dq.dividend_bounds(market.dividend(d.enriched))


@q("dq_price_bounds")
def _(d):
    closes = market.quarter_closes(d.enriched)
    return dq.price_bounds(closes)


@q("dq_stale_rows")
def _(d):
    """Rows the purge should have taken: by the keys noted at the load, and by the jump rule over
    what is stored."""
    return dq.stale_rows(d.price_quarterly, d.purged_keys)


@q("dq_corrupt_jumps")
def _(d):
    """Jump rule on the unguarded last close of every quarter."""
    closes = market.quarter_closes(d.enriched).withColumnRenamed("ticker", "ticker_yahoo")
    return quality.corrupt_jumps(closes)


@q("dq_future_quarters")
def _(d):
    return dq.future_quarters(d.view, dt.date(2001, 8, 1)).agg(
        F.count("*").alias("n"), F.max("quarter").alias("max_quarter"))


@q("dq_class_coverage")
def _(d):
    return dq.class_coverage(d.view, d.ticker_map)


@q("dq_glitch_dividends")
def _(d):
    """All positive vendor dividends against the as-of close: those the loader drops show up."""
    h = d.stored_history
    raw = h.where("dividends > 0 and not isnan(dividends)").selectExpr(
        "ticker as ticker_yahoo", "date as ex_date", "dividends * factor as amount_as_reported")
    prices = h.selectExpr("ticker as ticker_yahoo", "date", "close_ok as close")
    return dq.glitch_dividends(raw, prices, market.stock_split(h)).select(
        "ticker_yahoo", "ex_date", "amount_as_reported", "at_close")


@q("dq_event_buckets")
def _(d):
    return dq.event_buckets(market.dividend(d.enriched), [
        ("S1 1996-1997", "S1-A", "1996-01-01", "1997-12-31"),
        ("S1 1997", "S1-A", "1997-01-01", "1997-12-31"),
        ("S3 before 1998", "S3-A", "1900-01-01", "1997-12-31"),
    ])


@q("dq_both_bases")
def _(d):
    return dq.both_bases(market.dividend(d.enriched))


@q("dq_coverage_percent")
def _(d):
    return dq.coverage_percent(d.view)


@q("dq_dividend_mismatches")
def _(d):
    return dq.dividend_mismatches(d.view_rows, d.dividend).agg(F.count("*").alias("n"))


@q("dq_violation_report")
def _(d):
    return dq.violation_report(d.stored_eps, d.shares_quarterly, d.price_quarterly, d.dividend, d.view, fx.AS_OF)
