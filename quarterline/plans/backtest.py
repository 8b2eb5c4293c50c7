"""Equal-weighted value portfolio against a benchmark, with weights that drift between
rebalances."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterline.constants import (
    BENCHMARK_TICKER, COMPARISON_COLUMNS, DAYS_PER_YEAR, HOLDINGS_COLUMNS, TIE_EPSILON,
    WIN_BENCH, WIN_NA, WIN_TIE, WIN_VALUE,
)
from quarterline.functions.cleaning import billions, percent
from quarterline.functions.quarters import quarter_end_from_idx, quarter_from_idx
from quarterline.operators.returns import on_calendar, with_returns
from quarterline.operators.screen import eligible, matching_counts
from quarterline.params import ScreenParams

_SERIES_SCHEMA = "quarter string, date date, portfolio double, benchmark double"
_HOLDINGS_SCHEMA = (
    "rebalance_quarter string, date date, ticker string, name string, weight double, pe double, "
    "mktcap_b double, div_yield double, vol_252d double, ret_252d double"
)
_COMPARISON_SCHEMA = (
    "quarter string, date date, portfolio_return double, benchmark_return double, "
    "difference double, winner string"
)
_STATS_SCHEMA = (
    "start_quarter string, end_quarter string, years double, n_rebalances bigint, "
    "avg_holdings double, min_holdings bigint, portfolio_final double, benchmark_final double, "
    "portfolio_cagr double, benchmark_cagr double, excess_cagr double, "
    "portfolio_total_return double, benchmark_total_return double, portfolio_max_dd double, "
    "benchmark_max_dd double, value_win_quarters bigint, benchmark_win_quarters bigint, "
    "tie_quarters bigint, comparison_quarters bigint, portfolio_mean_quarterly_return double, "
    "benchmark_mean_quarterly_return double, portfolio_median_quarterly_return double, "
    "benchmark_median_quarterly_return double, settled boolean, rebalance_quarters array<string>, "
    "message string"
)
STATS_COLUMNS = tuple(part.split()[0] for part in _STATS_SCHEMA.split(", "))


@dataclass(frozen=True)
class Schedule:
    """Calendar of one run. ``sizes`` holds the number of holdings per rebalance."""

    first: int | None = None
    start: int | None = None
    last: int | None = None
    step: int = 1
    sizes: dict[int, int] | None = None
    message: str | None = None

    @property
    def settled(self) -> bool:
        return self.message is None

    @property
    def rebalances(self) -> list[int]:
        return sorted(self.sizes or {})


@dataclass(frozen=True)
class BacktestResult:
    series: DataFrame
    holdings: DataFrame
    stats: DataFrame
    comparison: DataFrame
    schedule: Schedule


def _label(q: int) -> str:
    return f"{q // 4}Q{q % 4 + 1}"


def make_schedule(panel: DataFrame, p: ScreenParams) -> Schedule:
    """Start at the first rebalance quarter with an eligible name; the last quarter only
    evaluates. What comes to the driver is one row per calendar quarter."""
    counts = {r.qidx: r.matching for r in matching_counts(panel, p).collect()}
    if not counts:
        return Schedule(message="there are no quarters")
    first, last = min(counts), max(counts)
    if last <= first:
        return Schedule(message="one quarter alone cannot be evaluated")
    of_year = p.rebalance_quarters_of_year
    grid = [q for q in range(first, last + 1) if q % 4 in of_year
            and (p.start_year is None or q >= p.start_year * 4)]
    if not grid:
        return Schedule(message="no quarter of the run is one to rebalance in")
    start = next((q for q in grid if counts.get(q, 0) > 0), None)
    if start is None:
        return Schedule(message="no rebalance finds a name within the limits")
    sizes = {q: counts.get(q, 0) for q in grid if start <= q < last}
    if not sizes:
        return Schedule(message="nothing follows the first rebalance")
    return Schedule(first, start, last, 4 // len(of_year), sizes)


def _rebalance_before(t: Column, step: int) -> Column:
    """The rebalance in force at t: the latest one before it. All frequencies end a year."""
    return t - 1 - F.pmod(t - 4, F.lit(step))


def growth_by_quarter(panel: DataFrame, p: ScreenParams, s: Schedule) -> DataFrame:
    """``t, k, held, growth, bench_r``: summed growth since rebalance k of the names held.

    Between rebalances drifting weights are buy and hold, so a name's contribution is the
    product of its returns since the rebalance and the portfolio's growth is their mean.
    Screen, calendar, returns and growth are all per ticker: one shuffle of a narrow
    projection, then a partial aggregation to one row per quarter.
    """
    narrow = panel.select("ticker", "qidx", "px_adj", "div_adj", eligible(p).alias("ok"))
    rows = with_returns(on_calendar(narrow, s.first, s.last, ("ok",)), p.delist_mode)
    w = Window.partitionBy("ticker").orderBy("qidx")
    q = F.col("qidx")
    is_rebalance = (_rebalance_before(q + 1, s.step) == q) & (q >= s.start) & (q < s.last)
    rows = rows.withColumn(
        "picked", F.when(is_rebalance, F.coalesce("ok", F.lit(False)))
    ).withColumn(
        "held", F.coalesce(F.last("picked", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    ).where(q > s.start).withColumn("k", _rebalance_before(q, s.step))
    since = (Window.partitionBy("ticker", "k").orderBy("qidx")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("g", F.product(F.col("r") + 1).over(since))
    bench = F.col("ticker") == BENCHMARK_TICKER
    return rows.where(F.col("held") | bench).groupBy(q.alias("t"), "k").agg(
        F.count_if("held").alias("held"),
        F.sum(F.when(F.col("held"), F.col("g"))).alias("growth"),
        F.max(F.when(bench, F.col("r"))).alias("bench_r"),
    )


def equity_series(growth: DataFrame, s: Schedule) -> DataFrame:
    """Both indices, 100 at the start quarter. One row per calendar quarter from here on."""
    spark = growth.sparkSession
    calendar = spark.range(s.start + 1, s.last + 1).select(F.col("id").cast("int").alias("t"))
    line = Window.orderBy("t")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = F.col("t")
    k = _rebalance_before(t, s.step)
    ends = (_rebalance_before(t + 1, s.step) != k)
    rows = calendar.join(growth.select("t", "held", "growth", "bench_r"), "t", "left").select(
        "t", ends.alias("ends"),
        # a rebalance without holdings stays in cash
        F.coalesce(F.col("growth") / F.nullif("held", F.lit(0)), F.lit(1.0)).alias("g"),
        F.coalesce("bench_r", F.lit(0.0)).alias("b"),
    )
    earlier = F.coalesce(F.product(F.when(F.col("ends"), F.col("g"))).over(before), F.lit(1.0))
    rows = rows.select(
        "t", (earlier * F.col("g") * 100).alias("portfolio"),
        (F.product(F.col("b") + 1).over(upto) * 100).alias("benchmark"),
    )
    start = spark.range(1).select(
        F.lit(s.start).alias("t"), F.lit(100.0).alias("portfolio"), F.lit(100.0).alias("benchmark"))
    return start.unionByName(rows).select(
        quarter_from_idx(t).alias("quarter"), quarter_end_from_idx(t).alias("date"),
        "portfolio", "benchmark",
    ).orderBy("quarter")


def _with_changes(series: DataFrame) -> DataFrame:
    """Add returns, winner and drawdowns; the first row has neither return nor winner."""
    line = Window.orderBy("quarter")
    running = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def change(c: str) -> Column:
        prev = F.nullif(F.lag(c).over(line), F.lit(0.0))
        return (F.col(c) - prev) / prev

    def down(c: str) -> Column:
        return F.col(c) / F.nullif(F.max(c).over(running), F.lit(0.0)) - 1

    d = F.col("difference")
    winner = (
        F.when(d.isNull(), WIN_NA).when(F.abs(d) < TIE_EPSILON, WIN_TIE)
        .when(d > 0, WIN_VALUE).otherwise(WIN_BENCH)
    )
    return (
        series.select(
            "*", change("portfolio").alias("portfolio_return"),
            change("benchmark").alias("benchmark_return"), down("portfolio").alias("portfolio_dd"),
            down("benchmark").alias("benchmark_dd"), F.row_number().over(line).alias("_n"),
        )
        .withColumn("difference", F.col("portfolio_return") - F.col("benchmark_return"))
        .withColumn("winner", F.when(F.col("_n") > 1, winner))
    )


def quarterly_comparison(series: DataFrame) -> DataFrame:
    """Returns of both indices per quarter and who won."""
    return _with_changes(series).where("_n > 1").select(*COMPARISON_COLUMNS)


def drawdowns(series: DataFrame) -> DataFrame:
    """Distance of each index from its running maximum."""
    return _with_changes(series).select("quarter", "portfolio_dd", "benchmark_dd")


def holdings_table(panel: DataFrame, p: ScreenParams, s: Schedule) -> DataFrame:
    """Holdings of every rebalance: a filtered projection of the panel.

    The rebalance quarters are an IN list, so a stored panel is read for them only, and the
    weights come from the counts the schedule already has.
    """
    weights = F.create_map(*[x for q, n in s.sizes.items() if n for x in (F.lit(q), F.lit(1.0 / n))])
    q = F.col("qidx")
    return panel.where(q.isin([q for q, n in s.sizes.items() if n]) & eligible(p)).select(
        quarter_from_idx(q).alias("rebalance_quarter"), quarter_end_from_idx(q).alias("date"),
        "ticker", "name", weights[q].alias("weight"), "pe", billions(F.col("mktcap")).alias("mktcap_b"),
        "div_yield", "vol_252d", "ret_252d",
    ).select(*HOLDINGS_COLUMNS)


def _years(s: Schedule) -> float:
    def end(q: int) -> dt.date:
        y, m = q // 4, 3 * (q % 4 + 1)
        return (dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1))
    return (end(s.last) - end(s.start)).days / DAYS_PER_YEAR


def backtest_stats(series: DataFrame, s: Schedule) -> DataFrame:
    """One row of summary figures."""
    years, sizes = _years(s), list(s.sizes.values())
    per_quarter = _with_changes(series)

    def final(c: str) -> Column:
        return F.max_by(c, "quarter")

    def cagr(c: str) -> Column:
        return F.when((final(c) > 0) & F.lit(years > 0), F.pow(final(c) / 100.0, F.lit(1.0 / years)) - 1)

    won = lambda who: F.count_if(F.col("winner") == who)
    lit = F.lit
    figures = {
        "start_quarter": lit(_label(s.start)), "end_quarter": lit(_label(s.last)), "years": lit(years),
        "n_rebalances": lit(len(sizes)), "avg_holdings": lit(sum(sizes) / len(sizes)),
        "min_holdings": lit(min(sizes)),
        "portfolio_final": final("portfolio"), "benchmark_final": final("benchmark"),
        "portfolio_cagr": cagr("portfolio"), "benchmark_cagr": cagr("benchmark"),
        "excess_cagr": cagr("portfolio") - cagr("benchmark"),
        "portfolio_total_return": final("portfolio") / 100.0 - 1,
        "benchmark_total_return": final("benchmark") / 100.0 - 1,
        "portfolio_max_dd": F.min("portfolio_dd"), "benchmark_max_dd": F.min("benchmark_dd"),
        "value_win_quarters": won(WIN_VALUE), "benchmark_win_quarters": won(WIN_BENCH),
        "tie_quarters": won(WIN_TIE),
        "comparison_quarters": F.count_if(F.col("winner") != WIN_NA),
        "portfolio_mean_quarterly_return": F.avg("portfolio_return"),
        "benchmark_mean_quarterly_return": F.avg("benchmark_return"),
        "portfolio_median_quarterly_return": F.median("portfolio_return"),
        "benchmark_median_quarterly_return": F.median("benchmark_return"),
        "settled": lit(True),
        "rebalance_quarters": F.array(*[lit(_label(q)) for q in s.rebalances]),
        "message": lit(None).cast("string"),
    }
    kinds = dict(part.split() for part in _STATS_SCHEMA.split(", "))
    return per_quarter.agg(*[c.alias(n) for n, c in figures.items()]).select(
        *[F.col(n).cast(kinds[n]).alias(n) for n in STATS_COLUMNS])


def empty_result(spark: SparkSession, s: Schedule) -> BacktestResult:
    """Same schemas, no rows, and one row of stats that says why."""
    zero = {"years": 0.0, "n_rebalances": 0, "avg_holdings": 0.0, "min_holdings": 0,
            "value_win_quarters": 0, "benchmark_win_quarters": 0, "tie_quarters": 0,
            "comparison_quarters": 0, "settled": False, "rebalance_quarters": [],
            "message": s.message}
    stats = spark.createDataFrame([tuple(zero.get(c) for c in STATS_COLUMNS)], _STATS_SCHEMA)
    return BacktestResult(
        spark.createDataFrame([], _SERIES_SCHEMA), spark.createDataFrame([], _HOLDINGS_SCHEMA),
        stats, spark.createDataFrame([], _COMPARISON_SCHEMA), s,
    )


def run_backtest(panel: DataFrame, params: ScreenParams) -> BacktestResult:
    """Lazy series, holdings, comparison and stats of a run over ``panel``.

    The panel is read once for the schedule and once per result, so pass a stored one. Unknown
    delisting modes and crossed bounds are refused.
    """
    p = params.lenient().validated()
    s = make_schedule(panel, p)
    if not s.settled:
        return empty_result(panel.sparkSession, s)
    series = equity_series(growth_by_quarter(panel, p, s), s)
    return BacktestResult(series, holdings_table(panel, p, s), backtest_stats(series, s),
                          quarterly_comparison(series), s)


# --- presentation -------------------------------------------------------------------

def latest_holdings(holdings: DataFrame) -> DataFrame:
    """Holdings of the last rebalance, scaled for reading."""
    last = holdings.agg(F.max("rebalance_quarter").alias("rebalance_quarter"))
    # one row
    return holdings.join(F.broadcast(last), "rebalance_quarter").select(
        "rebalance_quarter", "ticker", F.coalesce("name", F.lit("")).alias("name"),
        percent(F.col("weight")).alias("weight_pct"), F.round("pe", 2).alias("pe"),
        F.round("mktcap_b", 2).alias("mktcap_b"), percent(F.col("div_yield")).alias("yield_pct"),
        percent(F.col("vol_252d")).alias("vol_pct"), percent(F.col("ret_252d")).alias("ret_pct"),
    ).orderBy(F.desc("weight_pct"), "ticker")


def rebalance_history(holdings: DataFrame) -> DataFrame:
    """Holdings and new names per rebalance. A rebalance without holdings is not recorded, so
    it is not the previous one of the next."""
    quarters = holdings.select("rebalance_quarter").distinct().withColumn(
        "n", F.row_number().over(Window.orderBy("rebalance_quarter")))
    # one row per calendar quarter
    names = holdings.select("rebalance_quarter", "ticker").distinct().join(
        F.broadcast(quarters), "rebalance_quarter")
    prev = F.lag("n").over(Window.partitionBy("ticker").orderBy("n"))
    return names.withColumn("fresh", prev.isNull() | (prev != F.col("n") - 1)).groupBy(
        "rebalance_quarter"
    ).agg(F.count("*").alias("holdings"), F.count_if("fresh").alias("new_names"))


def comparison_summary(stats: DataFrame) -> DataFrame:
    """Mean and median quarterly return in percent with their difference."""
    rows = F.inline(F.array(*[
        F.struct(
            F.lit(f"{kind.title()} quarterly return").alias("statistic"),
            percent(F.col(f"portfolio_{kind}_quarterly_return")).alias("portfolio_pct"),
            percent(F.col(f"benchmark_{kind}_quarterly_return")).alias("benchmark_pct"),
            percent(F.col(f"portfolio_{kind}_quarterly_return")
                    - F.col(f"benchmark_{kind}_quarterly_return")).alias("difference_pp"),
        ) for kind in ("mean", "median")
    ]))
    return stats.select(rows)


def data_options(panel: DataFrame, as_of: dt.date) -> DataFrame:
    """First and last quarter and the start years a user may choose (from 2008 on)."""
    first = F.greatest(F.lit(2008), F.substring("first_quarter", 1, 4).cast("int"))
    return panel.agg(F.min("quarter").alias("first_quarter"), F.max("quarter").alias("last_quarter")).select(
        "first_quarter", "last_quarter",
        F.when(first <= as_of.year, F.sequence(first, F.greatest(first, F.lit(as_of.year))))
        .otherwise(F.array().cast("array<int>")).alias("start_years"),
    )
