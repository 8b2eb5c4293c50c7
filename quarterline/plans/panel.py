"""The valuation panel: one dense row per ticker and quarter, features lagged by a quarter."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import RAW_PANEL_COLUMNS, VALUE_PANEL_COLUMNS
from quarterline.functions.cleaning import finite, ratio
from quarterline.functions.quarters import qidx, quarter_from_idx
from quarterline.operators.splits import with_factor_after
from quarterline.plans.fundamentals import aligned, ticker_pairs

_TYPES = {
    "price_traded": "double", "shares": "double", "eps": "double", "eps_filed": "date",
    "eps_period_end": "date", "eps_is_derived": "boolean", "px_adj": "double",
    "price_date": "date", "div_adj": "double", "vol_252d": "double", "ret_252d": "double",
    "off_high_252d": "double",
}


def raw_panel(view_rows: DataFrame, eps_quarterly: DataFrame, price_quarterly: DataFrame,
              dividend: DataFrame, risk: DataFrame, ticker_map: DataFrame,
              company: DataFrame, tasks: int | None = None) -> DataFrame:
    """View rows with EPS provenance, split-adjusted price and dividends, risk and name.

    A ticker's own company is its smallest cik; EPS provenance is that company's even where
    the view row belongs to another one, named by ``view_cik``. All tables are put on (cik of the view, ticker,
    quarter) and met in one aggregation; rows the view does not have are dropped after it.
    Given a number of ``tasks``, the rows are dealt out to that many by ticker, and stay there for
    the windows on the ticker that follow.
    """
    pairs = ticker_pairs(ticker_map)
    own = pairs.groupBy("ticker").agg(F.min("cik").alias("own_cik"))
    named = own.join(company.select(F.col("cik").alias("own_cik"), F.col("entity_name")),
                     "own_cik", "left")

    def by_ticker(df):
        return df.withColumnRenamed("ticker_yahoo", "ticker").join(pairs, "ticker", "left")

    prov = (
        eps_quarterly.select(F.col("cik").alias("own_cik"), "quarter", "filed", "period_end", "is_derived")
        .join(own, "own_cik").join(pairs, "ticker")
    )
    same = lambda *cols: {c: F.col(c) for c in cols}
    measures = {m: (t, "sum" if m == "div_adj" else "max") for m, t in _TYPES.items()}
    measures["in_view"] = ("boolean", "max")
    met = aligned(
        [
            (view_rows, {"price_traded": F.col("price"), "shares": F.col("shares"),
                         "eps": F.col("eps"), "in_view": F.lit(True)}),
            (prov, {"eps_filed": F.col("filed"), "eps_period_end": F.col("period_end"),
                    "eps_is_derived": F.col("is_derived")}),
            (by_ticker(price_quarterly), {"px_adj": F.col("close_raw"), **same("price_date")}),
            (by_ticker(dividend), {"div_adj": F.col("amount")}),
            (by_ticker(risk.drop("price_date")), same("vol_252d", "ret_252d", "off_high_252d")),
        ],
        ("cik", "ticker", "quarter"), measures,
    ).where("in_view").withColumnRenamed("cik", "view_cik").drop("in_view")
    if tasks:  # both, or the join would go by the names' own partitions
        met, named = met.repartition(tasks, "ticker"), named.repartition(tasks, "ticker")
    return met.join(named, "ticker", "left").select(*[
        F.col({"cik": "own_cik", "name": "entity_name"}.get(c, c)).alias(c)
        for c in RAW_PANEL_COLUMNS
    ], "view_cik")


def dense_panel(raw: DataFrame) -> DataFrame:
    """Contiguous quarters per ticker from its first to its last; missing rows are NULL.

    One row per (ticker, quarter) is kept, that of the company with the smallest number in the
    view (``view_cik`` where the input has it). A row is expanded up to the next one of its
    ticker, so no calendar is joined and the partitioning by ticker stays.
    """
    view_cik = "view_cik" if "view_cik" in raw.columns else "cik"
    in_order = Window.partitionBy("ticker").orderBy(
        "qidx", F.col(view_cik).asc_nulls_last(), F.col("shares").desc_nulls_last(),
        F.col("eps").desc_nulls_last(),
    )
    by_quarter = Window.partitionBy("ticker").orderBy("qidx")
    rows = (
        raw.where("ticker is not null").withColumn("qidx", qidx(F.col("quarter")))
        .withColumn("_prev", F.lag("qidx").over(in_order))
        .where("_prev is null or _prev <> qidx").drop("_prev")
        .withColumn("_next", F.lead("qidx").over(by_quarter))
        .withColumn("_q", F.explode(F.sequence("qidx", F.coalesce(F.col("_next") - 1, F.col("qidx")))))
    )
    own = F.col("_q") == F.col("qidx")
    filled = rows.select(
        F.col("_q").alias("qidx"), quarter_from_idx(F.col("_q")).alias("quarter"), "ticker",
        *[F.when(own, F.col(c)).alias(c) for c in RAW_PANEL_COLUMNS if c not in ("quarter", "ticker")],
    )
    back = by_quarter.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the first known value of the ticker stands in for the rows before it
    whole = by_quarter.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def fill(c: str) -> Column:
        return F.coalesce(
            F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(whole)
        )

    return filled.withColumns({c: fill(c) for c in ("cik", "name")})


def with_present_basis(dense: DataFrame, splits: DataFrame) -> DataFrame:
    """EPS and share count on today's split basis.

    EPS is on the basis of its filing date (its period end if unknown), the share count on
    that of its price date.
    """
    rows = dense.withColumn("_basis", F.coalesce("eps_filed", "eps_period_end"))
    rows = with_factor_after(rows, splits, "ticker", {"_fe": "_basis", "_fs": "price_date"})
    return (
        rows.withColumn("eps_present", F.col("eps") / F.col("_fe"))
        .withColumn("shares_present", F.col("shares") * F.col("_fs"))
        .drop("_basis", "_fe", "_fs")
    )


def build_features(raw: DataFrame, splits: DataFrame) -> DataFrame:
    """The 26-column value panel.

    Frames are rows of the dense calendar. At quarter t earnings and share counts reach up to
    t-1 only: a quarter's own figures are not known before it is reported.
    """
    rows = with_present_basis(dense_panel(raw), splits)
    w = Window.partitionBy("ticker").orderBy("qidx")
    known = w.rowsBetween(-4, -1)
    year = w.rowsBetween(-3, 0)
    four = F.count("eps_present").over(known) == 4
    px = F.col("px_adj")
    rows = rows.withColumn("div_adj", F.coalesce(finite(F.col("div_adj")), F.lit(0.0))).withColumns({
        "ttm_eps": F.when(four, F.sum("eps_present").over(known)),
        "eps4_min": F.when(four, F.min("eps_present").over(known)),
        "ttm_div": F.when(F.count("*").over(year) == 4, F.sum("div_adj").over(year)),
        # carried for at most four quarters, then lagged by one
        "shares_lag": F.last("shares_present", ignorenulls=True).over(w.rowsBetween(-5, -1)),
    }).withColumns({
        "pe": ratio(px, F.col("ttm_eps")),
        "mktcap": px * F.col("shares_lag"),
        "div_yield": ratio(F.col("ttm_div"), px),
    })
    return rows.select(*VALUE_PANEL_COLUMNS)


def normalise_types(panel: DataFrame) -> DataFrame:
    """Declared types for a panel read back from storage."""
    kinds = dict(_TYPES, qidx="int", quarter="string", ticker="string", cik="bigint", name="string")
    return panel.select(*[F.col(c).cast(kinds.get(c, "double")).alias(c) for c in VALUE_PANEL_COLUMNS])


def trim_partial(panel: DataFrame, last_qidx: int) -> DataFrame:
    """Drop quarters that are not complete yet."""
    return panel.where(F.col("qidx") <= last_qidx)
