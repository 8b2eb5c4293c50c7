"""The six-column view, one row per company, ticker and quarter, and the queries on it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.constants import VIEW_COLUMNS

_KEYS = ("cik", "ticker", "quarter")
TICKER = "`ticker symbol`"


def ticker_pairs(ticker_map: DataFrame) -> DataFrame:
    return ticker_map.select("cik", F.col("ticker_yahoo").alias("ticker")).distinct()


def aligned(parts: list[tuple[DataFrame, dict[str, Column]]], keys: tuple[str, ...],
            measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Put tables with common keys side by side in one aggregation.

    Equals a full outer join on the keys of tables that are unique on them, but costs one
    shuffle for all of them and combines in the map tasks. ``measures`` maps a column to its
    type and to ``max`` (one value per key) or ``sum``.
    """
    rows = None
    for df, given in parts:
        one = df.select(*keys, *[
            (given[m] if m in given else F.lit(None)).cast(kind).alias(m)
            for m, (kind, _how) in measures.items()
        ])
        rows = one if rows is None else rows.unionByName(one)
    how = {"max": F.max, "sum": F.sum}
    return rows.groupBy(*keys).agg(*[how[h](m).alias(m) for m, (_k, h) in measures.items()])


def view_rows(eps_quarterly: DataFrame, shares_quarterly: DataFrame, price_quarterly: DataFrame,
              dividend: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """The view with its ``cik``, which stays NULL for tickers without a company.

    EPS and share counts fan out to all tickers of a company, prices and dividends to all
    companies of a ticker. Every row of one kind therefore lies on the key of the row it has
    to meet, so the distinct key list and the four left joins on it are one aggregation.
    """
    pairs = ticker_pairs(ticker_map)

    def by_company(df):
        return df.join(pairs, "cik")

    def by_ticker(df):
        return df.withColumnRenamed("ticker_yahoo", "ticker").join(pairs, "ticker", "left")

    shares = F.coalesce("shares_at_price_basis", "shares") \
        if "shares_at_price_basis" in shares_quarterly.columns else F.col("shares")
    return aligned(
        [
            (by_company(eps_quarterly), {"eps": F.col("eps")}),
            (by_company(shares_quarterly), {"shares": shares}),
            (by_ticker(price_quarterly), {"price": F.coalesce("close_as_traded", "close_raw")}),
            (by_ticker(dividend), {"dividends": F.coalesce("amount_as_reported", "amount")}),
        ],
        _KEYS,
        {"price": ("double", "max"), "shares": ("double", "max"), "eps": ("double", "max"),
         "dividends": ("double", "sum")},
    )


def quarterly_fundamentals(*tables: DataFrame) -> DataFrame:
    """The view: quarter, ticker symbol, price, shares outstanding, EPS, Dividends."""
    return view_of(view_rows(*tables))


def view_of(rows: DataFrame) -> DataFrame:
    """The view's six columns of its rows."""
    return rows.select(*[
        F.col(c).alias(name)
        for c, name in zip(("quarter", "ticker", "price", "shares", "eps", "dividends"), VIEW_COLUMNS)
    ])


# --- queries on the view ------------------------------------------------------------

def ticker_series(view: DataFrame, ticker: str) -> DataFrame:
    return view.where(F.col(TICKER) == ticker).orderBy("quarter")


def latest_quarters(rows: DataFrame, ticker: str, n: int = 4) -> DataFrame:
    """The view's last rows of a ticker; of one quarter the company with the smaller number
    goes first. ``rows`` are the view's rows with their ``cik``."""
    last = rows.where(F.col("ticker") == ticker).orderBy(F.desc("quarter"), F.col("cik").asc_nulls_last()).limit(n)
    return view_of(last)


def top_dividend_payers(view: DataFrame, quarter: str, n: int = 20) -> DataFrame:
    return (
        view.where((F.col("quarter") == quarter) & (F.col("Dividends") > 0))
        .select(TICKER, "Dividends").orderBy(F.desc("Dividends"), TICKER).limit(n)
    )


def valuation_ratios(view: DataFrame) -> DataFrame:
    """P/E, market cap in $B and dividend yield in percent, NULL where they mean nothing.

    Ratios are taken on decimals: as doubles, 48.66 / 0.4 falls just below the half that
    rounding to one digit has to push up.
    """
    px, eps = F.col("price").cast("decimal(20,10)"), F.col("EPS").cast("decimal(14,6)")
    div = F.col("Dividends").cast("decimal(18,10)")
    return view.select(
        "quarter", TICKER, "price", "EPS", "Dividends",
        F.when(eps > 0, F.round(px / eps, 1)).cast("double").alias("pe"),
        F.round(F.col("price") * F.col("`shares outstanding`") / 1e9, 3).alias("mktcap_b"),
        F.when(px > 0, F.round(div * 100 / px, 3)).cast("double").alias("yield_pct"),
    )


def column_coverage(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count("*").alias("rows"), F.count("price").alias("price"),
        F.count("`shares outstanding`").alias("shares"), F.count("EPS").alias("eps"),
        F.count("Dividends").alias("divs"),
    )


def named_rows(view: DataFrame, ticker_map: DataFrame, company: DataFrame) -> DataFrame:
    """Rows with company name and exchange."""
    names = ticker_map.select(F.col("ticker_yahoo").alias("ticker symbol"), "cik", "exchange").join(
        company, "cik")
    return view.join(names, "ticker symbol").select(
        "quarter", TICKER, "cik", "entity_name", "exchange", "price"
    )


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("n"))


def latest_dividends(dividend: DataFrame, ticker: str, n: int = 6) -> DataFrame:
    return dividend.where(F.col("ticker_yahoo") == ticker).orderBy(F.desc("ex_date")).limit(n)
