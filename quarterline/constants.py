"""Fixed values of the domain: concept registry, bounds and frozen column orders."""
from __future__ import annotations

# --- fixed values: filing concepts and the one unit each is read in -------------
EPS_BASIC = "us-gaap:EarningsPerShareBasic"
EPS_DILUTED = "us-gaap:EarningsPerShareDiluted"
SHARES_DEI = "dei:EntityCommonStockSharesOutstanding"
SHARES_GAAP = "us-gaap:CommonStockSharesOutstanding"

CONCEPT_REGISTRY: tuple[tuple[str, str, str], ...] = (
    # concept, kind, unit
    (EPS_BASIC, "eps", "USD/shares"),
    (EPS_DILUTED, "eps", "USD/shares"),
    (SHARES_DEI, "shares", "shares"),
    (SHARES_GAAP, "shares", "shares"),
    ("us-gaap:CommonStockSharesIssued", "shares", "shares"),
    ("us-gaap:WeightedAverageNumberOfSharesOutstandingBasic", "shares", "shares"),
    ("us-gaap:WeightedAverageNumberOfDilutedSharesOutstanding", "shares", "shares"),
    ("dei:EntityPublicFloat", "float", "USD"),
)

# --- fixed values: bounds --------------------------------------------------------
MIN_PERIOD_END = "1990-01-01"
QUARTER_DAYS = (75, 115)
ANNUAL_DAYS = (340, 385)
ANNUAL_FORM_PREFIX = "10-K"
TILE_GAP_DAYS = (1, 7)
LAST_QUARTER_DAYS = (80, 130)
EPS_ABS_MAX = 1e5
SHARES_MAX = 1e13
TIER1_DAYS_AFTER = 75
TIER2_DAYS_BEFORE = 45
TIER3_DAYS_AROUND = 120
SNAP_DAYS = 7

PRICE_FLOOR = 1e-6
PRICE_CEILING = 1e7
NUMERIC_MAX = 1e12
BIGINT_MAX = 9.2e18
DIVIDEND_MAX = 1e5
JUMP_UP = 100.0
JUMP_DOWN = 0.01

RISK_WINDOW = 252
RISK_MIN_RETURNS = 120
RISK_MIN_CLOSES = 60

BENCHMARK_TICKER = "SPY"
TIE_EPSILON = 1e-12
DAYS_PER_YEAR = 365.25

# --- fixed values: texts and the pattern of quarter labels ------------------------
WIN_VALUE, WIN_BENCH, WIN_TIE, WIN_NA = "Value portfolio", "S&P 500", "Tie", "n/a"
QUARTER_LABEL_PATTERN = "^(19|20)[0-9]{2}Q[1-4]$"

# --- fixed values: column orders -------------------------------------------------
VIEW_COLUMNS = ("quarter", "ticker symbol", "price", "shares outstanding", "EPS", "Dividends")
VIEW_TYPES = ("string", "string", "double", "double", "double", "double")

RAW_PANEL_COLUMNS = (
    "quarter", "ticker", "price_traded", "shares", "eps", "eps_filed", "eps_period_end",
    "eps_is_derived", "px_adj", "price_date", "div_adj", "vol_252d", "ret_252d",
    "off_high_252d", "cik", "name",
)
VALUE_PANEL_COLUMNS = ("qidx",) + RAW_PANEL_COLUMNS + (
    "eps_present", "shares_present", "ttm_eps", "eps4_min", "ttm_div", "shares_lag",
    "pe", "mktcap", "div_yield",
)
HOLDINGS_COLUMNS = (
    "rebalance_quarter", "date", "ticker", "name", "weight", "pe", "mktcap_b",
    "div_yield", "vol_252d", "ret_252d",
)
COMPARISON_COLUMNS = (
    "quarter", "date", "portfolio_return", "benchmark_return", "difference", "winner",
)
