"""The stored pipeline: loads that count what they write, materialised risk and panel tables and
the panel fast path."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterline.functions.cleaning import nan_to_null
from quarterline.functions.quarters import last_complete_qidx
from quarterline.operators import earnings, facts, market
from quarterline.operators.risk import stock_risk_quarter
from quarterline.plans.lineage import fingerprint, materialise
from quarterline.plans.panel import build_features, normalise_types, raw_panel, trim_partial
from quarterline.sources.tables import filled, materialise_table

RISK_TABLE, PANEL_TABLE = "stock_risk_quarter", "value_panel"


@dataclass(frozen=True)
class Loaded:
    """Tables as they were written, and what was counted while they were."""
    tables: dict[str, DataFrame]
    counts: dict[str, int]


def load_market(history: DataFrame, currency: DataFrame | None = None, tasks: int | None = None) -> Loaded:
    """Write the daily rows, which all market tables come from, and the quarter closes. Rows kept
    and skipped are counted by the tasks that write them; nothing is read for it again."""
    days, quarters = Observation(), Observation()
    daily = materialise(market.observed_daily(market.enriched_history(history, tasks), days), "daily")
    closes = materialise(market.observed_quarters(daily, quarters, currency), "price_quarterly")
    return Loaded({"daily": daily, "price_quarterly": closes}, {**days.get, **quarters.get})


def load_facts(raw: DataFrame, as_of: dt.date | None = None) -> Loaded:
    """Write the facts as first reported. Counted on the way: registered facts with readable periods,
    those skipped as out of range, and those kept; the rest were filed again."""
    read, kept = Observation(), Observation()
    parsed = facts.parse_facts(facts.registry_filter(raw), as_of).observe(
        read, F.count(F.lit(1)).alias("facts"), F.count_if(~F.col("in_range")).alias("skipped"))
    first = facts.earliest_filed(parsed).observe(kept, F.count(F.lit(1)).alias("kept"))
    table = materialise(first, "facts")
    counts = {**read.get, **kept.get}
    return Loaded({"facts": table}, {**counts, "filed_again": counts["facts"] - counts["skipped"] - counts["kept"]})


def load_eps(eps_facts: DataFrame) -> Loaded:
    """Write the quarterly figures, counting the reported, derived and dropped ones."""
    seen = Observation()
    winners = earnings.slot_winners(earnings.eps_candidates(eps_facts)).observe(seen, *earnings.winner_counts())
    table = materialise(earnings.plausible(winners), "eps_quarterly")
    return Loaded({"eps_quarterly": table}, seen.get)


def inputs_of(spark: SparkSession, *frames: DataFrame) -> str:
    """Fingerprint of the files that some frames are read from."""
    return fingerprint(spark, sorted({f for df in frames for f in df.inputFiles()}))


def prepare(spark: SparkSession, price_daily: DataFrame, view_rows: DataFrame, eps: DataFrame,
            price_quarterly: DataFrame, dividend: DataFrame, splits: DataFrame,
            ticker_map: DataFrame, company: DataFrame, force: bool = False) -> dict[str, bool]:
    """Build what is missing of the two derived tables; the panel reads the stored risk.

    Each table carries the fingerprint of the files it was built from and is built again when
    one of them has changed; the panel is, too, when the risk was. The panel is partitioned by
    quarter and sorted by ticker inside, as screens and backtests read it."""
    built = {RISK_TABLE: materialise_table(
        spark, RISK_TABLE, lambda: nan_to_null(stock_risk_quarter(price_daily)), force, inputs_of(spark, price_daily))}
    others = (view_rows, eps, price_quarterly, dividend, splits, ticker_map, company)
    built[PANEL_TABLE] = materialise_table(
        spark, PANEL_TABLE,
        lambda: nan_to_null(build_features(
            raw_panel(view_rows, eps, price_quarterly, dividend, spark.table(RISK_TABLE),
                      ticker_map, company), splits)),
        force or built[RISK_TABLE], inputs_of(spark, price_daily, *others), "qidx", ("ticker",))
    return built


def load_panel(spark: SparkSession, as_of: dt.date, compute=None, force_compute: bool = False) -> DataFrame:
    """The stored panel if there is one, else ``compute()``; complete quarters only."""
    if not force_compute and filled(spark, PANEL_TABLE):
        panel = normalise_types(spark.table(PANEL_TABLE))
    else:
        panel = normalise_types(compute())
    return trim_partial(panel, last_complete_qidx(as_of))
