"""The value screen."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.quarters import label_to_qidx
from quarterline.params import ScreenParams


def eligible(p: ScreenParams) -> Column:
    """Predicate of the screen; never NULL. All limits are plain column comparisons."""
    c = F.col
    rules = [c("px_adj") > 0, c("pe") >= p.pe_min, c("pe") <= p.pe_max]
    if p.mcap_min_b is not None or p.mcap_max_b is not None:
        rules.append(c("mktcap") >= (p.mcap_min_b or 0.0) * 1e9)
        if p.mcap_max_b is not None:
            rules.append(c("mktcap") <= p.mcap_max_b * 1e9)
    # no dividend data means nothing was paid
    rules.append(F.coalesce("div_yield", F.lit(0.0)) >= p.min_div_yield)
    if p.require_pos_eps4:
        rules.append(c("eps4_min") > 0)
    if p.vol_max is not None:
        rules.append(c("vol_252d") <= p.vol_max)
    if p.min_ret_12m is not None:
        rules.append(c("ret_252d") >= p.min_ret_12m)
    return F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False))


def matching_counts(panel: DataFrame, p: ScreenParams) -> DataFrame:
    """Eligible rows per quarter, quarters without any included."""
    return panel.where("qidx is not null").groupBy("qidx").agg(
        F.count_if(eligible(p)).alias("matching"))


def count_matching(panel: DataFrame, p: ScreenParams, quarter: str | None = None) -> int:
    """Eligible rows at ``quarter``, by default at the panel's last one."""
    counts = matching_counts(panel, p)
    if quarter is not None:
        counts = counts.where(F.col("qidx") == label_to_qidx(quarter))
    row = counts.agg(F.max_by("matching", "qidx").alias("n")).first()
    return int(row.n or 0)


def select_holdings(universe: DataFrame, p: ScreenParams) -> DataFrame:
    """Every eligible row, equally weighted within its quarter; there is no top-N.

    The counts per quarter are aggregated and sent to the rows. They are one row per calendar
    quarter, and no quarter's rows have to come together in one task.
    """
    chosen = universe.where(eligible(p))
    sizes = chosen.groupBy("qidx").agg((1.0 / F.count("*")).alias("weight"))
    return chosen.join(F.broadcast(sizes), "qidx")


def in_order(holdings: DataFrame) -> DataFrame:
    """Presentation order."""
    return holdings.orderBy("qidx", "pe", "ticker")
