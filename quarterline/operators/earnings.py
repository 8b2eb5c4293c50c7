"""Quarterly earnings per share: derived fourth quarters, slot winners and their audit.

Everything after the earliest-filed rule is local to a company, so one shuffle on ``cik``
serves all of it. What a company can hold there is bounded by the calendar (one row per
concept, start and end within fixed durations), not by how often it filed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import (
    ANNUAL_DAYS, ANNUAL_FORM_PREFIX, EPS_ABS_MAX, LAST_QUARTER_DAYS, QUARTER_DAYS,
    TILE_GAP_DAYS,
)
from quarterline.functions.quarters import snap_quarter


def _is_quarter() -> Column:
    return ~F.col("is_instant") & F.col("duration_days").between(*QUARTER_DAYS)


def _is_annual() -> Column:
    return (
        ~F.col("is_instant") & F.col("duration_days").between(*ANNUAL_DAYS)
        & F.col("form").startswith(ANNUAL_FORM_PREFIX)
    )


def eps_candidates(eps_facts: DataFrame) -> DataFrame:
    """One candidate per quarterly fact and per annual fact that implies a fourth quarter.

    An annual window [S, E] must contain exactly three quarterly facts of its own concept
    that tile it from S on. Read a concept by start date downwards: the quarters that start
    at or after S are those seen before the annual row. Then

    * the three seen last must follow each other gap by gap, the first starting at S;
    * every quarter seen earlier must end after E, which excludes a fourth contained
      quarter and a reported quarter that ends at E.

    Both are window expressions over one sort, so no range join of annual with quarterly
    facts is needed.
    """
    facts = (
        eps_facts.withColumn("_q", F.coalesce(_is_quarter(), F.lit(False)))
        .withColumn("_a", F.coalesce(_is_annual(), F.lit(False)))
        .where("_q or _a")
        .repartition("cik")
    )
    down = Window.partitionBy("cik", "concept").orderBy(
        F.col("period_start").desc(), F.col("_q").desc(), F.col("period_end").desc()
    )
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.withColumn(
        "_low", F.min(F.when(F.col("_q"), F.col("period_end"))).over(before)
    ).withColumn(
        "_item", F.when(F.col("_q"), F.struct("period_start", "period_end", "value", "_low"))
    )
    order = ("over (partition by cik, concept "
             "order by period_start desc, _q desc, period_end desc)")
    for n in (1, 2, 3):
        facts = facts.withColumn(f"_q{n}", F.expr(f"lag(_item, {n}) ignore nulls {order}"))

    def days(later: Column, earlier: Column) -> Column:
        return F.datediff(later, earlier)

    start, end = F.col("period_start"), F.col("period_end")
    tiled = (
        F.col("_a") & F.col("_q3").isNotNull()
        & (F.col("_q1.period_start") == start)
        & days(F.col("_q2.period_start"), F.col("_q1.period_end")).between(*TILE_GAP_DAYS)
        & days(F.col("_q3.period_start"), F.col("_q2.period_end")).between(*TILE_GAP_DAYS)
        & (F.col("_q3.period_end") < end)
        & (days(end, F.col("_q3.period_end")) + 1).between(*LAST_QUARTER_DAYS)
        & (F.col("_q3._low").isNull() | (F.col("_q3._low") > end))
    )
    rest = F.col("value") - (F.col("_q1.value") + F.col("_q2.value") + F.col("_q3.value"))
    return (
        facts.where(F.col("_q") | tiled)
        .select(
            "cik", "concept", F.col("_a").alias("is_derived"),
            F.when(F.col("_a"), F.date_add("_q3.period_end", 1)).otherwise(start)
            .alias("period_start"),
            "period_end",
            F.when(F.col("_a"), rest).otherwise(F.col("value")).alias("eps"),
            "filed", "accn",
        )
        .withColumn("quarter", snap_quarter(F.col("period_end")))
    )


def _diluted() -> Column:
    return F.col("concept").contains("Diluted")


def prefer_diluted(candidates: DataFrame) -> DataFrame:
    """Drop a reported basic figure where the diluted one exists for the same period.

    The slot order below ranks diluted first within a period anyway, so only the audit's
    candidate counts depend on this.
    """
    w = Window.partitionBy("cik", "is_derived", "period_start", "period_end").orderBy(
        _diluted().desc()
    )
    ranked = candidates.withColumn("_n", F.row_number().over(w))
    return ranked.where("is_derived or _n = 1").drop("_n")


def _slot_rank() -> Column:
    return F.row_number().over(Window.partitionBy("cik", "quarter").orderBy(
        F.col("period_end").desc(), F.col("is_derived").asc(), _diluted().desc(),
        F.col("filed").desc_nulls_last(), F.col("accn").desc_nulls_last(),
        F.col("period_start").asc(),
    ))


def slot_winners(candidates: DataFrame) -> DataFrame:
    """Best candidate per company and quarter, before the plausibility guard."""
    return (
        candidates.withColumn("_n", _slot_rank())
        .where("_n = 1").drop("_n")
    )


def eps_quarterly(eps_facts: DataFrame) -> DataFrame:
    """``cik, quarter, eps, concept, is_derived, period_start, period_end, filed, accn``.

    The guard drops the winner, it does not promote the runner-up.
    """
    return plausible(slot_winners(eps_candidates(eps_facts)))


def plausible(winners: DataFrame) -> DataFrame:
    return winners.where(
        F.abs("eps") <= EPS_ABS_MAX
    ).select("cik", "quarter", "eps", "concept", "is_derived", "period_start", "period_end",
             "filed", "accn")


def eps_collisions(eps_facts: DataFrame) -> DataFrame:
    """Audit of quarters with more than one candidate whose winner is stored.

    A quarter can only hold periods of bounded length that end within 98 days, so the list
    per row is bounded by the calendar.
    """
    cands = prefer_diluted(eps_candidates(eps_facts))
    text = F.format_string(
        "%s%s@%s=%.6f", F.element_at(F.split("concept", ":"), -1),
        F.when(F.col("is_derived"), "D").otherwise("R"),
        F.col("period_end").cast("string"), F.col("eps"),
    )
    ranked = cands.withColumn("_n", _slot_rank())

    def won(c: str) -> Column:
        return F.max(F.when(F.col("_n") == 1, F.col(c))).alias("chosen_" + c)

    listed = F.array_sort(F.collect_list(
        F.struct("is_derived", "period_start", "period_end", "concept", text.alias("text"))
    ))
    return (
        ranked.groupBy("cik", "quarter")
        .agg(F.count("*").alias("n_candidates"), won("concept"), won("is_derived"),
             won("period_end"), won("filed"), won("accn"), won("eps"),
             F.array_join(listed.getField("text"), " | ").alias("all_candidates"))
        .where((F.col("n_candidates") > 1) & (F.abs("chosen_eps") <= EPS_ABS_MAX))
    )


def winner_counts() -> list[Column]:
    ok = F.abs("eps") <= EPS_ABS_MAX
    return [
        F.count_if(ok & ~F.col("is_derived")).alias("reported"),
        F.count_if(ok & F.col("is_derived")).alias("derived"),
        F.count_if(~ok).alias("dropped"),
    ]


def eps_load_counts(eps_facts: DataFrame) -> DataFrame:
    """Reported, derived and dropped quarters of one load."""
    return slot_winners(eps_candidates(eps_facts)).agg(*winner_counts())
