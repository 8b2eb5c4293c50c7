"""Share counts per company and quarter: tiered choice of the nearest reported count."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.constants import (
    SHARES_DEI, SHARES_GAAP, SHARES_MAX, TIER1_DAYS_AFTER, TIER2_DAYS_BEFORE,
    TIER3_DAYS_AROUND,
)
from quarterline.functions.quarters import (
    day_qidx, quarter_end_from_idx, quarter_from_idx, snap_quarter,
)


def shares_spine(eps_quarterly: DataFrame, shares_facts: DataFrame) -> DataFrame:
    """Quarters that want a share count: those with EPS and those of any share fact, for
    companies that have share facts."""
    own = shares_facts.select("cik", snap_quarter(F.col("period_end")).alias("quarter"))
    eps = eps_quarterly.select("cik", "quarter").join(
        shares_facts.select("cik").distinct(), "cik", "left_semi"
    )
    return eps.union(own).distinct()


# The choice below orders candidates by one number, so that the aggregation keeps plain
# numeric buffers and combines in the map tasks: tier, then distance in days, then
# on-or-after before earlier, then the latest filing (an unknown one first).
_FILED_SPAN = 1 << 23
_FILED_BASE = 1_000_000  # days, keeps every representable date positive
_SPINE = -1  # stands for the quarter a fact adds to the spine


def shares_quarterly(eps_quarterly: DataFrame, shares_facts: DataFrame) -> DataFrame:
    """``cik, quarter, shares, source_concept, as_of, filed``.

    With E the quarter's end: (1) cover-page count dated E..E+75, earliest; (2) cover-page
    count dated E-45..E-1, latest; (3) balance-sheet count within 120 days, nearest, on or
    after E first. Counts that are not plausible are passed over before ranking.

    A count can serve only the three or four quarters around its date, so every fact is
    expanded to those plus the quarter it adds to the spine, and the choice is one aggregation
    on (cik, quarter). Facts are read once; company and dates are never joined by range.
    """
    v = F.bround("value", 0)
    usable = (
        F.col("is_instant") & F.col("concept").isin(SHARES_DEI, SHARES_GAAP)
        & (v > 0) & (v <= SHARES_MAX)
    )
    near = F.sequence(
        day_qidx(F.date_sub("as_of", TIER3_DAYS_AROUND)),
        day_qidx(F.date_add("as_of", TIER3_DAYS_AROUND)),
    )
    spine = F.array(F.lit(_SPINE))
    rows = shares_facts.select(
        "cik", "concept", F.col("period_end").alias("as_of"), "filed",
        F.when(usable, v).cast("long").alias("v"),
    ).withColumn(
        "q", F.explode(F.when(F.col("v").isNotNull(), F.concat(spine, near)).otherwise(spine))
    )
    wanted = F.col("q") == _SPINE
    gap = F.when(~wanted, F.datediff("as_of", quarter_end_from_idx(F.col("q"))))
    rows = rows.select(
        "cik", "concept", "as_of", "filed", "v", wanted.alias("wanted"), gap.alias("gap"),
        F.when(wanted, snap_quarter(F.col("as_of"))).otherwise(quarter_from_idx(F.col("q")))
        .alias("quarter"),
    )
    dei = F.col("concept") == SHARES_DEI
    tier = (
        F.when(dei & F.col("gap").between(0, TIER1_DAYS_AFTER), 1)
        .when(dei & F.col("gap").between(-TIER2_DAYS_BEFORE, -1), 2)
        .when(~dei & (F.abs("gap") <= TIER3_DAYS_AROUND), 3)
    )
    filed_rank = F.coalesce(
        F.lit(_FILED_SPAN - 1 - _FILED_BASE) - F.unix_date("filed"), F.lit(0)
    ).cast("long")
    key = (
        (tier.cast("long") * 1024 + F.abs("gap") * 2 + F.when(F.col("gap") >= 0, 0).otherwise(1))
        * _FILED_SPAN + filed_rank
    )
    columns = ("cik", "quarter", "wanted", "key", "v", "as_of", "filed")
    cand = rows.withColumn("key", key).where("wanted or key is not null").select(*columns)
    wanted = eps_quarterly.select("cik", "quarter", F.lit(True).alias("wanted"))

    best = cand.unionByName(wanted, allowMissingColumns=True).groupBy("cik", "quarter").agg(
        F.max("wanted").alias("wanted"), F.min("key").alias("key"),
        F.min_by("v", "key").alias("shares"), F.min_by("as_of", "key").alias("as_of"),
        F.min_by("filed", "key").alias("filed"),
    )
    # lowest key of the third tier
    third = F.col("key") >= F.lit(3 * 1024 * _FILED_SPAN)
    return best.where("wanted and key is not null").select(
        "cik", "quarter", "shares",
        F.when(third, SHARES_GAAP).otherwise(SHARES_DEI).alias("source_concept"),
        "as_of", "filed",
    )
