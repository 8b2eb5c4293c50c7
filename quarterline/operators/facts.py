"""Filing facts: parsing, sanity bounds and the earliest-filed rule."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.constants import CONCEPT_REGISTRY, MIN_PERIOD_END


def _iso_date(c):
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(c, 1, 10).try_cast("date"))


def registry_filter(facts: DataFrame) -> DataFrame:
    """Keep registered concepts in their required unit; adds ``kind``.

    The registry is a handful of constants, so it is a predicate and not a join.
    """
    kind = F.coalesce(*[
        F.when((F.col("concept") == concept) & (F.col("unit") == unit), kind)
        for concept, kind, unit in CONCEPT_REGISTRY
    ])
    names = [concept for concept, _kind, _unit in CONCEPT_REGISTRY]
    return facts.where(F.col("concept").isin(names)).withColumn("kind", kind).where(
        "kind is not null"
    )


def parse_facts(facts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Typed periods. No start means an instant. ``in_range`` marks plausible period ends.

    The dates are parsed inside a one-element ``inline``: filters above it cannot be pushed
    through, so Spark does not copy the parsing into each of them and every text is parsed
    once.
    """
    has_start = F.col("start").isNotNull() & (F.col("start") != "")
    today = F.current_date() if as_of is None else F.lit(as_of)
    parsed = facts.where("end is not null and end <> '' and val is not null").select(
        "cik", "concept", "kind", "unit", F.col("val").alias("value"), "accn", "fy", "fp",
        "form", "frame", "pos",
        F.inline(F.array(F.struct(
            has_start.alias("has_start"), _iso_date(F.col("start")).alias("ps"),
            _iso_date(F.col("end")).alias("period_end"), _iso_date(F.col("filed")).alias("filed"),
        ))),
    )
    start = F.when(F.col("has_start"), F.col("ps")).otherwise(F.col("period_end"))
    return (
        parsed.where("period_end is not null and (ps is not null or not has_start)")
        .select(
            "cik", "concept", "kind", "unit", start.alias("period_start"), "period_end",
            F.when(F.col("has_start"), F.datediff("period_end", "ps")).alias("duration_days"),
            (~F.col("has_start")).alias("is_instant"), "value",
            F.nullif("accn", F.lit("")).alias("accn"), "fy", "fp", "form", "filed", "frame", "pos",
            F.col("period_end").between(F.lit(MIN_PERIOD_END).cast("date"), F.date_add(today, 1))
            .alias("in_range"),
        )
    )


def skipped_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count_if(~F.col("in_range")).alias("skipped"))


def earliest_filed(parsed: DataFrame) -> DataFrame:
    """The value as first reported: smallest (filed, accession), missing ones last.

    ``row_number() = 1`` lets Spark cut every group to one row in the map tasks, so a fact
    that was filed again and again does not travel through the shuffle.
    """
    first = Window.partitionBy("cik", "concept", "period_start", "period_end", "unit").orderBy(
        F.col("filed").asc_nulls_last(), F.col("accn").asc_nulls_last(), F.col("pos")
    )
    return (
        parsed.where("in_range").drop("in_range")
        .withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "pos")
    )


def fact_tables(deduped: DataFrame) -> dict[str, DataFrame]:
    """The three stored fact tables."""
    # each column list is the stored layout
    stored = ["cik", "concept", "unit", "period_start", "period_end", "duration_days",
              "is_instant", "value", "accn", "fy", "fp", "form", "filed", "frame"]
    floats = [c for c in stored if c not in ("unit", "duration_days", "frame")]

    def of(kind, cols, decimal):
        return deduped.where(F.col("kind") == kind).select(
            *[F.col(c).try_cast(decimal).alias(c) if c == "value" else F.col(c) for c in cols]
        )

    return {
        "eps_facts": of("eps", stored, "decimal(18,6)"),
        "shares_facts": of("shares", stored, "decimal(28,0)"),
        "public_float_facts": of("float", floats, "decimal(28,0)"),
    }
