"""Stock-split factors.

Every number has a split basis. Converting between bases is a product of split ratios over a
half-open interval of dates; an empty interval has factor 1.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clean_splits(splits: DataFrame) -> DataFrame:
    """Usable splits: finite positive ratio, one per ticker and date."""
    ok = splits.where(
        F.col("split_date").isNotNull() & F.col("ratio").isNotNull()
        & ~F.isnan(F.col("ratio").cast("double")) & (F.col("ratio") > 0)
    )
    order = "pos" if "pos" in splits.columns else "ratio"
    return (
        ok.groupBy("ticker_yahoo", "split_date")
        .agg(F.min_by(F.col("ratio").cast("double"), order).alias("ratio"))
    )


def split_steps(splits: DataFrame) -> DataFrame:
    """The factor strictly after a date as a step function of that date.

    One row per split: for ``since <= d < until`` the product of all later ratios is
    ``factor``. Dates on or after a ticker's last split match no row (factor 1).
    """
    down = Window.partitionBy("ticker_yahoo").orderBy(F.col("split_date").desc())
    return splits.select(
        "ticker_yahoo",
        F.lead("split_date").over(down).alias("since"),
        F.col("split_date").alias("until"),
        F.product("ratio").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("factor"),
    )


def with_factor_after(rows: DataFrame, splits: DataFrame, ticker: str,
                      factors: dict[str, str]) -> DataFrame:
    """Add ``factors[out]``: the product of ratios dated strictly after that date column.

    ``factors`` maps new column to date column. A row meets at most one step, so the join
    never multiplies rows. Spark broadcasts the steps if they are small; otherwise both
    sides meet on the ticker and a hot ticker of ``rows`` is split by the adaptive skew join.
    """
    steps = split_steps(splits)
    for n, (out, day) in enumerate(factors.items()):
        s = steps.select(
            F.col("ticker_yahoo").alias(f"_t{n}"), F.col("since").alias(f"_s{n}"),
            F.col("until").alias(f"_u{n}"), F.col("factor").alias(f"_f{n}"),
        )
        on = (
            (F.col(ticker) == F.col(f"_t{n}")) & (F.col(day) < F.col(f"_u{n}"))
            & (F.col(f"_s{n}").isNull() | (F.col(day) >= F.col(f"_s{n}")))
        )
        rows = rows.join(s, on, "left").withColumn(
            out, F.coalesce(F.col(f"_f{n}"), F.lit(1.0))
        ).drop(f"_t{n}", f"_s{n}", f"_u{n}", f"_f{n}")
    return rows


def with_factor_between(rows: DataFrame, splits: DataFrame, ticker: str, lo: str, hi: str,
                        out: str = "factor") -> DataFrame:
    """Product of the ratios with ``lo < split_date <= hi``.

    A ticker's splits, at most one a day, are one array in the order of their dates, so the join
    keeps the rows as they are and each folds over its own stretch. The ratios are multiplied
    themselves: dividing two cumulative factors would leave 2.999... where 3 is meant and change
    rounded share counts.
    """
    listed = splits.groupBy(F.col("ticker_yahoo").alias("_t")).agg(
        F.array_sort(F.collect_list(F.struct("split_date", F.col("ratio").cast("double").alias("ratio")))).alias("_s"))
    inside = F.filter("_s", lambda s: (s["split_date"] > F.col(lo)) & (s["split_date"] <= F.col(hi)))
    product = F.aggregate(inside, F.lit(1.0), lambda f, s: f * s["ratio"])
    return rows.join(listed, F.col(ticker) == F.col("_t"), "left").withColumn(
        out, F.coalesce(product, F.lit(1.0))).drop("_t", "_s")
