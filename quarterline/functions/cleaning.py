"""Value cleaning at the boundary. Missing is NULL everywhere: NaN and infinity never pass."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.constants import BIGINT_MAX, NUMERIC_MAX


def norm_ticker(t: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(t)), "[./]", "-")


def finite(x: Column) -> Column:
    """NULL for NaN and infinities (NaN compares above everything in Spark)."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def sane_number(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < NUMERIC_MAX), x)


def sane_long(x: Column) -> Column:
    """Nearest integer, halves to even; NULL outside the BIGINT range."""
    return F.when(~F.isnan(x) & (F.abs(x) < BIGINT_MAX), F.bround(x, 0).cast("long"))


def ratio(num: Column, den: Column) -> Column:
    """num/den where den > 0, else NULL."""
    return F.when(den > 0, num / den)


def percent(x: Column, digits: int = 2) -> Column:
    return F.round(x * 100, digits)


def billions(x: Column, digits: int | None = None) -> Column:
    b = x / F.lit(1e9)
    return b if digits is None else F.round(b, digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN/Inf to NULL in every floating column, timestamps to dates."""
    def clean(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = finite(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date")
        return c.alias(f.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, missing values written as null, dates in ISO form."""
    safe = nan_to_null(df)
    return safe.select(
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in safe.columns]),
                  {"ignoreNullFields": "false"}).alias("json")
    )
