"""Small reference inputs: the ticker map in its two JSON layouts and the exclusion list."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows ``cik, name, ticker, exchange, pos`` of either layout.

    ``data`` is read as text per element, so one read covers ``{"fields": [...],
    "data": [[...]]}`` and ``{"data": [{...}]}``; another layout is an error. Rows without an integer cik are dropped.
    """
    doc = (
        spark.read.schema("fields array<string>, data array<string>")
        .option("multiLine", True).json(path)
    )
    data = F.when(F.col("data").isNull(), F.raise_error(F.lit(f"{path}: no list named data"))).otherwise(F.col("data"))
    rows = doc.select("fields", F.posexplode(data).alias("pos", "rec"))
    listed = F.from_json("rec", "array<string>")
    named = F.from_json("rec", "struct<cik string, name string, ticker string, exchange string>")

    def value(name: str):
        at = F.array_position("fields", name)
        by_position = F.when(at > 0, F.try_element_at(listed, at.cast("int")))
        return F.when(F.size("fields") > 0, by_position).otherwise(named.getField(name))

    return rows.select(
        value("cik").try_cast("bigint").alias("cik"), value("name").alias("name"),
        value("ticker").alias("ticker"), value("exchange").alias("exchange"),
        F.col("pos").cast("long").alias("pos"),
    ).where("cik is not null")


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """Upper-cased tickers of a text list with ``#`` comments; a missing file is an empty list."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "ticker string")
    return (
        lines.select(F.upper(F.trim("value")).alias("ticker"))
        .where("ticker <> '' and not startswith(ticker, '#')")
        .distinct()
    )
