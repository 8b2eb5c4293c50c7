"""Stored tables: load semantics on catalog tables.

Tables that are replaced ticker by ticker are cut by a hash bucket of the ticker (``versions``), so
a replacement reads and rewrites the buckets concerned and nothing else.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.cleaning import nan_to_null


BUCKET = "ticker_bucket"
DONE = ("ok", "empty")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def filled(spark: SparkSession, table: str) -> bool:
    return exists(spark, table) and not spark.table(table).isEmpty()


@dataclass(frozen=True)
class Buckets:
    """Layout of a catalog table that is joined on ``key``: hashed into ``n`` buckets, each sorted, so
    that a join of two such tables reads them as they lie, without an exchange."""
    n: int
    key: str
    sort_by: tuple[str, ...]


def _save(df: DataFrame, table: str, mode: str, layout: Buckets | None = None, path: str | None = None) -> None:
    if layout:
        df = df.repartition(layout.n, layout.key)  # a file for each bucket
    w = df.write.mode(mode).format("parquet")
    if layout:
        w = w.bucketBy(layout.n, layout.key).sortBy(*layout.sort_by)
    (w.option("path", path) if path else w).saveAsTable(table)


def bulk_append(df: DataFrame, table: str, columns: list[str] | None = None, layout: Buckets | None = None) -> None:
    """Append in declared column order. ``layout`` is the table's, if it is bucketed."""
    rows = df.select(*columns) if columns else df
    if exists(df.sparkSession, table):
        rows = rows.select(*df.sparkSession.table(table).columns)
    _save(rows, table, "append", layout)


def full_refresh(df: DataFrame, table: str, partition_by: str | None = None, sort_by: tuple[str, ...] = (),
                 layout: Buckets | None = None, path: str | None = None) -> None:
    """Replace the whole table by rows that do not come from it, bucketed or partitioned. With
    ``sort_by`` the rows of a partition come together and are sorted; adaptive execution has a large
    one written by several tasks. ``path`` is where a table outside the warehouse lies."""
    if layout:
        _save(df, table, "overwrite", layout, path)
        return
    if sort_by:
        keys = (partition_by, *sort_by) if partition_by else sort_by
        df = df.hint("rebalance", keys[0]).sortWithinPartitions(*keys)
    w = df.write.mode("overwrite").format("parquet")
    w = w.partitionBy(partition_by) if partition_by else w
    (w.option("path", path) if path else w).saveAsTable(table)


def absent_rows(new: DataFrame, stored: DataFrame | None, keys: list[str], order: list[str]) -> DataFrame:
    """Rows an insert-if-absent would add: first per key in the batch, none already stored."""
    first = Window.partitionBy(*keys).orderBy(*order)
    rows = new.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return rows if stored is None else rows.join(stored.select(*keys), keys, "left_anti")


def insert_absent(new: DataFrame, table: str, keys: list[str], order: list[str], layout: Buckets | None = None) -> None:
    """The first writer of a key wins."""
    spark = new.sparkSession
    stored = spark.table(table) if exists(spark, table) else None
    rows = absent_rows(new, stored, keys, order)
    rows = rows.select(*stored.columns) if stored is not None else rows
    _save(rows, table, "append", layout)


def with_bucket(df: DataFrame, buckets: int, key: str = "ticker_yahoo") -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def replaced_rows(stored: DataFrame, new: DataFrame, tickers: DataFrame, key: str = "ticker_yahoo") -> DataFrame:
    """Stored rows without the replaced tickers, plus the new rows of those tickers."""
    return stored.join(tickers, key, "left_anti").unionByName(new.join(tickers, key, "left_semi"))


def replaced_tables(stored: dict[str, DataFrame], new: dict[str, DataFrame], tickers: DataFrame) -> dict[str, DataFrame]:
    """Some tickers replaced in every table of a load at once."""
    return {name: replaced_rows(df, new[name], tickers) for name, df in stored.items()}


def ledger_latest(*attempts: DataFrame) -> DataFrame:
    """Latest outcome per ticker. The stored ledger is append-only and read through this."""
    rows = attempts[0]
    for more in attempts[1:]:
        rows = rows.unionByName(more)
    # all columns, so that an order of outcomes is total however they are put together
    ties = [c for c in rows.columns if c not in ("ticker_yahoo", "fetched_at", "status")]
    last = Window.partitionBy("ticker_yahoo").orderBy(F.desc("fetched_at"), "status", *sorted(ties))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def todo(universe: DataFrame, ledger: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Tickers still to load; errors are tried again, and so are tickers to be replaced."""
    done = ledger.where(F.col("status").isin(*DONE)).select(F.col("ticker_yahoo").alias("ticker"))
    if replaced is not None:
        done = done.join(replaced.select(F.col("ticker_yahoo").alias("ticker")), "ticker", "left_anti")
    return universe.join(done, "ticker", "left_anti")


def failures(log: DataFrame) -> DataFrame:
    return log.where("status = 'error'").select("ticker_yahoo", F.coalesce("error", F.lit("")).alias("error"))


def export_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append an audit or failure list to a folder of files."""
    w = df.write.mode("append").format(fmt)
    (w.option("header", True) if fmt == "csv" else w).save(path)


def export_json(df: DataFrame, path: str) -> T.StructType:
    """Write one JSON object a line: missing values, NaN and infinities as null, dates in ISO form.
    Returns the schema that ``read_json`` reads it by."""
    safe = nan_to_null(df)
    safe.write.option("ignoreNullFields", False).option("dateFormat", "yyyy-MM-dd").json(path)
    return safe.schema


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read by a declared schema; a line that does not fit it ends the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd").json(path)


INPUTS = "quarterline.inputs"


def stored_inputs(spark: SparkSession, table: str) -> str | None:
    """The fingerprint of the files that a derived table was built from."""
    rows = spark.sql(f"show tblproperties {table}").where(F.col("key") == INPUTS).collect()
    return rows[0]["value"] if rows else None


def materialise_table(spark: SparkSession, table: str, build, force: bool = False, inputs: str | None = None,
                      partition_by: str | None = None, sort_by: tuple[str, ...] = ()) -> bool:
    """Build a derived table unless it is there, filled and built from the same ``inputs`` (a
    fingerprint; None: whatever they were). Returns whether it was built.

    The fingerprint is noted after the rows, so a build that was cut off is done again."""
    if not force and filled(spark, table) and inputs in (None, stored_inputs(spark, table)):
        return False
    full_refresh(build(), table, partition_by, sort_by)
    if inputs is not None:
        spark.sql(f"alter table {table} set tblproperties ('{INPUTS}' = '{inputs}')")
    return True
