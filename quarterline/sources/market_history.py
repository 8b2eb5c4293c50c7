"""Reader of daily vendor history. Closes must be adjusted for splits, not for dividends.

``ts`` is the vendor's own wall clock, without a zone: a day is the exchange's day, whatever zone
the session or the file is in.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType()),
    T.StructField("pos", T.LongType()),
])
# fixed values: the vendor's column titles
VENDOR_NAMES = {
    "Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close",
    "Volume": "volume", "Dividends": "dividends", "Stock Splits": "stock_splits",
}
#: The parts of a row's place in its source, as ``read_history`` adds them.
FILE, BLOCK, LINE = "_file_rank", "_file_block", "_line"
ROW_IN_TASK = (1 << 33) - 1
_TEXT = r"^\s*(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?))?"


def local_time(df: DataFrame, zone: str | None = None) -> Column:
    """The wall clock that ``ts`` stands for, as a timestamp without zone.

    A text says it itself: its date and time are local and the offset behind them plays no part. A
    timestamp without zone and a date are taken as they are. A timestamp with zone is an instant,
    of which Parquet keeps no offset; it is read in the zone that a column ``zone`` (a name or an
    offset) or else the argument gives, or in UTC. The session's zone is never asked.
    """
    kind = df.schema["ts"].dataType
    ts = F.col("ts")
    if isinstance(kind, T.StringType):
        clock = F.nullif(F.regexp_extract("ts", _TEXT, 2), F.lit(""))
        return F.concat_ws(" ", F.regexp_extract("ts", _TEXT, 1), F.coalesce(clock, F.lit("00:00"))).try_cast("timestamp_ntz")
    if not isinstance(kind, T.TimestampType):
        return ts.cast("timestamp_ntz")
    own = F.coalesce(F.col("zone") if "zone" in df.columns else F.lit(None).cast("string"), F.lit(zone or "UTC"))
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_micros(ts).cast("decimal(18,0)") / 1000000)
    return F.convert_timezone(F.lit("UTC"), own, utc)


def _source_order(df: DataFrame) -> Column:
    """The order in which rows of one day count: by wall clock, then file, place in the file. One
    number, as the daily aggregation keeps fixed-width buffers only."""
    of_day = (F.hour("ts") * 60 + F.minute("ts")) * 60 + F.extract(F.lit("SECOND"), "ts")
    digits = lambda c: F.col(c).cast("decimal(38,0)") if c in df.columns else F.lit(0).cast("decimal(38,0)")
    # 11 digits of the day's microseconds, 6 of the file, 11 of the block, 10 of the line
    return (((of_day * 1000000).cast("decimal(11,0)").cast("decimal(38,0)") * 10**6 + digits(FILE)) * 10**11 + digits(BLOCK)) * 10**10 + digits(LINE)


def normalise_history(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Bring vendor titles to column names and add what is absent as NULL.

    ``pos`` decides between two rows of one day: the greater one stays. A source without it gets
    the later wall clock and, if ``read_history`` has read it, the later file by name and the later
    row of the file. A source without dividends or splits has none. Rows whose time cannot be read
    are left out.
    """
    for vendor, name in VENDOR_NAMES.items():
        if vendor in df.columns:
            df = df.withColumnRenamed(vendor, name)
    df = df.withColumn("ts", local_time(df, zone)).where("ts is not null")
    cols = []
    for f in HISTORY_SCHEMA.fields:
        if f.name == "pos":
            cols.append((F.col("pos") if "pos" in df.columns else _source_order(df)).alias("pos"))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("dividends", "stock_splits"):
            cols.append(F.lit(0.0).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _with_place(df: DataFrame) -> DataFrame:
    """Each row's file by rank of its name, its block and its number in the task that reads it.
    Blocks of a file are read row by row, so these order a file's rows as they stand in it. The
    list of files is Spark's own, one entry for each."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    ranks = spark.createDataFrame(list(enumerate(files)), f"{FILE} int, _file string")
    placed = df.select(
        "*", F.input_file_name().alias("_file"), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_TASK)).alias(LINE))
    known = placed.join(F.broadcast(ranks), "_file", "left").drop("_file")
    return known.withColumn(FILE, F.coalesce(F.col(FILE), F.raise_error(F.lit("a file that was not listed")).cast("int")))


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", zone: str | None = None) -> DataFrame:
    """History files of any format; all columns of a CSV file are read as text."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    return normalise_history(df if "pos" in df.columns else _with_place(df), zone)
