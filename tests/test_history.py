"""History files: the exchange's days in any session zone, and the order of rows in files."""
import contextlib
import datetime as dt
import random

import pytest

from quarterline.operators import market
from quarterline.sources.market_history import normalise_history, read_history

ZONES = ["UTC", "Asia/Tokyo", "America/New_York", "Pacific/Kiritimati"]


@contextlib.contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def days(history):
    return sorted((r.ticker, r.date.isoformat(), r.close) for r in market.daily_rows(history).collect())


def csv(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("ticker,ts,Close\n" + "".join(f"{t},{ts},{c}\n" for t, ts, c in rows))


TEXTS = [
    ("T", "2020-01-06 00:00:00+09:00", 1.0), ("T", "2020-01-07T00:00:00.000+09:00", 2.0), ("N", "2020-01-06 00:00:00-05:00", 3.0),
    ("N", "2020-01-06 23:59:59.999999-05:00", 4.0), ("Z", "2020-01-06T23:30:00Z", 5.0), ("D", "2020-01-06", 6.0), ("D", " 2020-01-07 09:30", 7.0),
    ("B", "not a day", 8.0), ("B", "", 9.0), ("B", "2020-02-30 00:00:00", 9.0),
]
WANT = [("D", "2020-01-06", 6.0), ("D", "2020-01-07", 7.0), ("N", "2020-01-06", 4.0), ("T", "2020-01-06", 1.0), ("T", "2020-01-07", 2.0), ("Z", "2020-01-06", 5.0)]


@pytest.mark.parametrize("zone", ZONES)
def test_texts_stay_on_their_day(spark, tmp_path, zone):
    csv(tmp_path / "h", "a.csv", TEXTS)
    with setting(spark, "spark.sql.session.timeZone", zone):
        assert days(read_history(spark, str(tmp_path / "h"), "csv")) == WANT


@pytest.mark.parametrize("zone", ZONES)
def test_instants_are_dated_in_the_exchange_zone(spark, tmp_path, zone):
    utc = dt.timezone.utc
    rows = [("T", dt.datetime(2020, 1, 5, 15, tzinfo=utc), "Asia/Tokyo", 1.0), ("N", dt.datetime(2020, 7, 7, 3, 59, 59, 250000, tzinfo=utc), "America/New_York", 2.0),
            ("O", dt.datetime(2020, 1, 5, 18, 30, tzinfo=utc), "+05:30", 3.0), ("U", dt.datetime(2020, 1, 6, tzinfo=utc), None, 4.0),
            ("E", dt.datetime(1960, 1, 6, 0, 0, 0, 1, tzinfo=utc), "UTC", 5.0)]
    made = spark.createDataFrame(rows, "ticker string, ts timestamp, zone string, Close double")
    made.write.parquet(str(tmp_path / "h"))
    made.drop("zone").where("ticker = 'T'").write.parquet(str(tmp_path / "t"))
    with setting(spark, "spark.sql.session.timeZone", zone):
        got = read_history(spark, str(tmp_path / "h"))
        assert days(got) == [("E", "1960-01-06", 5.0), ("N", "2020-07-06", 2.0), ("O", "2020-01-06", 3.0), ("T", "2020-01-06", 1.0), ("U", "2020-01-06", 4.0)]
        clocks = {r.ticker: r.ts for r in got.collect()}
        assert clocks["N"] == dt.datetime(2020, 7, 6, 23, 59, 59, 250000) and clocks["E"] == dt.datetime(1960, 1, 6, 0, 0, 0, 1)
        assert days(read_history(spark, str(tmp_path / "t"), zone="Asia/Tokyo")) == [("T", "2020-01-06", 1.0)]
        assert days(read_history(spark, str(tmp_path / "t"))) == [("T", "2020-01-05", 1.0)]


def test_csv_and_parquet_agree(spark, tmp_path):
    csv(tmp_path / "c", "a.csv", TEXTS)
    spark.createDataFrame(TEXTS, "ticker string, ts string, Close double").coalesce(1).write.parquet(str(tmp_path / "p"))
    assert days(read_history(spark, str(tmp_path / "c"), "csv")) == days(read_history(spark, str(tmp_path / "p"))) == WANT


@pytest.mark.parametrize("block", ["128m", "700"])
def test_the_last_row_of_the_last_file_stays(spark, tmp_path, block):
    """Also where a file is read in many blocks, whose tasks Spark numbers by size."""
    rng = random.Random(6)
    want = {}
    for name in ("part 1.csv", "part-2.csv", "part-3%20.csv"):
        rows = [(f"T{rng.randrange(6)}", f"2020-01-{rng.randrange(1, 4):02d} 00:00:00+09:00", round(rng.random(), 6)) for _ in range(200)]
        csv(tmp_path / "h", name, rows)
        want.update({(t, ts[:10]): c for t, ts, c in rows})
    with setting(spark, "spark.sql.files.maxPartitionBytes", block):
        history = read_history(spark, str(tmp_path / "h"), "csv")
        assert history.rdd.getNumPartitions() > 10 or block != "700"
        assert days(history) == sorted((*k, v) for k, v in want.items())


def test_a_later_clock_comes_before_the_place_in_the_file(spark, tmp_path):
    csv(tmp_path / "h", "a.csv", [("A", "2020-01-06 16:00:00-05:00", 1.0), ("A", "2020-01-06 09:30:00-05:00", 2.0)])
    assert days(read_history(spark, str(tmp_path / "h"), "csv")) == [("A", "2020-01-06", 1.0)]


def test_a_given_position_is_kept(spark, tmp_path):
    rows = [("A", "2020-01-06 10:00:00", 1.0, 7), ("A", "2020-01-06 11:00:00", 2.0, 3)]
    spark.createDataFrame(rows, "ticker string, ts string, Close double, pos long").write.parquet(str(tmp_path / "h"))
    assert days(read_history(spark, str(tmp_path / "h"))) == [("A", "2020-01-06", 1.0)]


def test_rows_in_memory(spark):
    """No file: the clock alone decides."""
    df = spark.createDataFrame([("A", "2020-01-06T10:00:00Z", 1.0), ("A", "2020-01-06T11:00:00Z", 2.0)], "ticker string, ts string, Close double")
    assert days(normalise_history(df)) == [("A", "2020-01-06", 2.0)]


def test_days_are_hash_aggregated(spark, tmp_path):
    csv(tmp_path / "h", "a.csv", TEXTS)
    plan = market.daily_rows(read_history(spark, str(tmp_path / "h"), "csv"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
