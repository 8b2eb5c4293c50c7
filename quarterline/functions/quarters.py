"""Quarter labels ``YYYYQn``, their dense index and their end dates, as column expressions."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterline.constants import SNAP_DAYS


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def snap_quarter(day: Column) -> Column:
    """Label of a filing period: an end on days 1-7 belongs to the quarter before.

    52/53-week filers close on the nearest weekend. Market data is never snapped.
    """
    return quarter_label(
        F.when(F.dayofmonth(day) <= SNAP_DAYS, F.date_sub(day, SNAP_DAYS)).otherwise(day)
    )


def day_qidx(day: Column) -> Column:
    return (F.year(day) * 4 + F.quarter(day) - 1).cast("int")


def qidx(label: Column) -> Column:
    parts = F.split(F.upper(label), "Q")
    return (parts[0].cast("int") * 4 + parts[1].cast("int") - 1).cast("int")


def quarter_from_idx(idx: Column) -> Column:
    return F.concat(
        F.floor(idx / 4).cast("string"), F.lit("Q"), (F.pmod(idx, F.lit(4)) + 1).cast("string")
    )


def quarter_end_from_idx(idx: Column) -> Column:
    return F.last_day(
        F.make_date(F.floor(idx / 4).cast("int"), (F.pmod(idx, F.lit(4)) * 3 + 3).cast("int"), F.lit(1))
    )


def quarter_end(label: Column) -> Column:
    return F.last_day(
        F.make_date(
            F.substring(label, 1, 4).cast("int"),
            (F.substring(label, 6, 1).cast("int") * 3).cast("int"),
            F.lit(1),
        )
    )


def last_complete_qidx(as_of: dt.date) -> int:
    """Index of the quarter before the one ``as_of`` falls in."""
    return as_of.year * 4 + (as_of.month - 1) // 3 - 1


def last_complete_quarter(as_of: dt.date) -> str:
    i = last_complete_qidx(as_of)
    return f"{i // 4}Q{i % 4 + 1}"


def label_to_qidx(label: str) -> int:
    year, q = label.upper().split("Q")
    return int(year) * 4 + int(q) - 1
