"""Builders of tiny frames."""
from __future__ import annotations

import datetime as dt

from quarterline.functions.quarters import label_to_qidx

PANEL = ("ticker string, quarter string, qidx int, px_adj double, div_adj double, pe double, mktcap double, "
         "div_yield double, eps4_min double, vol_252d double, ret_252d double, name string")
RAW = ("quarter string, ticker string, price_traded double, shares double, eps double, eps_filed date, "
       "eps_period_end date, eps_is_derived boolean, px_adj double, price_date date, div_adj double, "
       "vol_252d double, ret_252d double, off_high_252d double, cik bigint, name string")
SPLITS = "ticker_yahoo string, split_date date, ratio double"


#: What a panel row has unless a test says otherwise: a name that every default limit takes.
ORDINARY = {"div_adj": 0.0, "pe": 9.0, "mktcap": 3e9, "div_yield": 0.01, "eps4_min": 0.5, "vol_252d": 0.3, "ret_252d": 0.05}


def at(quarter, **names):
    """The rows of one quarter: a price, or a dict of columns with a ``px_adj`` among them."""
    rows = []
    for ticker, said in names.items():
        cell = {**ORDINARY, **(said if isinstance(said, dict) else {"px_adj": said})}
        if ticker == "SPY":  # the benchmark is no company
            cell["pe"] = None
        rows.append((ticker, quarter, label_to_qidx(quarter), cell["px_adj"], *(cell[c] for c in ORDINARY), ticker))
    return rows


def over(first, columns):
    """Rows of consecutive quarters from ``first`` on: by ticker a list of prices or dicts, in which
    None leaves the quarter out."""
    start = label_to_qidx(first)
    return [r for ticker, cells in columns.items() for i, cell in enumerate(cells) if cell is not None
            for r in at(f"{(start + i) // 4}Q{(start + i) % 4 + 1}", **{ticker: cell})]


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def quarter_end(label):
    q = label_to_qidx(label)
    y, m = q // 4, 3 * (q % 4 + 1)
    return dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)


def raw_rows(ticker, quarters, eps, px=100.0, shares=1000.0, filed=None, cik=1):
    return [(q, ticker, px, shares, None if e is None else float(e), filed, quarter_end(q), False, px,
             quarter_end(q), 0.0, 0.2, 0.0, 0.0, cik, ticker) for q, e in zip(quarters, eps)]


def column(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]
