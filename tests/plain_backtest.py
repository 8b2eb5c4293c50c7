"""The backtest as a loop over quarters and names, to hold the plan against."""
from __future__ import annotations

import datetime as dt
import statistics

from quarterline.constants import WIN_BENCH, WIN_NA, WIN_TIE, WIN_VALUE


def label(q):
    return f"{q // 4}Q{q % 4 + 1}"


def last_day(q):
    y, m = divmod(q * 3 + 3, 12)
    return dt.date(y, m + 1, 1) - dt.timedelta(days=1)


def passes(c, p):
    """``c``: a panel row as a dict; ``p``: the screen's limits."""
    def within(x, low, high):
        return x is not None and (low is None or x >= low) and (high is None or x <= high)

    ok = c["px_adj"] is not None and c["px_adj"] > 0 and within(c["pe"], p.pe_min, p.pe_max)
    if p.mcap_min_b is not None or p.mcap_max_b is not None:
        ok = ok and within(c["mktcap"], (p.mcap_min_b or 0) * 1e9, None if p.mcap_max_b is None else p.mcap_max_b * 1e9)
    ok = ok and (c["div_yield"] or 0.0) >= p.min_div_yield
    ok = ok and (not p.require_pos_eps4 or (c["eps4_min"] is not None and c["eps4_min"] > 0))
    ok = ok and (p.vol_max is None or within(c["vol_252d"], None, p.vol_max))
    return ok and (p.min_ret_12m is None or within(c["ret_252d"], p.min_ret_12m, None))


def returns(cells, first, last, mode):
    """Of one name by quarter; ``cells`` by quarter."""
    out, known, before, gone = {}, None, None, False
    for q in range(first, last + 1):
        c = cells.get(q) or {}
        px, paid = c.get("px_adj"), c.get("div_adj") or 0.0
        if mode == "writeoff" and not gone and px is None and before is not None:
            out[q], gone = -1.0, True
        elif gone or known is None:
            out[q] = 0.0
        else:
            out[q] = ((px if px is not None else known) + paid) / known - 1
        known, before = px if px is not None else known, px
    return out


def simulate(rows, p, of_year):
    """``rows``: dicts of a panel. Returns series, holdings, comparison and stats, or None if nothing
    can be evaluated."""
    names = {}
    for c in rows:
        names.setdefault(c["ticker"], {})[c["qidx"]] = c
    every = {c["qidx"] for c in rows}
    first, last = min(every), max(every)
    chosen = {q: sorted(t for t, cells in names.items() if q in cells and passes(cells[q], p)) for q in range(first, last + 1)}
    grid = [q for q in range(first, last) if q % 4 in of_year and (p.start_year is None or q >= 4 * p.start_year)]
    start = next((q for q in grid if chosen[q]), None)
    if start is None:
        return None
    grid = [q for q in grid if q >= start]
    r = {t: returns(cells, first, last, p.delist_mode) for t, cells in names.items()}
    held, value, bench, series = {}, 100.0, 100.0, [(label(start), 100.0, 100.0)]
    for q in range(start, last):
        if q in grid:
            held = {t: value / len(chosen[q]) for t in chosen[q]}
            cash = 0.0 if held else value
        held = {t: money * (1 + r[t][q + 1]) for t, money in held.items()}
        value = sum(held.values()) + cash
        bench *= 1 + r.get("SPY", {}).get(q + 1, 0.0)
        series.append((label(q + 1), value, bench))
    holdings = [(label(q), t, 1 / len(chosen[q])) for q in grid for t in chosen[q]]
    return series, holdings, compare(series), stats(series, [len(chosen[q]) for q in grid], start, last)


def compare(series):
    out = []
    for (_, p0, b0), (q, p1, b1) in zip(series, series[1:]):
        a, b = (p1 / p0 - 1 if p0 else None), (b1 / b0 - 1 if b0 else None)
        d = None if a is None or b is None else a - b
        out.append((q, a, b, d, WIN_NA if d is None else WIN_TIE if abs(d) < 1e-12 else WIN_VALUE if d > 0 else WIN_BENCH))
    return out


def stats(series, sizes, start, last):
    years = (last_day(last) - last_day(start)).days / 365.25
    won, out = compare(series), {"n_rebalances": len(sizes), "avg_holdings": sum(sizes) / len(sizes), "min_holdings": min(sizes), "years": years}
    for who, k in (("portfolio", 1), ("benchmark", 2)):
        line = [s[k] for s in series]
        changes = [c[k] for c in won if c[k] is not None]
        out |= {f"{who}_final": line[-1], f"{who}_total_return": line[-1] / 100 - 1, f"{who}_cagr": (line[-1] / 100) ** (1 / years) - 1 if line[-1] > 0 else None,
                f"{who}_max_dd": min(x / max(line[:i + 1]) - 1 for i, x in enumerate(line)),
                f"{who}_mean_quarterly_return": statistics.fmean(changes), f"{who}_median_quarterly_return": statistics.median(changes)}
    for name, who in (("value_win", WIN_VALUE), ("benchmark_win", WIN_BENCH), ("tie", WIN_TIE)):
        out[f"{name}_quarters"] = sum(c[-1] == who for c in won)
    return out
