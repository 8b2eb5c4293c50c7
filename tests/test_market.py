"""Vendor history, split factors, repairs and risk."""
import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quarterline.functions import cleaning
from quarterline.operators import asof, market, quality, risk, splits, universe
from quarterline.plans import fundamentals, validation
from quarterline.sources.market_history import HISTORY_SCHEMA, normalise_history, read_history

NAN = float("nan")


def day(i, start=dt.datetime(2020, 1, 1)):
    return start + dt.timedelta(days=i)


def history(spark, rows):
    """rows: ticker, day number, close, dividend, split, pos"""
    return spark.createDataFrame(
        [(t, day(i), c, c, c, c, c, 10.5, d, s, p) for t, i, c, d, s, p in rows], HISTORY_SCHEMA)


def test_vendor_rules(spark):
    h = history(spark, [
        ("A", 0, 10.0, 0.0, 0.0, 1), ("A", 0, 20.0, 0.5, 0.0, 2),   # last row of a day wins
        ("A", 1, None, 9.0, 3.0, 3),                                # no close: the split is not read either
        ("A", 2, 5.0, NAN, 2.0, 4), ("A", 3, 5.0, -1.0, 0.5, 5), ("A", 4, 5.0, 6.0, NAN, 6),
        ("A", 5, 5.0, 1.0, -2.0, 7), ("A", 89, 4.0, 0.0, 1.5, 8), ("A", 90, 2e7, 0.0, 0.0, 9),
        ("B", 0, 1e13, 2e5, 0.0, 1), ("C", 0, None, 0.0, 0.0, 1),
    ])
    e = market.enriched_history(h)
    f = {(r.ticker, r.date.toordinal() - dt.date(2020, 1, 1).toordinal()): r for r in e.collect()}
    assert len(f) == 8 and f["A", 0].close == 20.0
    # 2 * 0.5 * 1.5 strictly after day 0; a split of the day itself does not count
    assert f["A", 0].factor == 1.5 and f["A", 2].factor == 0.75 and f["A", 89].factor == 1.0
    assert f["A", 0].as_traded == 30.0 and f["B", 0].as_traded is None
    assert {(r.ticker_yahoo, r.ratio) for r in market.stock_split(e).collect()} == {("A", 2.0), ("A", 0.5), ("A", 1.5)}
    # day 90 is the last of its quarter: 2e7 is above the bound and clears it
    assert market.price_quarterly(e).isEmpty()
    div = {r.ex_date.day: (r.amount, r.amount_as_reported, r.quarter) for r in market.dividend(e).collect()}
    assert div == {1: (0.5, 0.75, "2020Q1"), 6: (1.0, 1.5, "2020Q1")}
    c = market.load_counters(e).first()
    # NaN, negative, above the price, above 1e5
    assert (c.prices, c.splits, c.dividends, c.dividends_skipped, c.quarters, c.quarters_skipped) == (8, 3, 2, 4, 0, 2)
    daily = {(r.ticker_yahoo, r.date): r for r in market.price_daily(e).collect()}
    assert daily["B", dt.date(2020, 1, 1)].close is None and daily["A", dt.date(2020, 1, 1)].volume == 10
    u = spark.createDataFrame([("A",), ("C",)], "ticker string")
    assert {tuple(r) for r in market.fetch_status(e, u).collect()} == {("A", "ok", 7), ("C", "empty", 0)}


def test_quarter_close_and_currency(spark):
    e = market.enriched_history(history(spark, [("A", 0, 10.0, 0.0, 0.0, 1), ("A", 5, 11.0, 0.0, 0.0, 1), ("A", 95, 12.0, 0.0, 2.0, 1)]))
    cur = spark.createDataFrame([("A", "EUR")], "ticker string, currency string")
    got = {r.quarter: (r.close_raw, r.close_as_traded, r.currency, r.price_date) for r in market.price_quarterly(e, cur).collect()}
    assert got == {"2020Q1": (11.0, 22.0, "EUR", dt.date(2020, 1, 6)), "2020Q2": (12.0, 12.0, "EUR", dt.date(2020, 4, 5))}


def test_read_history_with_vendor_titles(spark, tmp_path):
    df = spark.createDataFrame([("A", day(0), 1.0, 2.0)], "ticker string, ts timestamp, Close double, `Stock Splits` double")
    df.write.parquet(str(tmp_path / "h"))
    got = read_history(spark, str(tmp_path / "h"))
    assert got.drop("pos").schema.simpleString() == HISTORY_SCHEMA.simpleString().replace(",pos:bigint", "")
    r = got.first()
    # a source without the column has no dividends
    assert (r.close, r.stock_splits, r.dividends) == (1.0, 2.0, 0.0) and r.pos > 0
    assert normalise_history(got).first() == r


def _splits(spark, rows):
    return spark.createDataFrame(rows, "ticker_yahoo string, split_date date, ratio double")


def test_factors_against_loops(spark):
    rnd = random.Random(1)
    d0 = dt.date(2015, 1, 1)
    sp = list({(t, d0 + dt.timedelta(rnd.randint(0, 400))): rnd.choice([2.0, 3.0, 0.5, 1.5, 0.1])
               for t in "ABCD" for _ in range(9 if t != "D" else 0)}.items())
    sp = [(t, d, r) for (t, d), r in sp]
    rows = [(i, rnd.choice("ABCDE"), None if i % 50 == 0 else d0 + dt.timedelta(rnd.randint(-20, 430)),
             d0 + dt.timedelta(rnd.randint(-20, 430))) for i in range(500)]
    rows += [(500 + i, t, d, d) for i, (t, d, _r) in enumerate(sp)]  # on a split day itself
    df = spark.createDataFrame(rows, "id int, t string, a date, b date")
    s = _splits(spark, sp)
    after = {r.id: (r.fa, r.fb) for r in splits.with_factor_after(df, s, "t", {"fa": "a", "fb": "b"}).collect()}
    between = {r.id: r.f for r in splits.with_factor_between(df, s, "t", "a", "b", "f").collect()}
    assert len(after) == len(between) == len(rows)
    for i, t, a, b in rows:
        prod = lambda keep: math.prod(r for x, d, r in sp if x == t and keep(d))
        assert after[i] == pytest.approx((1.0 if a is None else prod(lambda d: d > a), prod(lambda d: d > b)))
        assert between[i] == pytest.approx(1.0 if a is None else prod(lambda d: a < d <= b))


def test_clean_splits(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), 2.0, 2), ("A", dt.date(2020, 1, 1), 3.0, 1), ("A", dt.date(2020, 1, 2), 0.0, 1),
                                ("A", dt.date(2020, 1, 3), NAN, 1), ("A", None, 2.0, 1)], "ticker_yahoo string, split_date date, ratio double, pos int")
    assert [tuple(r) for r in splits.clean_splits(df).collect()] == [("A", dt.date(2020, 1, 1), 3.0)]


def test_asof_against_loops(spark):
    rnd = random.Random(5)
    d0 = dt.date(2020, 1, 1)
    right = {(t, d0 + dt.timedelta(rnd.randint(0, 60))): (rnd.random() if rnd.random() > 0.1 else None) for t in "AB" for _ in range(30)}
    left = [(i, rnd.choice("ABC"), d0 + dt.timedelta(rnd.randint(-5, 70))) for i in range(200)]
    got = {r.id: r.v for r in asof.asof_backward(
        spark.createDataFrame(left, "id int, k string, at date"),
        spark.createDataFrame([(k, d, v) for (k, d), v in right.items()], "k string, d date, v double"), "k", "at", "d", "v").collect()}
    for i, k, at in left:
        past = [(d, v) for (x, d), v in right.items() if x == k and d <= at and v is not None]
        assert got[i] == (max(past)[1] if past else None)


def test_repairs(spark):
    pq = spark.createDataFrame([
        ("A", "2019Q4", 1.0, 1.0, dt.date(2019, 12, 30)), ("A", "2020Q2", 101.0, 101.0, dt.date(2020, 6, 30)),
        ("B", "2019Q4", 1.0, 1.0, dt.date(2019, 12, 30)), ("B", "2020Q1", 100.0, 1e-7, dt.date(2020, 3, 30)), ("B", "2020Q2", 99.0, None, dt.date(2020, 6, 30)),
    ], "ticker_yahoo string, quarter string, close_raw double, close_as_traded double, price_date date")
    kept = quality.drop_tiny_prices(pq)
    assert kept.count() == 4
    bad = quality.corrupt_tickers(kept)
    assert [r[0] for r in bad.collect()] == ["A"]
    out = quality.purge({"pq": kept, "panel": spark.createDataFrame([("A",), ("B",)], "ticker string")}, bad)
    assert out["pq"].count() == 2 and [r[0] for r in out["panel"].collect()] == ["B"]


def test_share_basis(spark):
    d = dt.date
    sh = spark.createDataFrame([(1, "2020Q1", 40284299, d(2020, 4, 20)), (2, "2020Q1", 101, d(2020, 3, 1)), (3, "2020Q1", 7, d(2020, 3, 31)),
                                (4, "2020Q1", 9, d(2020, 1, 1)), (5, "2020Q1", 9 * 10**12, d(2020, 3, 1))], "cik bigint, quarter string, shares bigint, as_of date")
    tm = spark.createDataFrame([(c, f"T{c}") for c in (1, 2, 3, 5)] + [(1, "Z1")], "cik bigint, ticker_yahoo string")
    pq = spark.createDataFrame([(f"T{c}", "2020Q1", d(2020, 3, 31)) for c in (1, 2, 3, 5)], "ticker_yahoo string, quarter string, price_date date")
    sp = _splits(spark, [("T1", d(2020, 4, 1), 3.0), ("T1", d(2020, 5, 1), 9.0), ("T2", d(2020, 3, 31), 1.5), ("T2", d(2020, 3, 1), 7.0),
                         ("T5", d(2020, 3, 5), 2.0)])
    n = quality.normalise_shares(sh, tm, pq, sp)
    got = {r.cik: (r.shares_at_price_basis, r.fallback) for r in n.collect()}
    # halves round up; above the bound the reported count stays
    assert got == {1: (13428100, False), 2: (152, False), 3: (7, False), 4: (9, False), 5: (9 * 10**12, True)}
    assert tuple(quality.normalisation_counts(n).first()) == (5, 2, 1)
    assert validation.unnormalised_straddles(n, tm, pq, sp).count() == 1  # the one that fell back


def brute_risk(rows):
    rows = sorted(rows)
    c = [v if v is not None and 1e-6 < v < 1e7 else None for _d, v in rows]
    if not any(v is not None for v in c):
        return {}
    r = [None] + [b / a - 1 if a is not None and b is not None else None for a, b in zip(c, c[1:])]
    out = {}
    for i, (d, _v) in enumerate(rows):
        win = [x for x in r[max(0, i - 251):i + 1] if x is not None]
        high = [x for x in c[max(0, i - 251):i + 1] if x is not None]
        out[f"{d.year}Q{(d.month - 1) // 3 + 1}"] = (
            d, statistics.stdev(win) * math.sqrt(252) if len(win) >= 120 else None,
            c[i] / c[i - 252] - 1 if i >= 252 and c[i] is not None and c[i - 252] is not None else None,
            c[i] / max(high) - 1 if len(high) >= 60 and c[i] is not None else None)
    return out


def test_risk_against_loops(spark):
    rnd, rows = random.Random(11), []
    # lengths around the block size, gaps, masked closes, one extreme jump, a ticker without any close
    for t, n, miss in (("A", 900, 0.0), ("B", 251, 0.05), ("C", 252, 0.05), ("D", 253, 0.05), ("E", 505, 0.3), ("F", 100, 1.0), ("G", 61, 0.0)):
        d = dt.date(2015, 1, 1)
        for i in range(n):
            d += dt.timedelta(rnd.choice([1, 1, 1, 3]))
            v = rnd.choice([0.0, 1e7, 1e-7]) if rnd.random() < miss else rnd.uniform(10, 20)
            rows.append((t, d, 9e6 if t == "A" and i == 300 else v))
    got = {}
    for r in risk.stock_risk_quarter(spark.createDataFrame(rows, "ticker_yahoo string, date date, close double")).collect():
        got.setdefault(r.ticker_yahoo, {})[r.quarter] = (r.price_date, r.vol_252d, r.ret_252d, r.off_high_252d)
    assert "F" not in got
    for t in "ABCDEG":
        want = brute_risk([(d, v) for x, d, v in rows if x == t])
        assert got[t].keys() == want.keys()
        for q, w in want.items():
            assert got[t][q][0] == w[0]
            for a, b in zip(got[t][q][1:], w[1:]):
                assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9)), (t, q)


def test_one_hot_ticker_with_repeated_days(spark):
    """Half of all rows are one ticker's repeated days: they are combined, and nothing is lost."""
    rows = [("HOT", i % 50, float(i), 0.0, 0.0, i) for i in range(3000)] + [(f"T{i}", i % 50, 1.0, 0.0, 0.0, i) for i in range(3000)]
    d = market.daily_rows(history(spark, rows))
    assert d.where("ticker = 'HOT'").count() == 50 and d.count() == 3050
    assert d.where("ticker = 'HOT'").agg(F.min("close")).first()[0] == 2950.0
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_universe_and_names(spark):
    src = spark.createDataFrame([(1, "One", " brk.b ", "N", 0), (1, "Uno", "BRK.B", "M", 1), (1, None, "brk/b", "N", 2), (2, "", "none-", "N", 3),
                                 (2, "Two", "bad", "N", 4), (3, None, " ", "N", 5)], "cik bigint, name string, ticker string, exchange string, pos bigint")
    exc = spark.createDataFrame([("BAD",)], "ticker string")
    tm = [tuple(r) for r in universe.ticker_map(src, exc).orderBy("ticker_edgar").collect()]
    assert tm == [(1, "BRK.B", "BRK-B", "N"), (1, "BRK/B", "BRK-B", "N")]
    filed = spark.createDataFrame([(1, "Filed", 0), (3, "Three", 1)], "cik bigint, entity_name string, pos bigint")
    assert {tuple(r) for r in universe.company(src, filed).collect()} == {(1, "One"), (2, "Two"), (3, "Three")}
    assert [r.ticker for r in universe.explicit_universe(spark, "b.a, x ,bad,,none-", exc).collect()] == ["B-A", "X"]
    assert [r.ticker for r in universe.excluded_found(src, exc).collect()] == ["BAD"]


def test_view(spark):
    d = dt.date
    eps = spark.createDataFrame([(1, "2020Q1", 1.0), (9, "2020Q1", 5.0)], "cik bigint, quarter string, eps double")
    sh = spark.createDataFrame([(1, "2020Q2", 100, None), (1, "2020Q1", 100, 200)], "cik bigint, quarter string, shares bigint, shares_at_price_basis bigint")
    pq = spark.createDataFrame([("A", "2020Q1", 3.0, 6.0), ("X", "2020Q1", 7.0, None)], "ticker_yahoo string, quarter string, close_raw double, close_as_traded double")
    div = spark.createDataFrame([("B", "2020Q1", 0.5, 1.0), ("B", "2020Q1", 0.25, None), ("B", "2020Q3", 1.0, 1.0)],
                                "ticker_yahoo string, quarter string, amount double, amount_as_reported double")
    tm = spark.createDataFrame([(1, "A", "A"), (1, "B", "B"), (1, "B.", "B"), (2, "A2", "A")], "cik bigint, ticker_edgar string, ticker_yahoo string")
    v = fundamentals.quarterly_fundamentals(eps, sh, pq, div, tm)
    assert validation.view_contract(v).where("not ok").isEmpty()
    got = sorted([tuple(r) for r in v.collect()], key=str)
    assert got == sorted([
        ("2020Q1", "A", 6.0, 200.0, 1.0, None), ("2020Q1", "A", 6.0, None, None, None), ("2020Q1", "B", None, 200.0, 1.0, 1.25),
        ("2020Q1", "X", 7.0, None, None, None), ("2020Q2", "A", None, 100.0, None, None), ("2020Q2", "B", None, 100.0, None, None),
        ("2020Q3", "B", None, None, None, 1.0)], key=str)
    assert validation.duplicates(v, "quarter", "ticker symbol").count() == 1


def test_cleaning(spark):
    r = spark.createDataFrame([(2.5, NAN, float("inf"), 1e12, 9.3e18)], "a double, b double, c double, d double, e double").select(
        cleaning.sane_long(F.col("a")), cleaning.sane_number(F.col("b")), cleaning.finite(F.col("c")), cleaning.sane_number(F.col("d")),
        cleaning.sane_long(F.col("e"))).first()
    assert tuple(r) == (2, None, None, None, None)
    df = spark.createDataFrame([(NAN, dt.date(2020, 1, 2), 1)], "x double, d date, n int")
    assert cleaning.to_json_rows(df).first().json == '{"x":null,"d":"2020-01-02","n":1}'


def test_counts_come_from_the_write(spark, tmp_path):
    """The same counters as of a second pass, with one scan of the history."""
    from pyspark.sql import Observation

    from quarterline.plans import load

    rng = random.Random(8)
    rows = [(f"T{rng.randrange(9)}", rng.randrange(400), rng.choice([None, 5.0, 2e7, 12.5]), rng.choice([0.0, 0.0, NAN, -1.0, 0.5, 90.0, None]),
             rng.choice([0.0, 0.0, 2.0, NAN, -3.0]), k) for k in range(900)]
    path = str(tmp_path / "h")
    history(spark, rows).write.parquet(path)
    h = spark.read.parquet(path)
    got = load.load_market(h)
    want = market.load_counters(market.enriched_history(h)).first().asDict()
    assert got.counts == want and all(want.values())
    assert got.tables["daily"].count() == want["prices"] and got.tables["price_quarterly"].count() == want["quarters"]
    plan = market.observed_daily(market.enriched_history(h), Observation())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1
    # the counters' windows need no exchange of their own
    assert plan.count("Exchange hashpartitioning") == 2
    assert load.load_market(h.where("false")).counts == {k: 0 for k in want}


def test_view_contract(spark):
    """Another name, another type, a column too many or too few: each is a row."""
    good = spark.createDataFrame([("2020Q1", "A", 1.0, 2.0, None, 0.0)], "quarter string, `ticker symbol` string, price double, `shares outstanding` double, EPS double, Dividends double")
    rows = {r.position: r for r in validation.view_contract(good).collect()}
    assert len(rows) == 6 and all(r.ok for r in rows.values()) and [rows[k].n_values for k in range(1, 7)] == [1, 1, 1, 1, 0, 1]
    bad = lambda df: {r.position: (r.name, r.type, r.wanted_name) for r in validation.view_contract(df).where("not ok").collect()}
    assert bad(good.withColumn("EPS", F.col("EPS").cast("decimal(18,6)"))) == {5: ("EPS", "decimal(18,6)", "EPS")}
    assert bad(good.withColumnRenamed("EPS", "eps")) == {5: ("eps", "double", "EPS")}
    assert bad(good.withColumn("more", F.lit(1))) == {7: ("more", "int", None)}
    assert bad(good.drop("Dividends")) == {6: (None, None, "Dividends")}


def test_wrong_figures_show_up(spark):
    """A wrong as-traded close, as-paid dividend and fourth quarter, planted one at a time."""
    h = history(spark, [("A", 0, 100.0, 0.0, 0.0, 1), ("A", 0, 90.0, 1.0, 0.0, 2), ("A", 30, 50.0, 0.5, 2.0, 3), ("A", 100, 20.0, 0.25, 3.0, 4),
                        ("A", 120, None, 9.0, 7.0, 5), ("A", 200, 19.0, 0.0, NAN, 6), ("B", 3, 7.0, 0.0, 0.0, 1)])
    raw = h.withColumn("date", F.to_date("ts"))
    e = market.enriched_history(h)
    prices, paid = market.price_quarterly(e), market.dividend(e)
    kinds = lambda p, d: [(r.kind, r.ticker_yahoo, r.date.isoformat()) for r in validation.basis_mismatches(p, d, raw).collect()]
    assert {(r.date.isoformat(), round(r.traded, 9)) for r in validation.forward_basis(raw).where("ticker_yahoo = 'A'").collect()} == {
        ("2020-01-01", 540.0), ("2020-01-31", 150.0), ("2020-04-10", 20.0), ("2020-07-19", 19.0)}
    assert kinds(prices, paid) == []
    on = F.col("quarter") == "2020Q1"
    wrong = lambda c: F.when(on & (F.col("ticker_yahoo") == "A"), F.col(c) * 2).otherwise(F.col(c))
    assert kinds(prices.withColumn("close_as_traded", wrong("close_as_traded")), paid) == [("close", "A", "2020-01-31")]
    on_day = F.when(F.col("ex_date") == "2020-01-31", F.col("amount")).otherwise(F.col("amount_as_reported"))
    assert kinds(prices, paid.withColumn("amount_as_reported", on_day)) == [("dividend", "A", "2020-01-31")]
    # a close on a day the vendor has no row for
    other = prices.withColumn("price_date", F.date_add("price_date", 1))
    assert {k for k, *_ in kinds(other, paid)} == {"close"}

    quarters = spark.createDataFrame([(1, 2020, 1, 1.0), (1, 2020, 2, 2.0), (1, 2020, 3, 3.0), (2, 2020, 1, 1.0), (2, 2020, 2, 1.0), (2, 2020, 3, 1.0), (2, 2020, 4, 7.0),
                                      (3, 2020, 1, 1.0), (3, 2020, 2, 1.0), (4, 2020, 1, 1.0), (4, 2020, 2, 1.0), (4, 2020, 3, 1.0)], "cik int, year int, q int, amount double")
    years = spark.createDataFrame([(1, 2020, 10.0), (2, 2020, 99.0), (3, 2020, 5.0)], "cik int, year int, amount double")
    want = validation.fourth_quarters(quarters, years).withColumn("quarter", F.concat("year", F.lit("Q4"))).withColumnRenamed("amount", "eps")
    # the year less three, the filed one, two quarters only, no year
    assert {(r.cik, r.eps) for r in want.collect()} == {(1, 4.0), (2, 7.0)}
    stored = spark.createDataFrame([(1, "2020Q4", 4.0), (2, "2020Q4", 7.0)], "cik int, quarter string, eps double")
    off = lambda df: {r.cik for r in validation.anchors(df, want, ["cik", "quarter"], "eps").collect()}
    assert off(stored) == set()
    assert off(stored.withColumn("eps", F.when(F.col("cik") == 1, F.col("eps") + 0.01).otherwise(F.col("eps")))) == {1}
    assert off(stored.where("cik = 1")) == {2}


def test_corrupt_marks_are_the_jumps(spark):
    rng = random.Random(12)
    rows = [(f"T{t}", f"{2000 + q // 4}Q{q % 4 + 1}", rng.choice([None, 0.0, -1.0, 1.0, 5.0, 90.0, 101.0, 0.05])) for t in range(40) for q in range(9) if rng.random() < 0.8]
    pq = spark.createDataFrame(rows, "ticker_yahoo string, quarter string, close_raw double")
    marked = quality.with_corrupt_mark(pq)
    assert marked.count() == len(rows)
    want = {r.ticker_yahoo for r in quality.corrupt_tickers(pq).collect()}
    assert {(r.ticker_yahoo, r.corrupt) for r in marked.collect()} == {(t, t in want) for t, *_ in rows} and 0 < len(want) < 40


def test_a_purge_left_out_shows_up(spark, monkeypatch):
    from quarterline.plans.domain import Domain
    from quarterline.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    done = QUERIES["dq_stale_rows"](spark, folder).first()
    assert (done.n, done.jumping) == (0, 0) and not Domain.of(spark, folder).purged_keys.isEmpty()
    d = Domain(spark, folder)
    monkeypatch.setattr(quality, "purge", lambda tables, corrupt: tables)
    left = validation.stale_rows(d.price_quarterly, d.purged_keys).first()
    assert left.n == d.purged_keys.count() > 0 and left.jumping > 0


def test_daily_rows_are_dealt_to_tasks(spark):
    """As many tasks as the rows need, whatever the session's number of partitions; the same rows."""
    rnd = random.Random(4)
    h = history(spark, [(f"T{rnd.randrange(9)}", rnd.randrange(40), rnd.choice([None, 5.0, 7.5]), 0.1, rnd.choice([0.0, 2.0]), p) for p in range(600)])
    plain, dealt = market.enriched_history(h), market.enriched_history(h, 7)
    assert sorted(dealt.collect()) == sorted(plain.collect())
    assert dealt.rdd.getNumPartitions() == 7
    risks = risk.stock_risk_quarter(market.price_daily(dealt))  # on the same deal
    assert risks.rdd.getNumPartitions() == 7
    assert market.tasks_for(0) == 1 and market.tasks_for(10 * market.TASK_ROWS) == 11


def test_the_panel_is_dealt_to_tasks(spark, tmp_path, monkeypatch):
    """By ticker, to as many tasks as the daily rows need; the same rows."""
    from quarterline.plans.domain import Domain
    from quarterline.plans.panel import dense_panel

    folder = str(tmp_path)
    spark.range(500).selectExpr(
        "id as l_orderkey", "id % 11 as l_partkey", "id % 7 as l_suppkey", "cast(id % 3 as int) as l_linenumber",
        "cast(1 + id % 5 as double) as l_quantity", "cast((1 + id % 5) * (20 + id % 13) as double) as l_extendedprice",
        "0.05D as l_discount", "0.02D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus",
        "cast(date_add(date '1996-01-01', cast(id * 3 as int)) as timestamp) as l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(7).selectExpr("id as s_suppkey", "concat('Name ', id) as s_name", "0L as s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.range(1).selectExpr("id as n_nationkey", "'Here' as n_name").write.parquet(f"{folder}/nation.parquet")
    plain = dense_panel(Domain.of(spark, folder).raw_panel).collect()
    Domain.forget(spark, folder)
    monkeypatch.setattr(market, "TASK_ROWS", 60)
    dealt = dense_panel(Domain.of(spark, folder).raw_panel)
    assert Domain.of(spark, folder).tasks == 9 == dealt.rdd.getNumPartitions()
    assert plain and sorted(map(str, dealt.collect())) == sorted(map(str, plain))
    Domain.forget(spark, folder)
