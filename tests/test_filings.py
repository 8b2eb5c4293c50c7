"""Filing documents, facts and the two quarterly derivations, against plain restatements of the rules."""
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from quarterline.operators import earnings, facts, shares
from quarterline.sources import filings, reference_lists

AS_OF = dt.date(2026, 1, 1)
BASIC, DILUTED = "us-gaap:EarningsPerShareBasic", "us-gaap:EarningsPerShareDiluted"
DEI, GAAP = "dei:EntityCommonStockSharesOutstanding", "us-gaap:CommonStockSharesOutstanding"


def fact(start, end, val, filed="2020-05-01", accn="a1", form="10-Q", **more):
    f = {"end": end, "val": val, "filed": filed, "accn": accn, "form": form, "fy": 2020, "fp": "Q1", **more}
    if start:
        f["start"] = start
    return f


@pytest.fixture
def documents(spark, tmp_path):
    one = {"cik": 320, "entityName": "One Corp", "facts": {
        "us-gaap": {
            "EarningsPerShareBasic": {"units": {"USD/shares": [
                fact("2020-01-01", "2020-03-31", 1, filed="", accn="z"),
                fact("2020-01-01", "2020-03-31", 2.5, filed="2020-05-01", accn="b"),
                fact("2020-01-01", "2020-03-31", 3, filed="2020-05-01", accn="a"),
                fact("2020-01-01", "2020-03-31", 4, filed="2021-05-01", accn="a"),
                {"start": "2020-04-01", "val": 9, "filed": "2020-08-01"},
                {"start": "2020-04-01", "end": "2020-06-30", "filed": "2020-08-01"},
                fact("2020-04-01", "2207-06-30", 9), fact("garbage", "2020-06-30", 9), fact("2020-04-01", "x", 9),
            ], "USD": [fact("2020-01-01", "2020-03-31", 77)]}},
            "Revenues": {"units": {"USD": [fact("2020-01-01", "2020-03-31", 1e9)]}},
            "CommonStockSharesOutstanding": {"units": {"shares": [fact(None, "2020-03-31", 1000)]}},
            "EarningsPerShareDiluted": {"units": {}},
        },
        "dei": {"EntityCommonStockSharesOutstanding": {"units": {"shares": [fact(None, "2020-04-20", 12345678901)]}},
                "EntityPublicFloat": {"units": {"USD": [fact(None, "2020-06-30", 5e8)]}}},
        "other": {"X": {"units": {}}},
    }}
    (tmp_path / filings.entry_name(320)).write_text(json.dumps(one))
    (tmp_path / filings.entry_name(77)).write_text(json.dumps({"entityName": "No Cik", "facts": {"dei": {
        "EntityCommonStockSharesOutstanding": {"units": {"shares": [fact(None, "2020-01-02", 5)]}}}}}))
    (tmp_path / filings.entry_name(5)).write_text("{broken")
    (tmp_path / filings.entry_name(6)).write_text(json.dumps({"cik": 6}))
    return str(tmp_path)


def test_documents(spark, documents):
    docs = filings.read_documents(spark, documents)
    got = {r.file_name[-9:-5].lstrip("0"): (r.cik, r.entity_name, r.is_error) for r in docs.collect()}
    assert got == {"320": (320, "One Corp", False), "77": (77, "No Cik", False), "5": (5, None, True), "6": (6, None, False)}
    assert filings.load_counts(docs).first().errors == 1
    assert {r.entity_name for r in filings.company_names(docs).collect()} == {"One Corp", "No Cik"}
    some = filings.read_documents(spark, documents, ciks=[6, 320, 999])
    assert sorted(r.cik for r in some.collect()) == [6, 320]


def files_read(df):
    """How many files a read has opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numFiles").value()


def test_subset_by_one_listing(spark, documents, tmp_path, monkeypatch):
    """Files of other companies are not opened, and the file system is not asked for each one."""
    assert files_read(filings.read_documents(spark, documents)) == 4
    some = filings.read_documents(spark, documents, ciks=[5, 77, *range(1000, 3000)])
    assert files_read(some) == 2 and {r.cik for r in some.collect()} == {5, 77}
    assert filings.read_documents(spark, documents, ciks=[]).collect() == []
    # the layout that Spark writes: a partition for each document
    texts = spark.createDataFrame([(filings.entry_name(c), json.dumps({"cik": c, "entityName": f"N{c}"}) if c != 3 else "{") for c in range(1, 9)],
                                  "document string, text string")
    folder = str(tmp_path / "written")
    filings.write_documents(texts, folder)
    every = filings.read_documents(spark, folder)
    assert {(r.cik, r.entity_name, r.is_error, r.file_name) for r in every.collect()} == {
        (c, f"N{c}" if c != 3 else None, c == 3, filings.entry_name(c)) for c in range(1, 9)}
    some = filings.read_documents(spark, folder, ciks=[3, 4, 99])
    assert files_read(some) == 2 and sorted(r.cik for r in some.collect()) == [3, 4]
    assert "PartitionFilters: [document" in some._jdf.queryExecution().executedPlan().toString()


def test_fact_rows(spark, documents):
    rows = filings.explode_facts(filings.read_documents(spark, documents))
    parsed = facts.parse_facts(rows, AS_OF)
    assert facts.skipped_count(parsed).first().skipped == 1
    first = {(r.cik, r.concept): r for r in facts.earliest_filed(parsed).collect()}
    assert len(first) == 5
    eps = first[320, BASIC]
    # the smallest filing date, then accession number; an unknown date comes last
    assert (eps.value, eps.accn, eps.filed, eps.duration_days) == (3.0, "a", dt.date(2020, 5, 1), 90)
    sh = first[320, DEI]
    assert (sh.value, sh.is_instant, sh.duration_days, sh.period_start) == (12345678901.0, True, None, dt.date(2020, 4, 20))
    tables = facts.fact_tables(facts.earliest_filed(parsed))
    assert {k: v.count() for k, v in tables.items()} == {"eps_facts": 1, "shares_facts": 3, "public_float_facts": 1}
    assert dict(tables["shares_facts"].dtypes)["value"] == "decimal(28,0)"


@pytest.mark.parametrize("layout", ["lists", "objects"])
def test_ticker_map_layouts(spark, tmp_path, layout):
    rows = [(1, "One", "brk.b", "NYSE"), ("2", None, "x/y", None), ("bad", "N", "N", "N"), (3, "Three", " ", "NYSE")]
    if layout == "lists":
        doc = {"fields": ["name", "cik", "exchange", "ticker"], "data": [[n, c, e, t] for c, n, t, e in rows]}
    else:
        doc = {"data": [{"cik": c, "name": n, "ticker": t, "exchange": e} for c, n, t, e in rows]}
    path = tmp_path / "map.json"
    path.write_text(json.dumps(doc))
    got = [tuple(r)[:4] for r in reference_lists.read_ticker_map(spark, str(path)).orderBy("pos").collect()]
    assert got == [(1, "One", "brk.b", "NYSE"), (2, None, "x/y", None), (3, "Three", " ", "NYSE")]


def test_ticker_map_of_another_layout(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"0": {"cik": 1, "ticker": "A"}}))
    with pytest.raises(Exception, match="no list named data"):
        reference_lists.read_ticker_map(spark, str(path)).collect()


def test_an_absurd_value_is_no_end(spark):
    row = {"cik": 1, "concept": GAAP, "unit": "shares", "period_start": AS_OF, "period_end": AS_OF, "duration_days": None, "is_instant": True,
           "value": 1e40, "accn": "a", "fy": 1, "fp": "Q1", "form": "10-Q", "filed": AS_OF, "frame": None, "kind": "shares"}
    df = spark.createDataFrame([row], "cik bigint, concept string, unit string, period_start date, period_end date, duration_days int, "
                               "is_instant boolean, value double, accn string, fy int, fp string, form string, filed date, frame string, kind string")
    assert facts.fact_tables(df)["shares_facts"].first().value is None


def test_exclusions(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("# rule\n\n abc \n  # more\nDEF\nabc\n")
    assert sorted(r.ticker for r in reference_lists.read_exclusions(spark, str(path)).collect()) == ["ABC", "DEF"]
    assert reference_lists.read_exclusions(spark, str(tmp_path / "none.txt")).isEmpty()


EPS = ("cik bigint, concept string, period_start date, period_end date, duration_days int, is_instant boolean, "
       "value double, accn string, form string, filed date")


def eps_frame(spark, rows):
    return spark.createDataFrame([
        (cik, c, s, e, (e - s).days, False, v, accn, form, filed) for cik, c, s, e, v, accn, form, filed in rows], EPS)


def snap(d):
    d = d - dt.timedelta(days=7) if d.day <= 7 else d
    return f"{d.year}Q{(d.month - 1) // 3 + 1}"


def D(text):
    return dt.date.fromisoformat(text)


def period(start, end, value, concept=DILUTED, form="10-Q", filed=None, cik=1, accn="n"):
    return (cik, concept, D(start), D(end), value, accn, form, D(filed) if filed else None)


Q1, Q2, Q3 = ("2019-01-01", "2019-03-31"), ("2019-04-01", "2019-06-30"), ("2019-07-01", "2019-09-30")
YEAR = ("2019-01-01", "2019-12-31")

#: Facts of one company, and (derived, end, figure, concept) of each quarter they give.
CASES = {
    "a year less its three quarters": (
        [period(*Q1, 0.5), period(*Q2, 0.75), period(*Q3, 1.0), period(*YEAR, 3.0, form="10-K/A")],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q2": (False, Q2[1], 0.75, DILUTED), "2019Q3": (False, Q3[1], 1.0, DILUTED),
         "2019Q4": (True, YEAR[1], 0.75, DILUTED)}),
    "no year under another form": (
        [period(*Q1, 0.5), period(*Q2, 0.75), period(*Q3, 1.0), period(*YEAR, 3.0, form="8-K")],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q2": (False, Q2[1], 0.75, DILUTED), "2019Q3": (False, Q3[1], 1.0, DILUTED)}),
    "no fourth quarter from two": (
        [period(*Q1, 0.5), period(*Q3, 1.0), period(*YEAR, 3.0, form="10-K")],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q3": (False, Q3[1], 1.0, DILUTED)}),
    "a gap of eight days is no tiling": (
        [period(*Q1, 0.5), period("2019-04-09", "2019-06-30", 0.75), period(*Q3, 1.0), period(*YEAR, 3.0, form="10-K")],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q2": (False, Q2[1], 0.75, DILUTED), "2019Q3": (False, Q3[1], 1.0, DILUTED)}),
    "a reported quarter stands before a derived one": (
        [period(*Q1, 0.5), period(*Q2, 0.75), period(*Q3, 1.0), period(*YEAR, 3.0, form="10-K"),
         period("2019-10-01", "2019-12-31", 0.7, BASIC)],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q2": (False, Q2[1], 0.75, DILUTED), "2019Q3": (False, Q3[1], 1.0, DILUTED),
         "2019Q4": (False, "2019-12-31", 0.7, BASIC)}),
    "diluted before basic, the other where it is missing": (
        [period(*Q1, 0.6, BASIC), period(*Q1, 0.5), period(*Q2, 0.8, BASIC)],
        {"2019Q1": (False, Q1[1], 0.5, DILUTED), "2019Q2": (False, Q2[1], 0.8, BASIC)}),
    "an end in the first week belongs to the quarter before": (
        [period("2019-01-04", "2019-04-05", 0.5)], {"2019Q1": (False, "2019-04-05", 0.5, DILUTED)}),
    "of two periods in a quarter the later end": (
        [period(*Q1, 0.5), period("2019-01-15", "2019-04-02", 0.25)], {"2019Q1": (False, "2019-04-02", 0.25, DILUTED)}),
    "an absurd winner clears the quarter": ([period(*Q1, 0.5), period("2019-01-02", "2019-04-01", 3e5)], {}),
    "too short and too long": ([period("2019-01-01", "2019-03-15", 1.0), period("2019-01-01", "2019-04-27", 1.0)], {}),
}


@pytest.mark.parametrize("case", CASES)
def test_eps_cases(spark, case):
    given, want = CASES[case]
    df = eps_frame(spark, given)
    got = {r.quarter: (r.is_derived, r.period_end.isoformat(), round(r.eps, 9), r.concept)
           for r in earnings.eps_quarterly(df).collect()}
    assert got == want


def test_eps_audit(spark):
    """Quarters with several candidates, companies apart."""
    df = eps_frame(spark, [period(*Q1, 0.5), period("2019-01-15", "2019-04-02", 0.25), period(*Q2, 1.0),
                           period(*Q1, 0.5, cik=2), period(*Q1, 0.75, BASIC, cik=2)])
    got = [(r.cik, r.quarter, r.n_candidates, r.chosen_eps) for r in earnings.eps_collisions(df).collect()]
    assert got == [(1, "2019Q1", 2, 0.25)]


SHARES = ("cik bigint, concept string, period_start date, period_end date, is_instant boolean, value double, filed date")


def brute_shares(spine, rows):
    out = {}
    for cik, q in spine:
        y, n = int(q[:4]), int(q[-1])
        e = dt.date(y + n // 4, n * 3 % 12 + 1, 1) - dt.timedelta(1)
        best = []
        for c, concept, _s, d, instant, v, filed in rows:
            v = round(v)
            if c != cik or not instant or not 0 < v <= 10**13:
                continue
            gap, latest = (d - e).days, -filed.toordinal() if filed else -10**9
            if concept == DEI and 0 <= gap <= 75:
                best.append((1, gap, 0, latest, v, concept, d, filed))
            elif concept == DEI and -45 <= gap < 0:
                best.append((2, -gap, 0, latest, v, concept, d, filed))
            elif concept == GAAP and abs(gap) <= 120:
                best.append((3, abs(gap), gap < 0, latest, v, concept, d, filed))
        if best:
            out[cik, q] = min(best, key=lambda b: b[:4])[4:]
    return out


def test_shares_against_loops(spark):
    rnd, rows = random.Random(3), {}
    for cik in range(80):
        for _ in range(rnd.randint(0, 14)):
            d = dt.date(2019, 1, 1) + dt.timedelta(rnd.randint(0, 700))
            concept = rnd.choice([DEI, GAAP, GAAP, "us-gaap:CommonStockSharesIssued"])
            filed = None if rnd.random() < 0.1 else d + dt.timedelta(rnd.randint(1, 90))
            rows[cik, concept, d] = (cik, concept, d, d, True, rnd.choice([0.0, 2e13, 10.5, 11.5, 1e6, 123456.0]), filed)
    rows = list(rows.values())
    eps = [(cik, f"2019Q{n}") for cik in range(0, 90, 2) for n in (1, 2, 3, 4)]
    eq = spark.createDataFrame(eps, "cik bigint, quarter string")
    sf = spark.createDataFrame(rows, SHARES)
    have = {r[0] for r in rows}
    spine = {k for k in eps if k[0] in have} | {(r[0], snap(r[3])) for r in rows}
    assert {tuple(r) for r in shares.shares_spine(eq, sf).collect()} == spine
    got = {(r.cik, r.quarter): (r.shares, r.source_concept, r.as_of, r.filed)
           for r in shares.shares_quarterly(eq, sf).collect()}
    assert got == brute_shares(spine, rows)


def test_derived_quarter_excludes_hidden_fourth(spark):
    """A quarter that starts after a non-contained one but ends inside still disqualifies."""
    d = dt.date
    base = [(1, BASIC, d(2020, 1, 1), d(2020, 3, 31), 1.0, "a", "10-Q", None), (1, BASIC, d(2020, 4, 1), d(2020, 6, 30), 1.0, "a", "10-Q", None),
            (1, BASIC, d(2020, 7, 1), d(2020, 9, 30), 1.0, "a", "10-Q", None), (1, BASIC, d(2020, 1, 1), d(2020, 12, 31), 5.0, "a", "10-K", None)]
    n = lambda rows: earnings.eps_candidates(eps_frame(spark, rows)).where("is_derived").count()
    assert n(base) == 1
    outside = (1, BASIC, d(2020, 9, 20), d(2021, 1, 5), 1.0, "a", "10-Q", None)
    inside = (1, BASIC, d(2020, 9, 25), d(2020, 12, 20), 1.0, "a", "10-Q", None)
    assert n(base + [outside]) == 1
    assert n(base + [outside, inside]) == 0
    assert n(base + [(1, BASIC, d(2020, 10, 1), d(2020, 12, 31), 1.0, "a", "10-Q", None)]) == 0


def test_facts_come_from_one_pass_over_the_lines(spark, tmp_path):
    """EPS reads the lines once, its annual figures are of the same sums; all facts share one stored sum."""
    from quarterline import fixtures as fx
    from quarterline.plans.domain import Domain

    lines = [(o, c, 2, dt.datetime(1995, 3 * q - 1, 5), 10.0, float(19000 + 1000 * q))
             for o, (c, q) in enumerate([(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (7, 1), (7, 2), (7, 3), (7, 4), (None, 1)])]
    lines.append((99, 1, 2, None, 10.0, 20000.0))
    folder = str(tmp_path)
    spark.createDataFrame(
        lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double",
    ).write.parquet(f"{folder}/lineitem.parquet")
    eps = fx.eps_source(spark, folder)
    assert eps._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1

    def rows(df):
        return sorted((r.cik, r.concept.split(":")[1][:8], r.fp, r.start, r.val) for r in df.where("cik is not null").collect())

    of = [("Q1", "1995-01-01", 0.05), ("Q2", "1995-04-01", 0.15), ("Q3", "1995-07-01", 0.25), ("Q4", "1995-10-01", 0.35)]
    wanted = [(1, name, *x) for name in ("Earnings", "Revenues") for x in of[:3]] + [(1, "Earnings", "FY", "1995-01-01", 0.81)]
    wanted += [(2, "Earnings", *of[0])] * 2 + [(7, name, *x) for name in ("Earnings", "Revenues") for x in of[:3]]
    wanted = sorted(wanted)
    assert rows(eps) == wanted

    d = Domain(spark, folder)
    for facts_of in (d.eps_facts, d.shares_facts, d.float_facts):
        files = facts_of.inputFiles()
        assert files and not any("lineitem" in f for f in files)
    assert list(d.paths) == ["quarter_sums"] and rows(fx.eps_source(spark, folder, d.quarter_sums)) == wanted
