"""Load semantics on stored tables."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import RAW, SPLITS, raw_rows
from quarterline.plans import load
from quarterline.plans.lineage import discard, materialise, new_path, shared_folder
from quarterline.plans.panel import build_features
from quarterline.sources import tables as tb

PRICES = "ticker_yahoo string, date date, close double"


@pytest.fixture
def name(spark, request):
    t = request.node.name.replace("[", "_").replace("]", "")
    yield t
    spark.sql(f"drop table if exists {t}")


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_insert_absent(spark, name):
    mk = lambda *r: spark.createDataFrame(list(r), "cik bigint, entity_name string, pos int")
    tb.insert_absent(mk((1, "a", 0), (1, "b", 1), (2, "c", 2)), name, ["cik"], ["pos"])
    tb.insert_absent(mk((1, "x", 0), (3, "d", 1)), name, ["cik"], ["pos"])
    assert [(r[0], r[1]) for r in rows(spark, name)] == [(1, "a"), (2, "c"), (3, "d")]


def test_append_and_refresh(spark, name):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    tb.bulk_append(a, name)
    tb.bulk_append(a.select("s", "n"), name)
    assert rows(spark, name) == [(1, "x"), (1, "x")]
    tb.full_refresh(a, name)
    assert rows(spark, name) == [(1, "x")]


LOG = "ticker_yahoo string, status string, rows bigint, error string, fetched_at timestamp"


def test_ledger(spark, tmp_path):
    t = lambda n: dt.datetime(2026, 1, n)
    log = spark.createDataFrame([("A", "error", 0, "x", t(1)), ("A", "ok", 5, None, t(2)), ("B", "ok", 1, None, t(1)),
                                 ("B", "error", 0, None, t(2)), ("C", "empty", 0, None, t(1))], LOG)
    latest = tb.ledger_latest(log)
    assert {(r.ticker_yahoo, r.status) for r in latest.collect()} == {("A", "ok"), ("B", "error"), ("C", "empty")}
    u = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    assert {r.ticker for r in tb.todo(u, latest).collect()} == {"B", "D"}
    for _ in range(2):
        tb.export_rows(tb.failures(latest), str(tmp_path / "failures"))
    assert spark.read.option("header", True).csv(str(tmp_path / "failures")).count() == 2


def test_stored_panel(spark):
    raw = spark.createDataFrame(raw_rows("AAA", ["2019Q4", "2020Q1", "2020Q2"], [1, 2, 3]), RAW)
    compute = lambda: build_features(raw, spark.createDataFrame([], SPLITS))
    as_of = dt.date(2020, 5, 1)
    spark.sql(f"drop table if exists {load.PANEL_TABLE}")
    quarters = lambda **k: sorted(r.quarter for r in load.load_panel(spark, as_of, compute, **k).collect())
    # the quarter in progress is trimmed on both ways
    assert quarters() == ["2019Q4", "2020Q1"]
    assert tb.materialise_table(spark, load.PANEL_TABLE, lambda: compute().where("quarter = '2019Q4'"))
    assert not tb.materialise_table(spark, load.PANEL_TABLE, compute)
    assert quarters() == ["2019Q4"] and quarters(force_compute=True) == ["2019Q4", "2020Q1"]
    assert tb.materialise_table(spark, load.PANEL_TABLE, compute, force=True)
    assert quarters() == ["2019Q4", "2020Q1"]
    spark.sql(f"drop table {load.PANEL_TABLE}")


def test_tables_lie_in_the_shared_folder(spark):
    root = shared_folder(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    path = new_path(spark, "t")
    df = materialise(spark.range(3).toDF("n"), "t", path)
    assert df.count() == 3 and all(root in f for f in df.inputFiles())
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_pipeline_is_reused_and_pruned(spark):
    """A second query writes nothing, and quarters are partition filters."""
    from quarterline.plans.domain import Domain
    from quarterline.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    d = Domain.of(spark, folder)
    QUERIES["value_panel"](spark, folder)
    written = dict(d.paths)
    pruned = {"top_dividend_payers": "quarter", "backtest_holdings": "qidx"}
    for query, column in pruned.items():
        plan = plan_of(QUERIES[query](spark, folder))
        filters = [line for line in plan.split("PartitionFilters: [")[1:]]
        assert any(f.startswith("isnotnull(" + column) or column in f.split("]")[0] for f in filters), plan
    QUERIES["ticker_series"](spark, folder).count()
    assert Domain.of(spark, folder) is d and d.paths == written
    Domain.forget(spark, folder)
    assert Domain.of(spark, folder) is not d


def test_factors_keep_rows(spark):
    """No plan node multiplies rows: the splits of a ticker are one row of the join."""
    from quarterline.queries import QUERIES

    plan = plan_of(QUERIES["split_factor_between"](spark, "/root/testdata/sf0.001"))
    above = plan.split("Join")[0]
    assert "HashAggregate" not in above and "ObjectHashAggregate" not in above


def test_prepare(spark):
    """Both derived tables from the whole pipeline; what is there is not built again."""
    from quarterline.constants import VALUE_PANEL_COLUMNS
    from quarterline.plans.domain import Domain

    d = Domain(spark, "/root/testdata/sf0.001")
    args = (spark, d.price_daily, d.view_rows, d.stored_eps, d.price_quarterly, d.dividend, d.stock_split,
            d.ticker_map, d.stored_company)
    for t in (load.RISK_TABLE, load.PANEL_TABLE):
        spark.sql(f"drop table if exists {t}")
    assert load.prepare(*args) == {load.RISK_TABLE: True, load.PANEL_TABLE: True}
    panel = load.load_panel(spark, dt.date(2026, 1, 1))
    assert tuple(panel.columns) == VALUE_PANEL_COLUMNS
    assert panel.count() == d.value_panel.count() > 0
    assert load.prepare(*args) == {load.RISK_TABLE: False, load.PANEL_TABLE: False}
    # only the missing one is rebuilt
    spark.sql(f"drop table {load.PANEL_TABLE}")
    assert load.prepare(*args) == {load.RISK_TABLE: False, load.PANEL_TABLE: True}
    for t in (load.RISK_TABLE, load.PANEL_TABLE):
        spark.sql(f"drop table {t}")


def copied(spark, tmp_path, *without):
    """A folder of tables that a test may change."""
    import shutil

    for t in ("lineitem", "supplier", "nation", "orders"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_changed_input_is_seen(spark, tmp_path):
    """In one session: only what comes from the changed table is built again."""
    import duckdb

    from quarterline.plans.domain import Domain
    from quarterline.queries import QUERIES

    folder = copied(spark, tmp_path)
    key = lambda df: sorted((r.ticker, r.quarter, r.px_adj, r.name) for r in df.collect())
    first = key(QUERIES["value_panel"](spark, folder))
    before = dict(Domain.of(spark, folder).paths)
    assert key(QUERIES["value_panel"](spark, folder)) == first and Domain.of(spark, folder).paths == before
    # fewer observations
    duckdb.sql(f"copy (select * from '/root/testdata/sf0.001/lineitem.parquet' where l_orderkey % 5 <> 0) to '{folder}/lineitem.parquet'")
    second = key(QUERIES["value_panel"](spark, folder))
    after = dict(Domain.of(spark, folder).paths)
    assert second != first and second
    assert {n for n in before if before[n] == after[n]} == {"stored_ticker_map", "stored_company"}
    # the same figures as of a folder that always was so
    Domain.forget(spark, folder)
    assert key(QUERIES["value_panel"](spark, folder)) == second
    # other names: the history stays as it is
    before = dict(Domain.of(spark, folder).paths)
    duckdb.sql(f"copy (select * replace ('other ' || s_name as s_name) from '/root/testdata/sf0.001/supplier.parquet') to '{folder}/supplier.parquet'")
    third = key(QUERIES["value_panel"](spark, folder))
    assert {r[:3] for r in third} == {r[:3] for r in second} and third != second
    after = dict(Domain.of(spark, folder).paths)
    assert {"stored_history", "stored_eps"} <= {n for n in before if before[n] == after[n]}
    Domain.forget(spark, folder)


def test_derived_tables_follow_their_files(spark, tmp_path):
    """Rebuilt if a file they come from changes, or if a build was cut off."""
    src = str(tmp_path / "src")
    spark.range(5).write.parquet(src)
    inputs = lambda: load.inputs_of(spark, spark.read.parquet(src))
    build = lambda: spark.read.parquet(src).selectExpr("id", "id % 2 as k")
    make = lambda **k: tb.materialise_table(spark, "derived", build, inputs=inputs(), partition_by="k", sort_by=("id",), **k)
    spark.sql("drop table if exists derived")
    assert make() and not make()
    assert inputs() == inputs() and tb.stored_inputs(spark, "derived") == inputs()
    spark.range(7, 9).write.mode("append").parquet(src)
    assert make() and not make() and spark.table("derived").count() == 7
    # rows without a note of their inputs: written, then cut off
    tb.full_refresh(build().where("id < 3"), "derived", "k")
    assert tb.stored_inputs(spark, "derived") is None
    assert make() and spark.table("derived").count() == 7 and not make()
    # a table that shrinks to the same bytes is another one, too
    spark.range(7).write.mode("overwrite").parquet(src)
    assert make()
    spark.sql("drop table derived")


def test_prepared_panel_is_partitioned(spark):
    """Quarters are partition filters, tickers sorted inside."""
    from quarterline.plans.domain import Domain

    d = Domain(spark, "/root/testdata/sf0.001")
    for t in (load.RISK_TABLE, load.PANEL_TABLE):
        spark.sql(f"drop table if exists {t}")
    load.prepare(spark, d.price_daily, d.view_rows, d.stored_eps, d.price_quarterly, d.dividend, d.stock_split, d.ticker_map, d.stored_company)
    panel = load.load_panel(spark, dt.date(2026, 1, 1)).where("qidx between 7980 and 7983 and ticker = 'S1-A'")
    plan = plan_of(panel)
    said = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 7980" in said and "<= 7983" in said
    assert "EqualTo(ticker,S1-A)" in plan
    assert all("qidx=" in f for f in panel.inputFiles())
    for t in (load.RISK_TABLE, load.PANEL_TABLE):
        spark.sql(f"drop table {t}")


def test_bucketed_tables_join_without_exchange(spark):
    from quarterline.plans.lineage import new_path as at

    names = ["bucketed_prices", "bucketed_splits"]
    for t in names:
        spark.sql(f"drop table if exists {t}")
    days = spark.createDataFrame([(f"T{i % 9}", dt.date(2020, 1, 1 + i // 9), float(i)) for i in range(90)], "ticker_yahoo string, date date, close double")
    splits = spark.createDataFrame([(f"T{i}", dt.date(2020, 1, 3), 2.0) for i in range(9)], "ticker_yahoo string, split_date date, ratio double")
    by = lambda c: tb.Buckets(4, "ticker_yahoo", ("ticker_yahoo", c))
    tb.full_refresh(days.where("close < 30"), names[0], layout=by("date"), path=at(spark, "b"))
    tb.full_refresh(splits, names[1], layout=by("split_date"), path=at(spark, "b"))
    join = lambda: spark.table(names[0]).join(spark.table(names[1]).hint("merge"), "ticker_yahoo").where("date > split_date")
    plan = plan_of(join())
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    tb.bulk_append(days.where("close >= 30 and close < 60"), names[0], layout=by("date"))
    tb.insert_absent(days.withColumn("close", F.col("close") + 0.5), names[0], ["ticker_yahoo", "date"], ["close"], by("date"))
    # more than one file in a bucket: rows still need no exchange
    plan = plan_of(join())
    assert "Exchange" not in plan
    assert join().count() == sum(1 for i in range(90) if i // 9 > 2)
    got = {r.close for r in spark.table(names[0]).collect()}
    assert got == {float(i) for i in range(60)} | {i + 0.5 for i in range(60, 90)}
    # of one ticker the join reads one bucket of each table
    assert plan_of(join().where("ticker_yahoo = 'T1'")).count("SelectedBucketsCount: 1 out of 4") == 2
    for t in names:
        spark.sql(f"drop table {t}")


def test_ledger_folds(spark, monkeypatch):
    from quarterline.sources import ledger as lg

    t = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)
    tries = [[("A", "error", 0, "x", t(1)), ("B", "ok", 1, None, t(1))], [("A", "ok", 5, None, t(2))], [("C", "empty", 0, None, t(3)), ("B", "error", 0, "late", t(0))],
             [("A", "error", 0, "y", t(4)), ("A", "ok", 1, None, t(4))], [("D", "ok", 2, None, t(5))], [("B", "error", 0, None, t(6))], []]
    u = spark.createDataFrame([(x,) for x in "ABCDE"], "ticker string")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    plain, folding, cut = (lg.Ledger(spark, new_path(spark, "ledger"), n) for n in (100, 2, 1))
    with pytest.raises(ValueError, match="no attempts"):
        plain.latest()
    for k, outcomes in enumerate(tries):
        df = spark.createDataFrame(outcomes, LOG)
        plain.append(df)
        folding.append(df)
        # a fold that is cut off after its rows are written leaves no snapshot, and the next one makes it good
        with monkeypatch.context() as m:
            if k % 2:
                m.setattr(lg, "claim", lambda s, draft, final, real=lg.claim: real(s, draft, final) if lg.ATTEMPTS in final else (_ for _ in ()).throw(KeyboardInterrupt()))
                with pytest.raises(KeyboardInterrupt):
                    cut.append(df)
            else:
                cut.append(df)
        want = rows(tb.ledger_latest(spark.createDataFrame([r for o in tries[:k + 1] for r in o], LOG)))
        assert rows(plain.latest()) == rows(folding.latest()) == rows(cut.latest()) == want
        assert rows(plain.todo(u)) == rows(folding.todo(u)) == rows(cut.todo(u))
    assert len(plain.latest().inputFiles()) > len(folding.latest().inputFiles())
    assert folding._state() == (6, [7]) and plain._state()[0] == 0
    before = rows(folding.latest())
    assert folding.sweep() == 6 + 2 and rows(folding.latest()) == before and folding.sweep() == 0
    assert folding.append(spark.createDataFrame(tries[0], LOG)) == 8
    # a fold beside another of the same attempts
    folding.fold()
    folding.fold()
    assert rows(folding.latest()) == before


def test_json_export(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, nan, "a\n\"é", dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3), [1.5]), (2, -inf, None, None, None, None), (3, 0.1 + 0.2, "", dt.date(1, 1, 1), None, [])],
                               "n long, x double, `a b` string, d date, t timestamp, l array<double>")
    schema = tb.export_json(df, str(tmp_path / "j"))
    lines = sorted(p for f in (tmp_path / "j").glob("part-*") for p in f.read_text().splitlines())
    assert lines[0] == '{"n":1,"x":null,"a b":"a\\n\\"é","d":"2020-01-02","t":"2020-01-02","l":[1.5]}'
    assert lines[1] == '{"n":2,"x":null,"a b":null,"d":null,"t":null,"l":null}'
    back = tb.read_json(spark, str(tmp_path / "j"), schema)
    assert dict(back.dtypes)["t"] == "date" and back.schema == schema
    assert sorted(map(tuple, back.select("n", "x", "d").collect())) == [(1, None, dt.date(2020, 1, 2)), (2, None, None), (3, 0.1 + 0.2, dt.date(1, 1, 1))]
    # another type than was declared is refused
    with pytest.raises(Exception):
        tb.read_json(spark, str(tmp_path / "j"), "n long, d double").collect()
    tb.export_json(df.limit(0), str(tmp_path / "e"))
    assert tb.read_json(spark, str(tmp_path / "e"), schema).collect() == []
