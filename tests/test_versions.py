"""Tables replaced together: one commit, cut-off runs, writers side by side."""
import datetime as dt
import threading

import pytest

from quarterline.plans.lineage import children, new_path
from quarterline.sources.versions import TableSet

NAMES = ["price_daily", "dividend", "stock_split", "price_quarterly", "yahoo_fetch_log"]
ROW = "ticker_yahoo string, d date, v double"
DAY = dt.date(2020, 1, 1)


def frame(spark, tickers, v):
    return spark.createDataFrame([(t, DAY, v) for t in tickers], ROW)


def tickers_of(spark, names):
    return spark.createDataFrame([(t,) for t in names], "ticker_yahoo string")


def state(tables):
    return {n: sorted((r.ticker_yahoo, r.v) for r in df.collect()) for n, df in tables.read_all().items()}


ALL = [f"T{i}" for i in range(20)]


@pytest.fixture
def tables(spark):
    made = TableSet(spark, new_path(spark, "set"), 8)
    made.load({n: frame(spark, ALL, 0.0) for n in NAMES})
    return made


def test_replacement(spark, tables):
    before = tables.latest()
    held = tables.read("dividend")
    tables.replace({n: frame(spark, ["T1", "T1", "T3"], 1.0) for n in NAMES[:4]}, tickers_of(spark, ["T1", "T2", "T40"]))
    want = sorted([(t, 0.0) for t in ALL if t not in ("T1", "T2")] + [("T1", 1.0)] * 2)
    got = state(tables)
    assert all(got[n] == want for n in NAMES[:4])
    # no rows come anew in the fifth, which loses the tickers' rows all the same
    assert got[NAMES[4]] == sorted((t, 0.0) for t in ALL if t not in ("T1", "T2"))
    # a frame from before keeps reading what it was made from, and so does an older commit
    assert held.count() == 20 and tables.read("dividend", before).count() == 20
    # buckets that no replaced ticker falls into are not written again
    after = tables.latest()
    same = [b for b in before.versions["dividend"] if before.versions["dividend"][b] == after.versions["dividend"].get(b)]
    assert 4 <= len(same) < 8 and after.number == before.number + 1
    assert tables.sweep() == 0 or state(tables) == got


def test_all_rows_of_a_bucket_go(spark, tables):
    tables.replace({}, tickers_of(spark, ALL))
    assert state(tables) == {n: [] for n in NAMES}
    tables.replace({n: frame(spark, ["T5"], 5.0) for n in NAMES}, tickers_of(spark, ["T5"]))
    assert state(tables) == {n: [("T5", 5.0)] for n in NAMES}


@pytest.mark.parametrize("cut_at", [*range(1, 6), "commit"])
def test_a_run_cut_off_changes_nothing(spark, tables, monkeypatch, cut_at):
    """Before the third of five tables, say, or when all are written and the commit is not."""
    before, written = state(tables), []
    with monkeypatch.context() as m:
        if cut_at == "commit":
            m.setattr(TableSet, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        else:
            write = TableSet._write

            def cut(self, table, rows):
                written.append(table)
                if len(written) == cut_at:
                    raise KeyboardInterrupt
                return write(self, table, rows)

            m.setattr(TableSet, "_write", cut)
        with pytest.raises(KeyboardInterrupt):
            tables.replace({n: frame(spark, ["T1"], 1.0) for n in NAMES}, tickers_of(spark, ["T1"]))
    assert state(tables) == before
    # the same again goes through, and what the cut-off run left can be swept
    tables.replace({n: frame(spark, ["T1"], 1.0) for n in NAMES}, tickers_of(spark, ["T1"]))
    done = state(tables)
    assert all(("T1", 1.0) in rows and len(rows) == 20 for rows in done.values())
    assert tables.sweep() >= (5 if cut_at == "commit" else cut_at - 1)
    assert state(tables) == done


def test_writers_side_by_side(spark, tables):
    """Tickers of the same and of other buckets; each writer's rows stay."""
    errors = []

    def work(k):
        try:
            mine = ALL[k::4]
            TableSet(spark, tables.folder, 8).replace({n: frame(spark, mine, float(k + 1)) for n in NAMES}, tickers_of(spark, mine))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    want = sorted((t, float(i % 4 + 1)) for i, t in enumerate(ALL))
    assert state(tables) == {n: want for n in NAMES}
    assert tables.latest().number == 5


def test_a_commit_in_between_is_taken_up(spark, tables, monkeypatch):
    """Another writer commits after this one has read: nothing of either is lost."""
    publish, calls = TableSet._publish, []

    def late(self, commit):
        calls.append(commit.number)
        if len(calls) == 1:
            monkeypatch.setattr(TableSet, "_publish", publish)
            TableSet(spark, self.folder, 8).replace({n: frame(spark, ["T7"], 7.0) for n in NAMES}, tickers_of(spark, ["T7"]))
            monkeypatch.setattr(TableSet, "_publish", late)
        return publish(self, commit)

    monkeypatch.setattr(TableSet, "_publish", late)
    tables.replace({n: frame(spark, ["T1", "T7"], 1.0) for n in NAMES}, tickers_of(spark, ["T1"]))
    got = state(tables)
    assert calls[0] + 1 == calls[-1]
    assert all(("T1", 1.0) in rows and ("T7", 7.0) in rows and len(rows) == 20 for rows in got.values())


def test_refusals_and_empty_sets(spark, tables):
    with pytest.raises(ValueError, match="8 buckets"):
        TableSet(spark, tables.folder, 4).latest()
    with pytest.raises(ValueError, match="no table x"):
        tables.read("x")
    with pytest.raises(ValueError, match="no table x"):
        tables.replace({"x": frame(spark, [], 0.0)}, tickers_of(spark, []))
    empty = TableSet(spark, new_path(spark, "set"), 8)
    assert empty.latest().number == 0 and empty.read_all() == {}
    # a draft that never became a commit is not one
    assert all(not n.startswith("_") for n in children(spark, f"{tables.folder}/_commits"))


def test_no_setting_is_changed(spark, tables):
    before = dict(spark.conf.getAll)
    tables.replace({}, tickers_of(spark, ["T1"]))
    assert dict(spark.conf.getAll) == before
