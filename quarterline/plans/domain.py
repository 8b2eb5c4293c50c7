"""The whole pipeline over the test tables, step by step as the stored pipeline runs it.

A step that several later ones read is written to the shared folder, once for an application
and state of the input folder; everything else stays one lazy plan. Each step names the given tables
it comes from, and is built again when one of their files has changed.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from quarterline import fixtures as fx
from quarterline.operators import earnings, facts, market, quality, risk, shares, universe
from quarterline.plans import fundamentals, panel
from quarterline.sources import tables
from quarterline.plans.lineage import discard, fingerprint, materialise, new_path


_KNOWN: dict[tuple[str, str], "Domain"] = {}
_LOCK = Lock()
TABLES = ("lineitem", "supplier", "nation")


class _Step(cached_property):
    """A frame that is made once, until a table it comes from changes."""
    reads: tuple[str, ...] = TABLES


def step(*reads: str):
    def made(f) -> _Step:
        found = _Step(f)
        found.reads = reads or TABLES
        return found
    return made


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.paths: dict[str, str] = {}  # of stored steps, by name
        self.inputs: dict[str, str] = {}  # fingerprints of the tables, and of all together

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Domain":
        """The application's stored pipeline over an input folder. Its tables are written when
        a query first needs them and reused by every later one, as long as the files they come
        from are the same; they go with the application."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _LOCK:
            if key not in _KNOWN:
                _KNOWN[key] = cls(spark, sf_dir)
            _KNOWN[key].refresh()
            return _KNOWN[key]

    @classmethod
    def forget(cls, spark: SparkSession, sf_dir: str) -> None:
        """Drop the stored pipeline of an input folder."""
        with _LOCK:
            old = _KNOWN.pop((spark.sparkContext.applicationId, sf_dir.rstrip("/")), None)
        for path in list(old.paths.values()) if old else ():
            discard(spark, path)

    def refresh(self) -> None:
        """Drop every step that comes from a table whose files have changed."""
        at = {t: f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES}
        all_ = fingerprint(self.spark, list(at.values()))
        if self.inputs.get("all") == all_:
            return
        now = {t: fingerprint(self.spark, [path]) for t, path in at.items()}
        changed = {t for t in TABLES if self.inputs.get(t) != now[t]}
        for name in [n for n in self.__dict__ if isinstance(found := getattr(type(self), n, None), _Step) and changed & set(found.reads)]:
            del self.__dict__[name]
            if name in self.paths:
                discard(self.spark, self.paths.pop(name))
        self.inputs = {**now, "all": all_}

    def _store(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        """``name`` is the step's."""
        path = new_path(self.spark, name)
        self.paths[name] = path
        return materialise(df, name, path, by)

    def _source(self, make) -> DataFrame:
        return make(self.spark, self.sf_dir)

    def _side_by_side(self, *steps: str) -> None:
        """Write steps that do not depend on each other together, as none of them keeps a cluster
        busy to its end. What they share has to be there."""
        todo = [s for s in steps if s not in self.__dict__]
        if todo:
            with ThreadPoolExecutor(len(todo)) as pool:
                list(pool.map(lambda step: getattr(self, step), todo))

    def _store_inputs(self) -> None:
        self._side_by_side("stored_history", "stored_eps", "stored_ticker_map", "stored_company")
        self.purged

    # --- market ---------------------------------------------------------------------
    @step("lineitem")
    def history(self) -> DataFrame:
        return self._source(fx.vendor_history)

    @step("lineitem")
    def tasks(self) -> int:
        """Tasks for the daily rows; the files' footers tell their number."""
        return market.tasks_for(self._source(lambda *at: fx.table(*at, "lineitem")).count())

    @step("lineitem")
    def enriched(self) -> DataFrame:
        """Lazy: for queries that read the daily pass once."""
        return market.enriched_history(self.history, self.tasks)

    @step("lineitem")
    def stored_history(self) -> DataFrame:
        """Written once: prices, splits, dividends and quarter closes all come from it."""
        return self._store(self.enriched.select(
            "ticker", "date", "close", "adj_close", "dividends", "ratio", "factor", "close_ok",
            "as_traded"), "stored_history")

    @step("supplier")
    def currency(self) -> DataFrame:
        return self._source(fx.currency)

    @step("lineitem", "supplier")
    def marked_prices(self) -> DataFrame:
        """Quarter closes as loaded, each with whether its ticker is corrupt; one write for both."""
        return self._store(quality.with_corrupt_mark(
            quality.drop_tiny_prices(market.price_quarterly(self.stored_history, self.currency))), "marked_prices")

    @step("lineitem", "supplier")
    def loaded_prices(self) -> DataFrame:
        return self.marked_prices.drop("corrupt")

    @step("lineitem", "supplier")
    def corrupt(self) -> DataFrame:
        return self.marked_prices.where("corrupt").select("ticker_yahoo").distinct()

    @step("lineitem", "supplier")
    def purged_keys(self) -> DataFrame:
        """Keys of the quarter closes that go with the corrupt tickers, noted at the load."""
        return self._store(self.marked_prices.where("corrupt").select("ticker_yahoo", "quarter"), "purged_keys")

    @step()
    def _purged(self) -> dict[str, DataFrame]:
        h = self.stored_history
        return quality.purge({
            "price_quarterly": self.loaded_prices,
            "dividend": market.dividend(h, self.currency),
            "stock_split": market.stock_split(h),
            "price_daily": h.selectExpr("ticker as ticker_yahoo", "date", "close_ok as close"),
            "ticker_map": self.stored_ticker_map,
            "yahoo_fetch_log": self.fetch_log,
        }, self.corrupt)

    @property
    def loaded(self) -> dict[str, DataFrame]:
        """The tables that name tickers, before the purge. Risk and panel are built after it."""
        h = self.stored_history
        return {
            "price_quarterly": self.loaded_prices, "dividend": market.dividend(h), "stock_split": market.stock_split(h),
            "price_daily": h.selectExpr("ticker as ticker_yahoo"), "ticker_map": self.stored_ticker_map,
            "yahoo_fetch_log": self.fetch_log}

    @property
    def purged(self) -> dict[str, DataFrame]:
        return self._purged

    @property
    def price_quarterly(self) -> DataFrame:
        return self._purged["price_quarterly"]

    @property
    def dividend(self) -> DataFrame:
        return self._purged["dividend"]

    @property
    def stock_split(self) -> DataFrame:
        return self._purged["stock_split"]

    @property
    def price_daily(self) -> DataFrame:
        return self._purged["price_daily"]

    @property
    def ticker_map(self) -> DataFrame:
        return self._purged["ticker_map"]

    # --- reference lists --------------------------------------------------------------
    @step("supplier", "nation")
    def loaded_ticker_map(self) -> DataFrame:
        return universe.ticker_map(self._source(fx.ticker_source), self._source(fx.exclusions))

    @step("supplier", "nation")
    def stored_ticker_map(self) -> DataFrame:
        return self._store(self.loaded_ticker_map, "stored_ticker_map")

    @step("supplier", "nation")
    def company(self) -> DataFrame:
        return universe.company(self._source(fx.ticker_source), self._source(fx.filing_names))

    @step("supplier", "nation")
    def stored_company(self) -> DataFrame:
        return self._store(self.company, "stored_company")

    # --- filings ----------------------------------------------------------------------
    @step("lineitem")
    def quarter_sums(self) -> DataFrame:
        """Written once: all facts come from it."""
        return self._store(self._source(fx.quarter_sums), "quarter_sums")

    def _facts(self, make) -> DataFrame:
        raw = make(self.spark, self.sf_dir, self.quarter_sums)
        return facts.earliest_filed(facts.parse_facts(facts.registry_filter(raw), fx.AS_OF))

    @step("lineitem")
    def eps_facts(self) -> DataFrame:
        return self._facts(fx.eps_source)

    @step("lineitem")
    def shares_facts(self) -> DataFrame:
        return self._facts(fx.shares_source)

    @step("lineitem")
    def float_facts(self) -> DataFrame:
        return self._facts(fx.float_source)

    @step("supplier")
    def fetch_log(self) -> DataFrame:
        return tables.ledger_latest(*[fx.fetch_log(self.spark, self.sf_dir, n) for n in (1, 2)])

    @step("lineitem")
    def eps_quarterly(self) -> DataFrame:
        return earnings.eps_quarterly(self.eps_facts)

    @step("lineitem")
    def stored_eps(self) -> DataFrame:
        return self._store(self.eps_quarterly, "stored_eps")

    @step("lineitem")
    def reported_shares(self) -> DataFrame:
        return shares.shares_quarterly(self.stored_eps, self.shares_facts)

    @step()
    def shares_quarterly(self) -> DataFrame:
        """On the basis of the quarter's price, with the fallback mark."""
        self._store_inputs()
        return self._store(quality.normalise_shares(
            self.reported_shares, self.ticker_map, self.price_quarterly, self.stock_split),
            "shares_quarterly")

    # --- composites ---------------------------------------------------------------------
    @step()
    def view_rows(self) -> DataFrame:
        """Partitioned by quarter and sorted by ticker, as it is read."""
        return self._store(fundamentals.view_rows(
            self.stored_eps, self.shares_quarterly, self.price_quarterly, self.dividend,
            self.ticker_map), "view_rows", ("quarter", "ticker"))

    @step()
    def view(self) -> DataFrame:
        return fundamentals.view_of(self.view_rows)

    @step()
    def risk(self) -> DataFrame:
        return self._store(risk.stock_risk_quarter(self.price_daily.repartition(self.tasks, "ticker_yahoo")), "risk")

    @step()
    def raw_panel(self) -> DataFrame:
        self._store_inputs()
        self._side_by_side("view_rows", "risk")
        return panel.raw_panel(
            self.view_rows, self.stored_eps, self.price_quarterly, self.dividend, self.risk,
            self.ticker_map, self.stored_company, self.tasks)

    @step()
    def value_panel(self) -> DataFrame:
        return panel.build_features(self.raw_panel, self.stock_split)

    @step()
    def stored_panel(self) -> DataFrame:
        """Partitioned by quarter and sorted by ticker, as screens and backtests read it."""
        return self._store(self.value_panel, "stored_panel", ("qidx", "ticker"))
