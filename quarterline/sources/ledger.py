"""The append-only ledger of fetch attempts, with snapshots.

Attempts are numbered folders that are never changed. A snapshot holds each ticker's latest outcome
as of an attempt; readers take the last snapshot and the attempts after it. When these have become
``fold_after``, they are folded into a new snapshot, so a read stays as long as the tickers and a bounded
number of attempts. The latest outcome of a snapshot and later attempts is that of all attempts,
as the order of outcomes is total.

Attempts and snapshots are written aside and then take their name, which only one writer can. What
a run leaves that was cut off has no name and is not read.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarterline.plans.lineage import children, claim, discard
from quarterline.sources.tables import ledger_latest, todo

ATTEMPTS, SNAPSHOTS = "attempts", "snapshots"


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, fold_after: int = 20):
        if fold_after < 1:
            raise ValueError("attempts are folded one by one at least")
        self.spark, self.folder, self.fold_after = spark, folder.rstrip("/"), fold_after

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(n) for n in children(self.spark, f"{self.folder}/{kind}") if n.isdigit())

    def _path(self, kind: str, n: int) -> str:
        return f"{self.folder}/{kind}/{n:010d}"

    def _state(self) -> tuple[int, list[int]]:
        """The attempt the last snapshot reaches to, 0 without one, and the attempts after it."""
        snapshot = max(self._numbers(SNAPSHOTS), default=0)
        return snapshot, [n for n in self._numbers(ATTEMPTS) if n > snapshot]

    def append(self, outcomes: DataFrame) -> int:
        """Add an attempt's outcomes; its number."""
        draft = f"{self.folder}/{ATTEMPTS}/_{uuid.uuid4().hex}"
        outcomes.write.parquet(draft)
        snapshot, later = self._state()
        n = max([snapshot, *later]) + 1
        while not claim(self.spark, draft, self._path(ATTEMPTS, n)):
            n += 1
        if len(self._state()[1]) >= self.fold_after:
            self.fold()
        return n

    def latest(self) -> DataFrame:
        """Each ticker's latest outcome. Reads the last snapshot and the attempts after it."""
        snapshot, later = self._state()
        paths = [self._path(SNAPSHOTS, snapshot)] * (snapshot > 0) + [self._path(ATTEMPTS, n) for n in later]
        if not paths:
            raise ValueError(f"no attempts in {self.folder}")
        return ledger_latest(self.spark.read.parquet(*paths))

    def fold(self) -> None:
        """Write a snapshot that reaches to the last attempt."""
        snapshot, later = self._state()
        if not later:
            return
        draft = f"{self.folder}/{SNAPSHOTS}/_{uuid.uuid4().hex}"
        self.latest().write.parquet(draft)
        if not claim(self.spark, draft, self._path(SNAPSHOTS, later[-1])):
            discard(self.spark, draft)  # another writer has folded the same attempts

    def todo(self, universe: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
        return todo(universe, self.latest(), replaced)

    def sweep(self) -> int:
        """Delete what the last snapshot holds already; how many folders. For when nobody reads."""
        snapshot, _ = self._state()
        old = [self._path(ATTEMPTS, n) for n in self._numbers(ATTEMPTS) if n <= snapshot]
        old += [self._path(SNAPSHOTS, n) for n in self._numbers(SNAPSHOTS) if n < snapshot]
        for path in old:
            discard(self.spark, path)
        return len(old)
