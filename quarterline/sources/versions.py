"""Several tables that are replaced together, ticker by ticker.

All tables of a set are cut into the same hash buckets of the ticker. A bucket's files are never
changed: a replacement writes the buckets it touches under a new version, for every table, and
then one commit, a small file that says which version of each bucket counts. Readers go by the
last commit, so they see a replacement in all tables or in none, and frames they hold keep reading
the versions they were made from. A run that is cut off leaves files that no commit names.

Commits are numbered and a number can be taken once (a rename onto a name that must be free,
which is atomic on HDFS). A replacement that finds its number taken goes on from the newer commit:
if the other one has touched other buckets, what is written holds, else it is worked out again.

A commit lists tables times buckets, a fixed number that does not grow with the data, and
nothing else comes to the driver. No setting of the session is changed.
"""
from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.plans.lineage import children, claim, discard, path_handle
from quarterline.sources.tables import BUCKET, replaced_rows, with_bucket

COMMITS = "_commits"


@dataclass(frozen=True)
class Commit:
    """``schemas`` by table, and by table and bucket the version that counts."""
    number: int
    schemas: dict[str, str]
    versions: dict[str, dict[str, str]]

    def touches(self, other: "Commit", buckets: set[str]) -> bool:
        """Whether any of some buckets has another version than in ``other``."""
        return any(self.versions[t].get(b) != other.versions.get(t, {}).get(b) for t in self.versions for b in buckets)


class TableSet:
    """Tables under one folder. ``buckets`` is fixed when the set is made."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, key: str = "ticker_yahoo"):
        self.spark, self.folder, self.buckets, self.key = spark, folder.rstrip("/"), buckets, key

    # --- commits ----------------------------------------------------------------------
    def latest(self) -> Commit:
        """The last commit; number 0 if there is none."""
        numbers = sorted(int(n.removesuffix(".json")) for n in children(self.spark, f"{self.folder}/{COMMITS}") if n.endswith(".json"))
        if not numbers:
            return Commit(0, {}, {})
        text = self.spark.read.text(f"{self.folder}/{COMMITS}/{numbers[-1]:010d}.json", wholetext=True).first()[0]
        said = json.loads(text)
        if said["buckets"] != self.buckets:
            raise ValueError(f"{self.folder} is cut into {said['buckets']} buckets, not {self.buckets}")
        return Commit(numbers[-1], said["schemas"], said["versions"])

    def _publish(self, commit: Commit) -> bool:
        """Take the commit's number; False if another writer has it."""
        said = json.dumps({"buckets": self.buckets, "schemas": commit.schemas, "versions": commit.versions})
        draft = f"{self.folder}/{COMMITS}/_{uuid.uuid4().hex}"
        path, fs = path_handle(self.spark, draft)
        out = fs.create(path, False)
        out.write(bytearray(said.encode()))
        out.close()
        if claim(self.spark, draft, f"{self.folder}/{COMMITS}/{commit.number:010d}.json"):
            return True
        discard(self.spark, draft)
        return False

    # --- reading ----------------------------------------------------------------------
    def read(self, table: str, commit: Commit | None = None, buckets: set[str] | None = None) -> DataFrame:
        """A table as of a commit, the last one if none is given. Of the buckets named only their
        files are opened."""
        commit = commit or self.latest()
        if table not in commit.schemas:
            raise ValueError(f"no table {table} in {self.folder}")
        schema = T.StructType.fromJson(json.loads(commit.schemas[table]))
        paths = [f"{self.folder}/{table}/{v}/{BUCKET}={b}" for b, v in sorted(commit.versions[table].items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_all(self) -> dict[str, DataFrame]:
        """All tables as of one commit."""
        commit = self.latest()
        return {t: self.read(t, commit) for t in commit.schemas}

    # --- writing ----------------------------------------------------------------------
    def _write(self, table: str, rows: DataFrame) -> dict[str, str]:
        """Write rows under a new version; the version by bucket that has rows."""
        version = uuid.uuid4().hex
        path = f"{self.folder}/{table}/{version}"
        # a bucket with much of the rows is split among tasks by adaptive execution
        dealt = with_bucket(rows, self.buckets, self.key).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key)
        dealt.write.partitionBy(BUCKET).parquet(path)
        return {name.split("=")[1]: version for name in children(self.spark, path) if name.startswith(f"{BUCKET}=")}

    def load(self, tables: dict[str, DataFrame]) -> Commit:
        """Set whole tables in one commit; other tables of the set stay as they are."""
        written = {t: self._write(t, df) for t, df in tables.items()}
        schemas = {t: df.schema.json() for t, df in tables.items()}
        while True:
            base = self.latest()
            commit = Commit(base.number + 1, {**base.schemas, **schemas}, {**base.versions, **written})
            if self._publish(commit):
                return commit

    def replace(self, new: dict[str, DataFrame], tickers: DataFrame) -> Commit:
        """Replace some tickers' rows in every table of the set, in one commit. ``new`` may hold
        rows of other tickers, which are passed over, and a table it leaves out only loses rows."""
        base = self.latest()
        unknown = set(new) - set(base.schemas)
        if unknown:
            raise ValueError(f"no table {', '.join(sorted(unknown))} in {self.folder}")
        touched = {str(r[0]) for r in with_bucket(tickers, self.buckets, self.key).select(BUCKET).distinct().collect()}
        written = self._replaced(base, new, tickers, touched)
        while True:
            versions = {t: {**{b: v for b, v in old.items() if b not in touched}, **written[t]} for t, old in base.versions.items()}
            commit = Commit(base.number + 1, base.schemas, versions)
            if self._publish(commit):
                return commit
            newer = self.latest()
            if set(newer.schemas) != set(written) or newer.touches(base, touched):
                written = self._replaced(newer, new, tickers, touched)
            base = newer

    def _replaced(self, base: Commit, new: dict[str, DataFrame], tickers: DataFrame, touched: set[str]) -> dict[str, dict[str, str]]:
        written = {}
        for t in base.schemas:
            stored = self.read(t, base, touched)
            fresh = new[t].select(*stored.columns) if t in new else stored.limit(0)
            written[t] = self._write(t, replaced_rows(stored, fresh, tickers.select(self.key).distinct(), self.key))
        return written

    def sweep(self) -> int:
        """Delete versions that the last commit does not name; how many there were. For when no
        writer is at work and no reader holds an older commit."""
        commit, gone = self.latest(), 0
        for t in commit.schemas:
            named = set(commit.versions[t].values())
            for version in children(self.spark, f"{self.folder}/{t}"):
                if version not in named:
                    discard(self.spark, f"{self.folder}/{t}/{version}")
                    gone += 1
        return gone
