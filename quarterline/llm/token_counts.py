"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes (inserts, deletes, revised counts) is summed to one signed row for each key
and written under its batch id; the totals are the sum of all committed batches, of which the
earlier ones are stored as sums. A batch that was cut off does not count, applying it after its
commit changes nothing. Counts are additive, so sources of any size meet as partial sums only.

Null keys are keys of their own. A null text has no tokens, a very long one is counted whole. Repeated
rows are changes each; the order of changes in a batch and of batches plays no part, so there are
no ties. Keys whose documents all went are left out of the totals. An empty batch commits and
changes nothing. Other columns are ignored, whatever their names.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm.bpe import encoder, read_tokenizer
from quarterline.llm.encoding import SegmentTreeWords
from quarterline.plans.lineage import children, claim, discard

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Rows of ``op`` (insert, delete, revise), the keys and ``n_tokens`` to signed rows. A
    revision also names what it replaces: ``old_source``, ``old_lang``, ``old_tokenizer``,
    ``old_tokens``. Another ``op`` ends the job with an error."""
    def part(sign: int, prefix: str = ""):
        names = {k: F.col(prefix + k) for k in KEYS}
        tokens = F.coalesce(F.col("old_tokens" if prefix else "n_tokens"), F.lit(0))
        return F.struct(*[c.cast("string").alias(k) for k, c in names.items()],
                        F.lit(sign).cast("long").alias("documents"), (tokens * sign).cast("long").alias("tokens"))

    rows = (F.when(F.col("op") == "insert", F.array(part(1))).when(F.col("op") == "delete", F.array(part(-1)))
            .when(F.col("op") == "revise", F.array(part(-1, "old_"), part(1)))
            .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null"))))))
    return changes.select(F.explode(rows).alias("row")).select("row.*")


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


class Rollup:
    """The committed batches in one folder of the shared store, and sums of the earlier ones.

    A batch's deltas are written aside and take the batch's name when they are done; the name can
    be taken once, so of two writers of one batch one commits. After ``fold_after`` batches the sums so
    far and the ids they cover are stored as a snapshot, which takes its name in the same way: the
    totals read the last snapshot and the few batches it does not cover."""

    def __init__(self, spark: SparkSession, folder: str, fold_after: int = 16):
        self.spark, self.folder, self.fold_after = spark, folder.rstrip("/"), fold_after

    def committed(self) -> list[str]:
        """Ids of the committed batches; their number is that of the loads, not of rows."""
        return sorted(n for n in children(self.spark, f"{self.folder}/commits") if not n.startswith("_"))

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The last snapshot's folder and the batches it covers."""
        numbers = [int(n) for n in children(self.spark, f"{self.folder}/snapshots") if n.isdigit()]
        if not numbers:
            return None, set()
        path = f"{self.folder}/snapshots/{max(numbers):010d}"
        return path, {r.batch for r in self.spark.read.schema("batch string").parquet(f"{path}/covers").collect()}

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False if it had been committed before."""
        if not batch.replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"not a batch id: {batch!r}")
        if batch in self.committed():
            return False
        draft = f"{self.folder}/commits/_{uuid.uuid4().hex}"
        summed(signed(changes)).write.parquet(draft)
        if not claim(self.spark, draft, f"{self.folder}/commits/{batch}"):
            discard(self.spark, draft)
            return False
        if len(set(self.committed()) - self._snapshot()[1]) >= self.fold_after:
            self.fold()
        return True

    def fold(self) -> None:
        """Store the sums of all committed batches."""
        sums, covered = self._sums()
        if not covered:
            return
        draft = f"{self.folder}/snapshots/_{uuid.uuid4().hex}"
        sums.write.parquet(f"{draft}/sums")
        self.spark.createDataFrame([(b,) for b in sorted(covered)], "batch string").coalesce(1).write.parquet(f"{draft}/covers")
        if not claim(self.spark, draft, f"{self.folder}/snapshots/{len(covered):010d}"):
            discard(self.spark, draft)

    def _sums(self) -> tuple[DataFrame, set[str]]:
        path, covered = self._snapshot()
        later = [b for b in self.committed() if b not in covered]
        paths = [f"{path}/sums"] * (path is not None) + [f"{self.folder}/commits/{b}" for b in later]
        if not paths:
            return self.spark.createDataFrame([], DELTA), covered
        return summed(self.spark.read.schema(DELTA).parquet(*paths)), covered | set(later)

    def totals(self) -> DataFrame:
        return self._sums()[0].where("documents <> 0 OR tokens <> 0")


def bpe_count(df: DataFrame, text: str, tokenizer_path: str):
    """A column expression: the number of a text's ids."""
    told = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    @F.pandas_udf("long")
    def count(texts):
        import pandas as pd

        enc = encoder(told.value, SegmentTreeWords)
        return pd.Series([len(ids) // 4 for ids in enc.encode([t or "" for t in texts])], dtype="int64")

    return count(F.col(text))


def word_count(text: str):
    """Words between white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def piece_count(text: str):
    """Words cut at their punctuation: runs of letters or digits, and single other signs."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]")), F.lit(0)).cast("long")
