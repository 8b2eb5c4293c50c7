"""Secret scans with an incremental ledger of blobs.

Every version of a path is addressed by the SHA-256 of its text. The ledger says which pairs of
blob and rule version have been scanned; a run scans the pairs that are new, each text once,
and joins the findings back to all paths. Findings of a run count once its pairs are marked, so
a run that was cut off is repeated and nothing counts twice.

DataFrame functions only. Copies of a text meet in a partial aggregation, so one text that a
third of all paths share is one row before anything is shuffled; findings are grouped by text,
which no group of copies makes larger.

A null text counts as empty and has no findings. Very long texts are scanned whole. Repeated
rows give repeated results. Other columns are left alone. Empty tables give empty results.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterline.plans.lineage import discard, materialise, new_path


@dataclass(frozen=True)
class Rule:
    """``group`` of a match has ``least`` characters at least; matches that fall short still
    take up their characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}-{self.version}"


# fixed values: the base patterns, in the order in which their kinds are listed
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, "[0-9a-f]{32,}", 0, 32),  # a run is taken whole, so shorter ones may be passed over
)

FINDING = "blob string, rule string, start long, end long"


def versions(df: DataFrame, path: str, text: str, version: Column | None = None) -> DataFrame:
    """``path``, ``version``, ``blob`` and ``text`` of every version of every path."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        F.col(path).alias("path"), (version if version is not None else F.lit(0)).alias("version"),
        F.sha2(body.cast("binary"), 256).alias("blob"), body.alias("text"))


class Ledger:
    """Scanned pairs and findings, as Parquet in one folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rule string, run string")

    def findings(self) -> DataFrame:
        """Findings of runs that came to their end."""
        runs = self.scanned().select("run").distinct()
        return self._read("findings", FINDING + ", run string").join(runs, "run", "left_semi")

    def scan(self, found: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new among ``versions``."""
        run = uuid.uuid4().hex
        blobs = found.groupBy("blob").agg(F.first("text").alias("text"))
        done = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("done"))  # a rule each
        keys = F.array(*[F.lit(r.key) for r in rules])
        need = F.array_except(keys, F.coalesce("done", F.array().cast("array<string>")))
        unseen = blobs.join(done, "blob", "left").select("blob", "text", need.alias("need")).where(F.size("need") > 0)
        spans(unseen, rules).withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.folder}/findings")
        marks = found.select("blob").distinct().join(done, "blob", "left").select("blob", F.explode(need).alias("rule"))
        marks.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.folder}/scanned")


def spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of each blob under the rules in its array ``need``: leftmost matches that don't
    overlap, by code points, the end exclusive."""
    text = F.col("text")

    def matches(rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        zipped = F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"))
        row = F.transform(F.filter(zipped, lambda x: x["hit"].isNotNull()), lambda x, i: F.struct(
            F.lit(rule.key).alias("rule"), i.alias("at"), F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("size"), (F.length(x["part"]) >= rule.least).alias("kept")))
        return F.when(F.array_contains("need", rule.key) & text.rlike(rule.pattern), row)

    empty = F.array().cast("array<struct<rule:string,at:int,gap:int,size:int,kept:boolean>>")
    hits = F.concat(*[F.coalesce(matches(r), empty) for r in rules])
    run = Window.partitionBy("blob", "rule").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    return (
        blobs.select("blob", F.explode(hits).alias("hit")).select("blob", "hit.*")
        .withColumn("end", end.cast("long")).where("kept")
        .select("blob", "rule", (F.col("end") - F.col("size")).cast("long").alias("start"), "end"))


def _by_blob(findings: DataFrame, rules: tuple[Rule, ...], base: int) -> DataFrame:
    """One row a blob: counts of the first ``base`` kinds, their digest, all spans as text."""
    order = reduce(lambda c, r: c.when(F.col("rule") == r[1].key, r[0]), enumerate(rules), F.when(F.lit(False), -1))
    kind = F.regexp_replace("rule", "-[0-9]+$", "")
    one = F.struct(F.col("start"), order.alias("kind"), F.concat_ws(":", kind, "start", "end").alias("shown"))
    grouped = findings.where(order.isNotNull()).groupBy("blob").agg(
        F.array_sort(F.collect_list(one)).alias("all"),
        *[F.count_if(F.col("rule") == r.key).alias(f"n_{r.kind}") for r in rules[:base]])
    shown = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: x["shown"]))
    return grouped.select(
        "blob", *[f"n_{r.kind}" for r in rules[:base]],
        F.sha2(shown(F.filter("all", lambda x: x["kind"] < base)), 256).alias("base_sha256"),
        shown(F.col("all")).alias("spans"), F.transform("all", lambda x: x["start"]).alias("starts"),
        F.transform("all", lambda x: F.element_at(F.split(x["shown"], ":"), 3).cast("long")).alias("ends"))


def report(found: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = 3) -> DataFrame:
    """Findings joined back to every path and version."""
    counts = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules[:base]]
    return found.select("path", "version", "blob").join(_by_blob(findings, rules, base), "blob", "left").select(
        "path", "version", *counts, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def scan_table(df: DataFrame, path: str, text: str) -> DataFrame:
    """Scan a table against a ledger of its own; returns ``report``'s columns."""
    ledger = Ledger(df.sparkSession, new_path(df.sparkSession, "secret_ledger"))
    found = versions(df, path, text)
    ledger.scan(found)
    return report(found, ledger.findings())


BLOCK = 4096  # code points of a text that are cut out together


def merged(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``cuts``: its spans, those that overlap or touch as one, in order, each with the
    end of the one before."""
    own = findings.where(F.col("rule").isin([r.key for r in rules])).select("blob", "start", "end")
    line = Window.partitionBy("blob").orderBy("start", "end")
    reached = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    rows = own.withColumn("fresh", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    rows = rows.withColumn("n", F.sum("fresh").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = rows.groupBy("blob", "n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    before = F.coalesce(F.lag("end").over(Window.partitionBy("blob").orderBy("n")), F.lit(0))
    # a text's own spans
    return spans.withColumn("before", before).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end", "before"))).alias("cuts"))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to ``end`` of a text in blocks."""
    i, j = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    at, to = (start % BLOCK).cast("int"), (end % BLOCK).cast("int")
    block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    one = F.substring(block(i), at + 1, to - at)
    several = F.concat(F.substring(block(i), at + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.substring(block(j), F.lit(1), to))
    return F.when(i == j, one).otherwise(several)


def redact(df: DataFrame, text: str, mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Put ``mask`` in place of every span; spans that overlap or touch become one mask. Nulls
    and texts without findings stay as they are. A text is cut once into blocks, and each piece
    between spans comes out of its blocks, so the work goes with text and findings and not with their
    product."""
    spark = df.sparkSession
    folder = new_path(spark, "secret_ledger")
    ledger = Ledger(spark, folder)
    names = df.columns
    ledger.scan(versions(df.select(F.lit(None).cast("long").alias("path"), F.col(text).alias("text")), "path", "text"), rules)
    found = materialise(merged(ledger.findings(), rules).select(F.col("blob").alias("__secret_blob"), F.col("cuts").alias("__cuts")), "secret_spans")
    discard(spark, folder)
    body = F.col(text)
    rows = df.withColumn("__secret_blob", F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256)).join(found, "__secret_blob", "left")
    # a column of its own, or the text is cut again for each span
    rows = rows.withColumn("__blocks", F.when(F.col("__cuts").isNotNull(), F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    kept = F.array_join(F.transform("__cuts", lambda c: F.concat(_piece(F.col("__blocks"), c["before"], c["start"]), F.lit(mask))), "")
    rest = _piece(F.col("__blocks"), F.element_at("__cuts", -1)["end"], F.length(body).cast("long"))
    clean = F.when(F.col("__cuts").isNull(), body).otherwise(F.concat(kept, rest))
    return rows.select(*[clean.alias(c) if c == text else F.col(c) for c in names])
