"""The registered queries of this subpackage: each operator over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm import bpe, decontaminate, importance, katz, minhash_dedup, runs, secrets, suffix_dedup, token_counts as tc, token_files, topk, toxicity, warc
from quarterline.llm.words import short_batches
from quarterline.plans.lineage import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def q(name: str):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@q("op7_bpe_round_trip")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, "text", bpe.default_tokenizer()).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")



@q("op4_token_files")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write(docs, "doc_id", "text", bpe.default_tokenizer(), end_id=2)
    return token_files.read_checksums(manifest)


@q("op9_secret_scan")
def _(spark, sf_dir):
    return secrets.scan_table(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@q("op8_token_rollup")
def _(spark, sf_dir):
    """Totals after four batches: all documents come in under two tokenizers, later copies of
    a text go, the word counts of what is left are revised to a new version, and the second
    batch comes once more, which changes nothing. Rows without id come after all others of their
    text; of those the one with the smallest source and language stays."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    counted = materialise(docs.select(
        "doc_id", "source", "lang", F.sha2(text.cast("binary"), 256).alias("digest"),
        tc.word_count("text").alias("words"), tc.piece_count("text").alias("pieces"),
        tc.bpe_count(docs, "text", bpe.default_tokenizer()).alias("bpe")), "counted")
    # rows alike in all that follows go together, with their number
    alike = ["digest", "doc_id", "source", "lang", "words", "pieces", "bpe"]
    groups = counted.groupBy(*alike).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("source").isNull(), "source", F.col("lang").isNull(), "lang")
    first = groups.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.min(order).alias("first"))
    # all rows of the smallest id stay, or one without id
    stay = F.when(F.col("doc_id").isNotNull(), F.when(F.col("doc_id") == F.col("first_id"), F.col("n")).otherwise(0)).otherwise(
        F.when(order.eqNullSafe(F.col("first")), 1).otherwise(0))
    groups = groups.join(first, "digest").withColumn("stay", stay.cast("int"))
    rows = lambda n, copy: groups.where(n > 0).select("*", F.explode(F.sequence(F.lit(1), n.cast("int")))).select(
        "source", "lang", "words", "pieces", "bpe", F.lit(copy).alias("copy"))
    left, gone = rows(F.col("stay"), False), rows(F.col("n") - F.col("stay"), True)

    def both(op: str, rows):
        line = lambda name, n: F.struct(F.lit(name).alias("tokenizer"), F.col(n).alias("n_tokens"))
        old = [F.lit(None).cast(t).alias(f"old_{c}") for c, t in (("source", "string"), ("lang", "string"), ("tokenizer", "string"), ("tokens", "long"))]
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.explode(F.array(line("words-1", "words"), line("byte_bpe_50k-1", "bpe"))).alias("x"), *old).select("*", "x.*").drop("x")

    copies = both("delete", gone)
    revised = left.select(
        F.lit("revise").alias("op"), "source", "lang", F.lit("words-2").alias("tokenizer"), F.col("pieces").alias("n_tokens"),
        F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.lit("words-1").alias("old_tokenizer"), F.col("words").alias("old_tokens"))
    rollup = tc.Rollup(spark, new_path(spark, "token_rollup"))
    for batch, changes in (("1-load", both("insert", counted)), ("2-copies", copies), ("3-words", revised), ("2-copies", copies)):
        rollup.apply(batch, changes)
    return rollup.totals()


@q("op2_warc_chunks")
def _(spark, sf_dir):
    archived = warc.write(warc.records(table(spark, sf_dir, "pages"), "page_id", "url", "html"))
    return warc.read(archived, payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@q("op1_minhash_dedup")
def _(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", width=3, percent=85)


@q("op5_toxicity_crf")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, spans="toxic").select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.array_join(F.transform("toxic", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("toxic_offsets"))


@q("op10_string_tiling")
def _(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@q("op6_suffix_dedup")
def _(spark, sf_dir):
    report = suffix_dedup.removal_report(table(spark, sf_dir, "documents"), "doc_id", "text")
    return report.withColumn("has_repeats", F.col("n_removed") > 0)


@q("op3_maxscore_topk")
def _(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


@q("op13_periodic_runs")
def _(spark, sf_dir):
    asked = runs.varied(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = runs.periodic_runs(asked, "doc_id", "text")
    return found.withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(runs.listing(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@q("op12_importance_draw")
def _(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@q("op11_katz_backoff")
def _(spark, sf_dir):
    """Logarithms are rounded to six decimals, as the order of their sums is open."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scores, _ = katz.score(table(spark, sf_dir, "documents"), "doc_id", "text", ~held_out)
    return scores.select("doc_id", (~F.col("taught")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"), "n_backed_off")
