"""Reader and writer of company filing documents: one JSON file per company.

The concept registry becomes the read schema, so the JSON parser materialises the few
registered concepts and skips the hundreds of others while it scans; nothing is inferred.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.constants import CONCEPT_REGISTRY

_FACT = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("start", "end", "val", "accn", "fy", "fp", "form", "filed", "frame")
])
NAMESPACES = ("us-gaap", "dei")
#: The partition column of a folder of documents that Spark has written.
DOCUMENT = "document"


def _document_schema() -> T.StructType:
    namespaces = []
    for ns in NAMESPACES:
        concepts = [
            T.StructField(concept.split(":", 1)[1], T.StructType([
                T.StructField("units", T.StructType([
                    T.StructField(unit, T.ArrayType(_FACT)),
                ])),
            ]))
            for concept, _kind, unit in CONCEPT_REGISTRY if concept.startswith(ns + ":")
        ]
        namespaces.append(T.StructField(ns, T.StructType(concepts)))
    return T.StructType([
        T.StructField("cik", T.StringType()),
        T.StructField("entityName", T.StringType()),
        T.StructField("facts", T.StructType(namespaces)),
        T.StructField("_corrupt_record", T.StringType()),
    ])


def entry_name(cik: int) -> str:
    return f"CIK{int(cik):010d}.json"


def read_documents(spark: SparkSession, directory: str, ciks: list[int] | None = None) -> DataFrame:
    """Documents with ``cik``, ``entity_name``, ``facts``, ``file_name`` and ``is_error``.

    A folder holds the files themselves, or a partition for each as ``write_documents`` makes
    them. ``ciks`` lists the companies wanted: their names are a filter on the listing, which Spark
    makes once, and no other file is opened; the ones that are missing are passed over. A file
    that is no JSON document yields one row with ``is_error``; it never stops the load. A document
    without ``cik`` has the first digits of its name, or 0.
    """
    docs = (
        spark.read.schema(_document_schema())
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(directory)
    )
    name = F.col(DOCUMENT) if DOCUMENT in docs.columns else F.col("_metadata.file_name")
    if ciks is not None:
        docs = docs.where(name.isin(sorted({entry_name(c) for c in ciks})))
    from_name = F.regexp_extract(name, r"(\d+)", 1).try_cast("bigint")
    return docs.select(
        F.coalesce(F.col("cik").try_cast("bigint"), from_name, F.lit(0)).alias("cik"),
        F.col("entityName").alias("entity_name"),
        "facts",
        name.alias("file_name"),
        (F.col("_corrupt_record").isNotNull() & F.col("facts").isNull()
         & F.col("cik").isNull() & F.col("entityName").isNull()).alias("is_error"),
    )


def write_documents(texts: DataFrame, directory: str) -> None:
    """Write ``document`` (a file's name) and ``text``, each as a partition of its own."""
    texts.select(DOCUMENT, "text").write.partitionBy(DOCUMENT).text(directory)


def explode_facts(documents: DataFrame) -> DataFrame:
    """One row per reported fact of a registered concept in its required unit."""
    entries = F.array(*[
        F.struct(
            F.lit(concept).alias("concept"),
            F.lit(kind).alias("kind"),
            F.lit(unit).alias("unit"),
            F.col("facts").getField(concept.split(":", 1)[0])
            .getField(concept.split(":", 1)[1]).getField("units").getField(unit).alias("items"),
        )
        for concept, kind, unit in CONCEPT_REGISTRY
    ])
    return (
        documents.where(~F.col("is_error"))
        .select("cik", F.inline(entries))
        .select("cik", "concept", "kind", "unit", F.posexplode("items").alias("pos", "f"))
        .select(
            "cik", "concept", "kind", "unit", "f.start", "f.end",
            F.col("f.val").try_cast("double").alias("val"),
            "f.accn", F.col("f.fy").try_cast("int").alias("fy"), "f.fp", "f.form", "f.filed",
            "f.frame", F.col("pos").cast("long").alias("pos"),
        )
    )


def company_names(documents: DataFrame) -> DataFrame:
    """Names seen in filings."""
    return documents.where("entity_name is not null and entity_name <> ''").select(
        "cik", "entity_name"
    )


def load_counts(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count("*").alias("files"), F.count_if("is_error").alias("errors"),
        F.count("entity_name").alias("companies"),
    )
