"""Cut a long lineage by writing a table to the folder that driver and executors share."""
from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where it is unset, a folder beside the
    session's tables, which executors see as well. The master plays no part."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return root.rstrip("/")


def session_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder. It goes when the application ends."""
    path = f"{shared_folder(spark)}/quarterline-{spark.sparkContext.applicationId}"
    jvm_path, fs = path_handle(spark, path)
    if not fs.exists(jvm_path):
        fs.mkdirs(jvm_path)
        fs.deleteOnExit(jvm_path)
    return path


def path_handle(spark: SparkSession, path: str):
    """A path and its file system."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right under a path; none if it is not there."""
    jvm_path, fs = path_handle(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []


def claim(spark: SparkSession, draft: str, final: str) -> bool:
    """Give what was written aside its name, unless somebody has it. One of several wins where the
    file system renames atomically, as HDFS does."""
    jvm = spark.sparkContext._jvm
    source, _ = path_handle(spark, draft)
    target, _ = path_handle(spark, final)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as taken:
        if "FileAlreadyExistsException" not in taken.java_exception.getClass().getName():
            raise
        return False
    return True


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """What the files under some paths are like: their number, bytes and a digest of names, sizes
    and times. Spark lists them, nothing is opened; the order plays no part."""
    if not paths:
        return "no files"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([unquote(p) for p in paths])
    row = files.select(F.xxhash64("path", "length", F.unix_micros("modificationTime")).alias("h"), "length").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x")).first()
    return f"{row.n} files, {row.size} bytes, {row.x & (1 << 64) - 1:016x}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table or folder of an earlier step that nothing reads any more."""
    jvm_path, fs = path_handle(spark, path)
    fs.delete(jvm_path, True)


def materialise(df: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Unlike cached blocks the table survives lost executors, and later reads prune columns and
    push filters into it. The first column of ``by`` is the table's partition, inside which rows
    are sorted by the others; adaptive execution has a large partition written by several tasks.
    (Ranges would need a sample, for which Spark works the whole table out a first time.)
    """
    path = path or new_path(df.sparkSession, name)
    if by:
        df.hint("rebalance", by[0]).sortWithinPartitions(*by).write.partitionBy(by[0]).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
