"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

#: Bytes that make up words: digits, lower-case letters and every byte of a non-ASCII character;
#: all other bytes become blanks, A-Z become lower case.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


#: Bytes of one Arrow batch between Spark and its Python workers: long texts come in smaller batches.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what a worker holds of its input at a time, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")   # Spark's default is a plain number of bytes
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Returns free memory of this worker to the machine: workers are reused by later stages, and what
    one stage leaves in their allocators would count against the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """``run`` over Arrow batches, giving memory back when its task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 ``text`` with A-Z lower-cased."""
    return text.translate(WORD_BYTES).split() if text else []


def staged(df: DataFrame, name: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the cluster's shared folder and read back, with its path;
    ``codec`` names another compression than the session's.

    A written table cuts the lineage: later jobs read it again after an executor is lost instead
    of computing it anew."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    return out, path


def release(spark: SparkSession, *paths: str) -> None:
    """Deletes staged tables that nothing reads any more, and lets the driver collect the plans of
    finished jobs, so that Spark removes their shuffle files from the executors' disks now."""
    for path in paths:
        delete_path(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts; sizes the number of work units, which grows with the input."""
    return int(docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0)


def units(total: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


def fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(folds)


def plainly(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, str, str, list[str]]:
    """``docs`` with columns c0, c1, ... so that no column's name can clash with an operator's own;
    the new names of the text and the id, and the old names, for ``toDF`` at the end."""
    bounded_batches(docs.sparkSession)
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), f"c{names.index(text)}", f"c{names.index(doc_id)}", names


def result_names(keep: list[str], results: list[str]) -> list[str]:
    """Names of result columns beside kept ones: a result that is named like a kept column (in any
    case) gets as many underscores at its end as make it differ."""
    taken, out = {c.lower() for c in keep}, []
    for name in results:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
