"""M1 records read (observed), M2 table totals after writes, M3 process timing rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def with_read_metrics(df: DataFrame, observation: Observation) -> DataFrame:
    """M1: the row count arrives with the first action on the frame; no extra pass."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def table_metrics(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """M2 totals: data files, bytes and rows of a Parquet table folder, in one aggregation: each row
    knows its file and the file's size (no column is read), files without rows are not counted."""
    if not path_exists(spark, path):
        return spark.createDataFrame([(name or path, 0, 0, 0)], "table string, files long, bytes long, rows long")
    per_file = (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
                .groupBy("f").agg(F.max("b").alias("b"), F.count(F.lit(1)).alias("n")))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
                        ).select(F.lit(name or path).alias("table"), "files", "bytes", "rows")


METRICS = ("operation string, rows_written long, inserted long, updated long, deleted long, files_added long, files_removed long, "
           "bytes_added long, bytes_removed long, total_files long, total_bytes long, total_rows long")


def write_metrics(spark: SparkSession, operation: str, result, path: str) -> DataFrame:
    """M2: one row for a write: its own figures, and the table's totals after it (from the footers of its
    files, read in tasks)."""
    m = result.merge
    own = (operation, result.rows_written, m.inserted if m else result.rows_written, m.updated if m else 0, m.deleted if m else 0,
           result.files_added, result.files_removed, result.bytes_added, result.bytes_removed)
    names = [c.split()[0] for c in METRICS.split(", ")]
    written = spark.createDataFrame([own], ", ".join(METRICS.split(", ")[:len(own)]))
    totals = table_metrics(spark, path).select(*[F.col(c).alias(f"total_{c}") for c in ("files", "bytes", "rows")])
    return totals.withColumns({c: F.lit(v).cast(written.schema[c].dataType) for c, v in zip(names, own)}).select(*names)


def process_events(spark: SparkSession, process: str, started: dt.datetime, finished: dt.datetime) -> DataFrame:
    """M3: start / end event rows and the duration with its unit."""
    secs = (finished - started).total_seconds()
    return spark.createDataFrame(
        [(process, "start", started, None, None), (process, "end", finished, secs, "Seconds")],
        "process string, event string, at timestamp, value double, unit string")
