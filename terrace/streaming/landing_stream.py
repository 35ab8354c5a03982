"""Incremental landing with Structured Streaming: newly delivered files of a landing folder are
parsed, dated from their name (or path) and appended to the raw table as they arrive.

This is the streaming form of the reference's delta mode (one run per incoming file):
a file-source stream (each file is read once, tracked in the source log) into the Parquet file
sink partitioned by the file date.  The file sink commits through its ``_spark_metadata`` log, so
a retried micro-batch after a lost executor or driver never duplicates rows, and batch readers of
the table path see only committed files.

:func:`start_controlled_landing` is the form with controls: every micro-batch of new files goes through
the whole landing job (names, formats, columns, duplicate copies, rules; any format), commits under the
batch's name, and files a status row for each file.  A batch that is run again after a failure finds its
commits and adds nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.casting import all_string_schema
from ..functions.text import anchored, file_date
from ..plans.landing import land
from ..session import hadoop_fs
from ..sinks.tables import append
from ..sources.files import literal_path, source_path
from ..specs import LandingSpec, TableSpec


def landing_stream(spark: SparkSession, folder: str, spec: LandingSpec, columns: list[str], date_from: str = "name",
                   max_files_per_trigger: int | None = None):
    """The streaming DataFrame of landed rows (all strings) with the partition column."""
    if spec.csv.header and spec.csv.header_position:
        raise ValueError("streaming landing reads headers on the first line; files with lines before it land in batch")
    r = (spark.readStream.options(**spec.csv.read_options()).schema(all_string_schema(columns))
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if spec.file_format != "csv":
        raise ValueError("streaming landing reads CSV deliveries; other formats land in batch")
    rows = r.csv(literal_path(folder)).withColumn("_path", source_path())
    name = F.element_at(F.split("_path", "/"), -1)
    source = F.col("_path") if date_from == "path" else name
    stamped = rows.withColumn(spec.partition_field, file_date(source, spec.date_regex))
    valid = name.rlike(anchored(spec.filename_pattern)) & F.col(spec.partition_field).isNotNull()
    return stamped.where(valid).drop("_path")


def default_checkpoint(raw: TableSpec) -> str:
    """``<raw.path>/_landing_checkpoint``: on the table's storage (also at a bucket root), the same
    on every run, and invisible to readers of the table (``_`` prefix).  The stream owns the table:
    one landing stream per raw table, as the file sink's own log requires."""
    return f"{raw.path.rstrip('/')}/_landing_checkpoint"


def start_landing(spark: SparkSession, folder: str, spec: LandingSpec, raw: TableSpec, columns: list[str],
                  checkpoint: str | None = None, date_from: str = "name", available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the stream into ``raw.path``; ``available_now`` processes what is there and stops.

    The default checkpoint (:func:`default_checkpoint`) is beside the table and the same on every
    run, so a restarted stream resumes from its source log instead of re-reading every file.
    The table is a file-sink table
    (``_spark_metadata`` log): the stream owns it, and batch rewrites (merge, delete) belong to the
    next layer's tables."""
    stream = landing_stream(spark, folder, spec, columns, date_from)
    w = (stream.writeStream.format("parquet").outputMode("append").partitionBy(spec.partition_field)
         .option("checkpointLocation", checkpoint or default_checkpoint(raw)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start(raw.path)


#: Columns of the status table of a controlled landing.
STATUS = "path string, file_name string, file_date string, status string, error string, content_md5 string, delivery string, batch long"


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that owns a checkpoint folder, made when the folder is."""
    fs, at = hadoop_fs(spark, f"{checkpoint.rstrip('/')}/landing_id")
    if not fs.exists(at):
        fs.mkdirs(at.getParent())
        out = fs.create(at, False)
        out.write(bytearray(uuid.uuid4().hex[:12].encode()))
        out.close()
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def start_controlled_landing(spark: SparkSession, folder: str, spec: LandingSpec, raw: TableSpec, columns: list[str] | None,
                             status: TableSpec, checkpoint: str | None = None, max_files_per_trigger: int = 1000,
                             available_now: bool = True, processing_time: str | None = None, **options) -> StreamingQuery:
    """Lands new files of ``folder`` in micro-batches of at most ``max_files_per_trigger``, each with all
    controls; ``options`` are those of :func:`terrace.plans.landing.land` (date_from, checks, processed, rules, ...).
    Statuses go to the ``status`` table.  The stream only lists the files: their content is read by the
    landing job of the batch."""
    if status.schema is None:
        status = replace(status, schema=StructType.fromDDL(STATUS))
    checkpoint = checkpoint or default_checkpoint(raw)
    own = _identity(spark, checkpoint)

    def batch(files, number: int) -> None:
        paths = [r.path for r in files.collect()]   # bounded by max_files_per_trigger
        if paths:
            res = land(spark, folder, spec, raw, columns, files=sorted(paths), token=f"{own}-{number}", **options)
            append(spark, res.status.withColumn("batch", F.lit(number).cast("long")), status, token=f"{own}-{number}-status")
    listed = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger)).load(literal_path(folder)).select("path"))
    w = listed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
