"""Inputs derived by Spark from the given tables, in the shapes the reference's pipelines
receive: string-typed raw rows, nested JSON documents, XML, archives, landing folders and
processed-copy listings.  Every builder reads the whole given table, so its work grows with it;
groupings are bounded (at most ``chunk`` records per document / archive)."""

from __future__ import annotations

import io
import zipfile
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import delete_path, hadoop_fs
from .sources.files import write_file

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rendered as strings with injected bad numbers and dates."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 97 == 0, F.lit("k?")).otherwise(k.cast("string")).alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 11 == 0, F.lit("2024-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        "o_orderpriority")


def events_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("data_date", F.date_format("ts", "yyyy-MM-dd"))


def _event_record():
    return F.struct(
        F.col("event_id"), F.date_format("ts", TS_FORMAT).alias("ts"), F.col("user_id"),
        F.col("event_type"), F.col("value"), F.from_json("props", "struct<k:int>").alias("props"))


def event_documents(spark: SparkSession, sf_dir: str, form: str = "array", chunk: int = 100) -> DataFrame:
    """Events packed into JSON documents of at most ``chunk`` records, one per line:
    ``{"response_content": [...]|{id: {...}}, "data_date": ...}``; every other document omits
    ``data_date`` so the reader's file-date fallback is exercised.  Columns: (value, day)."""
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    grp = e.groupBy("day", F.floor(F.col("event_id") / chunk).alias("chunk"))
    if form == "array":
        content = F.collect_list(_event_record())
    else:
        content = F.map_from_entries(F.collect_list(F.struct(F.col("event_id").cast("string"), _event_record())))
    docs = grp.agg(content.alias("response_content"))
    with_date = F.to_json(F.struct("response_content", F.col("day").alias("data_date")))
    without = F.to_json(F.struct("response_content"))
    return docs.select(F.when(F.col("chunk") % 2 == 0, with_date).otherwise(without).alias("value"), "day")


def customer_for_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("_id"), "c_name", "c_nationkey", "c_acctbal",
                    F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def _zip_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                name = path.rsplit("/", 1)[-1]
                z.writestr(name, bytes(content))
                z.writestr("readme/", b"")           # a directory entry, skipped on expansion
            out.append((path + ".zip", buf.getvalue()))
        yield pd.DataFrame(out, columns=["path", "content"])


def deliver(lines: DataFrame, folder: str, header: str | None = None, names: list[str] | None = None) -> str:
    """Text files with given names: ``lines`` (name, value) become the lines of ``<folder>/<name>``, each below
    ``header``; ``names`` without a line are delivered too.  A fixture has few names, whatever the rows."""
    spark = lines.sparkSession
    out = f"{folder}__parts"
    first = [(n, header, 0) for n in names or []] if header is not None else []
    rows = lines.select("name", "value", F.lit(1).alias("n"))
    rows = rows.union(spark.createDataFrame(first, "name string, value string, n int")) if first else rows
    rows = rows.withColumn("place", F.col("name")).repartition("place").sortWithinPartitions("place", "n").drop("n", "name")
    rows.write.partitionBy("place").text(out)
    fs, at = hadoop_fs(spark, out)
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for place in fs.listStatus(at):
        if place.isDirectory():
            name = utils.unescapePathName(place.getPath().getName().partition("=")[2])
            part = [f for f in fs.listStatus(place.getPath()) if f.getPath().getName().startswith("part-")][0].getPath()
            target = hadoop_fs(spark, f"{folder}/{name}")[1]
            fs.mkdirs(target.getParent())
            fs.rename(part, target)
    delete_path(spark, out)
    return folder


def zip_files(files: DataFrame) -> DataFrame:
    """Each ``(path, content)`` file wrapped into its own zip archive (one file per task row)."""
    return files.select("path", "content").mapInPandas(_zip_each, "path string, content binary")


def deliver_archives(lines: DataFrame, folder: str, header: str) -> None:
    """Zip archives in ``folder``: ``lines`` (archive, member, value) grouped by archive, each member with
    ``header``.  Groups are bounded by the caller."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for member, values in group.sort_values("value").groupby("member")["value"]:
                z.writestr(member, "\n".join([header, *values]) + "\n")
        write_file(f"{folder}/{key[0]}", buf.getvalue())
        return pd.DataFrame({"archive": [key[0]]})
    lines.groupBy("archive").applyInPandas(run, "archive string").write.format("noop").mode("overwrite").save()


def document_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as delivered files, and earlier processed copies of them.

    incoming   (file_name, content): ``doc_<id>.txt`` holding the whole text
    processed  (path, file_name, content): two copies per document under
               ``insert_date=…/insert_time=…``; the later copy of every fourth document was
               edited; documents of source ``src0`` were never processed."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    incoming = d.select(name.alias("file_name"), F.col("text").alias("content"))
    copies = F.array(
        F.struct(F.lit("processed/insert_date=2024-01-01/insert_time=08:00:00/").alias("dir"),
                 F.concat(F.col("text"), F.lit(" [old]")).alias("content")),
        F.struct(F.lit("processed/insert_date=2024-01-02/insert_time=09:30:00/").alias("dir"),
                 F.when(F.col("doc_id") % 4 == 0, F.concat(F.col("text"), F.lit(" [edited]")))
                 .otherwise(F.col("text")).alias("content")))
    processed = (d.where(F.col("source") != "src0")
                 .select(name.alias("file_name"), F.explode(copies).alias("c"))
                 .select(F.concat("c.dir", "file_name").alias("path"), "file_name", F.col("c.content").alias("content")))
    return incoming, processed
