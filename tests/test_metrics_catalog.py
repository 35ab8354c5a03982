import datetime as dt

import pytest

from terrace.plans.metrics import process_events, table_metrics, with_read_metrics, write_metrics
from terrace.sinks.tables import append, register_partition
from terrace.specs import TableSpec
from terrace.sources.tables import table_schema
from pyspark.sql import Observation


def test_table_metrics_and_read_metrics(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], "k int, v string, d string")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="d")
    append(spark, df, spec)
    m = table_metrics(spark, spec.path, "t").first()
    assert m.rows == 2 and m.files >= 2 and m.bytes > 0
    assert table_metrics(spark, f"{tmp_dir}/missing").first().rows == 0
    obs = Observation("read")
    with_read_metrics(spark.read.parquet(spec.path), obs).collect()
    assert obs.get["rows"] == 2


def test_process_events_and_write_metrics(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    ev = process_events(spark, "landing", t0, t0 + dt.timedelta(seconds=90)).collect()
    assert [(r.event, r.value, r.unit) for r in ev] == [("start", None, None), ("end", 90.0, "Seconds")]
    from terrace.sinks.tables import merge_into
    df = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], "k int, v string, d string")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, primary_keys=["k"], partition_field="d")
    first = write_metrics(spark, "append", append(spark, df, spec), spec.path).first()
    assert (first.rows_written, first.inserted, first.files_added, first.files_removed, first.total_rows) == (2, 2, 2, 0, 2)
    then = write_metrics(spark, "merge", merge_into(spark, spec, spark.createDataFrame([(2, "B", "p2"), (3, "c", "p3")], df.schema)), spec.path).first()
    assert (then.inserted, then.updated, then.deleted, then.total_rows, then.files_removed) == (1, 1, 0, 3, 1)
    assert then.total_bytes == first.total_bytes + then.bytes_added - then.bytes_removed


def test_schema_lookup_partition_last(spark, tmp_dir):
    df = spark.createDataFrame([(1, "p")], "k int, d string")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="d")
    append(spark, df, spec)
    rows = table_schema(spark, spec).collect()
    assert [(r.column_name, r.is_partition) for r in rows] == [("k", False), ("d", True)]


def test_register_partition_on_catalog_table(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS terrace_parts")
    spark.createDataFrame([(1, "2024-01-01")], "k int, data_date string").write.partitionBy("data_date") \
        .option("path", f"{tmp_dir}/cat").saveAsTable("terrace_parts")
    register_partition(spark, "terrace_parts", "data_date", "2024-01-02")
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS terrace_parts").collect()}
    assert "data_date=2024-01-02" in parts
    with pytest.raises(ValueError):
        register_partition(spark, "terrace_parts", "k", "1")
    spark.sql("DROP TABLE IF EXISTS terrace_parts")


def test_scratch_under_the_session_checkpoint_folder(spark):
    from terrace.session import checkpoint_root, scratch_path
    live = spark.sparkContext.getCheckpointDir().rstrip("/")
    assert checkpoint_root(spark) == live
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(live + "/terrace-scratch/x-") and p1 != p2


def test_streaming_landing_resumes_after_restart(spark, tmp_dir):
    import os
    from terrace.specs import LandingSpec
    from terrace.streaming.landing_stream import start_landing
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/d_2024_01_01.csv", "w") as f:
        f.write("id\n1\n2\n")
    spec = LandingSpec(filename_pattern=r"d_.*\.csv", date_regex=r"(\d{4})_(\d{2})_(\d{2})")
    raw = TableSpec(f"{tmp_dir}/raw", partition_field="data_date")
    start_landing(spark, f"{tmp_dir}/in", spec, raw, ["id"]).awaitTermination()
    with open(f"{tmp_dir}/in/d_2024_01_02.csv", "w") as f:
        f.write("id\n3\n")
    start_landing(spark, f"{tmp_dir}/in", spec, raw, ["id"]).awaitTermination()   # a restart
    rows = sorted((r.id, str(r.data_date)) for r in spark.read.parquet(raw.path).collect())
    assert rows == [("1", "2024-01-01"), ("2", "2024-01-01"), ("3", "2024-01-02")]


def test_stream_checkpoint_default_is_beside_the_table():
    from terrace.streaming.landing_stream import default_checkpoint
    assert default_checkpoint(TableSpec("/data/raw/t/")) == default_checkpoint(TableSpec("/data/raw/t")) == "/data/raw/t/_landing_checkpoint"
    assert default_checkpoint(TableSpec("s3a://lake/")) == "s3a://lake/_landing_checkpoint"


def test_partitions_with_odd_values_are_synced(spark, tmp_dir):
    from terrace.sinks.tables import read_target, sync_partitions
    df = spark.createDataFrame([(1, "it's a/b"), (2, "x=1"), (3, None)], "k int, d string")
    spec = TableSpec(f"{tmp_dir}/odd", schema=df.schema, partition_field="d")
    res = append(spark, df, spec)
    spark.sql("DROP TABLE IF EXISTS odd_parts")
    spark.sql(f"CREATE TABLE odd_parts (k INT, d STRING) USING parquet PARTITIONED BY (d) LOCATION '{spec.path}'")
    folders = [n.rpartition("/")[0] for n in __import__("terrace.sinks.commit", fromlist=["Commits"]).Commits(spark, spec.path).files(deep=True)]
    sync_partitions(spark, "odd_parts", folders, [])
    assert sorted(r.k for r in spark.table("odd_parts").collect()) == [1, 2, 3] and res.files_added == 3
    sync_partitions(spark, "odd_parts", [], [f for f in folders if "x" in f])
    assert sorted(r.k for r in spark.table("odd_parts").collect()) == [1, 3]
    assert read_target(spark, spec).count() == 3      # files are left alone
    spark.sql("DROP TABLE IF EXISTS odd_parts")
