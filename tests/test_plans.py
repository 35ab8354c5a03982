"""Plans: what reaches the scan, how often data is shuffled, and that no join is forced."""

import re

from conftest import SF_SMALL
from pyspark.sql import functions as F
from terrace.operators.merge import plan_merge
from terrace.quality.engine import _regex_valid
from terrace.sinks.tables import _writer, append, read_target, table_rows
from terrace.sources.tables import read_partition, read_table
from terrace.specs import TableSpec


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(read_table(spark, f"{SF_SMALL}/orders.parquet", where="o_orderstatus = 'F'", columns=["o_orderkey"]))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_delta_reads_prune_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(1, "p1"), (2, "p2")], "k int, d string")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="d")
    append(spark, df, spec)
    assert re.search(r"PartitionFilters: \[isnotnull\(d#\d+\), \(d#\d+ = p1\)\]", physical(read_partition(spark, spec, "delta", "p1")))


def test_raw_rows_are_shuffled_once(spark, tmp_dir):
    df = spark.range(100).selectExpr("id", "CAST(id % 3 AS STRING) AS d", "CAST(id % 7 AS STRING) AS f")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="d", source_field="f")
    rows = table_rows(spark, df, spec)
    assert physical(rows).count("Exchange") == 0
    assert physical(rows.hint("rebalance", *spec.partition_columns)).count("Exchange ") == 1
    assert _writer(rows, spec, "overwrite") is not None


def test_regex_checks_are_one_aggregation(spark):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    rule = {"control_description": "^C", "control_threshold_type": "Binary", "control_threshold_min": None, "control_threshold_max": None}
    checks = [F.count_if(_regex_valid({**rule, "control_description": p}, c)).alias(f"c{i}") for i, (p, c) in enumerate([("^C", "c_name"), ("x", "c_name"), ("^B", "c_mktsegment")])]
    plan = physical(customer.agg(*checks))
    assert plan.count("Scan parquet") == 1 and "Expand" not in plan


def test_merges_leave_the_join_to_spark(spark):
    t = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for strategy in ("upsert", "insert_only", "update_only", "delete_matched"):
        text = plan_merge(t, t.where("o_orderkey % 7 = 0"), ["o_orderkey"], strategy).frame._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in text and "broadcast" not in text.lower()


def test_written_tables_read_back_by_declared_types(spark, tmp_dir):
    df = spark.createDataFrame([(1, "007")], "k int, code string")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="code")
    append(spark, df, spec)
    assert [tuple(r) for r in read_target(spark, spec).collect()] == [(1, "007")]
