"""The registered query catalogue: one Spark plan per operator group of the inventory, each
with an equivalent DuckDB SQL oracle over the same parquet tables.

Every query reads whole given tables (or data Spark derives from them); queries that need files
write them under the session's shared checkpoint folder first.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from . import fixtures as fx
from .functions.casting import all_string_schema, cast_to, repair_json
from .functions.dates import apply_steps, format_date, register_transformation
from .functions.text import content_md5, normalise_header
from .operators.columns import (clean_names, coalesce_pairs, conform, distinct_tokens, pick_column, select_columns,
                                stack_columns)
from .operators.joins import equi_join
from .operators.merge import Clause
from .plans.flows import raw_to_staging, refine, run_summary
from .plans.landing import land
from .plans.metrics import write_metrics
from .plans.reports import run_reports
from .quality.engine import python_rule, run_controls, save_results, validate
from .quality.files import check_filenames, columns_result, csv_profile, flag_unchanged, format_result
from .quality.rules import master_frame, rules_frame
from .session import scratch_path
from .sinks.commit import Commits
from .sinks.tables import append, delete_where, merge_into, overwrite_partitions, read_target, write_raw
from .sources.files import archive_lines, list_files, read_csv, read_nested_json, read_xml
from .sources.tables import read_partition, read_table, table_schema
from .specs import CsvSpec, DateRepair, JsonSpec, LandingSpec, ReportSpec, TableSpec, XmlSpec
from .streaming.landing_stream import start_controlled_landing, start_landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


T = fx.table

# ------------------------------------------------------------------ scans and SQL


@register("read_filter_project", """
SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m%d') AS d, o_totalprice AS total
FROM orders WHERE o_orderstatus = 'F'
""")
def read_filter_project(spark, sf_dir):
    """Filter on source columns, then a projection of SQL expressions."""
    return read_table(spark, f"{sf_dir}/orders.parquet", where="o_orderstatus = 'F'",
                      columns=["o_orderkey AS k", "date_format(o_orderdate, 'yyyyMMdd') AS d", "o_totalprice AS total"])


LINEITEM_SUMMARY = """
SELECT l_returnflag, l_linestatus,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price,
       COUNT(*) AS count_order
FROM lineitem
WHERE CAST(l_shipdate AS DATE) <= DATE '1998-09-02'
GROUP BY l_returnflag, l_linestatus
"""


@register("sql_query", LINEITEM_SUMMARY)
def sql_query(spark, sf_dir):
    """S3: Spark SQL over a registered view."""
    T(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(LINEITEM_SUMMARY)


def _events_table(spark, sf_dir) -> TableSpec:
    events = fx.events_with_date(spark, sf_dir)
    spec = TableSpec(scratch_path(spark, "events_by_date"), schema=events.schema, partition_field="data_date")
    write_raw(spark, events, spec)
    return spec


EVENT_COLS = ["event_id", "user_id", "event_type", "value", "data_date"]


@register("partition_delta_read", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS data_date
FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'
""")
def partition_delta_read(spark, sf_dir):
    """Events filed by date, then one partition read back (directory pruning)."""
    spec = _events_table(spark, sf_dir)
    return read_partition(spark, spec, "delta", "2024-01-15").select(*EVENT_COLS)


@register("partition_full_read", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS data_date FROM events
""")
def partition_full_read(spark, sf_dir):
    spec = _events_table(spark, sf_dir)
    return read_partition(spark, spec, "full").select(*EVENT_COLS)


CUSTOMER_TYPES = StructType.fromJson(
    {"type": "struct", "fields": [
        {"name": "c_custkey", "type": "long", "nullable": True, "metadata": {}},
        {"name": "c_nationkey", "type": "integer", "nullable": True, "metadata": {}},
        {"name": "c_acctbal", "type": "double", "nullable": True, "metadata": {}}]})


@register("csv_roundtrip_cast", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_name || ', ' || c_mktsegment AS c_label
FROM customer
""")
def csv_roundtrip_cast(spark, sf_dir):
    """Customer written as CSV (quoted fields), read back all-string, cast."""
    c = T(spark, sf_dir, "customer").withColumn("c_label", F.concat_ws(", ", "c_name", "c_mktsegment"))
    path = scratch_path(spark, "customer_csv")
    c.write.options(header="true", sep=",").csv(path)
    raw = read_csv(spark, path, CsvSpec(), schema=c.columns)
    return cast_to(raw, CUSTOMER_TYPES)


EVENT_JSON_ORACLE = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value,
       replace(props, ' ', '') AS props, strftime(ts, '%Y-%m-%d') AS data_date
FROM events
"""
EVENT_JSON_TYPES = {"event_id": "bigint", "user_id": "bigint", "value": "double"}


def _event_docs_scan(spark, sf_dir, form):
    docs = fx.event_documents(spark, sf_dir, form)
    path = scratch_path(spark, f"event_docs_{form}")
    docs.hint("rebalance", "day").write.partitionBy("day").text(path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    day = F.regexp_extract("file_path", r"day=(\d{4}-\d{2}-\d{2})", 1)
    spec = JsonSpec("response_content", "array" if form == "array" else "dictionary")
    rows = read_nested_json(spark, lines, spec, columns=EVENT_RAW_COLS, file_date=day)
    return cast_to(rows, EVENT_JSON_TYPES)


@register("json_array_scan", EVENT_JSON_ORACLE)
def json_array_scan(spark, sf_dir):
    """Documents with records in an array; partition from document, else file."""
    return _event_docs_scan(spark, sf_dir, "array")


@register("json_dict_scan", EVENT_JSON_ORACLE)
def json_dict_scan(spark, sf_dir):
    """Documents with records as the values of an object."""
    return _event_docs_scan(spark, sf_dir, "dictionary")


@register("xml_scan", """
SELECT c_custkey AS id, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def xml_scan(spark, sf_dir):
    """Customer as XML (key as an attribute, missing elements), read all-string."""
    c = fx.customer_for_xml(spark, sf_dir)
    path = scratch_path(spark, "customer_xml")
    c.write.option("rowTag", "customer").option("rootTag", "customers").xml(path)
    rows = read_xml(spark, path, XmlSpec("/customers/customer"),
                    columns=["id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return cast_to(rows, {"id": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


ROWS_PER_ARCHIVE = 50_000


@register("archive_members", """
SELECT c_custkey, c_name, c_acctbal FROM customer
""")
def archive_members(spark, sf_dir):
    """Customer CSV part files, each zipped, expanded back into members and parsed."""
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "customer_parts")
    # the number of archives grows with the table: one for a bounded number of rows
    c.repartition(max(4, c.count() // ROWS_PER_ARCHIVE)).write.option("header", "true").csv(path)
    files = list_files(spark, path, "*.csv", with_content=True)
    lines = archive_lines(fx.zip_files(files), "zip")          # streamed, numbered member lines
    rows = lines.where((F.col("n") > 0) & (F.col("line") != ""))
    return rows.select(F.from_csv("line", "c_custkey bigint, c_name string, c_acctbal double").alias("r")).select("r.*")


# ------------------------------------------------------------------ joins and columns

def _join_sides(spark, sf_dir):
    shifted = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    c = T(spark, sf_dir, "customer").select(
        shifted.alias("custkey"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("status"), F.col("c_acctbal").alias("total"))
    apart = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(F.col("o_custkey") + 1_000_000_000)
    o = T(spark, sf_dir, "orders").select(
        apart.alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"))
    return c, o


JOIN_SIDES_SQL = """
WITH l AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS custkey, c_name AS name, c_mktsegment AS status, c_acctbal AS total
           FROM customer),
     r AS (SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_custkey + 1000000000 END AS custkey, o_orderkey AS orderkey,
                  o_orderstatus AS status, o_totalprice AS total FROM orders)
SELECT {key} AS custkey, l.name, l.status AS status_df_1, l.total AS total_df_1,
       r.orderkey, r.status AS status_df_2, r.total AS total_df_2
FROM l {kind} JOIN r ON l.custkey = r.custkey
"""

for _kind, _sql_kind, _key in [("inner", "INNER", "l.custkey"), ("left", "LEFT", "l.custkey"),
                               ("right", "RIGHT", "r.custkey"), ("outer", "FULL OUTER", "coalesce(l.custkey, r.custkey)")]:
    def _make(kind):
        def q(spark, sf_dir):
            """Same-named key once, clashing columns suffixed."""
            c, o = _join_sides(spark, sf_dir)
            return equi_join(c, o, kind, ["custkey"])
        return q
    register(f"join_{_kind}", JOIN_SIDES_SQL.format(key=_key, kind=_sql_kind))(_make(_kind))


@register("join_diff_keys", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def join_diff_keys(spark, sf_dir):
    """Right key renamed to the left name; only the left key column remains."""
    return equi_join(T(spark, sf_dir, "orders"), T(spark, sf_dir, "customer"), "inner", ["o_custkey"], ["c_custkey"])


@register("overwrite_columns", """
SELECT o.o_orderkey, o.o_custkey,
       coalesce(CASE WHEN c.c_acctbal < 0 THEN 'HOLD' END, o.o_orderpriority) AS o_orderpriority
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def overwrite_columns(spark, sf_dir):
    """P4 after J1: a per-customer override wins over the order's own value when not NULL."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                           F.col("o_orderpriority").alias("o_orderpriority_default"))
    c = T(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_acctbal") < 0, F.lit("HOLD")).alias("o_orderpriority_custom"))
    joined = equi_join(o, c, "left", ["o_custkey"])
    return coalesce_pairs(joined, ["o_orderpriority"], "_custom", "_default")


@register("add_dynamic_column", """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'R' THEN 'l_quantity' WHEN 'A' THEN 'l_discount' ELSE 'l_comment' END AS ref,
       CASE l_returnflag WHEN 'R' THEN l_quantity WHEN 'A' THEN l_discount ELSE -1.0 END AS picked
FROM lineitem
""")
def add_dynamic_column(spark, sf_dir):
    """P5: the value of the column named by another column; unknown names take the default."""
    li = T(spark, sf_dir, "lineitem").withColumn(
        "ref", F.when(F.col("l_returnflag") == "R", "l_quantity").when(F.col("l_returnflag") == "A", "l_discount")
        .otherwise("l_comment"))
    out = pick_column(li, "picked", "ref", ["l_quantity", "l_discount", "l_tax"], -1.0)
    return out.select("l_orderkey", "l_linenumber", "ref", "picked")


@register("stack_columns", """
SELECT 'c_name' AS column_name, c_name AS column_value FROM customer
UNION ALL SELECT 'c_mktsegment', nullif(c_mktsegment, 'HOUSEHOLD') FROM customer
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
""")
def stack_columns_q(spark, sf_dir):
    """Unpivot, NULL values kept, mixed types as strings."""
    c = T(spark, sf_dir, "customer").select(
        "c_name", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("c_mktsegment"), "c_nationkey")
    return stack_columns(c, ["c_name", "c_mktsegment", "c_nationkey"], ["column_name", "column_value"])


@register("unfold_string_values", r"""
SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS value
FROM documents WHERE text IS NOT NULL AND text <> ''
""")
def unfold_string_values(spark, sf_dir):
    """Distinct tokens over whole document texts (regex separator)."""
    return distinct_tokens(T(spark, sf_dir, "documents"), "text", r"[ \t\n\r]+")


@register("conform_distinct", """
SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem
""")
def conform_distinct(spark, sf_dir):
    """Target columns in order, whole-row distinct."""
    return conform(T(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])


@register("clean_column_names", """
SELECT o_orderkey AS OrderKey, o_totalprice AS TotalPrice, o_orderstatus AS statusflag FROM orders
""")
def clean_column_names(spark, sf_dir):
    """P8."""
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Order Key!"),
                                           F.col("o_totalprice").alias("Total-Price ($)"),
                                           F.col("o_orderstatus").alias("status/flag"))
    return clean_names(o)


@register("normalise_headers", r"""
SELECT p_partkey,
       regexp_replace(regexp_replace(replace(trim(lower(' ' || p_type || '/' || p_brand || ' (' || p_name || ') ')), '/', ' '),
                      '[^A-Za-z0-9\s_]', '', 'g'), '\s+', '_', 'g') AS header
FROM part
""")
def normalise_headers(spark, sf_dir):
    """P9 over header-like strings built from part."""
    p = T(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), "p_type", F.lit("/"), "p_brand", F.lit(" ("), "p_name", F.lit(") "))
    return p.select("p_partkey", normalise_header(raw).alias("header"))


# ------------------------------------------------------------------ casting

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(12,2)", "o_orderdate": "date"}


@register("cast_orders", """
SELECT CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderkey END AS o_orderkey, o.o_custkey, o.o_orderstatus,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_totalprice AS DECIMAL(12,2)) END AS o_totalprice,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS o_orderdate,
       o.o_orderpriority, c.c_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def cast_orders(spark, sf_dir):
    """C1/C4 + J1: string orders try-cast to the target types, then joined to customer names."""
    typed = cast_to(fx.raw_orders(spark, sf_dir), ORDER_TYPES)
    names = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return equi_join(typed, names, "left", ["o_custkey"])


BOOL_WORD = """CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'si' WHEN 2 THEN 'N' WHEN 3 THEN '0'
                    WHEN 4 THEN 'junk' ELSE 'TRUE' END"""


@register("cast_boolean", f"""
WITH w AS (SELECT o_orderkey, {BOOL_WORD} AS word FROM orders)
SELECT o_orderkey, word,
       CASE WHEN lower(word) IN ('true','t','yes','y','si','s','1') THEN true
            WHEN lower(word) IN ('false','f','no','n','0') THEN false END AS flag
FROM w
""")
def cast_boolean(spark, sf_dir):
    """Word lists, case-insensitive, anything else NULL."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", F.expr(BOOL_WORD).alias("word"))
    return cast_to(o.withColumn("flag", F.col("word")), {"flag": "boolean"})


@register("cast_json_struct", """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
FROM events
""")
def cast_json_struct(spark, sf_dir):
    """JSON text to struct; unparsable text gives NULL fields."""
    e = T(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 9 == 0, F.lit("not json")).otherwise(F.col("props")).alias("props"))
    return cast_to(e, {"props": "struct<k:int>"}).select("event_id", F.col("props.k").alias("k"))


REPAIR_NOTE = ("CASE event_id % 5 WHEN 0 THEN 'http://h/p?x=1&y=' || event_id WHEN 1 THEN 'it' || chr(39) || 's ' || event_type "
               "WHEN 2 THEN 'a: b=c' WHEN 3 THEN event_type ELSE 'tab ' || event_id END")


@register("repair_json", f"""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN event_id % 4 = 3 THEN replace({REPAIR_NOTE}, chr(39), '') ELSE {REPAIR_NOTE} END AS note
FROM events
""")
def repair_json_q(spark, sf_dir):
    """Map text in four forms, each with URLs, equal signs and apostrophes in its values: real JSON
    (only its keys are normalised), Java-style map text, Python-style text with double-quoted values, and
    with single quotes throughout; repaired, then parsed."""
    e = T(spark, sf_dir, "events").withColumn("note", F.expr(REPAIR_NOTE))
    k = F.get_json_object("props", "$.k")
    dirty = (F.when(F.col("event_id") % 4 == 0, F.to_json(F.struct(k.alias("K!"), F.col("note").alias("Note"))))
             .when(F.col("event_id") % 4 == 1, F.concat(F.lit("{K="), k, F.lit(", note="), "note", F.lit("}")))
             .when(F.col("event_id") % 4 == 2, F.concat(F.lit("{'@K': "), k, F.lit(", 'Note': \""), "note", F.lit("\"}")))
             .otherwise(F.concat(F.lit("{'@K': '"), k, F.lit("', 'Note': '"), F.replace("note", F.lit("'"), F.lit("")), F.lit("'}"))))
    parsed = e.select("event_id", F.from_json(repair_json(dirty), "struct<k:string,note:string>").alias("r"))   # parsed once, read twice
    return parsed.select("event_id", F.col("r.k").try_cast("int").alias("k"), F.col("r.note").alias("note"))


@register("parse_dates_multi", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 2 THEN 'garbage-' || CAST(o_orderkey AS VARCHAR) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_day,
       CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date
FROM orders
""")
def parse_dates_multi(spark, sf_dir):
    """Dates printed in two formats repaired to yyyy-MM-dd (others unchanged), then cast."""
    o = T(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    printed = (F.when(k % 3 == 0, F.date_format("o_orderdate", "dd-MMM-yyyy"))
               .when(k % 3 == 1, format_date("o_orderdate", "yyyy/MM/dd"))
               .otherwise(F.concat(F.lit("garbage-"), k.cast("string"))))
    raw = o.select("o_orderkey", printed.alias("order_day"))
    fixed = apply_steps(raw, [DateRepair(["order_day"], ["dd-MMM-yyyy", "yyyy/MM/dd"])])
    return fixed.withColumn("order_date", F.col("order_day").try_cast("date"))


# ------------------------------------------------------------------ table writes

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _orders_table(spark, sf_dir) -> TableSpec:
    o = T(spark, sf_dir, "orders")
    spec = TableSpec(scratch_path(spark, "orders_table"), schema=o.schema,
                     primary_keys=["o_orderstatus", "o_orderkey"], partition_field="o_orderstatus")
    # partition column last, as a partitioned table stores it
    cols = [c for c in o.columns if c != "o_orderstatus"] + ["o_orderstatus"]
    spec.schema = StructType([o.schema[c] for c in cols])
    append(spark, o.where(F.col("o_orderstatus").isin("F", "O")), spec)
    return spec


def _order_changes(spark, sf_dir) -> DataFrame:
    return (T(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P"))
            .withColumn("o_totalprice", F.col("o_totalprice") + 1))


MERGE_SQL = {
    "upsert": f"""SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus IN ('O', 'P')""",
    "insert_only": f"""SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'P'""",
    "update_only": f"""SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'O'""",
    "delete_matched": f"SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'",
}

for _strategy, _sql in MERGE_SQL.items():
    def _make_merge(strategy):
        def q(spark, sf_dir):
            """Merge into a partitioned Parquet table; only touched partitions rewritten."""
            spec = _orders_table(spark, sf_dir)
            merge_into(spark, spec, _order_changes(spark, sf_dir), strategy)
            return read_target(spark, spec)
        return q
    register(f"merge_{_strategy}", _sql)(_make_merge(_strategy))


@register("merge_metrics", """
SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS inserted,
       count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0) AS updated,
       CAST(0 AS BIGINT) AS deleted,
       count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderkey % 3 <> 0) AS kept,
       count(*) AS total, true AS bytes_counted
FROM orders
""")
def merge_metrics(spark, sf_dir):
    """M1/M2: inserted / updated / deleted / kept rows of an upsert, observed during the write (kept: unchanged
    rows of the rewritten partitions; untouched partitions are never read), and bytes added and removed."""
    spec = _orders_table(spark, sf_dir)
    changes = _order_changes(spark, sf_dir).where((F.col("o_orderstatus") == "P") | (F.col("o_orderkey") % 3 == 0))
    res = merge_into(spark, spec, changes, "upsert")
    m = res.merge
    total = read_target(spark, spec).agg(F.count(F.lit(1)).alias("total"))
    return total.select(F.lit(m.inserted).cast("bigint").alias("inserted"), F.lit(m.updated).cast("bigint").alias("updated"),
                        F.lit(m.deleted).cast("bigint").alias("deleted"), F.lit(m.kept).cast("bigint").alias("kept"), "total",
                        F.lit(res.bytes_added > 0 and res.bytes_removed > 0).alias("bytes_counted"))


@register("merge_conditional", """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderstatus = 'P' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderkey % 5 = 0 AND o_custkey % 2 = 0) AND NOT (o_orderstatus = 'P' AND o_orderkey % 2 = 0)
""")
def merge_conditional(spark, sf_dir):
    """MERGE clauses with conditions and per-column values: matched rows updated or deleted, some of
    the new ones inserted, and rows that the source lacks updated."""
    spec = _orders_table(spark, sf_dir)
    merge_into(spark, spec, _order_changes(spark, sf_dir), clauses=[
        Clause("matched", "delete", "t.o_orderkey % 5 = 0 AND s.o_custkey % 2 = 0"),
        Clause("matched", "update", "t.o_orderkey % 5 <> 0", {"o_totalprice": "t.o_totalprice + 1"}),
        Clause("not_matched", "insert", "s.o_orderkey % 2 = 1",
               {**{c: f"s.{c}" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")}, "o_totalprice": "round(s.o_totalprice - 1, 2)", "o_orderpriority": "'NEW'"}),
        Clause("not_matched_by_source", "update", None, {"o_orderpriority": "'CLOSED'"})])
    return read_target(spark, spec)


@register("merge_update_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, 'CHANGED' FROM orders WHERE o_orderstatus = 'P'
""")
def merge_update_columns(spark, sf_dir):
    """K2: an upsert that updates one column of matched rows and inserts the others whole."""
    spec = _orders_table(spark, sf_dir)
    changes = _order_changes(spark, sf_dir).withColumn("o_orderpriority", F.lit("CHANGED"))
    merge_into(spark, spec, changes, "upsert", update_columns=["o_totalprice"])
    return read_target(spark, spec)


CLUSTERED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey BETWEEN m.a AND m.b THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, true AS others_unchanged
FROM orders, (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 AS a,
                     min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 + (max(o_orderkey) - min(o_orderkey)) // 100 AS b FROM orders) m
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true FROM orders WHERE o_orderkey % 500 = 0
"""


@register("merge_clustered", CLUSTERED_SQL)
def merge_clustered(spark, sf_dir):
    """About 1 % of all orders, and some new ones, merged into an unpartitioned table whose files hold key
    ranges: files without one of those keys stay as they are."""
    o = T(spark, sf_dir, "orders")
    rows = o.count()
    spec = TableSpec(scratch_path(spark, "orders_clustered"), schema=o.schema, primary_keys=["o_orderkey"], partition_field=None, clustered=True,
                     file_rows=max(1, rows // 50))
    append(spark, o, spec)
    before = set(Commits(spark, spec.path).files())
    ends = o.agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b")).first()
    middle, width = ends.a + (ends.b - ends.a) // 2, (ends.b - ends.a) // 100
    changes = o.where(F.col("o_orderkey").between(middle, middle + width)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    fresh = o.where(F.col("o_orderkey") % 500 == 0).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    res = merge_into(spark, spec, changes.unionByName(fresh))
    stayed = before & set(Commits(spark, spec.path).files())
    if res.merge.updated == 0 or res.merge.inserted == 0:
        raise RuntimeError("the merge found no rows")
    return read_target(spark, spec).withColumn("others_unchanged", F.lit(len(before) - len(stayed) <= max(3, len(before) // 10)))


EVENT_TABLE_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "data_date"]


def _events_spec(spark, events: DataFrame) -> TableSpec:
    return TableSpec(scratch_path(spark, "events_table"), schema=events.select(*EVENT_TABLE_COLS).schema,
                     partition_field="data_date")


@register("append", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS data_date FROM events
""")
def append_q(spark, sf_dir):
    """Two appends (first half of the month, then the rest) make the whole table."""
    e = fx.events_with_date(spark, sf_dir)
    spec = _events_spec(spark, e)
    append(spark, e.where(F.col("data_date") <= "2024-01-15"), spec)
    append(spark, e.where(F.col("data_date") > "2024-01-15"), spec)
    return read_target(spark, spec).select(*EVENT_COLS)


@register("append_once", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS data_date FROM events
""")
def append_once(spark, sf_dir):
    """K3: batches with a name are added once, though the first is sent twice and the second comes between; the
    batch that was skipped reports the figures of the first time."""
    e = fx.events_with_date(spark, sf_dir)
    spec = _events_spec(spark, e)
    early = e.where(F.col("data_date") <= "2024-01-15")
    first = append(spark, early, spec, token="early")
    append(spark, e.where(F.col("data_date") > "2024-01-15"), spec, token="late")
    if append(spark, early, spec, token="early") != first:
        raise RuntimeError("the second sending of a batch reported other figures")
    return read_target(spark, spec).select(*EVENT_COLS)


@register("overwrite_partitions", """
SELECT event_id, user_id, event_type,
       CASE WHEN strftime(ts, '%Y-%m-%d') >= '2024-01-20' THEN value * 2 ELSE value END AS value,
       strftime(ts, '%Y-%m-%d') AS data_date
FROM events
""")
def overwrite_partitions_q(spark, sf_dir):
    """K4: dynamic partition overwrite replaces only the dates present in the new rows."""
    e = fx.events_with_date(spark, sf_dir)
    spec = _events_spec(spark, e)
    append(spark, e, spec)
    late = e.where(F.col("data_date") >= "2024-01-20").withColumn("value", F.col("value") * 2)
    overwrite_partitions(spark, late, spec)
    return read_target(spark, spec).select(*EVENT_COLS)


@register("delete_where", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS data_date
FROM events WHERE NOT coalesce(event_type = 'error' AND value > 50, false)
""")
def delete_where_q(spark, sf_dir):
    """K5: rows matching the predicate removed; only partitions holding one are rewritten."""
    e = fx.events_with_date(spark, sf_dir)
    spec = _events_spec(spark, e)
    append(spark, e, spec)
    delete_where(spark, spec, "event_type = 'error' AND value > 50")
    return read_target(spark, spec).select(*EVENT_COLS)


# ------------------------------------------------------------------ data quality


DQ_DATE = "2024-01-15"


@python_rule("positive_quantity")
def positive_quantity(df, rule, **params):
    """Data-level Python rule, as columns over the checked frame: every line has a quantity above one unit."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), F.col("l_quantity") > 1.0


# Each entry: the rule row, the SQL giving (identifier, result) for the oracle, the oracle's flag
# expression over ``result``, and the table the rule checks.
DQ_RULES = {
    "standard": dict(
        rule=dict(control_master_id="M_STD", control_table_id="T_LINEITEM", control_algorithm_type="SQL",
                  control_level="Data", control_threshold_type="Standard", control_threshold_min=0.0,
                  control_threshold_max=0.05, control_threshold_rag_max=0.9, blocking_control_indicator=True,
                  control_description="SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS identifier, "
                                      "l_discount AS result FROM lineitem"),
        outcomes="SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS identifier, l_discount AS result FROM lineitem",
        flag="CASE WHEN result IS NULL THEN NULL ELSE (NOT isnan(result) AND result >= 0.0 AND result <= 0.05) END"),
    "absolute": dict(
        rule=dict(control_master_id="M_ABS", control_table_id="T_CUSTOMER", control_algorithm_type="SQL",
                  control_level="Data", control_threshold_type="Absolute", control_threshold_max=5000.0,
                  control_threshold_rag_max=0.5, blocking_control_indicator=True,
                  control_description="SELECT CAST(c_custkey AS STRING) AS identifier, c_acctbal AS result FROM customer"),
        outcomes="SELECT CAST(c_custkey AS VARCHAR) AS identifier, c_acctbal AS result FROM customer",
        flag="CASE WHEN result IS NULL THEN NULL ELSE (NOT isnan(abs(result)) AND abs(result) <= 5000.0) END"),
    "binary": dict(
        rule=dict(control_master_id="M_BIN", control_table_id="T_ORDERS", control_algorithm_type="SQL",
                  control_level="Data", control_threshold_type="Binary", blocking_control_indicator=False,
                  control_description="SELECT CAST(o_orderkey AS STRING) AS identifier, "
                                      "o_orderstatus <> 'P' AND o_orderdate >= DATE '{file_date}' - INTERVAL 10000 DAYS AS result FROM orders"),
        outcomes="SELECT CAST(o_orderkey AS VARCHAR) AS identifier, "
                 "o_orderstatus <> 'P' AND o_orderdate >= DATE '2024-01-15' - INTERVAL 10000 DAYS AS result FROM orders",
        flag="result"),
    "regex": dict(
        rule=dict(control_master_id="M_REGEX", control_table_id="T_CUSTOMER", control_algorithm_type="Regex",
                  control_level="Data", control_threshold_type="Binary", control_field="c_name, c_mktsegment",
                  control_description=r"^Customer#\d{9}$", blocking_control_indicator=False),
        outcomes="SELECT 'c_name' AS identifier, regexp_matches(coalesce(c_name, ''), '^Customer#\\d{9}$') AS result FROM customer "
                 "UNION ALL SELECT 'c_mktsegment', regexp_matches(coalesce(c_mktsegment, ''), '^Customer#\\d{9}$') FROM customer",
        flag="result", regex=True),
    "python": dict(
        rule=dict(control_master_id="M_PY", control_table_id="T_LINEITEM", control_algorithm_type="Python",
                  control_level="Data", control_threshold_type="Binary", control_description="positive_quantity",
                  blocking_control_indicator=True, control_threshold_rag_max=0.95),
        outcomes="SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS identifier, "
                 "l_quantity > 1.0 AS result FROM lineitem",
        flag="result"),
}
DQ_DATA = {"standard": None, "absolute": None, "binary": None, "regex": "customer", "python": "lineitem"}


def _dq_detail(spec: dict) -> str:
    if not spec.get("regex"):
        return "CASE WHEN a.invalid > 0 THEN 'Invalid records: ' || CAST(a.invalid AS VARCHAR) ELSE '' END"
    return ("concat_ws('. ', CASE WHEN l.vids <> '' THEN 'Valid columns: ' || l.vids END, "
            "CASE WHEN l.iids <> '' THEN 'Invalid columns: ' || l.iids END)")


def _dq_oracle(kind: str) -> str:
    spec = DQ_RULES[kind]
    r = spec["rule"]
    listing = ""
    if spec.get("regex"):
        listing = f""",
     (SELECT coalesce(string_agg(identifier, ', ' ORDER BY identifier) FILTER (WHERE flag), '') AS vids,
             coalesce(string_agg(identifier, ', ' ORDER BY identifier) FILTER (WHERE NOT flag), '') AS iids
      FROM (SELECT DISTINCT identifier, {spec['flag']} AS flag FROM ({spec['outcomes']}) o) d) l"""
    return f"""
SELECT '{r['control_master_id']}' AS control_master_id, '{r['control_table_id']}' AS control_table_id,
       '{{total: ' || CAST(a.total AS VARCHAR) || ', value: ' || CAST(a.invalid AS VARCHAR) || '}}' AS control_outcome,
       CASE WHEN a.total = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - a.invalid::DOUBLE / a.total::DOUBLE END AS control_metric_value,
       {_dq_detail(spec)} AS control_detail,
       DATE '{DQ_DATE}' AS data_date
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE flag = false) AS invalid
      FROM (SELECT {spec['flag']} AS flag FROM ({spec['outcomes']}) o) f) a{listing}
"""


def _dq_identifiers_oracle(kind: str) -> str:
    spec = DQ_RULES[kind]
    r = spec["rule"]
    return (f"SELECT DISTINCT '{r['control_master_id']}' AS control_master_id, '{r['control_table_id']}' AS control_table_id, identifier, "
            f"DATE '{DQ_DATE}' AS data_date FROM (SELECT identifier, {spec['flag']} AS flag FROM ({spec['outcomes']}) o) f WHERE NOT flag")


DQ_VIEWS = ["lineitem", "customer", "orders"]
DQ_OUT = ["control_master_id", "control_table_id", "control_outcome", "control_metric_value", "control_detail", "data_date"]


def _dq_run(spark, sf_dir, kinds):
    for v in DQ_VIEWS:
        T(spark, sf_dir, v).createOrReplaceTempView(v)
    rules = rules_frame(spark, [DQ_RULES[k]["rule"] for k in kinds])
    data_tables = {DQ_DATA[k] for k in kinds if DQ_DATA[k]}
    if len(data_tables) > 1:   # rules checking different frames run as separate controls
        raise ValueError("one checked frame per run")
    df = T(spark, sf_dir, data_tables.pop()) if data_tables else None
    return run_controls(spark, df, rules, params={"file_date": DQ_DATE, "file_name": "orders.parquet"},
                        data_date=DQ_DATE)


for _kind in DQ_RULES:
    def _make_dq(kind):
        def q(spark, sf_dir):
            """One rule evaluated, thresholded and scored into a controls_results row."""
            return _dq_run(spark, sf_dir, [kind]).results.select(*DQ_OUT)
        return q
    register(f"dq_{_kind}", _dq_oracle(_kind))(_make_dq(_kind))


@register("dq_results", "\nUNION ALL\n".join(_dq_oracle(k) for k in ("standard", "absolute", "binary", "python")))
def dq_results(spark, sf_dir):
    """Several SQL and Python rules in one run, scored by one job, appended to the
    controls_results table and read back."""
    run = _dq_run(spark, sf_dir, ["standard", "absolute", "binary", "python"])
    spec = TableSpec(scratch_path(spark, "controls_results"), schema=StructType.fromJson(_RESULTS_JSON),
                     partition_field="data_date")
    save_results(spark, run, spec)
    return read_target(spark, spec).select(*DQ_OUT)


@register("dq_invalid_identifiers", "\nUNION ALL\n".join(_dq_identifiers_oracle(k) for k in ("standard", "absolute", "binary", "python")))
def dq_invalid_identifiers(spark, sf_dir):
    """Every invalid identifier of every rule, stored next to the results and read back."""
    run = _dq_run(spark, sf_dir, ["standard", "absolute", "binary", "python"])
    spec = TableSpec(scratch_path(spark, "controls_results"), schema=StructType.fromJson(_RESULTS_JSON), partition_field="data_date")
    ids = TableSpec(scratch_path(spark, "controls_identifiers"), schema=run.identifiers.schema, partition_field="data_date")
    save_results(spark, run, spec, ids)
    return read_target(spark, ids)


def _isolated_rules() -> list[dict]:
    def rule(master, table, text, **kw):
        return dict(control_master_id=master, control_table_id=table, control_algorithm_type="SQL", control_level="Data",
                    control_threshold_type="Binary", control_description=text, blocking_control_indicator=True) | kw
    return [rule("M_QTY", "T_LINEITEM", "SELECT CAST(l_orderkey AS STRING) AS identifier, l_quantity <= 25 AS result FROM lineitem"),
            rule("M_CAST", "T_ORDERS", "SELECT CAST(o_orderkey AS STRING) AS identifier, CAST(o_orderpriority AS INT) > 0 AS result FROM orders"),
            rule("M_TEXT", "T_ORDERS", "SELECT CAST(o_orderkey AS STRING) AS identifier, 'n/a' AS result FROM orders"),
            rule("M_NULL", None, "SELECT CAST(o_orderkey AS STRING) AS identifier, false AS result FROM orders"),
            rule("M_SAME", "T_SAME", "SELECT CAST(o_orderkey AS STRING) AS identifier, true AS result FROM orders"),
            rule("M_SAME", "T_SAME", "SELECT CAST(l_orderkey AS STRING) AS identifier, true AS result FROM lineitem"),
            rule("M_PRICE", "T_ORDERS", "SELECT CAST(o_orderkey AS STRING) AS identifier, o_totalprice AS result FROM orders",
                 control_threshold_type="Standard", control_threshold_max=100000.0)]


@register("dq_isolated_rules", """
WITH r AS (
  SELECT 'M_QTY' AS control_master_id, 'T_LINEITEM' AS control_table_id, 'ok' AS status, count(*) AS total,
         count(*) FILTER (WHERE NOT l_quantity <= 25) AS invalid FROM lineitem
  UNION ALL SELECT 'M_PRICE', 'T_ORDERS', 'ok', count(*), count(*) FILTER (WHERE NOT o_totalprice <= 100000.0) FROM orders
  UNION ALL SELECT 'M_CAST', 'T_ORDERS', 'error', NULL, NULL UNION ALL SELECT 'M_TEXT', 'T_ORDERS', 'error', NULL, NULL
  UNION ALL SELECT 'M_NULL', NULL, 'error', NULL, NULL
  UNION ALL SELECT 'M_SAME', 'T_SAME', 'error', NULL, NULL UNION ALL SELECT 'M_SAME', 'T_SAME', 'error', NULL, NULL)
SELECT *, false AS verdict FROM r
""")
def dq_isolated_rules(spark, sf_dir):
    """A rule that fails at run time, one with text results, one without a table id and two that
    share ids become errors of their own; the other rules are scored."""
    for v in DQ_VIEWS:
        T(spark, sf_dir, v).createOrReplaceTempView(v)
    run = run_controls(spark, None, rules_frame(spark, _isolated_rules()), data_date=DQ_DATE)
    return run.status.select("control_master_id", "control_table_id", "status", "total", "invalid", F.lit(run.verdict()).alias("verdict"))


@register("dq_validate", """
SELECT 'M_SEG' AS control_master_id, 'T1' AS control_table_id, 'ok' AS status, 2 * count(*) AS total,
       count(*) FILTER (WHERE NOT regexp_matches(c_mktsegment, '^[A-Z]+$')) + count(*) FILTER (WHERE NOT regexp_matches(c_name, '^[A-Z]+$')) AS invalid, false AS verdict FROM customer
UNION ALL SELECT 'M_BAL', 'T2', 'ok', count(*), count(*) FILTER (WHERE abs(c_acctbal) > 9000.0), false FROM customer
UNION ALL SELECT 'M_KEY', 'T5', 'ok', count(*), count(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#')), false FROM customer
UNION ALL SELECT 'M_BAD', 'T6', 'error', NULL, NULL, false
""")
def dq_validate(spark, sf_dir):
    """The active rules of one layer and table, completed by the master's defaults, run over
    the whole customer table with results stored; a rule with impossible limits is an error."""
    customer = T(spark, sf_dir, "customer")
    customer.createOrReplaceTempView("customer")
    base = dict(control_layer="staging", control_table="customer", control_level="Data", active_control_indicator=True, blocking_control_indicator=True)
    sql = dict(control_algorithm_type="SQL", control_description="SELECT CAST(c_custkey AS STRING) AS identifier, c_acctbal AS result FROM customer")
    dataset = rules_frame(spark, [
        base | dict(control_master_id="M_SEG", control_table_id="T1", control_algorithm_type="Regex", control_threshold_type="Binary",
                    control_field="c_mktsegment,c_name", control_description="^[A-Z]+$"),
        base | sql | dict(control_master_id="M_BAL", control_table_id="T2", control_threshold_rag_max=0.1),  # type and limit from the master
        base | sql | dict(control_master_id="M_BAL", control_table_id="T3", active_control_indicator=False),
        base | sql | dict(control_master_id="M_BAL", control_table_id="T4", control_layer="raw"),
        base | dict(control_master_id="M_KEY", control_table_id="T5", control_algorithm_type="Regex", control_threshold_type="Binary",
                    control_field="c_name", control_description="^Customer#"),
        base | sql | dict(control_master_id="M_BAD", control_table_id="T6", control_threshold_type="Standard", control_threshold_min=2.0, control_threshold_max=1.0)])
    master = master_frame(spark, [dict(control_master_id="M_BAL", control_level="Data", control_threshold_type="Absolute", control_threshold_max=9000.0)])
    results = TableSpec(scratch_path(spark, "validate_results"), schema=StructType.fromJson(_RESULTS_JSON), partition_field="data_date")
    run = validate(spark, "staging", "customer", customer, dataset, master, results, data_date=DQ_DATE)
    return run.status.select("control_master_id", "control_table_id", "status", "total", "invalid", F.lit(run.verdict()).alias("verdict"))


_RESULTS_JSON = {"type": "struct", "fields": [
    {"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in [
        ("control_master_id", "string"), ("control_table_id", "string"), ("control_outcome", "string"),
        ("control_metric_value", "double"), ("control_detail", "string"), ("initial_date", "timestamp"),
        ("end_date", "timestamp"), ("data_date", "date")]]}


def _overall_oracle(kinds) -> str:
    rows = []
    for k in kinds:
        r = DQ_RULES[k]["rule"]
        rag = r.get("control_threshold_rag_max")
        rows.append(f"SELECT control_metric_value AS m, {str(bool(r.get('blocking_control_indicator'))).lower()} AS b, "
                    f"{'NULL' if rag is None else rag}::DOUBLE AS rag FROM ({_dq_oracle(k)})")
    body = "\nUNION ALL\n".join(rows)
    return f"""
SELECT count(*) FILTER (WHERE b AND m < coalesce(rag, 1.0)) = 0 AS overall,
       count(*) FILTER (WHERE b AND m < coalesce(rag, 1.0)) AS failed_rules,
       CAST(0 AS BIGINT) AS errored_rules
FROM ({body}) x
"""


@register("dq_overall", _overall_oracle(["standard", "absolute", "binary", "python"]))
def dq_overall(spark, sf_dir):
    """Blocking rules below their pass ratio fail the run."""
    return _dq_run(spark, sf_dir, ["standard", "absolute", "binary", "python"]).overall


# ------------------------------------------------------------------ files, landing, reports, flows


CUST_HEADER = "c_custkey,c_name,c_acctbal"


@register("file_controls", """
SELECT c_mktsegment AS segment, c_mktsegment <> 'MACHINERY' AS name_ok, bool_and(c_acctbal >= 0) AS format_ok,
       c_mktsegment <> 'FURNITURE' AS columns_ok, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'balance' ELSE '' END AS extra,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'c_acctbal' ELSE '' END AS missing, count(*) AS rows
FROM customer GROUP BY c_mktsegment
""")
def file_controls(spark, sf_dir):
    """Customer delivered as CSV files per segment.  Rows of customers with a negative
    balance carry one field too many, which makes their file's format invalid; one segment comes under
    another file name (compressed), one with another header."""
    c = T(spark, sf_dir, "customer")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"),
                       F.when(F.col("c_acctbal") < 0, F.lit("extra")))
    path = scratch_path(spark, "customer_delivery")
    seg = F.col("c_mktsegment")
    for part, header, codec in ((~seg.isin("FURNITURE", "MACHINERY"), CUST_HEADER, "none"), (seg == "FURNITURE", "c_custkey,c_name,balance", "none"),
                                (seg == "MACHINERY", CUST_HEADER, "gzip")):
        (c.where(part).select(line.alias(header), "c_mktsegment").write.mode("append").partitionBy("c_mktsegment")
         .options(header="true", sep="\t", compression=codec).csv(path))
    names = check_filenames(list_files(spark, path, "*.csv*"), r"part-\d{5}-.*\.c000\.csv$").select("path", F.col("result").alias("name_ok"))
    profile = csv_profile(spark, path, glob="*.csv*")
    fmt = format_result(profile).select("path", F.col("result").alias("format_ok"), "rows")
    cols = columns_result(profile, ["c_custkey", "c_name", "c_acctbal"]).select(
        "path", F.col("result").alias("columns_ok"), F.array_join("extra_columns", ",").alias("extra"), F.array_join("missing_columns", ",").alias("missing"))
    per_file = names.join(fmt, "path").join(cols, "path")
    return per_file.groupBy(F.regexp_extract("path", r"c_mktsegment=([^/]+)/", 1).alias("segment")).agg(
        F.bool_and("name_ok").alias("name_ok"), F.bool_and("format_ok").alias("format_ok"), F.bool_and("columns_ok").alias("columns_ok"),
        F.max("extra").alias("extra"), F.max("missing").alias("missing"), F.sum("rows").alias("rows"))


@register("landing_dedupe", """
WITH p AS (SELECT doc_id, md5(CASE WHEN doc_id % 4 = 0 THEN text || ' [edited]' ELSE text END) AS h
           FROM documents WHERE source <> 'src0')
SELECT 'doc_' || CAST(d.doc_id AS VARCHAR) || '.txt' AS file_name, coalesce(md5(d.text) = p.h, false) AS is_duplicate
FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id
""")
def landing_dedupe(spark, sf_dir):
    """Whole-document MD5 against the latest processed copy of the same file name."""
    incoming, processed = fx.document_files(spark, sf_dir)
    known = processed.select("path", "file_name", content_md5("content").alias("content_md5"))  # as a landing status table stores it
    return flag_unchanged(incoming, known).select("file_name", "is_duplicate")


EVENT_PLACES = ["north/ev_2024-01-01.csv", "south/ev_2024-01-01.csv", "north/ev_2024-01-02.csv", "south/ev_2024-01-02.csv"]
EVENT_RAW_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("landing_to_raw", """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS data_date FROM events, range(2)
""")
def landing_to_raw(spark, sf_dir):
    """Daily CSV deliveries, every line twice, checked and filed by the date in each
    file's path.  Two runs deliver different files of the same dates (odd and even users); the second is
    delivered once more with the same names.  Raw keeps the repeated lines and both files of a date."""
    e = T(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", fx.TS_FORMAT).alias("ts"), "user_id", "event_type", "value", "props",
        F.date_format("ts", "yyyy_MM_dd").alias("day"))
    twice = e.withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_n")
    spec = LandingSpec(filename_pattern=r"part-\d{5}-.*\.csv", file_format="csv",
                       date_regex=r"day=(\d{4})_(\d{2})_(\d{2})")
    raw = TableSpec(scratch_path(spark, "raw_events"), partition_field="data_date")
    folders = []
    for half in (0, 1):
        folders.append(scratch_path(spark, "landing"))
        mine = twice.where(F.coalesce(F.pmod("user_id", F.lit(2)), F.lit(0)) == half)
        mine.hint("rebalance", "day").write.partitionBy("day").options(header="true", escape='"').csv(folders[-1])
    for folder in [*folders, folders[1]]:
        res = land(spark, folder, spec, raw, columns=EVENT_RAW_COLS, date_from="path")
        bad = res.status.where(F.col("status") != "PROCESSED").count()
        if bad:
            raise RuntimeError(f"{bad} landing files were not processed")
    typed = cast_to(read_target(spark, res.table), {"event_id": "bigint", "user_id": "bigint", "value": "double"})
    return typed.select("event_id", "user_id", "event_type", "value", "props", "data_date")


@register("landing_redelivery", """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS data_date,
       CASE event_id % 4 WHEN 1 THEN 'south/ev_2024-01-01.csv' ELSE 'north/ev_2024-01-02.csv' END AS delivery
FROM events WHERE event_id % 4 IN (1, 2)
UNION ALL
SELECT event_id, user_id, event_type, value * 2, props, strftime(ts, '%Y-%m-%d'), 'south/ev_2024-01-02.csv'
FROM events WHERE event_id % 4 = 3 AND strftime(ts, '%Y-%m-%d') <= '2024-01-10'
""")
def landing_redelivery(spark, sf_dir):
    """L1/L2/K6: deliveries of equal names in two folders, filed by a date in their rows.  One comes again without
    any row, another with half of its dates and other values; landed file by file, each replaces exactly
    what it brought before."""
    e = T(spark, sf_dir, "events").withColumn("place", F.element_at(F.array(*map(F.lit, EVENT_PLACES)), (F.col("event_id") % 4).cast("int") + 1))
    cells = ["event_id", F.date_format("ts", fx.TS_FORMAT), "user_id", "event_type", "value", F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))]

    def lines(rows):
        return rows.select(F.col("place").alias("name"), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("")) for c in cells]).alias("value"))
    spec = LandingSpec(filename_pattern=r"ev_.*\.csv", date_column="ts")
    raw = TableSpec(scratch_path(spark, "raw_redelivered"), partition_field="data_date")
    header = ",".join(EVENT_RAW_COLS)
    first = fx.deliver(lines(e), scratch_path(spark, "landing_first"), header, EVENT_PLACES)
    again = e.where((F.col("place") == EVENT_PLACES[3]) & (F.date_format("ts", "yyyy-MM-dd") <= "2024-01-10")).withColumn("value", F.col("value") * 2)
    second = fx.deliver(lines(again), scratch_path(spark, "landing_second"), header, [EVENT_PLACES[0], EVENT_PLACES[3]])
    land(spark, first, spec, raw, columns=EVENT_RAW_COLS)
    res = land(spark, second, spec, raw, columns=EVENT_RAW_COLS, files_per_batch=1)
    bad = res.status.where(F.col("status") != "PROCESSED").count()
    if bad:
        raise RuntimeError(f"{bad} landing files were not processed")
    typed = cast_to(read_target(spark, res.table, with_source=True), {"event_id": "bigint", "user_id": "bigint", "value": "double"})
    return typed.select("event_id", "user_id", "event_type", "value", "props", "data_date", F.col("source_file").alias("delivery"))


ARCHIVES_SQL = """
WITH a AS (SELECT c_nationkey AS nation, CAST(floor(c_custkey / 2000) AS BIGINT) AS part, count(*) AS n FROM customer GROUP BY ALL)
SELECT 'cust_' || CAST(nation AS VARCHAR) || '_' || CAST(part AS VARCHAR) || '_2024-01-' || lpad(CAST(nation + 1 AS VARCHAR), 2, '0') || '.zip' AS file_name,
       CASE nation WHEN 3 THEN 'ERROR' WHEN 5 THEN 'ERROR' WHEN 7 THEN 'ERROR' ELSE 'PROCESSED' END AS status,
       CASE nation WHEN 3 THEN 'names' WHEN 5 THEN 'format' WHEN 7 THEN 'columns' ELSE '' END AS reason,
       CASE WHEN nation IN (3, 5, 7) THEN 0 ELSE n END AS rows FROM a
"""


@register("landing_archives", ARCHIVES_SQL)
def landing_archives(spark, sf_dir):
    """Customers in zip archives of a hundred members each, read by a task for each member.
    Some archives hold a member of another name, some lines with a field too many, some another header;
    every archive has its status and reason, and the rows of the good ones land."""
    c = T(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    name = F.format_string("cust_%d_%d_2024-01-%02d.zip", nation, F.floor(F.col("c_custkey") / 2000), nation + 1)
    member = F.format_string("%s_%d.csv", F.when((nation == 3) & (F.col("c_custkey") % 100 == F.min("c_custkey").over(Window.partitionBy(name)) % 100), "odd").otherwise("m"), F.col("c_custkey") % 100)
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_acctbal").cast("string"), F.when(nation == 5, F.lit("x")))
    lines = c.select(name.alias("archive"), member.alias("member"), line.alias("value"), nation.alias("nation"))
    folder = scratch_path(spark, "landing_archives")
    for own, header in ((F.col("nation") != 7, CUST_HEADER), (F.col("nation") == 7, "c_custkey,c_name,balance")):
        fx.deliver_archives(lines.where(own).drop("nation"), folder, header)
    spec = LandingSpec(filename_pattern=r"cust_.*\.zip", zipped="zip", member_pattern=r"m_\d+\.csv")
    raw = TableSpec(scratch_path(spark, "raw_archives"), partition_field="data_date")
    res = land(spark, folder, spec, raw, columns=["c_custkey", "c_name", "c_acctbal"])
    landed = read_target(spark, res.table, with_source=True).groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("n"))
    reason = (F.when(F.col("error").contains("member names"), "names").when(F.col("error").contains("CSV format"), "format")
              .when(F.col("error").contains("member columns"), "columns").otherwise(F.col("error")))
    return res.status.join(landed, "file_name", "left").select("file_name", "status", reason.alias("reason"), F.coalesce("n", F.lit(0)).alias("rows"))


def _mixed_landing(spark, sf_dir):
    """A JSON landing folder: pretty-printed documents of the customers of each nation, one document without
    the expected level, one with an object where the list should be, and a file of another name."""
    c = T(spark, sf_dir, "customer")
    record = F.to_json(F.struct(F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")))
    docs = c.groupBy("c_nationkey").agg(F.concat(F.lit('{\n  "rows": [\n    '), F.array_join(F.collect_list(record), ",\n    "), F.lit("\n  ]\n}\n")).alias("doc"))
    bad = (F.when(F.col("c_nationkey") == 3, F.lit('{"other": []}')).when(F.col("c_nationkey") == 5, F.lit('{"rows": {"c_custkey": 1}}'))
           .otherwise(F.col("doc")))
    folder = scratch_path(spark, "landing_json")
    out = docs.select(bad.alias("value"), F.format_string("%s_2024_01_%02d", F.when(F.col("c_nationkey") == 7, "note").otherwise("cust"),
                                                          F.col("c_nationkey") + 1).alias("name"))
    out.write.partitionBy("name").option("lineSep", "\n").text(folder)
    spec = LandingSpec(filename_pattern=r".*", file_format="json", json=JsonSpec("rows"), date_regex=r"name=cust_(\d{4})_(\d{2})_(\d{2})")
    raw = TableSpec(scratch_path(spark, "raw_customers"), partition_field="data_date")
    return land(spark, folder, spec, raw, columns=["c_custkey", "c_name", "c_acctbal"], date_from="path")


MIXED_SQL = """
WITH n AS (SELECT c_nationkey AS nation, count(*) AS customers,
                  CASE WHEN c_nationkey IN (3, 5, 7) THEN 'ERROR' ELSE 'PROCESSED' END AS status FROM customer GROUP BY c_nationkey)
"""


@register("landing_mixed_status", MIXED_SQL + "SELECT nation, status FROM n")
def landing_mixed_status(spark, sf_dir):
    """The status of every file where some documents cannot be read and one has no date."""
    status = _mixed_landing(spark, sf_dir).status
    return status.select((F.regexp_extract("path", r"_(\d{2})/part", 1).cast("int") - 1).alias("nation"), "status")


@register("landing_mixed_rows", """
SELECT c_custkey, c_name, c_acctbal, '2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS data_date
FROM customer WHERE c_nationkey NOT IN (3, 5, 7)
""")
def landing_mixed_rows(spark, sf_dir):
    """The rows of the readable files land although others cannot be read."""
    res = _mixed_landing(spark, sf_dir)
    return cast_to(read_target(spark, res.table), {"c_custkey": "bigint", "c_acctbal": "double"}).select("c_custkey", "c_name", "c_acctbal", "data_date")


REPORT_PARAMS = {"file_date": "2024-01-15", "file_name": "orders.parquet", "status": "F", "excluded": "F"}


def _report(spark, sf_dir, spec: ReportSpec):
    out = scratch_path(spark, "outputs")
    status = run_reports(spark, [spec], REPORT_PARAMS, out).collect()[0]
    if not status.success:
        raise RuntimeError(status.error)
    return status.path


@register("report_csv", """
SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y%m%d') AS order_date, o_totalprice AS total
FROM orders WHERE o_orderstatus = 'F'
""")
def report_csv(spark, sf_dir):
    """Templated filter and aliased projection written as a CSV report."""
    spec = ReportSpec(name="Orders Report", source=f"{sf_dir}/orders.parquet",
                      columns=["o_orderkey", "date_format(o_orderdate, 'yyyyMMdd')", "o_totalprice"],
                      columns_alias=["order_key", "order_date", "total"], where="o_orderstatus = '{status}'",
                      filename_pattern="orders_{file_date}.csv", csv=CsvSpec(delimiter=";"))
    path = _report(spark, sf_dir, spec)
    back = spark.read.options(header="true", sep=";").schema("order_key string, order_date string, total string").csv(path)
    return cast_to(back, {"order_key": "bigint", "total": "double"})


@register("report_json", """
SELECT o_orderkey AS order_key, CASE o_orderstatus WHEN 'O' THEN 'OPEN' ELSE o_orderstatus END AS status,
       o_totalprice AS total
FROM orders WHERE o_orderstatus <> 'F'
""")
def report_json(spark, sf_dir):
    """A JSON-lines report with ordered literal replacements."""
    spec = ReportSpec(name="Orders JSON", source=f"{sf_dir}/orders.parquet",
                      columns=["o_orderkey AS order_key", "o_orderstatus AS status", "o_totalprice AS total"],
                      where="o_orderstatus <> '{excluded}'", filename_pattern="orders_{file_date}.json", json=True,
                      replaces=[('"status":"O"', '"status":"OPEN"')])
    path = _report(spark, sf_dir, spec)
    return spark.read.schema("order_key bigint, status string, total double").json(path)


STAGING_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DecimalType(12, 2)),
    StructField("o_orderdate", DateType()), StructField("o_orderpriority", StringType()),
    StructField("data_date", StringType())])


def _business_flow(spark, sf_dir, events=None):
    o = T(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
                   "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
                   F.date_format("o_orderdate", "dd-MMM-yyyy").alias("o_orderdate"), "o_orderpriority",
                   F.lit("2024-01-15").alias("data_date"))
    raw_base = scratch_path(spark, "raw_orders")
    raw.write.partitionBy("data_date").option("header", "true").csv(raw_base)
    staging = TableSpec(scratch_path(spark, "staging_orders"), schema=STAGING_SCHEMA,
                        primary_keys=["data_date", "o_orderkey"], partition_field="data_date")
    r1 = raw_to_staging(spark, raw_base, staging, fmt="csv", mode="delta", file_date="2024-01-15", csv=CsvSpec(),
                        raw_columns=[c for c in raw.columns if c != "data_date"],
                        steps=[DateRepair(["o_orderdate"], ["dd-MMM-yyyy", "yyyy/MM/dd"])], events=events)
    business = TableSpec(scratch_path(spark, "customer_totals"), primary_keys=["o_custkey"], partition_field=None)

    def totals(df):
        return df.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total_spent"),
                                           F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order"))
    r2 = refine(spark, staging, business, totals, mode="delta", value="2024-01-15", events=events, process="business")
    return business, [r1, r2]


@register("flow_raw_to_business", """
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total_spent, COUNT(*) AS orders,
       MAX(CAST(o_orderdate AS DATE)) AS last_order
FROM orders GROUP BY o_custkey
""")
def flow_raw_to_business(spark, sf_dir):
    """Raw CSV strings -> date repair + cast -> staging merge -> business totals merge."""
    business, _ = _business_flow(spark, sf_dir)
    return read_target(spark, business)


@register("flow_run_summary", """
SELECT 'raw_to_business' AS process, false AS success, false AS next_stage, 'orders.csv' AS file_name, '2024-01-15' AS file_date,
       2 * count(*) AS rows_read, count(*) + count(DISTINCT o_custkey) AS rows_written, CAST(1 AS BIGINT) AS failed_outputs,
       'staging_orders=' || CAST(count(*) FILTER (WHERE o_totalprice < 0) = 0 AS VARCHAR) || ',totals=false' AS checked, 'Nothing' AS failed
FROM orders
""")
def flow_run_summary(spark, sf_dir):
    """The summary of raw -> staging -> business with a control on each table (one fails) and two
    reports (one without data), without the columns that hold times."""
    business, results = _business_flow(spark, sf_dir)
    totals = read_target(spark, business)
    totals.createOrReplaceTempView("customer_totals")
    T(spark, sf_dir, "orders").createOrReplaceTempView("orders")

    def control(table, text):
        return run_controls(spark, None, rules_frame(spark, [dict(
            control_master_id="M", control_table_id=table, control_algorithm_type="SQL", control_level="Data", control_threshold_type="Binary",
            blocking_control_indicator=True, control_description=text)]), data_date=DQ_DATE)
    controls = {"staging_orders": control("S", "SELECT CAST(o_orderkey AS STRING) AS identifier, o_totalprice >= 0 AS result FROM orders"),
                "totals": control("T", "SELECT CAST(o_custkey AS STRING) AS identifier, total_spent < 0 AS result FROM customer_totals")}
    outputs = run_reports(spark, [ReportSpec(name=n, source="customer_totals", columns=["o_custkey", "orders"], where=w, filename_pattern="{name}.csv", csv=CsvSpec())
                                  for n, w in (("Totals", None), ("Nothing", "orders < 0"))], {}, scratch_path(spark, "outputs"))
    out = run_summary(spark, "raw_to_business", results, file_name="orders.csv", file_date="2024-01-15", outputs=outputs, controls=controls)
    checked = F.transform("checked_tables", lambda x: F.concat(x["table"], F.lit("="), x["passed"].cast("string")))
    return out.select("process", "success", "next_stage", "file_name", "file_date", "rows_read", "rows_written", "failed_outputs",
                      F.array_join(checked, ",").alias("checked"), F.array_join(F.transform("output_errors", lambda x: x["name"]), ",").alias("failed"))


@register("process_events", """
SELECT p.process, e.event, 1 AS events, e.event = 'end' AS timed, n.orders
FROM (VALUES ('raw_to_staging'), ('business')) p(process), (VALUES ('start'), ('end')) e(event), (SELECT count(*) AS orders FROM orders) n
""")
def process_events_q(spark, sf_dir):
    """M3: the start and end events that the flows of raw -> staging -> business filed, the end with its duration."""
    events = TableSpec(scratch_path(spark, "process_events"), partition_field=None)
    _, results = _business_flow(spark, sf_dir, events)
    out = read_target(spark, events).groupBy("process", "event").agg(
        F.count(F.lit(1)).cast("int").alias("events"), F.bool_and((F.col("value") > 0) & (F.col("unit") == "Seconds")).alias("timed"))
    return out.select("process", "event", "events", F.coalesce("timed", F.lit(False)).alias("timed"), F.lit(results[0].rows_read).cast("bigint").alias("orders"))


@register("write_metrics", """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS d FROM events), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE d <= '2024-01-15') AS early,
  count(*) FILTER (WHERE d >= '2024-01-20') AS late, count(*) FILTER (WHERE event_id % 10 = 0) AS tenth, count(*) FILTER (WHERE event_id % 100 = 0) AS fresh,
  count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'error' AND event_id % 100 = 0) AS fresh_errors FROM e)
SELECT 'append 1' AS operation, early AS inserted, 0::BIGINT AS updated, 0::BIGINT AS deleted, early AS total_rows, true AS balanced FROM n
UNION ALL SELECT 'append 2', n - early, 0, 0, n, true FROM n
UNION ALL SELECT 'overwrite', late, 0, 0, n, true FROM n
UNION ALL SELECT 'merge', fresh, tenth, 0, n + fresh, true FROM n
UNION ALL SELECT 'delete', 0, 0, errors + fresh_errors, n + fresh - errors - fresh_errors, true FROM n
""")
def write_metrics_q(spark, sf_dir):
    """M2: figures of every kind of write and the table's totals after it; files and bytes before, added and removed
    make those after."""
    e = fx.events_with_date(spark, sf_dir)
    spec = _events_spec(spark, e)
    spec.primary_keys = ["data_date", "event_id"]
    early, day = F.col("data_date") <= "2024-01-15", F.col("data_date")
    changed = e.where(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + 1)
    fresh = e.where(F.col("event_id") % 100 == 0).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    steps = [("append 1", lambda: append(spark, e.where(early), spec)), ("append 2", lambda: append(spark, e.where(~early), spec)),
             ("overwrite", lambda: overwrite_partitions(spark, e.where(day >= "2024-01-20").withColumn("value", F.col("value") * 2), spec)),
             ("merge", lambda: merge_into(spark, spec, changed.unionByName(fresh))), ("delete", lambda: delete_where(spark, spec, "event_type = 'error'"))]
    rows, files, size = [], 0, 0
    for name, write in steps:
        now = write_metrics(spark, name, write(), spec.path).first()
        files, size = files + now.files_added - now.files_removed, size + now.bytes_added - now.bytes_removed
        rows.append((name, now.inserted, now.updated, now.deleted, now.total_rows, files == now.total_files and size == now.total_bytes))
    return spark.createDataFrame(rows, "operation string, inserted long, updated long, deleted long, total_rows long, balanced boolean")


@register("catalog_partitions", """
SELECT strftime(ts, '%Y-%m-%d') AS data_date, count(*) AS rows, count(DISTINCT event_id % 4) AS deliveries FROM events
WHERE event_id % 4 <> 0 AND (event_id % 4 <> 3 OR strftime(ts, '%Y-%m-%d') <= '2024-01-10') GROUP BY ALL
""")
def catalog_partitions(spark, sf_dir):
    """K7: landed events read through a catalog table whose partitions the landing keeps: those of a delivery that
    comes again without rows, or without some dates, are forgotten."""
    e = T(spark, sf_dir, "events").withColumn("place", F.element_at(F.array(*map(F.lit, EVENT_PLACES)), (F.col("event_id") % 4).cast("int") + 1))
    columns = ["event_id", "ts", "user_id", "event_type"]

    def lines(rows):
        cells = [F.coalesce(F.date_format("ts", fx.TS_FORMAT) if c == "ts" else F.col(c).cast("string"), F.lit("")) for c in columns]
        return rows.select(F.col("place").alias("name"), F.concat_ws(",", *cells).alias("value"))
    path, name = scratch_path(spark, "raw_catalog"), f"raw_events_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{c} STRING' for c in columns)}, data_date STRING, source_file STRING) USING parquet PARTITIONED BY (data_date, source_file) LOCATION '{path}'")
    again = e.where((F.col("place") == EVENT_PLACES[3]) & (F.date_format("ts", "yyyy-MM-dd") <= "2024-01-10"))
    spec, raw = LandingSpec(filename_pattern=r"ev_.*\.csv", date_column="ts"), TableSpec(path, partition_field="data_date")
    for rows, names in ((e, EVENT_PLACES), (again, [EVENT_PLACES[0], EVENT_PLACES[3]])):
        folder = fx.deliver(lines(rows), scratch_path(spark, "landing_catalog"), ",".join(columns), names)
        land(spark, folder, spec, raw, columns=columns, catalog_table=name)
    known = spark.sql(f"SHOW PARTITIONS {name}").select(F.regexp_extract("partition", "data_date=([^/]+)", 1).alias("data_date")).groupBy("data_date").agg(F.count(F.lit(1)).alias("deliveries"))
    found = spark.table(name).groupBy("data_date").agg(F.count(F.lit(1)).alias("rows"))
    return found.join(known, "data_date", "full").select("data_date", "rows", "deliveries")


# ------------------------------------------------------------------ streaming and schema


@register("streaming_landing", """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS data_date FROM events
""")
def streaming_landing(spark, sf_dir):
    """Structured Streaming landing: daily CSV deliveries picked up by a file-source stream and
    appended exactly-once to the raw table through the Parquet file sink."""
    e = T(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", fx.TS_FORMAT).alias("ts"), "user_id", "event_type", "value", "props",
        F.date_format("ts", "yyyy_MM_dd").alias("day"))
    folder = scratch_path(spark, "landing_stream_in")
    e.hint("rebalance", "day").write.partitionBy("day").options(header="true", escape='"').csv(folder)
    spec = LandingSpec(filename_pattern=r"part-\d{5}-.*\.csv", date_regex=r"day=(\d{4})_(\d{2})_(\d{2})")
    raw = TableSpec(scratch_path(spark, "raw_events_stream"), partition_field="data_date")
    q = start_landing(spark, folder, spec, raw, EVENT_RAW_COLS, date_from="path")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    back = spark.read.schema(all_string_schema(EVENT_RAW_COLS + ["data_date"])).parquet(raw.path)
    typed = cast_to(back, {"event_id": "bigint", "user_id": "bigint", "value": "double"})
    return typed.select("event_id", "user_id", "event_type", "value", "props", "data_date")


@register("streaming_landing_checked", """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(day(ts) AS INTEGER) % 7 AS k, count(*) AS n FROM events GROUP BY ALL)
SELECT CASE k WHEN 6 THEN 'note_' ELSE 'ev_' END || day || '.csv' AS file_name, CASE k WHEN 3 THEN 'ERROR' WHEN 5 THEN 'ERROR' WHEN 6 THEN 'SKIP_PATTERN' ELSE 'PROCESSED' END AS status,
       CASE WHEN k IN (3, 5, 6) THEN 0 ELSE n END AS rows FROM e
""")
def streaming_landing_checked(spark, sf_dir):
    """L1/L2 incremental: daily files land in micro-batches with all controls.  Some have a field too many, some
    another header, some another name; the second half of the month comes after a restart of the stream.
    Every file has one status, and the rows of those that passed are in the table once."""
    e = T(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("k", F.dayofmonth("ts") % 7)
    cells = ["event_id", F.date_format("ts", fx.TS_FORMAT), "user_id", "event_type", "value"]
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("")) for c in cells])
    lines = e.select(F.concat(F.when(F.col("k") == 6, "note_").otherwise("ev_"), "day", F.lit(".csv")).alias("name"),
                     F.when(F.col("k") == 3, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"), "day", "k")
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    folder = scratch_path(spark, "landing_checked")
    raw = TableSpec(scratch_path(spark, "raw_checked"), partition_field="data_date")
    status = TableSpec(scratch_path(spark, "landing_status"), partition_field=None)
    spec = LandingSpec(filename_pattern=r"ev_.*\.csv")
    for half in (F.col("day") <= "2024-01-15", F.col("day") > "2024-01-15"):
        for own, header in ((F.col("k") != 5, ",".join(columns)), (F.col("k") == 5, "id,at,user,kind,amount")):
            mine = lines.where(half & own)
            fx.deliver(mine, folder, header, sorted(r.name for r in mine.select("name").distinct().collect()))   # a name per day
        q = start_controlled_landing(spark, folder, spec, raw, columns, status, checkpoint=f"{raw.path}_stream", max_files_per_trigger=8)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    landed = spark.read.parquet(raw.path).groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("n"))
    told = spark.read.parquet(status.path)
    return told.join(landed, "file_name", "left").select("file_name", "status", F.coalesce("n", F.lit(0)).alias("rows"))


@register("schema_lookup", """
WITH e AS (SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS data_date FROM events)
SELECT 'event_id' AS column_name, 1 AS position, false AS is_partition, count(event_id) AS filled FROM e
UNION ALL SELECT 'ts', 2, false, count(ts) FROM e UNION ALL SELECT 'user_id', 3, false, count(user_id) FROM e
UNION ALL SELECT 'event_type', 4, false, count(event_type) FROM e UNION ALL SELECT 'value', 5, false, count(value) FROM e
UNION ALL SELECT 'props', 6, false, count(props) FROM e UNION ALL SELECT 'data_date', 7, true, count(data_date) FROM e
""")
def schema_lookup(spark, sf_dir):
    """Columns of the filed events table with positions and partition flags (data columns first, then
    the partition key), each with the number of rows that have a value (one aggregation, unpivoted)."""
    spec = _events_table(spark, sf_dir)
    rows = read_target(spark, spec)
    counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    filled = stack_columns(counts, counts.columns, ["column_name", "filled"])
    return table_schema(spark, spec).join(filled, "column_name").select("column_name", "position", "is_partition", "filled")


@register("custom_transformation", """
SELECT DISTINCT p_partkey, upper(p_name) AS p_name, p_brand FROM part
""")
def custom_transformation(spark, sf_dir):
    """A user's own step, registered by name and applied with the others, then projected."""
    register_transformation("upper_case", lambda df, step: df.withColumns({c: F.upper(F.col(c)) for c in step.columns}))
    step = DateRepair(["p_name"], [], type="upper_case")
    return select_columns(apply_steps(T(spark, sf_dir, "part"), [step]), ["p_partkey", "p_name", "p_brand"]).distinct()
