"""S1 read_table, S2/F3 partition-aware reads, S3 SQL, S4 small frames, S14 schema lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..specs import TableSpec


def _load(spark: SparkSession, source: str | TableSpec | DataFrame) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, TableSpec):
        if source.schema is not None:  # the declared types, partition column included
            return spark.read.schema(source.schema).parquet(source.path)
        source = source.path
    if "/" in source or source.startswith("file:"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_table(spark: SparkSession, source, where: str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Filter on source columns first, then the projection of SQL expressions.
    Both reach the Parquet scan (pushed filters, pruned read schema)."""
    df = _load(spark, source)
    if where:
        df = df.where(where)
    if columns:
        df = df.selectExpr(*columns)
    return df


def read_partition(spark: SparkSession, spec: TableSpec, mode: str = "delta", value=None) -> DataFrame:
    """Delta reads the one partition ``value``; full reads the whole table.  The
    predicate is on the partition column, so Catalyst prunes directories."""
    df = _load(spark, spec)
    if mode == "delta":
        if not spec.partition_field:
            raise ValueError("delta mode needs a partition field")
        df = df.where(F.col(spec.partition_field) == F.lit(value))
    elif mode != "full":
        raise ValueError(f"unknown execution mode {mode!r}")
    return df


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """S3: Spark SQL over registered views; ``{name}`` placeholders are filled from ``params``."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text.format(**params) if params else text)


def create_frame(spark: SparkSession, data, schema=None) -> DataFrame:
    """Small local data only (rules, configuration)."""
    return spark.createDataFrame(data, schema)


def table_schema(spark: SparkSession, source, partition_columns: list[str] | None = None) -> DataFrame:
    """(column, type, position, is_partition) of a table, as a DataFrame.  For catalog
    tables the partition flags come from the catalog."""
    if isinstance(source, str) and "/" not in source:
        cols = spark.catalog.listColumns(source)
        rows = [(c.name, c.dataType, i + 1, bool(c.isPartition)) for i, c in enumerate(cols)]
    else:
        schema: StructType = _load(spark, source).schema
        parts = set(partition_columns or (source.partition_columns if isinstance(source, TableSpec) else []))
        rows = [(f.name, f.dataType.simpleString(), i + 1, f.name in parts) for i, f in enumerate(schema.fields)]
    rows.sort(key=lambda r: (r[3], r[2]))  # data columns first, then partition keys
    return spark.createDataFrame(rows, "column_name string, data_type string, position int, is_partition boolean")

