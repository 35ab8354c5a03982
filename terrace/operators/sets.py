"""T1 latest processed copy, T3 bag union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: where a processed copy's insert time sits in its path.
INSERT_PATH_PATTERN = r"insert_date=(\d{4}-\d{2}-\d{2})/insert_time=(\d{2}:\d{2}:\d{2})"


def insert_timestamp(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    stamp = F.concat_ws(" ", F.regexp_extract(p, INSERT_PATH_PATTERN, 1), F.regexp_extract(p, INSERT_PATH_PATTERN, 2))
    return F.when(p.rlike(INSERT_PATH_PATTERN), F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")))


def latest_copies(processed: DataFrame, name_col: str = "file_name", path_col: str = "path",
                  extra: list[str] | None = None) -> DataFrame:
    """Per file name, the processed copy with the latest insert timestamp in its path.
    ``max_by`` is a partial aggregate: one shuffle of one row per (partition, name)."""
    extra = extra or []
    ts = insert_timestamp(path_col)
    base = processed.withColumn("_ts", ts).where(F.col("_ts").isNotNull())
    aggs = [F.max_by(F.col(path_col), F.col("_ts")).alias(path_col)]
    aggs += [F.max_by(F.col(c), F.col("_ts")).alias(c) for c in extra]
    return base.groupBy(name_col).agg(F.max("_ts").alias("insert_ts"), *aggs)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """T3."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
