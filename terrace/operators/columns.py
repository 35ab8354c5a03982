"""Projection and column reshaping: P1-P12, A4.  Each is one narrow projection (no shuffle)
except :func:`distinct_tokens` and :func:`conform`, which end in a distinct."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import clean_name


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """P1."""
    return df.select(*columns)


def conform(df: DataFrame, target: StructType | list[str]) -> DataFrame:
    """Target columns in order, then whole-row DISTINCT (done before every write)."""
    names = target.fieldNames() if isinstance(target, StructType) else list(target)
    return df.select(*[F.col(f"`{n}`") for n in names]).distinct()


def project_report(df: DataFrame, columns: list[str], aliases: list[str] | None = None) -> DataFrame:
    """``columns[i] AS aliases[i]``, or SQL expressions carrying their own alias."""
    if aliases:
        if len(aliases) != len(columns):
            raise ValueError(f"{len(columns)} columns but {len(aliases)} aliases")
        return df.selectExpr(*[f"{c} AS `{a}`" for c, a in zip(columns, aliases)])
    return df.selectExpr(*columns)


def coalesce_pairs(df: DataFrame, columns: list[str], custom_suffix: str, default_suffix: str,
                   drop: bool = True) -> DataFrame:
    """``c = c<custom> if not NULL else c<default>``, for each name in ``columns``."""
    out = df.withColumns({c: F.coalesce(F.col(f"`{c}{custom_suffix}`"), F.col(f"`{c}{default_suffix}`"))
                          for c in columns})
    if drop:
        out = out.drop(*[f"{c}{s}" for c in columns for s in (custom_suffix, default_suffix)])
    return out


def pick_column(df: DataFrame, new: str, reference: str, available: list[str], default: Any = None) -> DataFrame:
    """P5: the value of the column *named by* ``reference``, among ``available``; else ``default``.
    All candidate columns are cast to string when their types differ."""
    types = {df.schema[c].dataType for c in available}
    values = {c: F.col(f"`{c}`") if len(types) == 1 else F.col(f"`{c}`").cast("string") for c in available}
    named = [F.when(F.col(reference) == c, F.struct(v.alias("value"))) for c, v in values.items()]
    chosen = F.coalesce(*named) if named else F.lit(None)
    picked = F.when(chosen.isNotNull(), chosen["value"]).otherwise(F.lit(default)) if named else F.lit(default)
    return df.withColumn(new, picked)


def stack_columns(df: DataFrame, sources: list[str], targets: list[str]) -> DataFrame:
    """P6 unpivot: k columns to (name, value); other columns dropped; NULL values kept.
    Values of mixed types are cast to string first."""
    if len(targets) != 2:
        raise ValueError(f"two target columns are needed, got {targets}")
    types = {df.schema[c].dataType for c in sources}
    base = df.select(*sources)
    if len(types) > 1:
        base = base.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in sources])
    return base.unpivot([], sources, targets[0], targets[1])


def rename_clashes(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
                   left_suffix: str, right_suffix: str) -> tuple[DataFrame, DataFrame]:
    """Suffix the non-key columns both sides share."""
    common = set(left.columns) & set(right.columns)
    lmap = {c: c + left_suffix for c in common if c not in left_keys}
    rmap = {c: c + right_suffix for c in common if c not in right_keys}
    return (left.withColumnsRenamed(lmap) if lmap else left,
            right.withColumnsRenamed(rmap) if rmap else right)


def clean_names(df: DataFrame) -> DataFrame:
    """Strip non-word characters from column names; clashes are an error."""
    new = [clean_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"cleaned column names collide: {new}")
    return df.toDF(*new)


def stamp_partition(df: DataFrame, field: str, value) -> DataFrame:
    """P10: the partition value on every record (a Column or a literal)."""
    from pyspark.sql import Column
    return df.withColumn(field, value if isinstance(value, Column) else F.lit(value))


def fill_empty(df: DataFrame) -> DataFrame:
    """NULL -> '' on string columns."""
    return df.na.fill("")


def distinct_tokens(df: DataFrame, column: str, separator: str, name: str = "value") -> DataFrame:
    """The distinct tokens of a delimited string column (``separator`` is a regex);
    NULL and '' cells are skipped.  Returned as a DataFrame, never collected."""
    c = F.col(column)
    return (df.where(c.isNotNull() & (c != ""))
            .select(F.explode(F.split(c, separator)).alias(name))
            .distinct())


def is_empty(df: DataFrame | None) -> bool:
    """A3: no frame, or no row in it (reads at most one)."""
    return df is None or df.isEmpty()
