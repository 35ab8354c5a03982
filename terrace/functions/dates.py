"""C6 parse_dates and C14 date formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import DateRepair


def repaired_date(col: Column | str, source_formats: list[str], target_format: str = "yyyy-MM-dd") -> Column:
    """The first source format that parses the original string wins; the value is rewritten in
    ``target_format``; strings no format parses are kept unchanged (NULL stays NULL).
    ``try_to_date`` never throws under ANSI mode."""
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.coalesce(*[F.try_to_date(c, fmt) for fmt in source_formats])
    return F.coalesce(F.date_format(parsed, target_format), c)


def parse_dates(df: DataFrame, step: DateRepair) -> DataFrame:
    missing = [c for c in step.columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; unable to apply parse_dates")
    return df.withColumns({c: repaired_date(c, step.source_formats, step.target_format) for c in step.columns})


def format_date(col: Column | str, fmt: str) -> Column:
    """C14."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, fmt)


# Transformation registry, dispatched by the step's type name.
TRANSFORMATIONS = {"parse_dates": parse_dates}


def register_transformation(name: str, fn) -> None:
    TRANSFORMATIONS[name] = fn


def apply_steps(df: DataFrame, steps: list) -> DataFrame:
    for step in steps or []:
        kind = getattr(step, "type", None)
        fn = TRANSFORMATIONS.get(kind)
        if fn is None:
            raise NotImplementedError(f"transformation {kind!r} is not registered; "
                                      f"available: {sorted(TRANSFORMATIONS)}")
        df = df.transform(fn, step)
    return df
