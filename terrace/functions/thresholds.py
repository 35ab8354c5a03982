"""Threshold predicates (F7, D5-D7) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Threshold types, algorithm types and rule levels.
THRESHOLD_TYPES = ["Standard", "Absolute", "Binary"]
ALGORITHM_TYPES = ["Python", "SQL", "Regex"]
CONTROL_LEVELS = ["Data", "File"]


def within(value: Column, lo: Column | float | None, hi: Column | float | None) -> Column:
    """inclusive limits, each optional (NULL limit = open).  NaN fails any limit that
    exists (Python comparison semantics; Spark alone would call NaN the largest value)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo).cast("double")
    hi_c = hi if isinstance(hi, Column) else F.lit(hi).cast("double")
    ok_lo = lo_c.isNull() | (value >= lo_c)
    ok_hi = hi_c.isNull() | (value <= hi_c)
    has_limit = lo_c.isNotNull() | hi_c.isNotNull()
    return F.when(has_limit & F.isnan(value), F.lit(False)).otherwise(ok_lo & ok_hi)


def threshold_flag(result_num: Column, result_bool: Column, kind: Column | str,
                   lo: Column | float | None, hi: Column | float | None) -> Column:
    """Per-row validity.  D5 Standard: numeric result within limits; D6 Absolute: |result|
    within limits; D7 Binary: the boolean result itself.  NULL results give a NULL flag."""
    k = F.lit(kind) if isinstance(kind, str) else kind
    return (F.when(k == "Binary", result_bool)
            .when(k == "Absolute", F.when(result_num.isNotNull(), within(F.abs(result_num), lo, hi)))
            .when(k == "Standard", F.when(result_num.isNotNull(), within(result_num, lo, hi))))

