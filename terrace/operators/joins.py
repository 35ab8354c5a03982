"""J1/J2 equi-joins with key coalescing and suffixes for clashing columns.

The plan is a plain ``DataFrame.join(on=[names])``: Catalyst picks broadcast-hash when one side is
known to be small (statistics or AQE at run time) and sort-merge otherwise, and AQE splits skewed
key partitions.  Keys are compared with ``=``: NULL keys never match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import rename_clashes

JOIN_KINDS = ("inner", "left", "right", "outer")


def equi_join(left: DataFrame, right: DataFrame, how: str, left_on: list[str],
              right_on: list[str] | None = None, left_suffix: str = "_df_1",
              right_suffix: str = "_df_2") -> DataFrame:
    if how not in JOIN_KINDS:
        raise ValueError(f"invalid join kind {how!r}; allowed: {', '.join(JOIN_KINDS)}")
    right_on = list(right_on or left_on)
    left_on = list(left_on)
    if len(left_on) != len(right_on):
        raise ValueError(f"left_on has {len(left_on)} columns, right_on {len(right_on)}")
    if right_on != left_on:
        # Right keys take the left names; the right key columns vanish from the result.  A left column
        # that is named like a right key is suffixed, as any name that both sides have.
        shared = [c for c in right_on if c in left.columns and c not in left_on]
        left = left.withColumnsRenamed({c: c + left_suffix for c in shared})
        clash = [c for c in left_on if c in right.columns and c not in right_on]
        if clash:
            right = right.withColumnsRenamed({c: c + right_suffix for c in clash})
        mapping = dict(zip(right_on, left_on))
        right = right.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in right.columns])
    left, right = rename_clashes(left, right, left_on, left_on, left_suffix, right_suffix)
    return left.join(right, on=left_on, how=how)
