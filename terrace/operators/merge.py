"""K1/K2/J5 merge of a source frame into a target frame on primary keys, with M2 counts.

Named strategies are semi and anti joins and a union, so Spark may broadcast a small source (by its
own statistics) and stream the target.  Clauses with conditions and expressions (WHEN MATCHED AND ...,
WHEN NOT MATCHED, WHEN NOT MATCHED BY SOURCE) classify every row in one outer join with marker columns
(``_t`` on target rows, ``_s`` on source rows).  Keys match with ``=`` (NULL never matches, as SQL
MERGE) unless ``null_safe``; rows that cannot match are kept out of the joins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

STRATEGIES = ("upsert", "insert_only", "update_only", "delete_matched")
#: What a clause may do, by the rows it is for.
CLAUSES = {"matched": ("update", "delete"), "not_matched": ("insert",), "not_matched_by_source": ("update", "delete")}


class DuplicateSourceKeyError(ValueError):
    pass


@dataclass
class Clause:
    """WHEN <when> [AND <condition>] THEN <action>: conditions and values are SQL over ``t`` (target) and ``s``
    (source).  ``values`` gives some columns; without it an update or insert takes the source's row."""
    when: str
    action: str
    condition: str | None = None
    values: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.action not in CLAUSES.get(self.when, ()):
            raise ValueError(f"a {self.when!r} clause cannot {self.action!r}; allowed: {CLAUSES}")
        if self.when == "not_matched_by_source" and self.action == "update" and not self.values:
            raise ValueError("an update of rows that the source lacks needs values")


@dataclass
class MergeCounts:
    """Row counts of one merge; ``kept`` covers the rewritten partitions only."""
    inserted: int
    updated: int
    deleted: int
    kept: int

    @property
    def total(self) -> int:
        return self.inserted + self.updated + self.kept


def _all_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def key_match(t: str, s: str, keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{t}.`{k}`"), F.col(f"{s}.`{k}`")) for k in keys]
    return _all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _has_keys(keys: list[str]) -> Column:
    return _all_of([F.col(f"`{k}`").isNotNull() for k in keys])


def check_duplicate_source_keys(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> None:
    """Q2: two source rows with one key may not match the same target row (MERGE would fail).  The
    source alone is aggregated first; the target is only read if it has repeated keys.  With
    ``null_safe`` keys, NULL is a key like any other."""
    named = [F.col(f"`{k}`") for k in keys]
    dup = (source if null_safe else source.where(_has_keys(keys))).groupBy(*named).count().where(F.col("count") > 1).drop("count")
    if not dup.isEmpty() and not target.select(*named).alias("t").join(dup.alias("s"), key_match("t", "s", keys, null_safe), "left_semi").isEmpty():
        raise DuplicateSourceKeyError(f"several source rows share a key that matches a target row; keys={keys}")


def _clauses_of(strategy: str, columns: list[str], keys: list[str], update_columns: list[str] | None) -> list[Clause]:
    some = {c: f"s.`{c}`" for c in update_columns if c not in keys} if update_columns is not None else {}
    update, insert = Clause("matched", "update", values=some), Clause("not_matched", "insert")
    if update_columns is not None and not some:
        update = None
    chosen = {"upsert": [update, insert], "insert_only": [insert], "update_only": [update], "delete_matched": [Clause("matched", "delete")]}
    return [c for c in chosen[strategy] if c is not None]


def merge_actions(target: DataFrame, source: DataFrame, keys: list[str], strategy: str = "upsert",
                  update_columns: list[str] | None = None, null_safe: bool = False,
                  clauses: list[Clause] | None = None) -> DataFrame:
    """Every row of the keyed outer join with the merged values of the target's columns and ``_action`` in kept /
    updated / inserted / deleted / ignored.  Of the clauses for a row's case the first whose condition
    holds acts.  Without inserts the source's other rows are not joined in (a left join)."""
    _validate(target, source, keys, strategy)
    cols = target.columns
    clauses = _clauses_of(strategy, cols, keys, update_columns) if clauses is None else clauses
    t = target.select(*[F.col(f"`{c}`") for c in cols]).withColumn("_t", F.lit(True)).alias("t")
    s = source.select(*[F.col(f"`{c}`") for c in cols]).withColumn("_s", F.lit(True)).alias("s")
    full = any(c.action == "insert" for c in clauses)
    j = t.join(s, key_match("t", "s", keys, null_safe), "full_outer" if full else "left")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    case = {"matched": in_t & in_s, "not_matched": in_s & ~in_t, "not_matched_by_source": in_t & ~in_s}
    hits = [case[c.when] & (F.coalesce(F.expr(c.condition), F.lit(False)) if c.condition else F.lit(True)) for c in clauses]

    def value(c: str) -> Column:
        out = None
        for clause, hit in zip(clauses, hits):
            if clause.action == "delete":
                new = F.col(f"t.`{c}`")
            elif clause.values:
                other = F.lit(None) if clause.action == "insert" else F.col(f"t.`{c}`")
                new = F.expr(clause.values[c]).cast(target.schema[c].dataType) if c in clause.values else other
            else:
                new = F.col(f"s.`{c}`")
            out = F.when(hit, new) if out is None else out.when(hit, new)
        rest = F.when(in_t, F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`"))
        return (rest if out is None else out.otherwise(rest)).alias(c)

    action = None
    for clause, hit in zip(clauses, hits):
        name = {"update": "updated", "insert": "inserted", "delete": "deleted"}[clause.action]
        action = F.when(hit, name) if action is None else action.when(hit, name)
    rest = F.when(in_t, "kept").otherwise("ignored")
    return j.select(*[value(c) for c in cols], (rest if action is None else action.otherwise(rest)).alias("_action"))


def _validate(target: DataFrame, source: DataFrame, keys: list[str], strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown merge strategy {strategy!r}; allowed: {STRATEGIES}")
    if not keys:
        raise ValueError("merge needs primary keys")
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """The source rows that match no target row; those without a whole key match nothing and pass by the join."""
    src = source.select(*[F.col(f"`{c}`") for c in target.columns])
    whole = F.lit(True) if null_safe else _has_keys(keys)
    t_keys = target.where(whole).select(*[F.col(f"`{k}`") for k in keys]).alias("t")
    fresh = src.where(whole).alias("s").join(t_keys, key_match("t", "s", keys, null_safe), "left_anti")
    return fresh if null_safe else fresh.unionByName(src.where(~whole))


@dataclass
class MergePlan:
    """The merged rows plus the observations that yield :class:`MergeCounts` once the frame has
    been written (or otherwise computed by an action)."""
    frame: DataFrame
    strategy: str
    observations: dict

    def counts(self) -> MergeCounts:
        from ..session import observed
        if "actions" in self.observations:
            return MergeCounts(*[observed(self.observations["actions"], a) for a in ("inserted", "updated", "deleted", "kept")])
        g = {k: observed(o, "n") for k, o in self.observations.items()}
        apart = g.get("apart", 0)  # target rows without a whole key
        if self.strategy == "insert_only":
            return MergeCounts(g.get("inserted", 0) + g.get("bare", 0), 0, 0, g["target"] + apart)
        hit = g["target"] - g["kept"]
        if self.strategy == "delete_matched":
            return MergeCounts(0, 0, hit, g["kept"] + apart)
        inserted = g.get("source", 0) + g.get("bare", 0) - hit if self.strategy == "upsert" else 0
        return MergeCounts(inserted, hit, 0, g["kept"] + apart)


def plan_merge(target: DataFrame, source: DataFrame, keys: list[str], strategy: str = "upsert",
               update_columns: list[str] | None = None, null_safe: bool = False,
               clauses: list[Clause] | None = None) -> MergePlan:
    """The merge as a plan.

    upsert          (target anti source) + source
    insert_only     target + (source anti target)
    update_only     (target anti source) + (source semi target)
    delete_matched  target anti source
    ``update_columns`` (partial update) and ``clauses``: :func:`merge_actions`, one outer join.
    Rows of either side without a whole key match nothing, so they pass by the joins (a NULL key
    would gather them in one partition).  Counts assume the source has one row per key among matched
    keys (MERGE's own rule; see :func:`check_duplicate_source_keys`).
    """
    _validate(target, source, keys, strategy)
    cols = target.columns
    tag = uuid.uuid4().hex[:8]
    obs: dict[str, Observation] = {}

    def counted(df: DataFrame, name: str) -> DataFrame:
        obs[name] = Observation(f"merge_{name}_{tag}")
        return df.observe(obs[name], F.count(F.lit(1)).alias("n"))

    src = source.select(*[F.col(f"`{c}`") for c in cols])
    tgt = target.select(*[F.col(f"`{c}`") for c in cols])
    if clauses is not None or (update_columns is not None and strategy in ("upsert", "update_only")):
        acts = merge_actions(tgt, src, keys, strategy, update_columns, null_safe, clauses)
        obs["actions"] = Observation(f"merge_actions_{tag}")
        acts = acts.observe(obs["actions"], *[F.count_if(F.col("_action") == a).alias(a) for a in ("inserted", "updated", "deleted", "kept")])
        return MergePlan(acts.where(F.col("_action").isin("kept", "updated", "inserted")).drop("_action"), strategy, obs)

    whole = F.lit(True) if null_safe else _has_keys(keys)
    t = counted(tgt.where(whole), "target").alias("t")
    s = src.where(whole).alias("s")
    s_keys = src.where(whole).select(*keys).alias("s")
    t_keys = tgt.where(whole).select(*keys).alias("t")
    match = key_match("t", "s", keys, null_safe)
    inserts = strategy in ("upsert", "insert_only")
    if strategy == "insert_only":
        parts = [t, counted(s.join(t_keys, match, "left_anti"), "inserted")]
    else:
        parts = [counted(t.join(s_keys, match, "left_anti"), "kept")]
        if strategy == "upsert":
            parts.append(counted(s, "source"))
        elif strategy == "update_only":
            parts.append(s.join(t_keys, match, "left_semi"))
    if not null_safe:
        parts.append(counted(tgt.where(~whole), "apart"))
        if inserts:
            parts.append(counted(src.where(~whole), "bare"))
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return MergePlan(frame.select(*[F.col(f"`{c}`") for c in cols]), strategy, obs)


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str], strategy: str = "upsert",
                 update_columns: list[str] | None = None, null_safe: bool = False,
                 clauses: list[Clause] | None = None) -> DataFrame:
    """The merged table as a DataFrame with the target's columns (see :func:`plan_merge`).

    upsert          matched -> source row (or only ``update_columns``), unmatched source -> insert
    insert_only     unmatched source rows are inserted; matched targets untouched
    update_only     matched targets updated; unmatched source rows dropped
    delete_matched  matched target rows removed
    """
    return plan_merge(target, source, keys, strategy, update_columns, null_safe, clauses).frame
