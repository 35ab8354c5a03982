"""Evaluate data-quality rules and score them.

Every rule has its place in the rules frame (``_rule``), its own outcome frame and its own
thresholds as literals, so neither repeated nor missing rule ids can mix outcomes.  SQL and Python
rules give ``(identifier, result)`` rows; their outcomes are counted by observations while the
invalid identifiers of all of them are written, complete, to one staged table: one job over the
union, no join and no second pass.  Regex rules over one checked frame share one scan: one
aggregation of match counts per (rule, column).

If a shared job fails, its rules run one by one, so only the failing rule gets an error.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..functions.text import fill_template, regex_find
from ..functions.thresholds import threshold_flag
from ..operators.sets import union_all
from ..session import observed, scratch_path
from .rules import effective_rules, violation_list

KEYS = ["control_master_id", "control_table_id"]
IDENTIFIERS_DDL = "control_master_id string, control_table_id string, identifier string, data_date date"

# name -> fn(df, rule, **params) for Data level, fn(rule, **params) for File level;
# returns a DataFrame with columns identifier, result.
PYTHON_RULES: dict[str, Callable] = {}


def python_rule(name: str):
    def wrap(fn):
        PYTHON_RULES[name] = fn
        return fn
    return wrap


class RuleError(Exception):
    pass


@dataclass
class ControlRun:
    results: DataFrame           # controls_results rows of the rules that computed
    status: DataFrame            # (rule keys, status ok|error, error, total, invalid) of every rule
    overall: DataFrame           # one row: overall boolean, failed_rules, errored_rules
    identifiers: DataFrame       # every invalid identifier of every rule: IDENTIFIERS_DDL
    errors: dict = field(default_factory=dict)      # by place in the rules frame

    def verdict(self) -> bool:
        return bool(self.overall.first()["overall"])


@dataclass
class Counts:
    """What one rule's outcomes add up to."""
    total: int = 0
    invalid: int = 0
    nulls: int = 0
    valid_columns: list = field(default_factory=list)
    invalid_columns: list = field(default_factory=list)


@dataclass
class Outcomes:
    """The rows (_rule, identifier, flag, _null) of one rule.  Where the rule is a plain projection of a
    ``source``, ``entry`` is its row as a struct over that source's columns, and ``where`` its condition."""
    frame: DataFrame
    source: DataFrame | None = None
    entry: Column | None = None
    where: Column | None = None


def _judged(rule: dict, kind, identifier: Column, result: Column) -> list[Column]:
    """The outcome of a row, with its validity under the rule's own limits."""
    if not isinstance(kind, (BooleanType, NumericType)):
        raise RuleError(f"a result must be numeric or boolean, not {kind.simpleString()}")
    boolean = isinstance(kind, BooleanType)
    _check_result_type(rule, boolean)
    num = result.cast("int").cast("double") if boolean else result.cast("double")
    flag = threshold_flag(num, result if boolean else F.lit(None).cast("boolean"), rule["control_threshold_type"],
                          rule["control_threshold_min"], rule["control_threshold_max"])
    return [F.lit(rule["_rule"]).alias("_rule"), identifier.cast("string").alias("identifier"), flag.alias("flag"), result.isNull().alias("_null")]


def _as_outcomes(df: DataFrame, rule: dict) -> Outcomes:
    """A rule's result frame must have ``identifier`` and a numeric or boolean ``result``."""
    if df is None or "identifier" not in df.columns or "result" not in df.columns:
        raise RuleError('the result frame must have the columns "identifier" and "result"')
    return Outcomes(df.select(*_judged(rule, df.schema["result"].dataType, F.col("identifier"), F.col("result"))))


def _over(source: DataFrame, rule: dict, identifier: Column, result: Column, where: Column | None = None) -> Outcomes:
    """A rule that is a projection of ``source``: it can share one scan with others."""
    kind = source.select(result.alias("result")).schema["result"].dataType
    own = _judged(rule, kind, identifier, result)
    return Outcomes((source if where is None else source.where(where)).select(*own), source, F.struct(*own), where)


#: A rule text that may be a plain projection of one table.
PROJECTION = re.compile(r"\s*SELECT\s+(.+?)\s+AS\s+identifier\s*,\s*(.+?)\s+AS\s+result\s+FROM\s+([\w.`]+)(?:\s+WHERE\s+(.+?))?\s*;?\s*", re.I | re.S)


def _projection(spark: SparkSession, text: str, frame: DataFrame, rule: dict) -> Outcomes | None:
    """The rule's expressions over its table, if the text is a plain projection.  The pattern only
    guesses them: Spark says whether they mean the same as the text (``sameSemantics``), and that they
    are values of a row (they stand beside all columns, as no aggregate or generator can)."""
    found = PROJECTION.fullmatch(text)
    if not found:
        return None
    identifier, result, table, where = found.groups()
    try:
        source = spark.table(table)
        kept = source.where(where) if where else source
        if not kept.selectExpr(f"{identifier} AS identifier", f"{result} AS result").sameSemantics(frame):
            return None
        source.selectExpr("*", f"struct({identifier})", f"struct({result})")
        own = _over(source, rule, F.expr(identifier), F.expr(result), F.expr(where) if where else None)
        source.select(F.explode(F.array(own.entry)))
        return own
    except (AnalysisException, ParseException):
        return None


def fused(outcomes: list[Outcomes]) -> list[DataFrame]:
    """A5: the outcomes of rules over one and the same source by one scan of it; of the others each by its own."""
    groups: list[list[Outcomes]] = []
    for own in outcomes:
        mates = next((g for g in groups if own.source is not None and g[0].source is not None and g[0].source.sameSemantics(own.source)), None)
        mates.append(own) if mates else groups.append([own])
    out = []
    for group in groups:
        if len(group) == 1:
            out.append(group[0].frame)
            continue
        entries = [F.when(F.lit(True) if o.where is None else o.where, o.entry) for o in group]
        rows = group[0].source.select(F.explode(F.array(*entries)).alias("o")).where(F.col("o").isNotNull())
        out.append(rows.select("o.*"))
    return out


def _check_result_type(rule: dict, is_boolean: bool) -> None:
    """A Binary threshold needs boolean results; an Absolute one numeric results (``abs`` of a
    boolean is an analysis error).  Standard compares booleans as 1/0."""
    kind = rule.get("control_threshold_type")
    if kind == "Binary" and not is_boolean:
        raise RuleError("a Binary threshold needs a boolean result")
    if kind == "Absolute" and is_boolean:
        raise RuleError("an Absolute threshold needs a numeric result")


def regex_columns(df: DataFrame | None, rule: dict) -> list[str]:
    if df is None:
        raise RuleError("a regex rule needs the data frame")
    _check_result_type(rule, True)
    cols = [c.strip() for c in (rule.get("control_field") or "").split(",") if c.strip()]
    missing = [c for c in cols if c not in df.columns]
    if not cols or missing:
        raise RuleError(f"regex rule columns not found: {missing or cols}")
    return cols


def _regex_valid(rule: dict, column: str) -> Column:
    """The value (NULL as '') matches, judged by the rule's own limits."""
    matched = regex_find(F.col(f"`{column}`"), rule["control_description"])
    return threshold_flag(matched.cast("int").cast("double"), matched, rule["control_threshold_type"],
                          rule["control_threshold_min"], rule["control_threshold_max"])


def regex_counts(df: DataFrame, rules: list[tuple[dict, list[str]]]) -> dict[int, Counts]:
    """ONE scan of the checked frame for all its regex rules: match counts per (rule, column)."""
    checks = [(rule["_rule"], c, _regex_valid(rule, c)) for rule, cols in rules for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(valid).alias(f"c{i}") for i, (_, _, valid) in enumerate(checks)]).first()
    out: dict[int, Counts] = {rule["_rule"]: Counts() for rule, _ in rules}
    for i, (place, column, _) in enumerate(checks):
        counts, valid = out[place], row[f"c{i}"]
        counts.total += row["n"]
        counts.invalid += row["n"] - valid
        if valid and column not in counts.valid_columns:
            counts.valid_columns.append(column)
        if valid < row["n"] and column not in counts.invalid_columns:
            counts.invalid_columns.append(column)
    return out


def sql_outcomes(spark: SparkSession, rule: dict, df: DataFrame | None, params: dict) -> Outcomes:
    """The rule text with {file_date}/{file_name}/… filled in; ``data`` names the checked
    frame."""
    if df is not None:
        df.createOrReplaceTempView("data")
    text = fill_template(rule["control_description"], params, quote=True)
    frame = spark.sql(text)
    plain = _as_outcomes(frame, rule)
    return _projection(spark, text, frame, rule) or plain


def python_outcomes(df: DataFrame | None, rule: dict, params: dict, registry: dict) -> Outcomes:
    """A registered function; Data-level rules receive the frame, File-level rules do not.  It returns a
    frame with identifier and result, or these two as columns over the frame it was given."""
    name = rule["control_description"]
    fn = registry.get(name)
    if fn is None:
        raise RuleError(f"validation function {name!r} is not registered")
    out = fn(df, rule, **params) if rule.get("control_level") == "Data" else fn(rule, **params)
    return _over(df, rule, *out) if isinstance(out, tuple) and df is not None else _as_outcomes(out, rule)


def rule_outcomes(spark: SparkSession, df: DataFrame | None, rule: dict, params: dict, registry: dict) -> Outcomes:
    kind = rule.get("control_algorithm_type")
    if kind == "SQL":
        return sql_outcomes(spark, rule, df, params)
    if kind == "Python":
        return python_outcomes(df, rule, params, registry)
    raise RuleError(f"unknown algorithm type {kind!r}")


def _message(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def _write_outcomes(frames: dict[int, Outcomes], path: str) -> dict[int, Counts]:
    """A5: counts of each rule, observed while the invalid identifiers are written to ``path``."""
    obs = Observation(f"rules_{uuid.uuid4().hex[:8]}")
    own = {place: F.col("_rule") == place for place in frames}
    metrics = [m for place, mine in own.items() for m in (
        F.count_if(mine).alias(f"total_{place}"), F.count_if(mine & ~F.col("flag")).alias(f"invalid_{place}"),
        F.count_if(mine & F.col("_null")).alias(f"null_{place}"))]
    seen = union_all(fused(list(frames.values()))).observe(obs, *metrics)
    seen.where(~F.col("flag")).select("_rule", "identifier").write.parquet(path)
    return {place: Counts(*[observed(obs, f"{m}_{place}") for m in ("total", "invalid", "null")]) for place in frames}


def _each(rules: list, shared: Callable, alone: Callable) -> tuple[dict[int, Counts], dict[int, str]]:
    """The shared job; if it fails, every rule by itself, so one failure stays its own."""
    if not rules:
        return {}, {}
    try:
        return shared(), {}
    except Exception:  # some rule fails at run time; which one shows when each runs alone
        counts, errors = {}, {}
        for place, rule in rules:
            try:
                counts.update(alone(place, rule))
            except Exception as e:
                errors[place] = _message(e)
        return counts, errors


def _has_limits(rule: dict) -> bool:
    return rule.get("control_threshold_min") is not None or rule.get("control_threshold_max") is not None


def _detail(rule: dict, counts: Counts) -> str:
    """A regex rule lists its valid and invalid columns; other rules say how many records are
    invalid (the identifiers themselves are in the identifiers table)."""
    if rule["control_algorithm_type"] == "Regex":
        parts = [(label, ", ".join(sorted(cols))) for label, cols in (("Valid columns", counts.valid_columns), ("Invalid columns", counts.invalid_columns)) if cols]
        return ". ".join(f"{label}: {cols}" for label, cols in parts)
    return f"Invalid records: {counts.invalid}" if counts.invalid else ""


RESULT_DDL = ("control_master_id string, control_table_id string, control_outcome string, control_metric_value double, "
              "control_detail string, initial_date timestamp, end_date timestamp, data_date date")


def _metric(counts: Counts) -> float:
    """A6."""
    return 1.0 if counts.total == 0 else 1.0 - counts.invalid / counts.total


def overall(rules: list[dict], counts: dict[int, Counts], errors: dict[int, str]) -> tuple[bool, int, int]:
    """The run passes when no blocking rule's metric is below coalesce(rag_max, 1.0)
    and no rule failed to compute."""
    failed = 0
    for rule in rules:
        if rule["_rule"] in counts and rule.get("blocking_control_indicator"):
            rag = rule.get("control_threshold_rag_max")
            failed += _metric(counts[rule["_rule"]]) < (1.0 if rag is None else rag)
    return failed == 0 and not errors, failed, len(errors)


def _id_errors(rules: list[dict]) -> dict[int, str]:
    """Rules whose results could not be told apart: ids missing or shared."""
    ids = [(r["control_master_id"], r["control_table_id"]) for r in rules]
    return {r["_rule"]: "rule ids are missing" if None in key else "rule ids are shared by several rules"
            for r, key in zip(rules, ids) if None in key or ids.count(key) > 1}


def run_controls(spark: SparkSession, df: DataFrame | None, rules: DataFrame, params: dict | None = None,
                 registry: dict | None = None, strict: bool = False,
                 initial_date: dt.datetime | None = None, data_date: dt.date | str | None = None) -> ControlRun:
    """Validate and evaluate every rule (each isolated), score them, and compute the
    overall verdict.  ``strict`` raises after the run when any rule failed."""
    params = dict(params or {})
    registry = {**PYTHON_RULES, **(registry or {})}
    initial_date = initial_date or dt.datetime.now()
    if data_date is None:
        data_date = params.get("file_date") or dt.date.today()
    if isinstance(data_date, str):
        data_date = dt.date.fromisoformat(data_date)
    # rules are configuration rows: few, so they are collected with their violations
    rule_rows = [{**r.asDict(), "_rule": i} for i, r in enumerate(rules.select("*", F.array_join(violation_list(), "; ").alias("v")).collect())]
    by_place = {r["_rule"]: r for r in rule_rows}
    errors = _id_errors(rule_rows)
    frames: dict[int, Outcomes] = {}
    regex: list[tuple[dict, list[str]]] = []
    for rule in rule_rows:
        place = rule["_rule"]
        if place in errors:
            continue
        if rule["v"]:
            errors[place] = rule["v"]
            continue
        try:
            if rule["control_algorithm_type"] == "Regex":
                regex.append((rule, regex_columns(df, rule)))
                df.select(*[_regex_valid(rule, c) for c in regex[-1][1]])  # analysed here, so a bad pattern is its own
            else:
                frames[place] = rule_outcomes(spark, df, rule, params, registry)
        except Exception as e:  # isolate the rule: record and go on
            errors[place] = _message(e)
    regex = [(r, cols) for r, cols in regex if r["_rule"] not in errors]
    base = scratch_path(spark, "invalid_identifiers")
    counts, late = _each(list(frames.items()), lambda: _write_outcomes(frames, f"{base}/all"),
                         lambda place, frame: _write_outcomes({place: frame}, f"{base}/rule_{place}"))
    regex_found, regex_late = _each([(r["_rule"], (r, cols)) for r, cols in regex], lambda: regex_counts(df, regex),
                                    lambda _, own: regex_counts(df, [own]))
    counts.update(regex_found)
    errors.update(late | regex_late)
    for place, c in list(counts.items()):
        rule = by_place[place]
        if rule["control_threshold_type"] in ("Standard", "Absolute") and _has_limits(rule) and c.nulls > 0:
            errors[place] = "NULL result with threshold limits"
            del counts[place]
    end_date = dt.datetime.now()
    rows = [(by_place[p]["control_master_id"], by_place[p]["control_table_id"], f"{{total: {c.total}, value: {c.invalid}}}",
             _metric(c), _detail(by_place[p], c), initial_date, end_date, data_date) for p, c in sorted(counts.items())]
    status = [(r["control_master_id"], r["control_table_id"], "error" if r["_rule"] in errors else "ok", errors.get(r["_rule"]),
               counts[r["_rule"]].total if r["_rule"] in counts else None, counts[r["_rule"]].invalid if r["_rule"] in counts else None)
              for r in rule_rows]
    run = ControlRun(
        spark.createDataFrame(rows, RESULT_DDL),
        spark.createDataFrame(status, "control_master_id string, control_table_id string, status string, error string, total long, invalid long"),
        spark.createDataFrame([overall(rule_rows, counts, errors)], "overall boolean, failed_rules long, errored_rules long"),
        _identifiers(spark, base, by_place, counts, late, data_date), errors)
    if strict and errors:
        raise RuleError(f"{len(errors)} rules failed: " + "; ".join(
            f"{by_place[p]['control_master_id']}/{by_place[p]['control_table_id']}: {e}" for p, e in sorted(errors.items())))
    return run


def _identifiers(spark: SparkSession, base: str, rules: dict[int, dict], counts: dict[int, Counts], late: dict, data_date) -> DataFrame:
    """Every invalid identifier of the rules that computed, from the staged table (distributed);
    the invalid columns of regex rules are few and come from the counts."""
    computed = [p for p in counts if rules[p]["control_algorithm_type"] != "Regex"]
    columns = [(p, c) for p, n in counts.items() for c in n.invalid_columns]
    found = spark.createDataFrame(columns, "_rule int, identifier string")
    paths = [f"{base}/rule_{p}" for p in computed] if late else [f"{base}/all"] if computed else []
    if paths:
        found = spark.read.schema("_rule int, identifier string").parquet(*paths).where(F.col("_rule").isin(computed)).unionByName(found)
    ids = F.create_map(*[x for p, r in rules.items() if p in counts for x in (F.lit(p), F.struct(F.lit(r["control_master_id"]).alias("m"), F.lit(r["control_table_id"]).alias("t")))]) if counts else None
    if ids is None:
        return spark.createDataFrame([], IDENTIFIERS_DDL)
    own = ids[F.col("_rule")]
    return found.select(own["m"].alias("control_master_id"), own["t"].alias("control_table_id"), "identifier", F.lit(data_date).cast("date").alias("data_date"))


def invalid_identifiers(run: ControlRun) -> DataFrame:
    """Every invalid identifier of every rule, with its rule and the run's date."""
    return run.identifiers


def save_results(spark: SparkSession, run: ControlRun, spec, identifiers_spec=None) -> int:
    """Append the run's controls_results rows to the results table, and the complete invalid
    identifiers to theirs (by default the folder ``<results>_identifiers``)."""
    from dataclasses import replace

    from ..sinks.tables import append
    written = append(spark, run.results, spec).rows_written
    if identifiers_spec is None:
        identifiers_spec = replace(spec, path=f"{spec.path.rstrip('/')}_identifiers", schema=run.identifiers.schema, primary_keys=[])
    append(spark, run.identifiers, identifiers_spec)
    return written


def validate(spark: SparkSession, layer: str, table: str, df: DataFrame | None, dataset: DataFrame, master: DataFrame, results,
             database: str | None = None, params: dict | None = None, registry: dict | None = None, identifiers=None,
             data_date: dt.date | str | None = None) -> ControlRun:
    """D1-D15 in one: the active rules of ``table`` in ``layer`` (completed by the master's defaults) are loaded
    and run, results and invalid identifiers are stored, and the run with its verdict is returned."""
    rules = effective_rules(dataset, master, layer=layer, database=database, table=table)
    run = run_controls(spark, df, rules, params, registry, data_date=data_date)
    save_results(spark, run, results, identifiers)
    return run
