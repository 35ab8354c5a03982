"""Rule tables: D1 effective rules (F2 + J3 + P4), D2-D4 rule validation as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.thresholds import ALGORITHM_TYPES, CONTROL_LEVELS, THRESHOLD_TYPES
from ..operators.columns import coalesce_pairs
from ..operators.joins import equi_join
from ..sources.tables import create_frame

# The columns of the three rule tables.
MASTER_SCHEMA = ("control_master_id string, control_level string, control_threshold_min double, "
                 "control_threshold_max double, control_threshold_type string")

DATASET_SCHEMA = ("control_master_id string, control_table_id string, control_layer string, "
                  "control_database string, control_table string, control_field string, "
                  "control_dataset_details string, control_description string, control_algorithm_type string, "
                  "control_level string, control_threshold_min double, control_threshold_max double, "
                  "control_threshold_type string, control_threshold_rag_min double, control_threshold_rag_max double, "
                  "blocking_control_indicator boolean, active_control_indicator boolean")

RESULTS_SCHEMA = ("control_master_id string, control_table_id string, control_outcome string, "
                  "control_metric_value double, control_detail string, initial_date timestamp, "
                  "end_date timestamp, data_date date")


def effective_rules(dataset: DataFrame, master: DataFrame, layer: str | None = None,
                    database: str | None = None, table: str | None = None) -> DataFrame:
    """Active rules of one table/layer, completed by the master: for every column both
    tables share, the rule's own value wins when not NULL, else the master's."""
    cond = F.coalesce(F.col("active_control_indicator"), F.lit(False))
    for col, value in (("control_layer", layer), ("control_database", database), ("control_table", table)):
        if value is not None:
            cond = cond & (F.col(col) == F.lit(value))
    rules = dataset.where(cond)
    common = sorted((set(rules.columns) & set(master.columns)) - {"control_master_id"})
    joined = equi_join(rules, master, "left", ["control_master_id"], left_suffix="_rules", right_suffix="_master")
    return coalesce_pairs(joined, common, "_rules", "_master")


def _check(cond: Column, message: Column | str) -> Column:
    return F.when(cond, message if isinstance(message, Column) else F.lit(message))


def violation_list() -> Column:
    """D2-D4 as one array expression over a rules row: the messages of every broken property
    (D2 threshold type, limits and pass ratios; D3 algorithm type and description; D4 level)."""
    t = F.col("control_threshold_type")
    lo, hi = F.col("control_threshold_min"), F.col("control_threshold_max")
    rlo, rhi = F.col("control_threshold_rag_min"), F.col("control_threshold_rag_max")
    algo, level = F.col("control_algorithm_type"), F.col("control_level")
    def one_of(what: str, value: Column, allowed: list[str]) -> Column:
        said = F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit("nothing"))
        return _check(value.isNull() | ~value.isin(*allowed), F.concat(F.lit(f"{what} must be one of {allowed}, got "), said))

    def in_order(what: str, low: Column, high: Column) -> Column:
        return _check(low > high, F.format_string(f"{what}: lower bound %s exceeds upper bound %s", low, high))

    def share(what: str, value: Column) -> Column:
        return _check((value < 0) | (value > 1), F.format_string(f"{what} %s is no share between 0 and 1", value))

    checks = [
        one_of("threshold type", t, THRESHOLD_TYPES),
        in_order("limits", lo, hi), in_order("pass ratios", rlo, rhi),
        share("lower pass ratio", rlo), share("upper pass ratio", rhi),
        _check(lo.isNotNull() & hi.isNotNull() & (t == "Binary"), "a Binary threshold takes no limits"),
        one_of("algorithm type", algo, ALGORITHM_TYPES),
        _check(F.coalesce(F.trim(F.col("control_description")), F.lit("")) == "", "the rule describes no algorithm"),
        one_of("control level", level, CONTROL_LEVELS),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def rule_violations(rules: DataFrame) -> DataFrame:
    """One row per broken rule property, ``(control_master_id, control_table_id,
    violation)``; a valid rule has no rows."""
    return rules.select("control_master_id", "control_table_id", F.explode(violation_list()).alias("violation"))


def rules_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rules from configuration rows (missing fields NULL)."""
    names = [part.strip().split(" ")[0] for part in DATASET_SCHEMA.split(",")]
    return create_frame(spark, [tuple(r.get(n) for n in names) for r in rows], DATASET_SCHEMA)


def master_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [part.strip().split(" ")[0] for part in MASTER_SCHEMA.split(",")]
    return create_frame(spark, [tuple(r.get(n) for n in names) for r in rows], MASTER_SCHEMA)
