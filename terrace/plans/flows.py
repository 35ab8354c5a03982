"""L3 raw -> staging (C5 datacast), L4 staging -> common / business, L6/M3 run summary.

Each flow is one lazy plan from the raw read to the write: the read count is observed (M1), not
counted in an extra pass, and the write is a keyed merge (K1) into the target table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.casting import all_string_schema, cast_to, repair_json_columns
from ..functions.dates import apply_steps
from ..sinks.tables import WriteResult, append, merge_into
from ..session import observed
from ..sources.files import partition_path, read_nested_json, read_raw
from ..sources.tables import read_partition
from ..specs import CsvSpec, JsonSpec, TableSpec
from .metrics import process_events, with_read_metrics
from .reports import failed_outputs


def datacast(spark: SparkSession, raw_base: str, target: StructType, fmt: str = "csv",
             mode: str = "delta", file_date: str | None = None, partition_field: str = "data_date",
             csv: CsvSpec | None = None, json: JsonSpec | None = None, raw_columns: list[str] | None = None,
             strategy: str = "one_by_one", steps: list | None = None, fix_characters: bool = True,
             observation: Observation | None = None) -> DataFrame:
    """Read the raw table by strategy, apply the transformation steps (C8), repair struct
    JSON text (C7), then cast every column to the target type (C4).

    one_by_one: read every column as a string (``raw_columns``, default the target's names)
    dynamic:    the reader's own types (Parquet schema; strings for CSV, no inference pass)
    """
    names = raw_columns or [f.name for f in target.fields]
    if fmt == "json":
        path = raw_base if mode == "full" else partition_path(raw_base, partition_field, file_date)
        df = read_nested_json(spark, path, json or JsonSpec(), columns=[c for c in names if c != partition_field],
                              partition_field=partition_field, file_date=file_date, dynamic=strategy == "dynamic")
    else:
        schema = all_string_schema(names) if strategy == "one_by_one" else None
        df = read_raw(spark, raw_base, fmt, mode, partition_field, file_date, csv, schema)
    if observation is not None:
        df = with_read_metrics(df, observation)
    df = apply_steps(df, steps or [])
    if strategy == "one_by_one":
        if fix_characters:
            df = repair_json_columns(df, target)
        df = cast_to(df, target)
    return df


@dataclass
class FlowResult:
    rows_read: int | None
    written: WriteResult
    started: dt.datetime
    finished: dt.datetime
    extra: dict = field(default_factory=dict)

    @property
    def seconds(self) -> float:
        return (self.finished - self.started).total_seconds()


def _finished(spark: SparkSession, process: str, result: FlowResult, events: TableSpec | None) -> FlowResult:
    """M3: the process events of a flow that wrote, filed in the ``events`` table."""
    if events is not None:
        append(spark, process_events(spark, process, result.started, result.finished), events)
    return result


def raw_to_staging(spark: SparkSession, raw_base: str, staging: TableSpec, transform: Callable | None = None,
                   events: TableSpec | None = None, **cast_options) -> FlowResult:
    """L3: datacast -> optional user transformation -> merge into staging on its keys."""
    started = dt.datetime.now()
    obs = Observation("raw_read")
    df = datacast(spark, raw_base, staging.schema, observation=obs, **cast_options)
    if transform is not None:
        df = transform(df)
    written = merge_into(spark, staging, df)
    return _finished(spark, "raw_to_staging", FlowResult(observed(obs, "rows"), written, started, dt.datetime.now()), events)


def refine(spark: SparkSession, source: TableSpec, target: TableSpec, transform: Callable[[DataFrame], DataFrame],
           mode: str = "full", value=None, events: TableSpec | None = None, process: str = "refine") -> FlowResult:
    """L4: staging -> common / business: partition-aware read -> user code -> merge."""
    started = dt.datetime.now()
    obs = Observation("read")
    df = with_read_metrics(read_partition(spark, source, mode, value), obs)
    written = merge_into(spark, target, transform(df))
    return _finished(spark, process, FlowResult(observed(obs, "rows"), written, started, dt.datetime.now()), events)


def run_summary(spark: SparkSession, process: str, results: list[FlowResult], file_name: str | None = None,
                file_date: str | None = None, next_stage: bool = True, outputs: DataFrame | None = None,
                controls: dict | None = None) -> DataFrame:
    """One summary row per run: timings, counts, the checked tables with their verdicts (``controls``:
    table -> ControlRun) and the outputs that failed with their errors.  A run succeeds if every flow
    wrote, every verdict is true and no output failed; the next stage starts only then."""
    failed = [] if outputs is None else [(r["name"], r["error"]) for r in failed_outputs(outputs).orderBy("name").collect()]
    checked = [(table, run.verdict()) for table, run in sorted((controls or {}).items())]
    ok = all(r.written is not None for r in results) and all(v for _, v in checked) and not failed
    row = (process, ok, next_stage and ok, file_name, file_date,
           min(r.started for r in results) if results else None, max(r.finished for r in results) if results else None,
           float(sum(r.seconds for r in results)), int(sum(r.rows_read or 0 for r in results)),
           int(sum((r.written.rows_written or 0) for r in results)), len(failed), checked, failed)
    return spark.createDataFrame([row], "process string, success boolean, next_stage boolean, file_name string, "
                                        "file_date string, started timestamp, finished timestamp, duration_sec double, "
                                        "rows_read long, rows_written long, failed_outputs long, "
                                        "checked_tables array<struct<table: string, passed: boolean>>, "
                                        "output_errors array<struct<name: string, error: string>>")
