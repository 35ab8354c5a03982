"""L1/L2 landing -> raw as distributed jobs over the files of a landing folder.

list files (S13) -> name pattern (F6) -> file date (C11) -> file controls (D16, D18, D19, rules) ->
unchanged-copy check (D20) -> parse the files that passed (S5 / S8 / S11 / S6, or archive members
S12) -> stamp date and file (P10) -> commit to the raw table (K6/K7/K12).

Per-file failures do not stop the job: every file gets a status row (PROCESSED, SKIP_PATTERN,
SKIP_DUPLICATE, ERROR) with the reason.  Only files that passed are read, in batches of a bounded
number of paths.  If a batch fails, its files are read without writing, in halves, until the unreadable
ones are alone; those become ERROR and the others are written.  A failure that no file explains (of
the table, of the cluster) is raised: it is no fault of the deliveries.

A delivery is known by its path below the landing folder, so files of one name in two folders live side
by side, in one batch or in many.  Each batch is one commit, with a record of the partitions that every
file filled: a file that comes again replaces exactly those.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.casting import all_string_schema
from ..functions.text import anchored, file_date
from ..operators.columns import fill_empty, stamp_partition
from ..quality.files import (columns_result, content_lines, csv_lines, csv_profile, flag_unchanged, format_result,
                             member_profile, numbered_lines)
from ..quality.engine import ControlRun, run_controls, save_results
from ..sinks.tables import WriteResult, stage, sync_partitions, write_raw
from ..session import checkpoint_root, delete_path, hadoop_fs
from ..sources.files import (archive_contents, archive_directory, list_files, literal_path, member_contents, nested_json_items,
                             reads_by_range, source_path, source_path_of)
from ..specs import LandingSpec, TableSpec

#: Files of one read: what the driver holds of the paths at a time.
FILES_PER_BATCH = 5000
#: If no file of a batch is larger, opening and writing files is the work: a write task has so many of them.
SMALL_FILE, FILES_PER_TASK = 1 << 20, 50


@dataclass
class LandingResult:
    status: DataFrame
    written: WriteResult | None
    table: TableSpec | None = None          # the raw table as written (declared schema included)
    controls: ControlRun | None = None      # results of the landing rules, if there were any


def delivery_of(path: Column, root: str) -> Column:
    """A file's path below the landing folder ``root``, which names the delivery."""
    return F.substring_index(path, root.rstrip("/") + "/", -1)


def _root(spark: SparkSession, folder: str) -> str:
    fs, at = hadoop_fs(spark, folder)
    return fs.makeQualified(at).toUri().getPath()


def _file_status(spark: SparkSession, folder: str | list[str], spec: LandingSpec, columns: list[str] | None,
                 processed: DataFrame | None, date_from: str, checks: tuple[str, ...], contents: DataFrame | None) -> DataFrame:
    files = list_files(spark, folder)
    name_ok = F.col("file_name").rlike(anchored(spec.filename_pattern))
    source = F.col("path") if date_from == "path" else F.col("file_name")
    files = files.withColumn("name_ok", name_ok).withColumn("file_date", file_date(source, spec.date_regex))
    errors = [] if spec.date_column else [F.when(F.col("file_date").isNull(), F.lit("no date in file name"))]
    if spec.zipped:
        per_archive = []
        names = contents.where(F.col("n") < 0)
        ok = F.col("member").rlike(anchored(spec.member_pattern)) if spec.member_pattern else F.lit(True)
        check_names = bool(spec.member_pattern) and "member_names" in checks
        per_archive.append(names.groupBy(F.col("archive").alias("path")).agg(
            F.max("error").alias("archive_error"),
            F.bool_and(F.col("member").isNull() | ok | F.lit(not check_names)).alias("members_ok"),
            F.array_sort(F.collect_list(F.when(F.col("member").isNotNull() & ~ok, F.col("member")))).alias("bad_members")))
        errors.append(F.when(F.col("archive_error").isNotNull(), F.concat(F.lit("unreadable archive: "), F.col("archive_error"))))
        errors.append(F.when(~F.coalesce(F.col("members_ok"), F.lit(True)), F.concat(
            F.lit("invalid member names: "), F.array_join("bad_members", ", "))))
        if spec.file_format == "csv" and ({"csv_format", "csv_columns"} & set(checks)):
            # D18/D19 on every member, one aggregation over the members' lines
            prof = member_profile(contents.where(F.col("n") >= 0), spec.csv)
            if "csv_format" in checks and (spec.csv.header or columns):
                fmt = format_result(prof, spec.csv, len(columns) if columns else None)
                per_archive.append(fmt.groupBy("path").agg(F.bool_and("result").alias("format_ok")))
                errors.append(F.when(~F.coalesce(F.col("format_ok"), F.lit(False)), F.lit("invalid CSV format in a member")))
            if "csv_columns" in checks and columns and spec.csv.header:
                cols = columns_result(prof, columns, spec.csv)
                per_archive.append(cols.groupBy("path").agg(F.bool_and("result").alias("columns_ok")))
                errors.append(F.when(~F.coalesce(F.col("columns_ok"), F.lit(False)), F.lit("invalid member columns")))
        for frame in per_archive:
            files = files.join(frame, "path", "left")
    elif spec.file_format == "csv" and checks:
        # one pass over the lines serves both CSV checks
        profile = csv_profile(spark, folder, spec.csv, glob=None)
        if "csv_format" in checks and (spec.csv.header or columns):
            fmt = format_result(profile, spec.csv, len(columns) if columns else None).select(
                "path", F.col("result").alias("format_ok"))
            files = files.join(fmt, "path", "left")
            errors.append(F.when(~F.coalesce(F.col("format_ok"), F.lit(False)), F.lit("invalid CSV format")))
        if "csv_columns" in checks and columns and spec.csv.header:
            cols = columns_result(profile, columns, spec.csv).select(
                "path", F.col("result").alias("columns_ok"), "extra_columns", "missing_columns")
            files = files.join(cols, "path", "left")
            errors.append(F.when(~F.coalesce(F.col("columns_ok"), F.lit(False)), F.format_string(
                "invalid columns (extra: %s, missing: %s)", F.array_join("extra_columns", ", "),
                F.array_join("missing_columns", ", "))))
    files = files.withColumn("error", F.concat_ws("; ", *errors))
    if processed is not None and spec.compare_with_previous_file:
        at = [literal_path(p) for p in folder] if isinstance(folder, list) else literal_path(folder)
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at).select("path", "content")
        incoming = content.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
        flags = flag_unchanged(incoming, processed).select("path", "is_duplicate", "content_md5")
        files = files.join(flags, "path", "left")
    else:
        files = files.withColumn("is_duplicate", F.lit(False)).withColumn("content_md5", F.lit(None).cast("string"))
    return _with_status(files)


def _with_status(files: DataFrame) -> DataFrame:
    dup = F.coalesce(F.col("is_duplicate"), F.lit(False))
    return files.withColumn("status", F.when(~F.col("name_ok"), "SKIP_PATTERN").when(F.col("error") != "", "ERROR")
                            .when(dup, "SKIP_DUPLICATE").otherwise("PROCESSED"))


def _archive_contents(spark: SparkSession, folder: str | list[str], spec: LandingSpec) -> tuple[DataFrame, str]:
    """The members of all archives whose name passes the file pattern, read once (a task for each member),
    and staged: the checks and the parsing read them from there.  Other files are not opened."""
    named = F.col("file_name").rlike(anchored(spec.filename_pattern))
    files = list_files(spark, folder).where(named)
    if reads_by_range(folder[0] if isinstance(folder, list) else _qualified(spark, folder)):
        rows = member_contents(archive_directory(files, spec.zipped), spec.zipped, spec.csv.encoding, spec.csv.comment)
    else:   # a store that only Spark can read
        rows = archive_contents(list_files(spark, folder, with_content=True).where(named), spec.zipped, spec.csv.encoding, spec.csv.comment)
    return stage(spark, rows, "archive_contents")


def _qualified(spark: SparkSession, folder: str) -> str:
    fs, at = hadoop_fs(spark, folder)
    return str(fs.makeQualified(at).toString())


def _line_options(spec: LandingSpec) -> dict:
    """CSV options for parsing single lines with ``from_csv``."""
    return {k: v for k, v in spec.csv.read_options().items() if k not in ("header", "multiLine", "encoding")}


def _parse_lines(lines: DataFrame, spec: LandingSpec, columns: list[str]) -> DataFrame:
    ddl = ", ".join(f"`{c}` string" for c in columns)
    parsed = lines.select("path", F.from_csv("line", ddl, _line_options(spec)).alias("r"))
    return parsed.select("r.*", "path")


def _parse(spark: SparkSession, paths: list[str], spec: LandingSpec, columns: list[str] | None, contents: DataFrame | None) -> DataFrame:
    """Rows of the given files with the file's path; all values strings (Parquet: its types).  Header
    positions count content lines only (blank and comment lines are skipped), as a CSV header
    position does."""
    meta = source_path().alias("path")
    files = [literal_path(p) for p in paths]
    hp = spec.csv.header_position
    if spec.zipped:
        archive = F.col("archive")   # the range leaves out most parts of the contents, which lie in the archives' order
        lines = contents.where((F.col("n") >= 0) & archive.between(min(paths), max(paths)) & archive.isin(paths)).withColumnRenamed("archive", "path")
        body = lines.where(F.col("n") > hp) if spec.csv.header else lines
        return _parse_lines(body, spec, columns)
    if spec.file_format == "csv" and spec.csv.header and hp > 0:
        # the lines up to the header are dropped per file (the reader's own header option only
        # skips the first line); line numbers come from one scan
        numbered = numbered_lines(content_lines(csv_lines(spark, paths, None, spec.csv), spec.csv))
        body = numbered.where((F.col("block") > 0) | (F.col("n") > hp + 1))
        return _parse_lines(body.withColumn("path", source_path_of(F.col("path"))), spec, columns)
    if spec.file_format == "csv":
        r = spark.read.options(**spec.csv.read_options())
        if columns:
            r = r.schema(all_string_schema(columns))
        return r.csv(files).select("*", meta)
    if spec.file_format == "xml":
        r = (spark.read.format("xml").option("rowTag", spec.xml.row_tag).option("attributePrefix", "")
             .option("encoding", spec.xml.encoding))
        r = r.schema(all_string_schema(columns)) if columns else r.option("inferSchema", "false")
        return fill_empty(r.load(files).select("*", meta))
    if spec.file_format == "parquet":
        return spark.read.parquet(*files).select("*", meta)
    raise ValueError(f"unknown landing format {spec.file_format!r}")


def json_text(content: Column, encoding: str) -> Column:
    """Text of a JSON file; a byte-order mark decides the encoding and is no part of the document."""
    def marked(mark: str) -> Column:
        return F.substring(content, 1, len(mark) // 2) == F.unhex(F.lit(mark))
    text = (F.when(marked("EFBBBF"), F.decode(content, "UTF-8")).when(marked("FFFE") | marked("FEFF"), F.decode(content, "UTF-16"))
            .otherwise(F.decode(content, encoding)))
    return F.regexp_replace(text, "^\ufeff", "")


def _json_documents(spark: SparkSession, paths: list[str], spec: LandingSpec) -> DataFrame:
    """``(value, path)``: a file is one document of any layout (pretty-printed, a top-level list);
    where its first line is a whole document, every line is one."""
    files = spark.read.format("binaryFile").load([literal_path(p) for p in paths])
    text = files.select(json_text(F.col("content"), spec.json.encoding).alias("_text"), "path")
    whole_line = F.get_json_object(F.regexp_extract("_text", r"^\s*([^\r\n]*)", 1), "$").isNotNull()
    lines = F.filter(F.split("_text", r"[\r\n]+"), lambda x: F.trim(x) != "")
    return text.select(F.explode(F.when(whole_line, lines).otherwise(F.array("_text"))).alias("value"), "path")


def _file_rows(spark: SparkSession, paths: list[str], spec: LandingSpec, raw: TableSpec, columns: list[str] | None, date_from: str, root: str,
               contents: DataFrame | None = None) -> DataFrame:
    """Rows of some files, stamped with their date and delivery: both follow from the path."""
    name, delivery = F.element_at(F.split("path", "/"), -1), delivery_of(F.col("path"), root)
    stamp = file_date(F.col("path") if date_from == "path" else name, spec.date_regex)
    if spec.file_format == "json":
        docs = _json_documents(spark, paths, spec).withColumn("_date", stamp).withColumn("_file", delivery)
        items = nested_json_items(docs, spec.json, spec.partition_field, file_date=F.col("_date"), keep=["_file"])
        m = F.from_json("item", "map<string,string>")
        return items.select(*[m.getItem(c).alias(c) for c in columns], spec.partition_field, F.col("_file").alias(raw.source_field))
    rows = _parse(spark, paths, spec, columns, contents)
    if spec.date_column:   # Q28: the partition comes from a data column (file date as fallback)
        stamp = F.coalesce(F.date_format(F.try_to_date(F.col(spec.date_column)), "yyyy-MM-dd"), stamp)
    rows = stamp_partition(stamp_partition(rows, spec.partition_field, stamp), raw.source_field, delivery)
    return rows.drop("path", "member")


def _unreadable(read, paths: list[str]) -> list[tuple[str, str]]:
    """(path, error) of the files that cannot be read: a failing lot is halved."""
    try:
        read(paths)
        return []
    except Exception as e:
        if len(paths) == 1:
            return [(paths[0], f"{type(e).__name__}: {e}")]
        half = len(paths) // 2
        return _unreadable(read, paths[:half]) + _unreadable(read, paths[half:])


def _write_files(write, read, paths: list[str]) -> tuple[WriteResult | None, list[tuple[str, str]]]:
    """What was written, and (path, error) of files that cannot be read.  Only reading tells that a file is
    at fault: if every file can be read, the error is the sink's and is raised.  The commit notes the files
    it left out, so a batch that is committed already knows them."""
    try:
        done = write(paths, [])
        return done, [tuple(note) for note in done.notes]
    except Exception:
        bad = _unreadable(read, paths)
        if not bad:
            raise
    names = {p for p, _ in bad}
    good = [p for p in paths if p not in names]
    return (write(good, bad) if good else None), bad


def _batches(files, each: int):
    """(path, length) of some files at a time."""
    batch: list[tuple[str, int]] = []
    for row in files.toLocalIterator():
        batch.append((row["path"], row["length"]))
        if len(batch) == each:
            yield batch
            batch = []
    if batch:
        yield batch


def _write_tasks(spark: SparkSession, files: list[tuple[str, int]]) -> int | None:
    """How many tasks write the rows of some small files; None where the rows are the work."""
    if max(size for _, size in files) > SMALL_FILE:
        return None
    return max(len(files) // FILES_PER_TASK, min(len(files), spark.sparkContext.defaultParallelism))


def _gate(spark: SparkSession, status: DataFrame, rules: DataFrame, params: dict | None, registry: dict | None, results) -> tuple[DataFrame, ControlRun]:
    """The landing rules run over the files' status frame (view ``data``: one row per file, the
    outcome of every check as a column; identifiers are paths); results are stored, and only a
    *blocking* rule that fails stops files, namely those it calls invalid (all, if it cannot be computed)."""
    run = run_controls(spark, status, rules, params, registry)
    if results is not None:
        save_results(spark, run, results)
    blocking = [r.asDict() for r in rules.where(F.coalesce("blocking_control_indicator", F.lit(False))).collect()]
    scored = {(r["control_master_id"], r["control_table_id"]): r["control_metric_value"] for r in run.results.collect()}
    failed, broken = [], False
    for r in blocking:
        metric = scored.get((r["control_master_id"], r["control_table_id"]))
        broken |= metric is None
        if metric is not None and metric < (1.0 if r["control_threshold_rag_max"] is None else r["control_threshold_rag_max"]):
            failed.append((r["control_master_id"], r["control_table_id"]))
    if broken:
        return status.withColumn("error", F.concat_ws("; ", F.nullif("error", F.lit("")), F.lit("a blocking rule could not be computed"))), run
    keys = F.struct("control_master_id", "control_table_id")
    hit = run.identifiers.where(keys.isin([F.struct(F.lit(m), F.lit(t)) for m, t in failed])) if failed else run.identifiers.limit(0)
    stopped = hit.groupBy(F.col("identifier").alias("path")).agg(F.array_join(F.array_sort(F.collect_set("control_master_id")), ", ").alias("_rules"))
    said = F.when(F.col("_rules").isNotNull(), F.concat(F.lit("blocked by rules: "), F.col("_rules")))
    return status.join(stopped, "path", "left").withColumn("error", F.concat_ws("; ", F.nullif("error", F.lit("")), said)).drop("_rules"), run


def land(spark: SparkSession, folder: str, spec: LandingSpec, raw: TableSpec, columns: list[str] | None = None,
         processed: DataFrame | None = None, date_from: str = "name",
         checks: tuple[str, ...] = ("csv_format", "csv_columns", "member_names"), rules: DataFrame | None = None,
         params: dict | None = None, registry: dict | None = None, results: TableSpec | None = None,
         files: list[str] | None = None, token: str | None = None, files_per_batch: int = FILES_PER_BATCH,
         catalog_table: str | None = None) -> LandingResult:
    """Land the files of ``folder`` (or only ``files`` of it) in the raw table; returns per-file statuses and counts.

    Rows are filed by date and delivery, as delivered: repeated rows stay, several files of a date live side
    by side, and a file that is delivered again replaces everything it brought before, and nothing else.  The
    failed ``checks`` make a file an ERROR.  With ``rules`` (effective rules of the landing layer), the checks
    are columns of the view ``data`` instead (name_ok, format_ok, columns_ok, error, ...): the rules judge
    them, results go to the ``results`` table, and only blocking rules stop files.  With a ``token`` every
    batch is written once, however often the same landing is run.  ``catalog_table`` names an external table
    over the raw table's folder: after each commit it knows the partitions that are there (K7)."""
    if spec.zipped and spec.file_format != "csv":
        raise ValueError("archive members are landed as CSV; unpack other formats before landing")
    line_based = spec.zipped or (spec.file_format == "csv" and spec.csv.header and spec.csv.header_position > 0)
    if line_based and not columns:
        raise ValueError("columns are needed to parse archive members or CSV files with a header below line 1")
    checkpoint_root(spark)   # DataFrame.checkpoint() needs the shared folder installed
    raw = replace(raw, source_field=raw.source_field or "source_file")   # a copy: the caller's spec is not changed
    if raw.schema is None and columns:
        raw = replace(raw, schema=all_string_schema([*columns, *raw.partition_columns]))
    elif raw.schema is not None and raw.source_field not in raw.schema.fieldNames():
        raw = replace(raw, schema=StructType([*raw.schema.fields, StructField(raw.source_field, StringType())]))
    root = _root(spark, folder)
    given = folder if files is None else files
    contents, contents_path = _archive_contents(spark, given, spec) if spec.zipped and files != [] else (None, None)
    status = _file_status(spark, given, spec, columns, processed, date_from, checks, contents).checkpoint(eager=True)
    control = None
    if rules is not None:
        undated = F.when(F.col("file_date").isNull() & F.lit(spec.date_column is None), F.lit("no date in file name"))
        judged, control = _gate(spark, status.where("name_ok").withColumn("check_error", F.col("error")), rules, params, registry, results)
        # what the checks alone would have stopped is up to the rules; a file without a date has no partition
        own = F.concat_ws("; ", undated, F.when(F.col("error") != F.col("check_error"), F.col("error")))
        judged = judged.select("path", own.alias("_judged"))
        status = status.join(judged, "path", "left").withColumn("error", F.coalesce("_judged", F.lit(""))).drop("_judged")
        status = _with_status(status).checkpoint(eager=True)

    def read(paths: list[str]) -> None:
        _file_rows(spark, paths, spec, raw, columns, date_from, root, contents).write.format("noop").mode("overwrite").save()

    written, unreadable = WriteResult(0, [], None, 0, 0, 0, 0), []   # of all batches
    for i, batch in enumerate(_batches(status.where(F.col("status") == "PROCESSED").select("path", "length").orderBy("path"), files_per_batch)):
        tasks = _write_tasks(spark, batch)

        def write(paths: list[str], left_out: list[tuple[str, str]]) -> WriteResult:
            delivered = [p.rsplit(root.rstrip("/") + "/", 1)[-1] for p in paths]
            return write_raw(spark, _file_rows(spark, paths, spec, raw, columns, date_from, root, contents), raw, delivered, token and f"{token}-{i}", left_out, tasks)
        done, bad = _write_files(write, read, [path for path, _ in batch])
        written, unreadable = written if done is None else written + done, unreadable + bad
        if done is not None and catalog_table:
            sync_partitions(spark, catalog_table, done.partitions, done.gone)
    if unreadable:
        found = spark.createDataFrame(unreadable, "path string, _unread string")
        status = status.join(found, "path", "left")
        status = status.withColumn("error", F.concat_ws("; ", F.nullif("error", F.lit("")), "_unread")).withColumn(
            "status", F.when(F.col("_unread").isNotNull(), "ERROR").otherwise(F.col("status")))
    if contents_path:
        delete_path(spark, contents_path)
    status = status.withColumn("delivery", delivery_of(F.col("path"), root))
    return LandingResult(status.select("path", "file_name", "file_date", "status", "error", "content_md5", "delivery"), written, raw, control)
