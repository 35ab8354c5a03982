"""Table writes on Parquet folders: K3 append, K4 partition overwrite, K1/K2 merge, K5 delete,
K6/K7 raw partitions.

Parquet has no row-level MERGE or DELETE, so both rewrite the files that hold a matching row, and no
others.  Every write stages its files below the table and takes effect as one commit (see ``commit``),
which is refused and worked out again if another writer was faster, and written once for a ``token``.

Every write conforms the rows to the table (declared column order and types, whole-row
DISTINCT), so files of one table never disagree on a column's type.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, MapType, StringType, StructField, StructType, TimestampType

from ..operators.merge import Clause, MergeCounts, check_duplicate_source_keys, key_match, merge_frames, new_rows, plan_merge
from ..session import delete_path, hadoop_fs, observed, path_exists, scratch_path
from ..sources.files import literal_path, source_path_of
from ..specs import TableSpec
from .commit import STAGED, CommitConflict, Commits, new_token

#: How often a write is worked out before it gives up to faster writers.
ATTEMPTS = 4


@dataclass
class WriteResult:
    rows_written: int | None = None
    partitions: list | None = None
    merge: MergeCounts | None = None
    files_added: int | None = None
    files_removed: int | None = None
    bytes_added: int | None = None
    bytes_removed: int | None = None
    notes: list = field(default_factory=list)   # what the writer left in the commit, see ``write_raw``
    gone: list = field(default_factory=list)    # partitions that a delivery filled before and does not fill any more

    def __add__(self, other: WriteResult) -> WriteResult:
        """Figures of two writes of one table together."""
        return WriteResult(self.rows_written + other.rows_written, sorted({*(self.partitions or []), *(other.partitions or [])}), None,
                           *[getattr(self, f) + getattr(other, f) for f in ("files_added", "files_removed", "bytes_added", "bytes_removed", "notes", "gone")])


def _writer(df: DataFrame, spec: TableSpec, mode: str, tasks: int | None = None):
    """Partitioned writes first REBALANCE on the partition columns: rows of one partition value
    meet in few tasks (few, large files instead of tasks x partitions small ones), and AQE
    splits a partition value that holds a large share of the rows and coalesces small ones.  Where
    many partitions hold few rows each, the files are the work, not the rows: ``tasks`` says how many
    tasks share them.  Files of a clustered table are written in the order of its keys."""
    keys = _cluster_keys(spec)
    if spec.partition_columns and tasks:
        df = df.repartition(tasks, *spec.partition_columns)
    elif spec.partition_columns:
        df = df.hint("rebalance", *spec.partition_columns)
    df = df.sortWithinPartitions(*spec.partition_columns, *keys) if keys else df
    w = df.write.mode(mode)
    w = w.option("maxRecordsPerFile", spec.file_rows) if spec.file_rows else w
    return w.partitionBy(*spec.partition_columns) if spec.partition_columns else w


def read_target(spark: SparkSession, spec: TableSpec, with_source: bool = False) -> DataFrame:
    """The table with its declared schema; without one, the file schema with the partition
    columns read as the directory text (no type inference: '007' stays '007').  The column that tells
    the delivered file of raw rows is left out unless asked for ``with_source``."""
    df = _read_table(spark, spec)
    return df.drop(spec.source_field) if spec.source_field and not with_source else df


def _read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    if spec.schema is not None:
        return spark.read.schema(spec.schema).parquet(spec.path)
    df = spark.read.parquet(spec.path)
    if set(spec.partition_columns) & set(df.columns):
        schema = StructType([StructField(f.name, StringType(), True) if f.name in spec.partition_columns else f
                             for f in df.schema.fields])
        df = spark.read.schema(schema).parquet(spec.path)
    return df


def _target_columns(spark: SparkSession, spec: TableSpec, df: DataFrame) -> list[str]:
    if spec.schema is not None:
        return spec.column_names()
    if path_exists(spark, spec.path):
        return _read_table(spark, spec).columns
    return df.columns


def table_rows(spark: SparkSession, df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns in order, cast to the declared types; every row stays."""
    if spec.schema is not None:
        out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    else:
        out = df.select(*[F.col(f"`{c}`") for c in _target_columns(spark, spec, df)])
    pf = spec.partition_field
    if pf and pf in out.columns and out.schema[pf].dataType == StringType():
        # '' and NULL share the default partition directory; keys must agree with what is read back
        out = out.withColumn(pf, F.when(F.col(pf) == "", F.lit(None).cast("string")).otherwise(F.col(pf)))
    return out


def conform_to_table(spark: SparkSession, df: DataFrame, spec: TableSpec) -> DataFrame:
    """P2 for a table: :func:`table_rows` and whole-row DISTINCT.  Where a column's type has no order
    (MAP), rows are compared by its entries in the order of their keys."""
    out = table_rows(spark, df, spec)
    maps = [f.name for f in out.schema.fields if isinstance(f.dataType, MapType)]
    if not maps:
        return out.distinct()
    entries = out.withColumns({f"_entries_{i}": F.array_sort(F.map_entries(F.col(f"`{c}`"))) for i, c in enumerate(maps)})
    keys = [c for c in out.columns if c not in maps] + [f"_entries_{i}" for i in range(len(maps))]
    return entries.dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in out.columns])


def _cluster_keys(spec: TableSpec) -> list[Column]:
    return [F.col(f"`{k}`") for k in spec.primary_keys if k not in spec.partition_columns] if spec.clustered else []


def _clustered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """For an unpartitioned table whose files hold ranges of its keys: rows dealt by key range (the DISTINCT
    that follows needs no further shuffle), so that a later merge finds its keys in few files."""
    keys = _cluster_keys(spec)
    return df.repartitionByRange(*keys) if keys and not spec.partition_columns else df


def _result(facts: dict, **more) -> WriteResult:
    """A write's figures as its commit wrote them down, so that a batch that comes again reports the same."""
    said = {k: json.loads(v) for k, v in facts.items()}
    merge = said.pop("merge", None)
    known = {k: v for k, v in said.items() if k in WriteResult.__dataclass_fields__}
    return WriteResult(**(known | more), merge=MergeCounts(**merge) if merge else None)


def _retried(spark: SparkSession, spec: TableSpec, token: str | None, attempt) -> WriteResult:
    """Runs ``attempt(commits, token, base)``, which ends in a commit; after a conflict the change is worked out anew
    on the table as it is then.  A batch whose ``token`` is committed already is not written again."""
    commits = Commits(spark, spec.path)
    done = commits.facts(token) if token else None
    if done is not None:
        commits.version()
        return _result(done)
    token = token or new_token()
    for n in range(ATTEMPTS):
        try:
            return _result(attempt(commits, token, commits.version()))
        except CommitConflict:
            if n == ATTEMPTS - 1:
                raise
        finally:
            delete_path(spark, f"{spec.path.rstrip('/')}/{STAGED}/{token}")


def _staged_rows(commits: Commits, token: str, rows: DataFrame, spec: TableSpec, tasks: int | None = None) -> tuple[str, Observation]:
    """Rows written aside, partitioned as the table is."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    staged = commits.staging(token)
    _writer(rows.observe(obs, F.count(F.lit(1)).alias("rows")), spec, "overwrite", tasks).parquet(staged)
    return staged, obs


def append(spark: SparkSession, df: DataFrame, spec: TableSpec, token: str | None = None) -> WriteResult:
    """Conformed rows appended; a batch with a ``token`` once, however often it is sent."""
    def attempt(commits, token, base):
        staged, obs = _staged_rows(commits, token, conform_to_table(spark, _clustered(df, spec), spec), spec)
        return commits.commit(token, base, staged, {}, facts={"rows_written": observed(obs, "rows")})
    return _retried(spark, spec, token, attempt)


def overwrite_partitions(spark: SparkSession, df: DataFrame, spec: TableSpec, token: str | None = None) -> WriteResult:
    """K4: only the partitions present in ``df`` are replaced (whole table if unpartitioned)."""
    def attempt(commits, token, base):
        staged, obs = _staged_rows(commits, token, conform_to_table(spark, _clustered(df, spec), spec), spec)
        below = len(f"{STAGED}/{token}/")
        folders = sorted({n[below:].rpartition("/")[0] for n in commits.files(f"{STAGED}/{token}", True)})
        removed = {n: size for f in folders for n, size in commits.files(f).items()}
        return commits.commit(token, base, staged, removed, folders, {"rows_written": observed(obs, "rows")})
    return _retried(spark, spec, token, attempt)


def _partition_values(df: DataFrame, field: str) -> list[tuple]:
    """Distinct partition values with Spark's string form of each (as used in directory names):
    bounded by the table's partition count, not its rows."""
    rows = df.select(F.col(field).alias("v"), F.col(field).cast("string").alias("s")).distinct().collect()
    return [(r.v, r.s) for r in rows]


def _is_default(text) -> bool:
    """NULL and '' both live in Spark's default partition directory."""
    return text is None or text == ""


def _in_partitions(field: str, values: list[tuple]) -> Column:
    """Rows of the given partitions; the default partition (NULL or '') is matched explicitly."""
    present = [v for v, s in values if not _is_default(s)]
    cond = F.col(field).isin(*present) if present else F.lit(False)
    if any(_is_default(s) for _, s in values):
        cond = cond | F.col(field).isNull() | (F.col(field).cast("string") == F.lit(""))
    return cond


def stage(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: the
    lineage is cut (a lost executor re-reads the staged files, not the sources)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def partition_folder(spark: SparkSession, values: dict) -> str:
    """The folder of partition values, named exactly as Spark names it (escaping, NULL)."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(field, text) for field, text in values.items())


def _table_files(spark: SparkSession, df: DataFrame, path: str, *more) -> DataFrame:
    """``df``'s rows with ``_file``, the path within the table of the file that each comes from."""
    root = hadoop_fs(spark, path)[0].makeQualified(hadoop_fs(spark, path)[1]).toUri().getPath()
    name = source_path_of(F.col("_metadata.file_path"))
    below = F.substring_index(name, root.rstrip("/") + "/", -1)
    return df.select(*more, below.alias("_file"))


def _rows_of(spark: SparkSession, spec: TableSpec, files: list[str], like: DataFrame) -> DataFrame:
    """The rows of some files of the table, with the columns and types of ``like``."""
    if not files:
        return like.limit(0)
    schema = StructType([f for f in like.schema.fields])
    paths = [literal_path(f"{spec.path.rstrip('/')}/{f}") for f in files]
    return spark.read.schema(schema).option("basePath", spec.path).parquet(*paths).select(*[F.col(f"`{c}`") for c in like.columns])


def key_ranges(source: DataFrame, key: str, most: int = 32) -> Column | None:
    """A condition on ``key`` that holds for every source row with a key, as a few ranges: a filter that
    the Parquet reader answers from footers, so row groups without a source key are not read.  NULL keys
    are let through.  None for types without ranges, or for a source without keys."""
    kind = source.schema[key].dataType
    c = F.col(f"`{key}`")
    if not isinstance(kind, (IntegralType, DateType, TimestampType, StringType)):
        return None
    ends = source.agg(F.min(c).alias("a"), F.max(c).alias("b")).first()
    if ends.a is None:
        return None
    if isinstance(kind, IntegralType) and ends.b > ends.a:
        step = (ends.b - ends.a) // most + 1
        runs = source.where(c.isNotNull()).groupBy(((c - F.lit(ends.a)) / F.lit(step)).cast("long").alias("run")).agg(F.min(c).alias("a"), F.max(c).alias("b"))
        pairs = [(r.a, r.b) for r in runs.collect()]   # at most ``most`` rows
    else:
        pairs = [(ends.a, ends.b)]
    out = c.isNull()
    for a, b in pairs:
        out = out | c.between(F.lit(a), F.lit(b))
    return out


def _touched_files(spark: SparkSession, spec: TableSpec, scope: Column | None, src: DataFrame, null_safe: bool) -> dict[str, str | None]:
    """The files with a row that a source row matches: only key columns are read, and of those only the
    row groups whose range has a source key.  The list is as long as the table has files, at most."""
    table = read_target(spark, spec, with_source=True)
    table = table.where(scope) if scope is not None else table
    for key in spec.primary_keys:
        if key not in spec.partition_columns:
            near = key_ranges(src, key)
            if near is not None:
                table = table.where(near)
            break
    rows = _table_files(spark, table, spec.path, *[F.col(f"`{k}`") for k in spec.primary_keys]).alias("t")
    keys = src.select(*[F.col(f"`{k}`") for k in spec.primary_keys]).alias("s")
    hit = rows.join(keys, key_match("t", "s", spec.primary_keys, null_safe), "left_semi")
    return [r._file for r in hit.select("_file").distinct().collect()]


def merge_into(spark: SparkSession, spec: TableSpec, source: DataFrame, strategy: str = "upsert",
               update_columns: list[str] | None = None, null_safe: bool = False,
               check_duplicates: bool = True, clauses: list[Clause] | None = None, token: str | None = None) -> WriteResult:
    """Merge ``source`` into the table on ``spec.primary_keys``, by a named strategy or by
    conditional ``clauses``.

    The conformed source is staged once (it is read several times).  Only *files* with a matching row are
    rewritten: they are found by the keys, with partition pruning where the partition column is a key and
    row-group pruning by key ranges.  With clauses for rows that the source lacks, every file is.  The new
    files and the removal of the old ones are one commit; if another writer changed the partitions in
    between, the merge is worked out again on the table as it is then.  ``kept`` counts the unchanged rows
    of the partitions that the source names (of the table, where the partition column is no key).
    """
    if not path_exists(spark, spec.path):
        if clauses is not None:
            if not any(c.action == "insert" for c in clauses):
                return WriteResult(rows_written=0, merge=MergeCounts(0, 0, 0, 0))
            empty = conform_to_table(spark, source, spec).limit(0)
            source = merge_frames(empty, conform_to_table(spark, source, spec), spec.primary_keys, clauses=clauses)
        elif strategy in ("update_only", "delete_matched"):
            return WriteResult(rows_written=0, merge=MergeCounts(0, 0, 0, 0))
        res = append(spark, source, spec, token)
        return replace(res, merge=MergeCounts(res.rows_written, 0, 0, 0))
    src, src_path = stage(spark, conform_to_table(spark, source, spec), "merge_source")
    pf = spec.partition_field
    by_partition = pf and pf in spec.primary_keys and not any(c.when == "not_matched_by_source" for c in clauses or [])

    def attempt(commits, token, base):
        cols = _target_columns(spark, spec, source)
        target = read_target(spark, spec).select(*cols)
        values = _partition_values(src, pf) if by_partition else None
        scope = _in_partitions(pf, values) if by_partition else None
        if by_partition and not values:
            return commits.commit(token, base, None, {}, facts={"rows_written": 0, "partitions": [], "merge": vars(MergeCounts(0, 0, 0, 0))})
        if any(c.when == "not_matched_by_source" for c in clauses or []):
            files = list(commits.files(deep=True))
        else:
            files = _touched_files(spark, spec, scope, src, null_safe)
        old = _rows_of(spark, spec, files, target)
        if check_duplicates:
            check_duplicate_source_keys(old, src, spec.primary_keys, null_safe)
        if strategy == "insert_only" and clauses is None:   # matched rows stay as they are, and so do their files
            frame, counts, files = new_rows(old, src, spec.primary_keys, null_safe), None, []
        else:
            plan = plan_merge(old, src, spec.primary_keys, strategy, update_columns, null_safe, clauses)
            frame, counts = plan.frame, plan.counts
        staged, obs = _staged_rows(commits, token, frame, spec)
        written = observed(obs, "rows")
        done = counts() if counts else MergeCounts(written, 0, 0, 0)
        before = (target.where(scope) if by_partition else target).select().count()   # from footers
        done = replace(done, kept=before - done.updated - done.deleted)
        sizes = {n: commits.files(n.rpartition("/")[0]).get(n, 0) for n in files} if len(files) < 100 else {n: s for n, s in commits.files(deep=True).items() if n in set(files)}
        folders = [partition_folder(spark, {pf: text}) for _, text in values] if by_partition else [""]
        return commits.commit(token, base, staged, sizes, folders,
                              {"rows_written": done.total, "partitions": sorted((s for _, s in values), key=str) if by_partition else None, "merge": vars(done)})
    try:
        return _retried(spark, spec, token, attempt)
    finally:
        delete_path(spark, src_path)


def delete_where(spark: SparkSession, spec: TableSpec, predicate: str, token: str | None = None) -> WriteResult:
    """K5: rows where ``predicate`` is true are removed (NULL keeps the row, as SQL DELETE).
    Only files holding a matching row are rewritten (filter and write); ``kept`` counts the other rows of
    their partitions."""
    if not path_exists(spark, spec.path):
        return WriteResult(rows_written=0)

    def attempt(commits, token, base):
        table = read_target(spark, spec, with_source=True)
        pred, pf = F.coalesce(F.expr(predicate), F.lit(False)), spec.partition_field
        part = [F.col(f"`{pf}`").alias("v"), F.col(f"`{pf}`").cast("string").alias("s")] if pf else [F.lit(None).alias("v"), F.lit("").alias("s")]
        hit = _table_files(spark, table.where(pred), spec.path, *part).groupBy("_file", "v", "s").agg(F.count(F.lit(1)).alias("n")).collect()
        if not hit:
            return commits.commit(token, base, None, {}, facts={"rows_written": 0, "partitions": [] if pf else None, "merge": vars(MergeCounts(0, 0, 0, 0))})
        values = list({r.s: (r.v, r.s) for r in hit}.values())
        files = [r._file for r in hit]
        staged, obs = _staged_rows(commits, token, _rows_of(spark, spec, files, table).where(~pred), spec)
        deleted = sum(r.n for r in hit)
        before = (table.where(_in_partitions(pf, values)) if pf else table).select().count()
        every = commits.files(deep=True) if len(files) > 100 else {n: s for f in {n.rpartition("/")[0] for n in files} for n, s in commits.files(f).items()}
        folders = [partition_folder(spark, {pf: text}) for _, text in values] if pf else [""]
        return commits.commit(token, base, staged, {n: every.get(n, 0) for n in files}, folders,
                              {"rows_written": observed(obs, "rows"), "partitions": sorted((s for _, s in values), key=str) if pf else None,
                               "merge": vars(MergeCounts(0, 0, deleted, before - deleted))})
    return _retried(spark, spec, token, attempt)


def write_raw(spark: SparkSession, df: DataFrame, spec: TableSpec, delivered: list[str] | None = None, token: str | None = None,
              notes: list | None = None, tasks: int | None = None) -> WriteResult:
    """K6/K7: records filed as delivered (repeated records stay) under
    ``<table>/<partition_field>=<value>/``, and below it by delivered file if the table has a
    ``source_field``; partitions are created by the write.

    ``delivered`` names all files of this delivery, those without any row too.  The commit records which
    partitions each of them filled, and takes out every partition that its last delivery filled: a file
    that is delivered again, with other dates or none, replaces exactly what it brought before.  Without
    a source field a re-delivered date replaces its partition.  ``tasks``: see :func:`_writer`."""
    missing = [c for c in spec.partition_columns if c not in df.columns]
    if missing or not spec.partition_columns:
        raise ValueError(f"{missing or spec.partition_field!r}: not a partition column of the rows")
    delivered = sorted(set(delivered or [])) if spec.source_field else []

    def attempt(commits, token, base):
        staged, obs = _staged_rows(commits, token, table_rows(spark, df, spec), spec, tasks)
        below = len(f"{STAGED}/{token}/")
        files = commits.files(f"{STAGED}/{token}", True)
        fresh = {n[below:].rpartition("/")[0] for n in files}
        before, now = set(), []
        if delivered:
            names = spark.createDataFrame([(s,) for s in delivered], "source string")
            for r in commits.deliveries().join(names, "source").collect():   # of these files only
                before |= set(r.partitions)
            utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
            ending = {utils.getPartitionPathString(spec.source_field, s): s for s in delivered}
            filled: dict[str, list[str]] = {s: [] for s in delivered}
            for folder in sorted(fresh):
                filled.setdefault(ending.get(folder.rpartition("/")[2], folder), []).append(folder)
            now = sorted(filled.items())
        removed = {n: size for f in sorted(fresh | before) for n, size in commits.files(f).items()}
        scope = sorted(fresh | before)
        facts = commits.commit(token, base, staged, removed, scope, {"rows_written": observed(obs, "rows"), "partitions": sorted(fresh), "notes": notes or [], "gone": sorted(before - fresh)}, now, files)
        return facts
    return _retried(spark, spec, token, attempt)


def register_partition(spark: SparkSession, table: str, field: str, value: str) -> None:
    """K7 for catalog tables."""
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if field not in parts:
        raise ValueError(f"{field!r} is not a partition column of {table}")
    sync_partitions(spark, table, [partition_folder(spark, {field: value})], [])


def sync_partitions(spark: SparkSession, table: str, filled: list[str], gone: list[str], each: int = 200) -> None:
    """K7: partition folders (as in a commit) that a catalog table is to know, and those it is to forget.  The
    table's files are left alone: it must be external."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def spec(folder: str) -> str:
        pairs = []
        for step in folder.split("/"):
            name, _, value = step.partition("=")
            value = utils.unescapePathName(value)
            text = "NULL" if value == "__HIVE_DEFAULT_PARTITION__" else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            pairs.append(f"`{name}` = {text}")
        return f"PARTITION ({', '.join(pairs)})"
    for word, ending, folders in (("ADD IF NOT EXISTS", " ", filled), ("DROP IF EXISTS", ", ", gone)):
        for at in range(0, len(folders), each):
            spark.sql(f"ALTER TABLE {table} {word} {ending.join(map(spec, folders[at:at + each]))}")
