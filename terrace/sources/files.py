"""File sources: S5 CSV, S6 Parquet, S7 delta/full paths, S8-S10 nested JSON, S11 XML,
S12 archive members, S13 listings.  All readers return distributed DataFrames; no file content
passes through the driver."""

from __future__ import annotations

import codecs
import contextlib
import io
import itertools
import re
import tarfile
import uuid
import zipfile
import zlib
from typing import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.casting import all_string_schema
from ..operators.columns import fill_empty
from ..specs import CsvSpec, JsonSpec, XmlSpec


def literal_path(path: str) -> str:
    """A path as a literal for Spark's readers, which glob-expand paths: [, ], {, }, * and ? are
    escaped, so a folder or file named with them reads as itself."""
    return "".join("\\" + ch if ch in "[]{}*?\\" else ch for ch in path)


def source_path_of(encoded: Column) -> Column:
    """A URI-encoded file path (as ``_metadata.file_path`` reports it: spaces become %20, '+'
    stays literal) in ``binaryFile``'s plain form."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def source_path() -> Column:
    """The path of the file a row was read from, in the same form as ``binaryFile``'s ``path``."""
    return source_path_of(F.col("_metadata.file_path"))


def partition_path(base: str, field: str, value) -> str:
    return f"{base.rstrip('/')}/{field}={value}"


def _reader(spark: SparkSession, options: dict, schema: StructType | None, base_path: str | None):
    r = spark.read.options(**options)
    if base_path:
        r = r.option("basePath", base_path)
    if schema is not None:
        r = r.schema(schema)
    return r


def read_csv(spark: SparkSession, path: str | list[str], spec: CsvSpec | None = None,
             schema: StructType | list[str] | None = None, base_path: str | None = None) -> DataFrame:
    """CSV with the spec's options.  A list of names gives the all-string schema (P12) used
    by the one-by-one casting strategy; no ``inferSchema`` pass."""
    spec = spec or CsvSpec()
    if isinstance(schema, list):
        schema = all_string_schema(schema)
    return _reader(spark, spec.read_options(), schema, base_path).csv(path)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                 base_path: str | None = None) -> DataFrame:
    """S6."""
    r = _reader(spark, {}, schema, base_path)
    return r.parquet(*path) if isinstance(path, list) else r.parquet(path)


def read_raw(spark: SparkSession, base: str, fmt: str = "csv", mode: str = "delta", field: str = "data_date",
             value=None, spec: CsvSpec | None = None, schema=None) -> DataFrame:
    """Delta reads one partition folder with ``basePath`` (the partition column survives);
    full reads the base folder."""
    path = partition_path(base, field, value) if mode == "delta" else base
    base_path = base if mode == "delta" else None
    if fmt == "csv":
        return read_csv(spark, path, spec, schema, base_path)
    return read_parquet(spark, path, schema if isinstance(schema, StructType) else None, base_path)


def _json_path(levels: list[str]) -> str:
    return "$" + "".join(f"['{lvl}']" for lvl in levels)


def nested_json_items(lines: DataFrame, spec: JsonSpec, partition_field: str = "data_date",
                      file_date: Column | str | None = None, drop_missing: bool = False,
                      text_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One JSON document per row -> one row per record ``(item, <partition_field>)``,
    ``item`` the record's JSON text.  The partition value comes from the document, else
    ``file_date``.  A document without the source level, or with another kind of value there (an
    object for an array), raises; ``drop_missing`` drops it."""
    doc = F.col(text_col)
    sub = F.get_json_object(doc, _json_path(spec.levels)) if spec.levels else doc
    if spec.source_level_format == "dictionary":
        items = F.map_values(F.from_json(sub, "map<string,string>"))
    elif spec.source_level_format == "array":
        items = F.from_json(sub, "array<string>")
    else:
        raise ValueError(f"unknown source level format {spec.source_level_format!r}")
    if not drop_missing:
        items = F.coalesce(items, F.raise_error(F.lit(
            f"path {spec.source_level or '$'!r} not found in a JSON document as {spec.source_level_format}")).cast(
                "array<string>"))
    fallback = F.lit(file_date) if isinstance(file_date, str) or file_date is None else file_date
    stamp = F.coalesce(F.get_json_object(doc, f"$['{partition_field}']"), fallback)
    return (lines.select(items.alias("_items"), stamp.alias(partition_field), *(keep or []))
            .where(F.col("_items").isNotNull())
            .select(F.explode("_items").alias("item"), partition_field, *(keep or [])))


def json_record_keys(items: DataFrame, item_col: str = "item") -> list[str]:
    """The union of record keys (bounded by the schema width, not the data)."""
    keys = (items.select(F.explode(F.map_keys(F.from_json(F.col(item_col), "map<string,string>"))).alias("k"))
            .distinct().collect())
    return sorted(r.k for r in keys)


def read_nested_json(spark: SparkSession, path: str | DataFrame, spec: JsonSpec,
                     columns: list[str] | None = None, partition_field: str = "data_date",
                     file_date: Column | str | None = None, dynamic: bool = False,
                     drop_missing: bool = False) -> DataFrame:
    """Records as columns.  One-by-one: every field a string (nested values keep their
    JSON text).  Dynamic: types inferred by one ``schema_of_variant_agg`` pass (decimals read as
    double)."""
    lines = spark.read.text(path) if isinstance(path, str) else path
    items = nested_json_items(lines, spec, partition_field, file_date, drop_missing)
    if dynamic:
        ddl = items.select(F.schema_of_variant_agg(F.parse_json("item")).alias("s")).first().s
        ddl = _decimal_to_double(ddl)
        parsed = items.select(F.from_json("item", ddl).alias("r"), partition_field)
        return parsed.select("r.*", partition_field)
    names = [c for c in (columns or json_record_keys(items)) if c != partition_field]
    m = F.from_json(F.col("item"), "map<string,string>")
    return items.select(m.alias("_m"), partition_field).select(
        *[F.col("_m").getItem(c).alias(c) for c in names], partition_field)


def _decimal_to_double(ddl: str) -> str:
    """A variant schema as a ``from_json`` type: OBJECT -> STRUCT, fractional DECIMAL -> DOUBLE,
    VOID (only NULLs seen) -> STRING."""
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", ddl)
    ddl = re.sub(r"\bVOID\b", "STRING", ddl)
    return re.sub(r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE", ddl, flags=re.IGNORECASE)


def read_xml(spark: SparkSession, path: str, spec: XmlSpec, columns: list[str] | None = None) -> DataFrame:
    """Elements named by the last xpath step are rows; attributes keep their names;
    every value a string; NULL -> ''."""
    r = (spark.read.format("xml").option("rowTag", spec.row_tag).option("attributePrefix", "")
         .option("encoding", spec.encoding))
    r = r.schema(all_string_schema(columns)) if columns else r.option("inferSchema", "false")
    return fill_empty(r.load(path))


# ---------------------------------------------------------------- S12 archives
ARCHIVE_SCHEMA = "archive string, member string, content binary, validate boolean"


def _expand(kind: str, include_archive: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "member", "content", "validate"]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                if include_archive:
                    yield pd.DataFrame([(path, path.rsplit("/", 1)[-1], bytes(content), False)], columns=columns)
                for name, opener in _members(kind, bytes(content)):  # one member at a time
                    with opener() as fh:
                        yield pd.DataFrame([(path, name, fh.read(), True)], columns=columns)
    return run


def _members(kind: str, content: bytes):
    """(name, opener) for the file members of one archive."""
    buf = io.BytesIO(content)
    if kind == "zip":
        z = zipfile.ZipFile(buf)
        return [(i.filename, (lambda i=i: z.open(i))) for i in z.infolist() if not i.is_dir()]
    if kind == "tar":
        t = tarfile.open(fileobj=buf, mode="r:*")
        return [(m.name, (lambda m=m: t.extractfile(m))) for m in t.getmembers() if m.isfile()]
    raise ValueError(f"unknown archive kind {kind!r}")


def _verify(kind: str, content: bytes, encoding: str | None) -> None:
    """Read every member once, in 1 MB blocks: CRC / truncation errors (and, with ``encoding``,
    undecodable text) surface here, so the archive is reported instead of failing a later job."""
    for _, opener in _members(kind, content):
        decoder = codecs.getincrementaldecoder(encoding)() if encoding else None
        with opener() as fh:
            for block in iter(lambda: fh.read(1 << 20), b""):
                if decoder is not None:
                    decoder.decode(block)
        if decoder is not None:
            decoder.decode(b"", final=True)


def archive_member_names(files: DataFrame, kind: str = "zip", encoding: str | None = None) -> DataFrame:
    """``(archive, member, error)`` of every file member (D17 needs names).  Members are read once
    to verify them; an archive that cannot be opened or read gives one row with ``member`` NULL
    and the error."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    data = bytes(content)
                    _verify(kind, data, encoding)
                    rows += [(path, name, None) for name, _ in _members(kind, data)]
                except Exception as e:  # not an archive, truncated upload, bad CRC, bad text
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["archive", "member", "error"])
    return files.select("path", "content").mapInPandas(run, "archive string, member string, error string")


LINE_CHUNK = 10_000
# Characters a CSV reader treats as blank around a line (Java trim: every char <= U+0020).
_BLANK = "".join(chr(i) for i in range(33))
# Errors that mean a damaged archive or member (bad zip/tar structure, CRC, truncation, bad text).
ARCHIVE_DAMAGE = (zipfile.BadZipFile, tarfile.TarError, zlib.error, EOFError, UnicodeDecodeError, OSError, pa.ArrowInvalid)   # the last: a place that the file does not have


def archive_lines(files: DataFrame, kind: str = "zip", encoding: str = "utf-8", chunk: int = LINE_CHUNK,
                  comment: str | None = None, errors: str = "raise") -> DataFrame:
    """``(archive, member, n, line)``: the content lines of every member (blank lines and lines
    starting with ``comment`` are left out; ``n`` counts the content lines from 0, as a CSV
    header position does), read through the archive stream and emitted in batches of at most
    ``chunk`` lines, so a task holds one archive's bytes plus one batch, never a whole decoded
    member.  A damaged archive raises (check archives first with :func:`archive_member_names`);
    with ``errors="skip"`` its reading just stops (for checks of archives that are reported as
    damaged anyway)."""
    def lines_of(path, content):
        rows = []
        for name, opener in _members(kind, content):
            n = 0
            with io.TextIOWrapper(opener(), encoding=encoding, newline=None) as fh:
                for line in fh:
                    line = line.rstrip("\n")
                    if not line.strip(_BLANK) or (comment and line.startswith(comment)):
                        continue
                    rows.append((path, name, n, line))
                    n += 1
                    if len(rows) >= chunk:
                        yield rows
                        rows = []
        if rows:
            yield rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["archive", "member", "n", "line"]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    for rows in lines_of(path, bytes(content)):
                        yield pd.DataFrame(rows, columns=cols)
                except ARCHIVE_DAMAGE:
                    if errors != "skip":
                        raise
    return files.select("path", "content").mapInPandas(run, "archive string, member string, n long, line string")


# ---------------------------------------------------------------- S12 archives by range
#: One row for every member (n = -1) with its error, if it has one, and one for each of its content lines.
CONTENTS = "archive string, member string, n long, line string, error string"
#: Most tasks that read members, and bytes of members for each.
MEMBER_TASKS, TASK_BYTES = 100_000, 32 << 20
#: What opening a member costs, as bytes that could be read in that time, and runs of members for each task.
MEMBER_BYTES, LOTS_PER_TASK = 16 << 10, 4


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path within it."""
    plain = re.sub(r"^file:/+", "/", path)
    if plain.startswith("/"):
        return fs.LocalFileSystem(), plain
    scheme, _, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")


def write_file(path: str, content: bytes) -> None:
    """Writes a whole file from a task: under a name of its own first, then moved, so that a task that is run
    twice leaves no broken file."""
    system, at = _store(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    own = f"{at}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(content)
    system.move(own, at)


def reads_by_range(path: str) -> bool:
    """Whether tasks can open a path of this kind and read any part of it."""
    try:
        _store(path)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def _directory(kind: str, raw) -> list[tuple[str, int, int]]:
    """Names of an archive's file members, their places and sizes.  Places: of a zip the number in its central
    directory; of a tar where the member's header begins (-1: it is compressed as a whole and read through)."""
    if kind == "zip":
        with zipfile.ZipFile(raw) as z:
            return [(m.filename, i, m.file_size) for i, m in enumerate(z.infolist()) if not m.is_dir()]
    if kind != "tar":
        raise ValueError(f"unknown archive kind {kind!r}")
    try:
        with tarfile.open(fileobj=raw, mode="r:") as t:
            return [(m.name, m.offset, m.size) for m in t if m.isfile()]
    except tarfile.ReadError:
        raw.seek(0)
        with tarfile.open(fileobj=raw, mode="r:*") as t:
            return [(m.name, -1, m.size) for m in t if m.isfile()]


class _Opened:
    """An archive opened once for several of its members, one after another."""

    def __init__(self, kind: str, raw):
        self.kind, self.raw, self.whole, self.entries = kind, raw, None, None
        if kind == "zip":
            self.whole = zipfile.ZipFile(raw)
            self.entries = self.whole.infolist()

    @contextlib.contextmanager
    def member(self, name: str, place: int):
        """A member's bytes as a stream.  Of a zip and of a plain tar only its own range is read."""
        if self.kind == "zip":
            with self.whole.open(self.entries[place]) as found:
                yield found
        elif place >= 0:
            self.raw.seek(place)
            with tarfile.open(fileobj=self.raw, mode="r:") as t, t.extractfile(t.next()) as found:
                yield found
        else:
            if self.whole is None:
                self.whole = tarfile.open(fileobj=self.raw, mode="r:*")
            with self.whole.extractfile(name) as found:
                yield found

    def close(self) -> None:
        if self.whole is not None:
            self.whole.close()
        self.raw.close()


def archive_directory(files: DataFrame, kind: str) -> DataFrame:
    """``(archive, member, place, size, start, error)`` from the directories of archives (``path``): of a zip only its end
    is read.  ``start`` is what the members before it in the archive weigh (see ``MEMBER_BYTES``).  An archive without a
    readable directory gives one row with its error."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path in pdf["path"]:
                try:
                    system, at = _store(path)
                    with system.open_input_file(at) as raw:
                        start, own = 0, []
                        for member, place, size in _directory(kind, raw):
                            own.append((path, member, place, size, start, None))
                            start += size + MEMBER_BYTES
                    rows += own
                except ARCHIVE_DAMAGE as e:
                    rows.append((path, None, None, 0, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["archive", "member", "place", "size", "start", "error"]).astype({"place": "Int64"})
    return files.select("path").mapInPandas(run, "archive string, member string, place long, size long, start long, error string")


def _streamed(path: str, members, kind: str, opened, encoding: str, comment: str | None) -> Iterator[tuple]:
    """Rows of CONTENTS of some members of one archive, which is opened once (and again after damage); a member's
    own row comes after its lines, with what went wrong."""
    source = None
    try:
        for member, place in members:
            n, error = 0, None
            try:
                if source is None:
                    source = _Opened(kind, opened())
                with source.member(member, place) as found, io.TextIOWrapper(found, encoding=encoding, newline=None) as text:
                    for line in text:
                        line = line.rstrip("\n")
                        if not line.strip(_BLANK) or (comment and line.startswith(comment)):
                            continue
                        yield path, member, n, line, None
                        n += 1
            except ARCHIVE_DAMAGE as e:
                error = f"{type(e).__name__}: {e}"
                source = None
            yield path, member, -1, None, error
    finally:
        if source is not None:
            source.close()


def _frames(rows: Iterator[tuple], chunk: int) -> Iterator[pd.DataFrame]:
    while part := list(itertools.islice(rows, chunk)):
        yield pd.DataFrame(part, columns=_CONTENT_NAMES)


def member_contents(directory: DataFrame, kind: str, encoding: str = "utf-8", comment: str | None = None, chunk: int = LINE_CHUNK) -> DataFrame:
    """The members of a directory, each read by one task as a stream, in CONTENTS: every byte is read once, and
    a task, which reads one member after another, holds one batch of lines.  Members that lie together in an archive
    and weigh little are one lot, for which the archive is opened once; a large archive is many lots.  Lots are dealt in
    the order of their archives, so that some archives are found in few of the parts.  Content lines are those of
    :func:`archive_lines`.  A damaged member has the rows before the damage and its error."""
    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for path, members in zip(pdf["archive"], pdf["members"]):
                for m in members:
                    if m["member"] is None:
                        yield path, None, -1, None, m["error"]

                def opened(path=path):
                    system, at = _store(path)
                    return system.open_input_file(at)
                yield from _streamed(path, [(m["member"], int(m["place"])) for m in members if m["member"] is not None], kind, opened, encoding, comment)
    # the rows are names, which say nothing of the work: the number of tasks follows from the members' weight
    found = directory.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("size") + MEMBER_BYTES), F.lit(0)).alias("bytes")).first()
    least = 2 * directory.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(found.n, max(least, found.bytes // TASK_BYTES), MEMBER_TASKS))
    each = max(1, found.bytes // (LOTS_PER_TASK * tasks))
    lots = directory.groupBy("archive", F.floor(F.col("start") / each).alias("lot")).agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "member", "error"))).alias("members"))
    return lots.repartitionByRange(tasks, "archive", "lot").mapInPandas(lambda batches: _frames(rows_of(batches), chunk), CONTENTS)


_CONTENT_NAMES = ["archive", "member", "n", "line", "error"]


def archive_contents(files: DataFrame, kind: str, encoding: str = "utf-8", comment: str | None = None) -> DataFrame:
    """CONTENTS of whole archives given as ``(path, content)``, for stores that only Spark can read: one
    archive (of at most 2 GB) is one task's work."""
    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                data = bytes(content)
                try:
                    members = _directory(kind, io.BytesIO(data))
                except ARCHIVE_DAMAGE as e:
                    yield path, None, -1, None, f"{type(e).__name__}: {e}"
                    continue
                yield from _streamed(path, [(member, place) for member, place, _ in members], kind, lambda data=data: io.BytesIO(data), encoding, comment)
    return files.select("path", "content").mapInPandas(lambda batches: _frames(rows_of(batches), LINE_CHUNK), CONTENTS)


def expand_archives(files: DataFrame, kind: str = "zip", include_archive: bool = False) -> DataFrame:
    """One row per archive member ``(archive, member, content, validate)``.  Input rows are
    ``(path, content)`` (``binaryFile``); each task holds one archive at a time."""
    return files.select("path", "content").mapInPandas(_expand(kind, include_archive), ARCHIVE_SCHEMA)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None, with_content: bool = False) -> DataFrame:
    """Recursive listing ``(path, file_name, modificationTime, length[, content])``.  Without
    ``content`` the files are not opened (column pruning)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load([literal_path(p) for p in path] if isinstance(path, list) else literal_path(path))
    cols = ["path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "modificationTime", "length"]
    if with_content:
        cols.append("content")
    return df.select(*cols)
