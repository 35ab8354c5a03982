"""File controls D16-D20 as distributed checks over a folder of delivered files.

Every check returns one row per file, ``(path, file_name, identifier, result, ...)``, so the
results feed the rule engine (File-level Python rules) or a landing status table.  CSV checks read
lines, not whole files: the header is the first line(s) of each file's first block (a window
group-limit per file, so only those lines are ranked), and row widths are counted per line.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import anchored, content_md5, normalise_header
from ..operators.sets import latest_copies
from ..sources.files import literal_path, source_path_of
from ..specs import CsvSpec


def check_filenames(files: DataFrame, pattern: str, name_col: str = "file_name") -> DataFrame:
    """Name matches ``pattern`` anchored at its start (``re.match``)."""
    return files.withColumn("identifier", F.col(name_col)).withColumn("result", F.col(name_col).rlike(anchored(pattern)))


@dataclass
class _Grammar:
    """The CSV reader's view of a line as patterns: delimiter, quote, the inside of quotes (as far as it goes),
    and text up to the next delimiter."""
    d: str
    q: str
    inside: str
    bare: str

    @classmethod
    def of(cls, spec: CsvSpec) -> _Grammar:
        d, q = re.escape(spec.delimiter), re.escape(spec.quote or '"')
        escape = re.escape(spec.escape or spec.quote or '"')
        inside = f"(?:[^{q}]|{q}{q})*+" if escape == q else f"(?:[^{q}{escape}]|{escape}.)*+"
        return cls(d, q, inside, f"(?:(?!{d}).)*+")

    @property
    def field(self) -> str:
        """A delimiter and the field after it: a field that begins with a quote goes to its closing quote and on to
        the next delimiter, or, never closed, to the end of the line."""
        return f"(?s){self.d}({self.q}{self.inside}{self.q}{self.bare}|{self.q}.*|{self.bare})"

    @property
    def whole(self) -> str:
        return f"(?:{self.q}{self.inside}{self.q}{self.bare}|(?!{self.q}){self.bare})"


def _field_count(line: Column, spec: CsvSpec) -> Column:
    """Fields in a CSV line (Q22: quoted delimiters do not split)."""
    return F.regexp_count(F.concat(F.lit(spec.delimiter), line), F.lit(_Grammar.of(spec).field))


def _split_header(line: Column, spec: CsvSpec) -> Column:
    g = _Grammar.of(spec)
    parts = F.regexp_extract_all(F.concat(F.lit(spec.delimiter), line), F.lit(g.field), F.lit(1))
    return F.transform(parts, lambda x: F.regexp_replace(x, f"^\\s*{g.q}|{g.q}\\s*$", ""))


#: What a block of lines adds to its file's profile, if it begins outside (0) or inside (1) of quotes: the same at its
#: end, fields added to the record that was open and whether that ended, complete records begun here, the
#: widest of them, fields of the one left open, and the header's text.
_PART = ("path string, block long, start int, finish int, head int, ended boolean, rows long, widest int, left int, header string, head_done boolean")


def _line_steps(lines: DataFrame, spec: CsvSpec) -> DataFrame:
    """Each line as a step of a machine with two states: for a line that begins a record, its fields and whether
    it ends inside of quotes; the same for a line that goes on inside of quotes."""
    g, line = _Grammar.of(spec), F.col("line")
    rest = F.regexp_extract(line, f"(?s)^{g.inside}{g.q}(.*)$", 1)
    closes = line.rlike(f"(?s)^{g.inside}{g.q}")
    blank = line.rlike(r"^[\x00-\x20]*$")
    if spec.comment:
        blank = blank | F.startswith(line, F.lit(spec.comment))
    return lines.select(
        "path", "block", "line", blank.alias("blank"),
        _field_count(line, spec).alias("n0"), line.rlike(f"(?s)^(?:{g.whole}{g.d})*+{g.q}{g.inside}$").alias("open0"),
        F.when(closes, F.regexp_count(rest, F.lit(g.field))).otherwise(0).alias("n1"),
        (~closes | rest.rlike(f"(?s)^{g.bare}{g.d}(?:{g.whole}{g.d})*+{g.q}{g.inside}$")).alias("open1"))


def _walk(start: int, block: int, rows, at: int) -> tuple:
    """One block's part of the profile (_PART without path) for one start; ``at``: the header's place among the
    records of a file, which is told by its first block (-1: none)."""
    inside, head, ended, n, widest, width, seen = start == 1, 0, start == 0, 0, 0, 0, -1
    header: list[str] = []
    done = at < 0
    for line, blank, n0, open0, n1, open1 in rows:
        if inside:
            inside = open1
            if not ended:
                head, ended = head + n1, not inside
                continue
            width += n1
        elif blank:
            continue
        else:
            inside, width, seen = open0, n0, seen + 1
        first = block == 0 and start == 0
        if first and seen == at:
            header.append(line)
        if not inside:
            if first and seen <= at:
                done = done or seen == at
            else:
                n, widest = n + 1, max(widest, width)
            width = 0
    return block, start, int(inside), head, ended, n, widest, width, "\n".join(header) if header else None, done


def _record_profile(spark: SparkSession, path: str | list[str], spec: CsvSpec, glob: str | None) -> DataFrame:
    """The profile of files whose records may span lines, by blocks in parallel.  Whether a block begins inside of
    quotes is known only from all blocks before it, so each says what it holds in either case; the blocks
    of a file (few rows) are then put together in order.  A header must end in the file's first block."""
    at = spec.header_position if spec.header else -1
    steps = _line_steps(csv_lines(spark, path, glob, spec), spec)
    names = [c.split()[0] for c in _PART.split(", ")]

    def run(batches):
        place, rows = None, []

        def parts():
            return pd.DataFrame([(place[0], *_walk(start, place[1], rows, at)) for start in (0, 1)], columns=names)
        for pdf in batches:
            for key, group in pdf.groupby(["path", "block"], sort=False):
                if key != place and rows:
                    yield parts()
                    rows = []
                place = key
                rows.extend(zip(*[group[c] for c in ("line", "blank", "n0", "open0", "n1", "open1")]))
        if rows:
            yield parts()

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        inside, width, n, widest, header, done = 0, 0, 0, 0, None, at < 0
        for block, both in group.sort_values("block").groupby("block"):
            p = both[both["start"] == inside].iloc[0]
            if inside:
                width += p["head"]
                if p["ended"]:
                    n, widest = n + 1, max(widest, width)
            elif block == 0:
                header, done = p["header"], bool(p["head_done"])
            n, widest = n + p["rows"], max(widest, p["widest"])
            if not inside or p["ended"]:
                width = p["left"]
            inside = p["finish"]
        if inside and done:   # the last record's quotes are never closed
            n, widest = n + 1, max(widest, width)
        return pd.DataFrame({"path": [key[0]], "header": [header], "max_width": [int(widest)], "rows": [int(n)]})
    per_block = steps.mapInPandas(run, _PART)
    out = per_block.groupBy("path").applyInPandas(joined, "path string, header string, max_width int, rows long")
    return out.withColumn("path", source_path_of(F.col("path")))


def _literal(path: str | list[str]) -> str | list[str]:
    return [literal_path(p) for p in path] if isinstance(path, list) else literal_path(path)


_UTF8 = {"utf-8", "utf8"}


def csv_lines(spark: SparkSession, path: str | list[str], glob: str | None = "*.csv", spec: CsvSpec | None = None) -> DataFrame:
    """Lines of every CSV file with their file (``path``, URI-encoded as Spark reports it), split
    start (``block``) and read position (``pos``).  UTF-8 files are read by the text source;
    other encodings by the CSV reader as one unquoted column, which decodes them."""
    spec = spec or CsvSpec()
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if spec.encoding.lower() in _UTF8:
        df = r.text(_literal(path)).withColumnRenamed("value", "line")
    else:
        df = (r.option("encoding", spec.encoding).option("sep", "\u0001").option("quote", "\u0000")
              .option("escape", "\u0000").option("header", "false").schema("line string").csv(_literal(path)))
    return df.select("line", F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))


def content_lines(lines: DataFrame, spec: CsvSpec) -> DataFrame:
    """Lines that carry content: blank lines and comment lines are left out.  Header positions
    count these lines only, as a CSV reader's header position does."""
    keep = ~F.col("line").rlike(r"^[\x00-\x20]*$")     # blank: only characters <= U+0020
    if spec.comment:
        keep = keep & ~F.startswith(F.col("line"), F.lit(spec.comment))
    return lines.where(keep)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with their number ``n`` (from 1) within the file, for files whose first lines must be
    told apart (a header below line 1).  One scan: a window per (file, split), so the numbers
    never depend on how two scans pack splits; only block-0 numbers are file line numbers.
    The window shuffles and sorts the lines: the price of a header below line 1."""
    w = Window.partitionBy("path", "block").orderBy("pos")
    return lines.withColumn("n", F.row_number().over(w))


def csv_profile(spark: SparkSession, path: str | list[str], spec: CsvSpec | None = None, glob: str | None = "*.csv") -> DataFrame:
    """One row per CSV file: ``(path, header, max_width, rows)``, where ``max_width`` is the widest
    data row and ``rows`` the data rows; blank and comment lines are ignored.

    With the header on the first content line (the usual case) this is ONE partial aggregation
    over the lines: the header is the line read first in the file's first block (``min_by`` on
    the read position), and the header's own width can be included in the maximum because a
    data row is only invalid when wider than the header.  Without a header every line is data.
    A header further down needs line numbers (:func:`numbered_lines`).  Paths are decoded once
    per file, after the aggregation."""
    spec = spec or CsvSpec()
    if spec.multiline:
        return _record_profile(spark, path, spec, glob)
    lines = content_lines(csv_lines(spark, path, glob, spec), spec)
    width = _field_count(F.col("line"), spec)
    if not spec.header:
        prof = lines.groupBy("path").agg(F.lit(None).cast("string").alias("header"),
                                         F.max(width).alias("max_width"), F.count(F.lit(1)).alias("rows"))
    elif spec.header_position == 0:
        first = F.col("block") == 0
        prof = lines.groupBy("path").agg(
            F.min_by(F.when(first, F.col("line")), F.when(first, F.col("pos"))).alias("header"),
            F.max(width).alias("max_width"), F.count(F.lit(1)).alias("_lines"))
        prof = prof.select("path", "header", "max_width",
                           (F.col("_lines") - F.when(F.col("header").isNotNull(), 1).otherwise(0)).alias("rows"))
    else:
        k = spec.header_position + 1
        numbered = numbered_lines(lines)
        head = (F.col("block") == 0) & (F.col("n") == k)
        body = (F.col("block") > 0) | (F.col("n") > k)
        prof = numbered.groupBy("path").agg(F.max(F.when(head, F.col("line"))).alias("header"),
                                            F.max(F.when(body, width)).alias("max_width"),
                                            F.count_if(body).alias("rows"))
    return prof.withColumn("path", source_path_of(F.col("path")))


def member_profile(lines: DataFrame, spec: CsvSpec | None = None) -> DataFrame:
    """The CSV profile of each archive member, ``(path=archive, member, header, max_width, rows)``,
    from content lines numbered per member (:func:`terrace.sources.files.archive_lines`): one
    partial aggregation, the header being content line ``header_position``."""
    spec = spec or CsvSpec()
    n, hp = F.col("n"), spec.header_position if spec.header else -1
    body = n > hp
    return lines.groupBy("archive", "member").agg(
        F.max(F.when(n == hp, F.col("line"))).alias("header"),
        F.max(F.when(body, _field_count(F.col("line"), spec))).alias("max_width"),
        F.count_if(body).alias("rows")).withColumnRenamed("archive", "path")


def _named(profile: DataFrame) -> list:
    name = F.element_at(F.split("path", "/"), -1)
    return ["path", name.alias("file_name"), name.alias("identifier")]


def format_result(profile: DataFrame, spec: CsvSpec | None = None, n_columns: int | None = None) -> DataFrame:
    """D18 from a profile: valid when no data row is wider than the header (shorter rows are
    allowed: a CSV reader fills them with NULL).  Header-less files are held to ``n_columns``."""
    spec = spec or CsvSpec()
    if spec.header:
        expected = _field_count(F.col("header"), spec)
    elif n_columns is None:
        raise ValueError("a header-less CSV format check needs the number of columns")
    else:
        expected = F.lit(n_columns)
    return profile.select(*_named(profile),
                          (F.coalesce(F.col("max_width"), F.lit(0)) <= expected).alias("result"),
                          expected.alias("expected_columns"), "rows")


def columns_result(profile: DataFrame, expected: list[str], spec: CsvSpec | None = None) -> DataFrame:
    """D19 from a profile: the normalised header equals the expected columns, in order."""
    spec = spec or CsvSpec()
    cols = F.transform(_split_header(F.col("header"), spec), lambda x: normalise_header(x))
    exp = F.array(*[F.lit(c) for c in expected])
    return profile.select(*_named(profile), (cols == exp).alias("result"), cols.alias("columns"),
                          F.array_except(cols, exp).alias("extra_columns"),
                          F.array_except(exp, cols).alias("missing_columns"))


def check_csv_format(spark: SparkSession, path: str, spec: CsvSpec | None = None, glob: str | None = "*.csv",
                     n_columns: int | None = None) -> DataFrame:
    """D18 over a folder (header-less files need ``n_columns``)."""
    return format_result(csv_profile(spark, path, spec, glob), spec, n_columns)


def check_csv_columns(spark: SparkSession, path: str, expected: list[str], spec: CsvSpec | None = None,
                      glob: str | None = "*.csv") -> DataFrame:
    """D19 over a folder; extra and missing names are reported."""
    return columns_result(csv_profile(spark, path, spec, glob), expected, spec)


def flag_unchanged(incoming: DataFrame, processed: DataFrame, name_col: str = "file_name",
                   content_col: str = "content") -> DataFrame:
    """An incoming file whose MD5 equals the MD5 of its latest processed copy (same
    base name, latest ``insert_date/insert_time`` in the path) is a duplicate.  A ``content_md5`` column
    of ``processed`` (as landing statuses carry it) is taken as it is, so the archive is not read
    again; else hashes are computed where the content is.  Only (name, hash) pairs are shuffled."""
    stored = F.col("content_md5") if "content_md5" in processed.columns else content_md5(content_col)
    latest = latest_copies(processed.withColumn("_md5", stored).drop(content_col),
                           name_col=name_col, path_col="path", extra=["_md5"])
    inc = incoming.withColumn("_in_md5", content_md5(content_col)).drop(content_col)
    j = inc.join(latest.select(name_col, F.col("path").alias("last_processed_path"), "_md5"), name_col, "left")
    return j.withColumn("is_duplicate", F.coalesce(F.col("_in_md5") == F.col("_md5"), F.lit(False))).drop("_md5").withColumnRenamed("_in_md5", "content_md5")
