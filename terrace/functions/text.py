"""Text helpers as Column expressions: regex find (C9), file-name dates (C11), content hash
(C12), ordered literal replaces (C13), header clean-up (P8, P9)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def regex_find(col: Column | str, pattern: str) -> Column:
    """NULL is matched as ''; the pattern may match anywhere (find semantics)."""
    return F.coalesce(_c(col).cast("string"), F.lit("")).rlike(to_java_regex(pattern))


def anchored(pattern: str) -> str:
    """Python ``re.match`` semantics (anchored at the start only) for ``rlike``."""
    return "^(?:" + to_java_regex(pattern) + ")"


def to_java_regex(pattern: str) -> str:
    """Python named groups ``(?P<name>`` and back-references ``(?P=name)`` in Java syntax."""
    pattern = re.sub(r"\(\?P<([A-Za-z][A-Za-z0-9]*)>", r"(?<\1>", pattern)
    return re.sub(r"\(\?P=([A-Za-z][A-Za-z0-9]*)\)", r"\\k<\1>", pattern)


def file_date(name: Column | str, pattern: str) -> Column:
    """C11: 'YYYY-MM-DD' from a file name.  Groups named year/month/day are used in any order,
    otherwise groups 1-3 are year, month, day.  No match gives NULL (callers flag it)."""
    compiled = re.compile(pattern)
    groups = compiled.groupindex
    if groups:
        missing = {"year", "month", "day"} - set(groups)
        if missing:
            raise ValueError(f"date pattern {pattern!r} lacks groups {sorted(missing)}")
        idx = [groups["year"], groups["month"], groups["day"]]
    else:
        if compiled.groups < 3:
            raise ValueError(f"date pattern {pattern!r} needs three groups")
        idx = [1, 2, 3]
    java = to_java_regex(pattern)
    n = _c(name)
    parts = [F.regexp_extract(n, java, i) for i in idx]
    return F.when(n.rlike(java), F.concat_ws("-", *parts))


def content_md5(col: Column | str) -> Column:
    """C12."""
    return F.md5(_c(col))


def replace_pairs(col: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Literal find/replace pairs applied in order."""
    out = _c(col)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def normalise_header(col: Column | str) -> Column:
    """Lower, trim, '/' to space, drop characters outside [A-Za-z0-9 whitespace _],
    whitespace runs to '_'."""
    c = F.replace(F.trim(F.lower(_c(col))), F.lit("/"), F.lit(" "))
    c = F.regexp_replace(c, r"[^A-Za-z0-9\s_]", "")
    return F.regexp_replace(c, r"\s+", "_")


def clean_name(name: str) -> str:
    """Drop non-word characters from a column name."""
    return re.sub(r"\W", "", name)


def fill_template(text: str, params: dict, quote: bool = False) -> str:
    """``{name}`` becomes the value of that name; other braces (a regex quantifier, JSON) stay.  With
    ``quote`` values are made safe inside SQL string literals, where Spark takes a backslash as an escape."""
    def value(found: re.Match) -> str:
        out = str(params[found[1]])
        return out.replace("\\", "\\\\").replace("'", "\\'") if quote else out
    names = "|".join(map(re.escape, sorted(params, key=len, reverse=True)))
    return re.sub(r"\{(%s)\}" % names, value, text) if names else text
