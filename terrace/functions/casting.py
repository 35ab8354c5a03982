"""Casting untyped (string) columns to a target schema without failing on bad values.

C1 try-cast, C2 boolean words, C3 JSON to struct/array, C4 the cast projection, C7 JSON repair.
Everything here returns Column expressions, so the cast stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, MapType, NumericType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from .text import clean_name

# The words read as booleans, compared case-insensitively.
TRUE_WORDS = ["true", "t", "yes", "y", "si", "s", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]

#: Types whose text is try-cast: numbers of any width, dates and timestamps.
TRY_CAST = (NumericType, DateType, TimestampType, TimestampNTZType)


def cast_bool(col: Column | str) -> Column:
    """Words to boolean; anything else is NULL."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    return (F.when(c.isin(*TRUE_WORDS), F.lit(True))
            .when(c.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def cast_expr(col: Column | str, target: DataType | str) -> Column:
    """The typed expression for one column; types may be given as DDL."""
    c = F.col(col) if isinstance(col, str) else col
    kind = DataType.fromDDL(target) if isinstance(target, str) else target
    if isinstance(kind, BooleanType):
        return cast_bool(c)
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.from_json(c, kind.simpleString().lower())   # keys are compared in lower case
    return c.try_cast(kind) if isinstance(kind, TRY_CAST) else c


def cast_to(df: DataFrame, target: StructType | dict, keep_unknown: bool = True) -> DataFrame:
    """C4: cast every column of ``df`` to the target type looked up by lower-cased name.

    Columns the target does not know stay strings (``keep_unknown``) or are dropped.
    One projection, no SQL text.
    """
    if isinstance(target, StructType):
        types = {f.name.lower(): f.dataType for f in target.fields}
    else:
        types = {k.lower(): v for k, v in target.items()}
    cols = []
    for name in df.columns:
        t = types.get(name.lower())
        if t is None:
            if keep_unknown:
                cols.append(F.col(f"`{name}`"))
            continue
        cols.append(cast_expr(F.col(f"`{name}`"), t).alias(name))
    return df.select(*cols)


def all_string_schema(columns: list[str]) -> StructType:
    """Every column a nullable string."""
    return StructType([StructField(c, StringType(), True) for c in columns])


# ---------------------------------------------------------------- C7: JSON text repair
# The four ordered rewrites applied to Python/Java-style map text.
#   1. key=value           -> "key": "value"      pattern ([^{},=\s]+)=([^,}]+)
#   2. 'Key': / "Key":     -> "key":  (the key lower-cased, non-word characters removed)
#   3. 'key':              -> "key":              pattern '([^']+)'(\s*:\s*)
#   4. : 'value'           -> : "value"           pattern (:\s*)'([^']+)'
_KV = r"([^{},=\s]+)=([^,}]+)"
_QUOTED_KEY = r"[\"']([^\"']+)[\"'](?=\s*:)"
_SINGLE_KEY = r"'([^']+)'(\s*:\s*)"
_SINGLE_VALUE = r"(:\s*)'([^']+)'"

# String tokens of JSON text, with the colon that makes one a key.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?'


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _rewritten(col: Column, pattern: str, group: int, rewrite) -> Column:
    """``col`` with each match of ``pattern`` replaced by ``rewrite(group)``: the text is split around the
    matches, which are rewritten and zipped back in."""
    def around(c: Column) -> Column:
        found = F.transform(F.regexp_extract_all(c, F.lit(pattern), group), rewrite)
        return _once(F.split(c, pattern, -1), lambda parts: F.concat(
            F.element_at(parts, 1), F.array_join(F.zip_with(found, F.slice(parts, 2, F.size(parts)), lambda f, p: F.concat(f, F.coalesce(p, F.lit("")))), "")))
    return _once(col, lambda c: F.when(c.rlike(pattern), around(c)).otherwise(c))


def _plain_key(key: Column) -> Column:
    """Lower case without non-word characters (``(?U)``: Unicode-aware, as in Python)."""
    return F.lower(F.regexp_replace(key, r"(?U)\W", ""))


def normalise_keys(col: Column) -> Column:
    """Rewrite 2 as JVM expressions."""
    return _rewritten(col, _QUOTED_KEY, 1, lambda k: F.concat(F.lit('"'), _plain_key(k), F.lit('"')))


def normalise_json_keys(col: Column) -> Column:
    """Rewrite 2 for text that is JSON already: a string is a key exactly if a colon follows it, so
    nothing inside string values is touched."""
    return _rewritten(col, _TOKEN, 0, lambda t: F.when(t.endswith(":"), F.concat(F.lit('"'), _plain_key(t), F.lit('":'))).otherwise(t))


def repair_json(col: Column | str) -> Column:
    """Make dirty map text parseable JSON with the four rewrites, all JVM-side (no Python UDF
    on the row path).  Text that is JSON already only has its keys normalised (Q21); ``key=value``
    (rewrite 1) is looked for only where no quoted key is, so equal signs in quoted values stay."""
    def dirty(c: Column) -> Column:
        step1 = F.when(c.rlike(_QUOTED_KEY), c).otherwise(F.regexp_replace(c, _KV, '"$1": "$2"'))
        step3 = F.regexp_replace(normalise_keys(step1), _SINGLE_KEY, '"$1"$2')
        return F.regexp_replace(step3, _SINGLE_VALUE, '$1"$2"')
    return _once(F.col(col) if isinstance(col, str) else col,
                 lambda c: F.when(F.try_parse_json(c).isNotNull(), normalise_json_keys(c)).otherwise(dirty(c)))


def repair_json_columns(df: DataFrame, target: StructType) -> DataFrame:
    """The text of every column that is to hold a struct somewhere, repaired; all columns under their
    plain names."""
    nested = {f.name.lower() for f in target.fields if _holds_struct(f.dataType)}
    fixed = {c: repair_json(F.col(f"`{c}`")) if c.lower() in nested else F.col(f"`{c}`") for c in df.columns}
    return df.select(*[expr.alias(clean_name(c)) for c, expr in fixed.items()])


def _holds_struct(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_struct(kind.elementType)
    if isinstance(kind, MapType):
        return _holds_struct(kind.keyType) or _holds_struct(kind.valueType)
    return isinstance(kind, StructType)
