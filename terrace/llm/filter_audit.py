"""What each quality filter removes, alone and after the others, by a sparse document-term matrix.

The corpus's words are numbered globally: a task counts the words of each of its documents under the
numbers of its own unit, a shard of the dictionary numbers the words that fall to it, and the numbers
go back to the units (see ``unit_words``).  The matrix is kept as CSR shards, one for a unit: kept
columns of its rows, ``indptr``, ``indices`` (global numbers, ascending in a row) and ``counts``.
Row sums are the documents' words, nonzero counts their distinct words; the flags that need the text
itself are attached, and documents are added up by part and set of failed filters.  Every order of
the filters follows from those sums.

Defined results: a null text counts as empty and has no words; words are told apart by their bytes;
every row is a document, rows with equal ids too; a null id is in no relation to other ids, so such a
row is never a later copy and makes none, and has no label; a null part is the empty string; an id counts as good (toxic)
if any of its label rows says so, without label rows it is neither; an empty table has no parts and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..session import scratch_path
from .common import bounded_batches, lean, release, staged, text_bytes
from .shared_arrays import map_array
from .unit_words import DEALT, UNIT_BYTES, Numbers, at_shards, deal, next_units, pack, shard_count, to_units, unpack

FILTERS = "ABCDE"
WORD = StructType([StructField("word", StringType()), StructField("word_id", LongType())])


@dataclass
class Matrix:
    """``shards``: unit, rows (array of the kept columns), indptr, data (indices and counts, packed);
    ``dictionary``: word, word_id."""
    shards: DataFrame
    dictionary: DataFrame
    paths: list[str]


def _rows(texts: pa.Array, numbers: Numbers) -> list[bytes]:
    """For each text the numbers of its words, ascending, and how often each comes.  The words of all texts are told
    apart together, so that ``numbers`` is asked once for each."""
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    split = pc.ascii_split_whitespace(texts.fill_null(b"").view(kind))
    words, text = split.flatten(), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(words), 0)
    words, text = words.filter(full).dictionary_encode(), text.filter(full).to_numpy()
    names = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    ids = np.fromiter(map(numbers.__getitem__, names), np.int64, len(names))
    keys = np.sort(text << 32 | ids[words.indices.to_numpy()])
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts, keys = np.diff(first, append=len(keys)).astype(np.uint32), keys[first]
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1) << 32).tolist()
    ids = (keys & 0xFFFFFFFF).astype(np.uint32)
    return [np.concatenate([ids[a:b], counts[a:b]]).tobytes() for a, b in zip(cuts, cuts[1:])]


def _counted(kept: int, shards: int):
    """Each document's words and how often they come, by the numbers of its unit; then the unit's words."""
    def words(schema, unit, numbers):
        for shard, data in deal(list(numbers), shards):
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(schema)[:kept]], pa.array([unit], pa.int64()), pa.array([shard], pa.int32()), pa.array([data], pa.binary())],
                                             names=[*schema.names[:kept], "unit", "shard", "data"])

    def run(batches):
        numbering = next_units()
        unit, numbers, size = next(numbering), Numbers(), 0
        for batch in batches:
            texts, n = batch.column(kept), batch.num_rows
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            found = _rows(texts, numbers)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array([unit] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(found, pa.binary())],
                                             names=[*batch.schema.names[:kept], "unit", "shard", "data"])
            if size >= UNIT_BYTES:
                yield from words(batch.schema, unit, numbers)
                unit, numbers, size = next(numbering), Numbers(), 0
        if numbers:
            yield from words(batch.schema, unit, numbers)
    return run


def _numbered(shards: int):
    """The words of a dictionary shard get the numbers shard, shard + shards, shard + 2 * shards, ..."""
    def work(shard, words):
        ids = np.arange(len(words), dtype=np.int64) * shards + shard
        return ids.reshape(-1, 1), pa.table({"word": pa.array(words, pa.binary()).cast(pa.string()), "word_id": ids})
    return work


def _shards(kept: int, folder: str):
    """CSR shards: the rows of a unit that come in one batch, under the words' global numbers."""
    def run(batches):
        last, ids = None, None
        for batch in batches:
            units = batch.column(kept).to_numpy()
            for at in np.split(np.arange(len(units)), np.flatnonzero(np.diff(units)) + 1) if len(units) else []:
                own, unit = batch.slice(int(at[0]), len(at)), int(units[at[0]])
                rows = [np.frombuffer(raw.as_py(), np.uint32).reshape(2, -1) for raw in own.column(kept + 1)]
                sizes = np.array([r.shape[1] for r in rows])
                indptr = np.concatenate([[0], np.cumsum(sizes)])
                indices = counts = np.zeros(0, np.int64)
                if indptr[-1]:
                    if unit != last:
                        last, ids = unit, map_array(folder, f"{unit}-figures")
                    indices, counts = ids[np.concatenate([r[0] for r in rows])], np.concatenate([r[1] for r in rows])
                    order = np.argsort(np.repeat(np.arange(len(sizes)), sizes) << 40 | indices)   # by row, then number: no two are equal
                    indices, counts = indices[order], counts[order]
                struct = pa.StructArray.from_arrays(own.columns[:kept], names=own.schema.names[:kept])
                yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), struct),
                                                  pa.array([indptr], pa.list_(pa.int64())), pa.array([pack(indices, counts.astype(np.uint32))], pa.binary())],
                                                 names=["unit", "rows", "indptr", "data"])
    return run


def document_term_matrix(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> Matrix:
    """The matrix of all documents, with their ``keep`` columns (default doc_id); words are the runs of
    other bytes than blank and 0x09 to 0x0D."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keep = keep or ["doc_id"]
    kept = len(keep)
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"))
    own = [StructField(f.name, f.dataType) for f in src.schema.fields[:kept]]
    shards = shard_count(text_bytes(docs, text))
    counted, path_counted = staged(src.mapInArrow(lean(_counted(kept, shards)), StructType(own + DEALT)), "audit-counts", "zstd")
    back, path_back = staged(at_shards(counted, _numbered(shards), WORD), "audit-words", "zstd")
    folder = scratch_path(spark, "audit-ids")
    to_units(back, folder, np.int64)
    release(spark)
    schema = StructType([StructField("unit", LongType()), StructField("rows", ArrayType(StructType(own))), StructField("indptr", ArrayType(LongType())), StructField("data", BinaryType())])
    rows = counted.where(F.col("shard").isNull()).select(*[f.name for f in own], "unit", "data")
    csr, path_csr = staged(rows.mapInArrow(lean(_shards(kept, folder)), schema), "audit-csr", "zstd")
    release(spark, path_counted, folder)
    return Matrix(csr, back.where(F.col("word_id").isNotNull()).select("word", "word_id"), [path_back, path_csr])


def row_figures(matrix: Matrix) -> DataFrame:
    """Kept columns (k0, k1, ...) of every document with n_words (row sum) and n_distinct (nonzero count)."""
    own = matrix.shards.schema["rows"].dataType.elementType.fields
    schema = StructType([*own, StructField("n_words", LongType()), StructField("n_distinct", LongType())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows").slice(i, 1).flatten()
                indptr = batch.column("indptr")[i].values.to_numpy()
                _, counts = unpack(batch.column("data")[i].as_py())
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[indptr]
                yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(np.diff(sums), pa.int64()), pa.array(np.diff(indptr), pa.int64())], names=schema.names)
    return matrix.shards.select("rows", "indptr", "data").mapInArrow(lean(run), schema)


def flagged(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """doc_id, part, digest of the text and the flags A to D of every document."""
    body = F.coalesce(F.col(text), F.lit(""))
    upper = F.octet_length(F.regexp_replace(body, "[^A-Z]+", ""))
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("text"),
                         (100 * upper > 10 * F.length(body)).alias("c"), body.rlike(r"[#$%&*|]").alias("d"), F.sha2(body.cast("binary"), 256).alias("digest"))
    figures = row_figures(document_term_matrix(marked, "text", ["doc_id", "part", "c", "d", "digest"]))
    n, distinct = F.col("n_words"), F.col("n_distinct")
    return figures.select(F.col("k0").alias("doc_id"), F.col("k1").alias("part"), F.col("k4").alias("digest"),
                          (n < 100).alias("a"), (100 * distinct < 80 * n).alias("b"), F.col("k2").alias("c"), F.col("k3").alias("d"))


def failed_sets(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: fails filter i of FILTERS), n, good, toxic: the documents of each set of failed
    filters.  Copies of a text are added up by part and id first, so that no text's rows meet in one task."""
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    mask = sum((F.col(f).cast("int") * (1 << i) for i, f in enumerate("abcd")), F.lit(0))
    rows = rows.select("doc_id", "part", "digest", mask.alias("mask")).join(told, F.col("doc_id") == F.col("l_id"), "left")
    figures = ("n", "good", "toxic")
    by_id = rows.groupBy("digest", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in figures[1:]])
    known = F.col("doc_id").isNotNull()
    by_part = by_id.groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in figures], F.min(F.when(known, F.struct("doc_id", *figures))).alias("first"),
        *[F.sum(F.when(~known, F.col(c)).otherwise(0)).alias(f"free_{c}") for c in figures])
    by_part = by_part.withColumn("first_id", F.col("first.doc_id"))
    least = by_part.where(F.col("first_id").isNotNull()).groupBy(F.col("digest").alias("l_digest")).agg(F.min("first_id").alias("l_id"))
    met = by_part.join(least, (F.col("digest") == F.col("l_digest")) & (F.col("first_id") == F.col("l_id")), "left")
    stay = {c: F.col(f"free_{c}") + F.when(F.col("l_id").isNotNull(), F.col(f"first.{c}")).otherwise(0) for c in figures}
    both = F.array(F.struct(F.col("mask"), *[stay[c].alias(c) for c in figures]),
                   F.struct((F.col("mask") + F.lit(1 << FILTERS.index("E"))).alias("mask"), *[(F.col(c) - stay[c]).alias(c) for c in figures]))
    return met.select("part", F.explode(both).alias("s")).groupBy("part", "s.mask").agg(*[F.sum(F.col(f"s.{c}")).alias(c) for c in figures])


def interactions(sets: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, from the documents of each set of failed filters."""
    steps = [(order, i + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(g) for g in order[:i]))
             for order in map("".join, permutations(FILTERS)) for i, f in enumerate(order)]
    every = F.expr("array(" + ", ".join(f"struct('{o}' AS filter_order, {s} AS step, {own} AS own, {before} AS before)" for o, s, own, before in steps) + ")")
    rows = sets.select("part", "mask", "n", "good", "toxic", F.explode(every).alias("x")).select("*", "x.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    orders = len(steps) // len(FILTERS)
    count = {"kept": (~fails & ~gone, "n"), "removed": (fails & ~gone, "n"), "redundant": (fails & gone, "n"), "unique_fails": (F.col("mask") == F.col("own"), "n"),
             "good_lost": (fails & ~gone, "good"), "toxic_lost": (fails & ~gone, "toxic")}
    share = F.when(fails, F.expr(f"n * ({orders} DIV bit_count(mask))")).otherwise(0)   # its filter comes first among the failed ones
    return rows.groupBy("part", "filter_order", "step").agg(
        *[F.sum(F.when(c, F.col(n)).otherwise(0)).cast("long").alias(name) for name, (c, n) in count.items()], F.sum(share).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every
    part, order of the five filters and step.  ``labels``: doc_id, quality, toxic."""
    sets, _ = staged(failed_sets(flagged(docs, text, doc_id, part), labels), "audit-sets")
    return interactions(sets)
