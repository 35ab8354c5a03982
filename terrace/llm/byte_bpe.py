"""Byte-level BPE over a whole corpus: merges are replayed once for every distinct piece of it.

Texts are split into pieces once; a task writes each document as numbers of its unit's pieces and
sends the distinct pieces to shards (see ``unit_words``).  A shard holds its pieces end to end, with
an inverted index from each merge's rank to the positions of the token pairs that it joins.  Ranks
are replayed in order; a merge looks only at its own positions and brings the index up to date for
the two neighbours of each.  The tokens go back to the units that asked, and documents are put
together from them.

Within a piece the lowest rank goes first, leftmost where it comes twice.  A merge can bring up a
pair of a lower or equal rank: the piece's other positions of this rank then wait until that is done.

Defined results: a null text counts as empty and has no tokens; texts and pieces of any length are
encoded whole; repeated rows give repeated results; an empty table gives no rows; what looks like a
special token is ordinary text; kept columns may have any name (``common.result_names``).
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..session import scratch_path
from .common import bounded_batches, lean, release, result_names, staged, text_bytes
from .shared_arrays import map_array
from .unit_words import DEALT, UNIT_BYTES, Numbers, at_shards, deal, next_units, shard_count, to_units

# The pattern of pieces, and the letters, numbers and white space below U+0250.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
#: The same pattern for texts of characters below U+0250 and common punctuation and signs only.
NEAR = re.compile(f" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
FAR = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")


@functools.lru_cache(maxsize=65_536)
def _stand_in(c: str) -> str:
    """A character of the same class as ``c`` in tiktoken's Unicode tables: they are younger than
    Python's, so that characters unknown here are tried out there."""
    for prefix, like in (("a", "x"), ("1", "0")):
        raw = (prefix + c).encode()
        ranks = {bytes([b]): b for b in range(256)} | {raw[:n]: 254 + n for n in range(2, len(raw) + 1)}
        if len(tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(prefix + c)) == 1:
            return like
    return "!"


@functools.lru_cache(maxsize=8)
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def pieces(text: str, pattern: str = PATTERN) -> list[str]:
    """The pattern's matches, which for PATTERN make up the whole text."""
    if pattern != PATTERN:
        return [m.group() for m in _pattern(pattern).finditer(text)]
    if not FAR.search(text):
        return NEAR.findall(text)
    unknown = {c for c in set(text) if unicodedata.category(c) == "Cn"}
    if not unknown:
        return _pattern(PATTERN).findall(text)
    like = text.translate({ord(c): _stand_in(c) for c in unknown})
    return [text[m.start():m.end()] for m in _pattern(PATTERN).finditer(like)]


class Ranks:
    """A file of ranks: a token's bytes in base64 and its rank, which is its id, in each line."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = {i: t for t, i in self.of.items()}
        self.most = max(self.of.values()) + 1
        self.single = [self.of[bytes([b])] for b in range(256)]
        #: left id * most + right id -> rank of the token they make
        self.pair = {self.of[t[:i]] * self.most + self.of[t[i:]]: rank
                     for t, rank in self.of.items() for i in range(1, len(t)) if t[:i] in self.of and t[i:] in self.of}

    @property
    def dtype(self):
        return np.uint16 if self.most <= 1 << 16 else np.uint32

    def replay(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word; a word that is a token itself is that token."""
        out = [np.array([self.of[w]]) if w in self.of else None for w in words]
        rest = [i for i, found in enumerate(out) if found is None]
        ids: list[int] = []
        starts: list[int] = []
        for i in rest:
            starts.append(len(ids))
            ids.extend(map(self.single.__getitem__, words[i]))
        bounds = [*starts, len(ids)]
        before = list(range(-1, len(ids) - 1))
        after = list(range(1, len(ids) + 1))
        for at in starts:
            before[at] = -1
            after[at - 1] = -1   # of the word before; the very last one follows
        if ids:
            after[-1] = -1
        pair, most = self.pair, self.most
        where: dict[int, list[int]] = {}   # rank -> positions of the left halves
        for p, q in enumerate(after):
            if q >= 0:
                rank = pair.get(ids[p] * most + ids[q])
                if rank is not None:
                    where.setdefault(rank, []).append(p)
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            held = -1   # positions below this one wait
            for p in sorted(where.pop(rank)):
                if p < held:
                    self._add(where, active, rank, p)
                    continue
                q = after[p]
                if q < 0 or ids[p] < 0 or pair.get(ids[p] * most + ids[q]) != rank:
                    continue   # another merge took one of the two
                ids[p], ids[q] = rank, -1
                after[p] = r = after[q]
                if r >= 0:
                    before[r] = p
                for left, right in ((before[p], p), (p, r)):
                    if left >= 0 and right >= 0:
                        found = pair.get(ids[left] * most + ids[right])
                        if found is not None:
                            self._add(where, active, found, left)
                            if found <= rank:
                                held = bounds[bisect_right(bounds, p)]
        for i, at in zip(rest, starts):
            own = []
            while at >= 0:
                own.append(ids[at])
                at = after[at]
            out[i] = np.array(own, np.int64)
        return out

    @staticmethod
    def _add(where: dict[int, list[int]], active: list[int], rank: int, p: int) -> None:
        if rank not in where:
            where[rank] = []
            heapq.heappush(active, rank)
        where[rank].append(p)

    def decode(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def _sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


#: Result columns: Arrow type, Spark type, and how each comes from the ids of a document's pieces (arrays,
#: decimal figures joined by blanks) and their decoded bytes.
RESULTS = {
    "ids": (pa.list_(pa.int32()), ArrayType(IntegerType()), lambda ids, decoded: np.array(ids.split(), np.int32)),
    "decoded": (pa.string(), StringType(), lambda ids, decoded: decoded.decode()),
    "ids_sha256": (pa.string(), StringType(), lambda ids, decoded: _sha256(ids.encode())),
    "decoded_sha256": (pa.string(), StringType(), lambda ids, decoded: _sha256(decoded)),
}


def _numbered(kept: int, shards: int, pattern: str):
    """Rows of documents as numbers of their unit's pieces, then the unit's pieces for the shards."""
    def run(batches):
        numbering = next_units()
        unit, numbers, size = next(numbering), Numbers(), 0
        for batch in batches:
            names, texts, found = batch.schema.names, batch.column(kept), []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                size += len(text)
                own = pieces(text, pattern)
                found.append(np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array([unit] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(found, pa.binary())],
                                             names=[*names[:kept], "unit", "shard", "data"])
            if size >= UNIT_BYTES:
                yield from words(batch.schema, unit, numbers)
                unit, numbers, size = next(numbering), Numbers(), 0
        if numbers:
            yield from words(batch.schema, unit, numbers)

    def words(schema, unit, numbers):
        for shard, data in deal([w.encode() for w in numbers], shards):
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(schema)[:kept]], pa.array([unit], pa.int64()), pa.array([shard], pa.int32()), pa.array([data], pa.binary())],
                                             names=[*schema.names[:kept], "unit", "shard", "data"])
    return run


def _joined(kept: int, folder: str, path: str, results: tuple[str, ...]):
    """Documents put together from their pieces' tokens, which come from the unit's arrays."""
    def run(batches):
        own, last, figures, raw, counts = ranks(path), None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns: list[list] = [[] for _ in results]
            n_tokens = []
            for unit, data in zip(batch.column(kept).to_pylist(), batch.column(kept + 1)):
                seq = np.frombuffer(data.as_py(), np.uint32)
                if len(seq) and unit != last:
                    counts, ids = (map_array(folder, f"{unit}-{name}") for name in ("n", "figures"))
                    ends = np.cumsum(counts, dtype=np.int64).tolist()
                    flat = ids.tolist()
                    each = [flat[a:b] for a, b in zip([0, *ends], ends)]
                    figures = [" ".join(map(str, e)) for e in each]
                    raw = [own.decode(e) for e in each]
                    last = unit
                    del flat, each
                n_tokens.append(int(counts[seq].sum()) if len(seq) else 0)
                seq = seq.tolist()
                joined, decoded = " ".join(map(figures.__getitem__, seq)), b"".join(map(raw.__getitem__, seq))
                for column, result in zip(columns, results):
                    column.append(RESULTS[result][2](joined, decoded))
            arrays = [pa.array(n_tokens, pa.int64())] + [pa.array(c, RESULTS[r][0]) for c, r in zip(columns, results)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *arrays], names=[*batch.schema.names[:kept], "n_tokens", *results])
    return run


def encode(docs: DataFrame, path: str, pattern: str = PATTERN, text: str = "text", keep: list[str] | None = None,
           results: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with ``n_tokens`` and the asked-for ``results``: ids (array of
    int), the text decoded from them, and the SHA-256 of either (ids_sha256, decoded_sha256)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keep = keep or ["doc_id"]
    kept = len(keep)
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    own = [StructField(f.name, f.dataType) for f in src.schema.fields[:kept]]
    shards = shard_count(text_bytes(docs, text))
    numbered, path_numbered = staged(src.mapInArrow(lean(_numbered(kept, shards, pattern)), StructType(own + DEALT)), "byte-bpe-pieces", "zstd")
    folder, dtype = scratch_path(spark, "byte-bpe-tokens"), ranks(path).dtype
    to_units(at_shards(numbered, lambda shard, words: ranks(path).replay(words)), folder, dtype)
    release(spark)
    schema = StructType(own + [StructField("n_tokens", LongType())] + [StructField(r, RESULTS[r][1]) for r in results])
    rows = numbered.where(F.col("shard").isNull()).select(*[f.name for f in own], "unit", "data")
    return rows.mapInArrow(lean(_joined(kept, folder, path, results)), schema).toDF(*keep, *result_names(keep, ["n_tokens", *results]))


def decode(rows: DataFrame, path: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that each array of ids stands for (null for null); ids that the file
    does not have are an error."""
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(rows.schema.fields)] + [StructField("raw", BinaryType())])
    at = rows.columns.index(ids)

    def run(batches):
        own = ranks(path)
        for batch in batches:
            raw = [None if e is None else own.decode(e) for e in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "raw"])
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(lean(run), schema).toDF(*rows.columns, *result_names(rows.columns, [result]))
