"""Interpolated modified Kneser-Ney language model (bigrams, words, uniform), counted in Spark.

Words and word pairs are counted per work unit, merged by shards of their hashes, and stored as
sorted hash arrays in the cluster's shared folder.  Workers memory-map the arrays, so a worker
reads the pages that its texts ask for, not the model.

A pair's shard follows from its first word and three bits of the second: a word that starts a third of
all pairs is spread over eight shards, and counts of second words meet from one shard in eight.
Work units, shards and files grow with the input in number, not in size.

Defined results: null and empty texts are one end token; texts of any length are read whole; repeated
rows count as often as they come; words never seen share one slot of the uniform base; without any
training text the model is that base.  Other columns are left alone.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import scratch_path
from .common import lean, release, staged, text_bytes, units
from .shared_arrays import map_array, write_array

START, END = b" ", b"\n"  # no word holds white space
#: Tokens that a task counts before it writes; text bytes of a group of eight shards of pairs, and of a shard of words.
FLUSH, PAIR_BYTES, WORD_BYTES = 6_000_000, 192_000_000, 64_000_000
SCORED = 1_500_000
BLOB = StructType([StructField("kind", StringType()), StructField("shard", IntegerType()), StructField("data", BinaryType())])
U64 = np.uint64


class Numbers(dict):
    """Gives every new word the next number."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w) for w in self], U64)


HASH_START, HASH_END = (U64(xxhash.xxh64_intdigest(w)) for w in (START, END))


def pair_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    k = (u * U64(0x9E3779B97F4A7C15) + w) * U64(0xC2B2AE3D27D4EB4F)
    return k ^ (k >> U64(29))


def pair_shard(u: np.ndarray, w: np.ndarray, groups: int) -> np.ndarray:
    return ((u >> U64(20)) % U64(groups)).astype(np.int64) * 8 + (w >> U64(61)).astype(np.int64)


def word_shard(w: np.ndarray, shards: int) -> np.ndarray:
    return ((w >> U64(13)) % U64(shards)).astype(np.int64)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers; the hashes as they are, counts compressed."""
    parts = [c.astype("<u8").tobytes() if i == 0 else zlib.compress(c.astype("<u4").tobytes() if c.dtype != U64 else c.tobytes(), 1) for i, c in enumerate(columns)]
    kinds = bytes(8 if c.dtype == U64 else 4 for c in columns)
    head = np.array([len(columns), *map(len, parts)], "<u8").tobytes()
    return head + kinds + b"".join(parts)


def unpack(raw: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    sizes = np.frombuffer(raw, "<u8", n, 8).astype(int)
    kinds, at, out = raw[8 * (n + 1):8 * (n + 1) + n], 8 * (n + 1) + n, []
    for i, (size, kind) in enumerate(zip(sizes, kinds)):
        part = raw[at:at + size]
        out.append(np.frombuffer(part if i == 0 else zlib.decompress(part), "<u8" if kind == 8 else "<u4"))
        at += size
    return out


def summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return [keys[first], *[np.add.reduceat(v[order].astype(np.int64), first) if len(keys) else np.zeros(0, np.int64) for v in values]]


def _sliced(shard: np.ndarray, shards: int, *columns: np.ndarray):
    """Yields (shard, columns of its rows) for rows sorted by shard."""
    ends = np.searchsorted(shard, np.arange(shards + 1))
    for s in range(shards):
        if ends[s] < ends[s + 1]:
            yield s, [c[ends[s]:ends[s + 1]] for c in columns]


def _counted(numbers: Numbers, flat: array, groups: int, words: int):
    """Rows of one work unit: word counts and pair counts by shard."""
    own, h = np.frombuffer(flat, np.int32), numbers.hashes()
    c = np.bincount(own, minlength=len(h))
    shard = word_shard(h, words)
    order = np.lexsort((h, shard))
    for s, (hs, cs) in _sliced(shard[order], words, h[order], c[order]):
        yield "w", s, pack(hs, cs)
    code = (own[:-1].astype(np.int64) << 32) | own[1:]
    code, n = np.unique(code[own[:-1] != 1], return_counts=True)  # 1 is the end; nothing follows it
    u, w = h[code >> 32], h[code & 0xFFFFFFFF]
    shard = pair_shard(u, w, groups)
    order = np.lexsort((u, shard))
    for s, (us, ws, ns) in _sliced(shard[order], 8 * groups, u[order], w[order], n[order]):
        first = np.flatnonzero(np.concatenate([[True], us[1:] != us[:-1]]))
        yield "p", s, pack(ws, ns, np.diff(np.append(first, len(us)))) + pack(us[first]) + len(first).to_bytes(8, "little")


def _counter(groups: int, words: int):
    def run(batches):
        def rows(numbers, flat):
            for kind, shard, data in _counted(numbers, flat, groups, words):
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=BLOB.names)

        def fresh():
            numbers = Numbers()
            return numbers, numbers[START], numbers[END], array("i")
        numbers, start, end, flat = fresh()
        for b in batches:
            for raw in b.column(0):
                flat.append(start)
                flat.extend(map(numbers.__getitem__, (raw.as_py() or b"").lower().split()))
                flat.append(end)
                if len(flat) >= FLUSH:
                    yield from rows(numbers, flat)
                    numbers, start, end, flat = fresh()
        if flat:
            yield from rows(numbers, flat)
    return run


def _pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = int.from_bytes(blob[-8:], "little")
    size = 8 * 2 + 1 + 8 * k  # the packed first words
    ws, ns, run = unpack(blob[:-8 - size])
    us, = unpack(blob[-8 - size:-8])
    return np.repeat(us, run), ws, ns


def _few(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in (1, 2, 3, 4)]


def _merge(folder: str, words: int):
    """Merges a shard: word counts to one blob; pairs to a sorted hash array on disk, and to what the
    words need: how many followers with one, two, more counts, and how many words go before."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kind, shard = key[0], int(key[1])
        out: list[tuple[str, int, bytes]] = []
        if kind == "w":
            parts = [unpack(d) for d in rows["data"]]
            out.append(("w", shard, pack(*[x.astype(U64) for x in summed(*map(np.concatenate, zip(*parts)))])))
        else:
            u, w, n = map(np.concatenate, zip(*[_pairs(d) for d in rows["data"]]))
            keys = pair_key(u, w)
            order = np.argsort(keys, kind="stable")
            keys, u, w, n = keys[order], u[order], w[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            c, u, w = np.add.reduceat(n.astype(np.int64), first), u[first], w[first]
            write_array(f"{folder}/pairs", f"keys-{shard}", keys[first])
            write_array(f"{folder}/pairs", f"counts-{shard}", np.minimum(c, 255).astype(np.uint8))
            large = np.flatnonzero(c >= 255)
            write_array(f"{folder}/pairs", f"large-{shard}", np.column_stack([large, c[large]]).astype(np.int64))
            out.append(("s", 0, np.array(_few(c) + [len(c)], "<i8").tobytes()))
            for kind, own in (("u", summed(u, c == 1, c == 2, c >= 3)), ("c", summed(w, np.ones(len(w), int)))):
                to = word_shard(own[0], words)
                order = np.argsort(to, kind="stable")
                for s, cols in _sliced(to[order], words, *[x[order] for x in own]):
                    out.append((kind, s, pack(*cols)))
        return pd.DataFrame(out, columns=BLOB.names)
    return run


def _words(folder: str):
    """Writes a shard of words: sorted hashes with count, followers by count, words before."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, cols = [], []
        for kind, width, at in (("w", 1, 0), ("u", 3, 1), ("c", 1, 4)):
            for d in rows.loc[rows["kind"] == kind, "data"]:
                h, *values = unpack(d)
                block = np.zeros((5, len(h)), np.int64)
                block[at:at + width] = values
                hashes.append(h)
                cols.append(block)
        h, *sums = summed(np.concatenate(hashes), *np.concatenate(cols, axis=1))
        shard = int(key[0])
        write_array(f"{folder}/words", f"hash-{shard}", h)
        write_array(f"{folder}/words", f"values-{shard}", np.column_stack(sums))
        word = h != HASH_START
        stats = [int(sums[0][word].sum()), int(word.sum()), *_few(sums[4]), int((sums[4] > 0).sum())]
        return pd.DataFrame([("t", shard, np.array(stats, "<i8").tobytes())], columns=BLOB.names)
    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams with 1 to 4 counts; each between 0.1
    and its count, half of it where the numbers say nothing."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
    return tuple(min(float(i), max(0.1, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] and n[i] else 0.5 * i for i in (1, 2, 3))


@dataclass
class Model:
    """Where the arrays are, and what all words share."""

    folder: str
    groups: int
    words: int
    tokens: int  # N, with ends
    types: int  # V, with the end
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    spare: float  # mass that words leave to the uniform base

    def word_values(self, h: np.ndarray) -> np.ndarray:
        """Columns of words: count, followers seen once, twice, more often, words before."""
        out = np.zeros((len(h), 5), np.int64)
        order = np.argsort(h)
        shard = word_shard(h[order], self.words)
        for s in np.unique(shard):
            at = order[shard == s]
            keys = _mapped(f"{self.folder}/words", f"hash-{s}")
            if keys is None:
                continue
            place = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            hit = keys[place] == h[at]
            out[at[hit]] = _mapped(f"{self.folder}/words", f"values-{s}")[place[hit]]
        return out

    def pair_counts(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        out, key = np.zeros(len(u), np.int64), pair_key(u, w)
        order = np.argsort(key)
        shard = pair_shard(u[order], w[order], self.groups)
        for s in np.unique(shard):
            at = order[shard == s]
            keys = _mapped(f"{self.folder}/pairs", f"keys-{s}")
            if keys is None:
                continue
            place = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
            hit = keys[place] == key[at]
            c = _mapped(f"{self.folder}/pairs", f"counts-{s}")[place[hit]].astype(np.int64)
            large = _mapped(f"{self.folder}/pairs", f"large-{s}")
            if len(large):
                more = np.flatnonzero(c == 255)
                c[more] = large[np.searchsorted(large[:, 0], place[hit][more]), 1]
            out[at[hit]] = c
        return out

    def probabilities(self, u: np.ndarray, w: np.ndarray, values: np.ndarray) -> np.ndarray:
        """p(w | u) for rows u, w of ``values`` (and hash in column 5)."""
        h = values[:, 5].view(U64)
        d, e = np.array((0.0, *self.pair_discounts)), np.array((0.0, *self.word_discounts))
        before = values[:, 4]
        base = self.spare / (self.types + 1) + (before - e[np.minimum(before, 3)]) / max(1, self.pairs)
        c = self.pair_counts(h[u], h[w])
        total = values[u, 0]
        left = values[u, 1:4] @ d[1:]
        seen = np.maximum(total, 1)
        return np.where(total > 0, (c - d[np.minimum(c, 3)] + left * base[w]) / seen, base[w])


_MISSING: set[tuple[str, str]] = set()


@functools.lru_cache(maxsize=4096)
def _opened(folder: str, name: str) -> np.ndarray:
    return map_array(folder, name)


def _mapped(folder: str, name: str) -> np.ndarray | None:
    """The array, or None if no pair or word fell into its shard."""
    if (folder, name) in _MISSING:
        return None
    try:
        return _opened(folder, name)
    except FileNotFoundError:
        _MISSING.add((folder, name))
        return None


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts all texts and writes the model to the shared folder."""
    spark = docs.sparkSession
    total = text_bytes(docs, text)
    groups, words = units(total, PAIR_BYTES), units(total, WORD_BYTES)
    folder = scratch_path(spark, "language-model")
    raw = docs.select(F.col(text).cast("binary").alias("text"))
    counts = raw.mapInArrow(lean(_counter(groups, words)), BLOB)
    merged, path = staged(counts.groupBy("kind", "shard").applyInPandas(_merge(folder, words), BLOB), "lm-merged")
    release(spark)
    few = [np.frombuffer(r["data"], "<i8") for r in merged.where("kind = 's'").collect()]
    few = np.sum(few, axis=0) if few else np.zeros(5, int)
    done, own = staged(merged.where("kind <> 's'").groupBy("shard").applyInPandas(_words(folder), BLOB), "lm-words")
    stats = [np.frombuffer(r["data"], "<i8") for r in done.collect()]
    stats = np.sum(stats, axis=0) if stats else np.zeros(7, int)
    release(spark, path, own)
    pairs, d, e = int(few[4]), discounts(few[:4].tolist()), discounts(stats[2:6].tolist())
    once, twice = int(stats[2]), int(stats[3])
    spare = (e[0] * once + e[1] * twice + e[2] * (int(stats[6]) - once - twice)) / pairs if pairs else 1.0
    return Model(folder, groups, words, int(stats[0]), int(stats[1]), pairs, d, e, spare)


def _scored(model: Model, texts: list[bytes | None]) -> list[np.ndarray]:
    numbers = Numbers()
    start, end, flat, sizes = numbers[START], numbers[END], array("i"), []
    for raw in texts:
        at = len(flat)
        flat.append(start)
        flat.extend(map(numbers.__getitem__, (raw or b"").lower().split()))
        flat.append(end)
        sizes.append(len(flat) - at)
    own, h = np.frombuffer(flat, np.int32), numbers.hashes()
    values = np.column_stack([model.word_values(h), h.view(np.int64)])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    real = np.ones(len(own), bool)
    real[first] = False
    w = own[real]
    code, back = np.unique((own[np.flatnonzero(real) - 1].astype(np.int64) << 32) | w, return_inverse=True)
    score = np.log10(model.probabilities(code >> 32, code & 0xFFFFFFFF, values))[back]
    known = values[w, 0]
    base = np.log10((known + 1) / (model.tokens + model.types + 1))
    at = first - np.arange(len(first))
    return [np.array(sizes) - 1, np.add.reduceat((known > 0).astype(np.int64), at), np.add.reduceat(base, at), np.add.reduceat(score, at)]


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with n_tokens, n_known, train_tokens, base_score, score (log10
    probability) and perplexity."""
    keep = keep or ["doc_id"]
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"))
    schema = StructType([f for f in src.schema.fields if f.name != "_text"] + [StructField("n_tokens", LongType()), StructField("n_known", LongType()),
                                                                              StructField("base_score", DoubleType()), StructField("score", DoubleType())])

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("_text")
            texts, rest, done = b.column(at), [i for i in range(b.num_columns) if i != at], 0
            part, size = [], 0
            for i in range(b.num_rows):
                part.append(texts[i].as_py())
                size += len(part[-1] or b"") // 6 + 2
                if size >= SCORED or i == b.num_rows - 1:
                    found = _scored(model, part)
                    arrays = [pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([b.column(c).slice(done, len(part)) for c in rest] + arrays,
                                                     names=[b.schema.names[c] for c in rest] + ["n_tokens", "n_known", "base_score", "score"])
                    part, size, done = [], 0, i + 1
    out = src.mapInArrow(lean(run), schema).toDF(*keep, "n_tokens", "n_known", "base_score", "score")
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
