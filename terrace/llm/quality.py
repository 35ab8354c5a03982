"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight vector over hashed words and word shapes is shared by all grades; ordered thresholds cut
its sum into grades: P(grade <= j) = sigmoid(threshold_j - weights . text).  The expected grade ranks
documents, the tail probability P(grade >= g) selects them.

The model is fitted to a bounded sample of rated documents (``RATED``); every document is scored.

Defined results: null and empty texts have only the features of an empty text; texts of any length
are read whole; ratings that are null, or whose document is missing, are ignored; of several ratings of
an id the least counts; with fewer than two grades every document has that grade (0 if none).
Other columns are left alone.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import lean, release, staged

#: Most rated documents that the fit reads, and hashed features.
RATED, FEATURES = 8000, 1 << 16
REMEMBERED = 200_000
SHAPE = bytes(48 if 48 <= b < 58 else 65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else b for b in range(256))


def shape_of(word: bytes) -> bytes:
    """Letters as a or A, digits as 0, other signs as they are, runs as one."""
    raw = word.translate(SHAPE)
    return bytes(b for i, b in enumerate(raw) if not i or raw[i - 1] != b)


def _slots(word: bytes) -> tuple[int, int]:
    return zlib.crc32(word.lower()) % FEATURES, zlib.crc32(b"shape " + shape_of(word)) % FEATURES


def _text_slots(words: int, distinct: int) -> list[int]:
    """Features of the whole text: length class and share of distinct words."""
    size = int(math.log2(words + 1))
    return [zlib.crc32(b"length %d" % size) % FEATURES, zlib.crc32(b"distinct %d" % int(10 * distinct / max(1, words))) % FEATURES]


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values: shares of the words, and the whole-text features."""
    own = Counter((text or b"").split())
    n = sum(own.values())
    sums: dict[int, float] = {}
    for word, count in own.items():
        for slot in _slots(word):
            sums[slot] = sums.get(slot, 0.0) + count / n
    for slot in _text_slots(n, len(own)):
        sums[slot] = sums.get(slot, 0.0) + 0.25
    return np.array(list(sums), np.int32), np.array(list(sums.values()), np.float32)


@dataclass
class Grades:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than the grades
    grades: list[int]

    def probabilities(self, s: float) -> list[float]:
        """P(grade >= g) for each grade after the first."""
        return [1 / (1 + math.exp(max(-500.0, min(500.0, t - s)))) for t in self.thresholds]


def fit_grades(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 30, ridge: float = 1e-4, seed: int = 1) -> Grades:
    """Cumulative-link regression (logistic) of grades on features, by Adam over shuffled batches."""
    grades = sorted({g for g, _, _ in rows})
    k, n = len(grades), len(rows)
    w = np.zeros(FEATURES)
    if k < 2:
        return Grades(w, np.zeros(0), grades or [0])
    y = np.array([grades.index(g) for g, _, _ in rows])
    share = np.cumsum(np.bincount(y, minlength=k))[:-1] / n
    # ordered thresholds: the first, and logarithms of the steps to the next
    free = np.log(share / (1 - share))
    free[1:] = np.log(np.maximum(np.diff(free), 1e-2)) if k > 2 else free[1:]
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(free), np.zeros_like(free)]
    rng, t = np.random.default_rng(seed), 0

    def thresholds() -> np.ndarray:
        return np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            own = order[at:at + 128]
            slots = np.concatenate([rows[i][1] for i in own])
            values = np.concatenate([rows[i][2] for i in own]).astype(float)
            who = np.repeat(np.arange(len(own)), [len(rows[i][1]) for i in own])
            s = np.bincount(who, weights=w[slots] * values, minlength=len(own))
            cut = np.concatenate([[-np.inf], thresholds(), [np.inf]])
            hi, lo = 1 / (1 + np.exp(np.clip(s - cut[y[own] + 1], -500, 500))), 1 / (1 + np.exp(np.clip(s - cut[y[own]], -500, 500)))
            p = np.maximum(hi - lo, 1e-9)
            d_hi, d_lo = hi * (1 - hi) / p / len(own), lo * (1 - lo) / p / len(own)
            grad_w = np.bincount(slots, weights=(d_hi - d_lo)[who] * values, minlength=FEATURES) + ridge * w
            grad_cut = -np.bincount(y[own], weights=d_hi, minlength=k)[:k - 1] + np.bincount(y[own], weights=d_lo, minlength=k)[1:]
            grad_free = np.concatenate([[grad_cut.sum()], np.exp(free[1:]) * np.cumsum(grad_cut[::-1])[::-1][1:]])
            t += 1
            for value, grad, m, v in ((w, grad_w, state[0], state[1]), (free, grad_free, state[2], state[3])):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Grades(w, thresholds(), grades)


def fit(docs: DataFrame, ratings: DataFrame, rated: int = RATED, text: str = "text", doc_id: str = "doc_id") -> Grades:
    """Fits grades to at most ``rated`` rated documents (``ratings``: doc_id, grade), the first by a hash of their id."""
    own = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = F.broadcast(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rated))
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(chosen, "doc_id").select(F.col("doc_id").cast("long"), "grade", "text")
    schema = StructType([StructField("doc_id", LongType()), StructField("grade", IntegerType()), StructField("slots", BinaryType()), StructField("shares", BinaryType())])

    def run(batches):
        for b in batches:
            found = [features(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())],
                                             names=schema.names)
    sample, path = staged(src.mapInArrow(run, schema), "rated")
    rows = [(r["grade"], np.frombuffer(r["slots"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in sample.orderBy("doc_id", "slots").collect()]
    release(docs.sparkSession, path)
    return fit_grades(rows)


def grade(docs: DataFrame, model: Grades, at_least: int | None = None, limit: float = 0.5, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with ``expected_grade``, ``tail_prob`` (of ``at_least``, by
    default the second lowest grade) and ``keep`` (tail_prob >= limit)."""
    keep = keep or ["doc_id"]
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"))
    schema = StructType([f for f in src.schema.fields if f.name != "_text"] + [StructField("expected_grade", DoubleType()), StructField("tail_prob", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights
    goal = at_least if at_least is not None else (model.grades[1] if len(model.grades) > 1 else model.grades[0])

    def run(batches):
        own = shared.value
        known: dict[bytes, float] = {}
        for b in batches:
            at = b.schema.get_field_index("_text")
            expected, tail = [], []
            for raw in b.column(at):
                words = (raw.as_py() or b"").split()
                distinct = set(words)
                if len(known) + len(distinct) > REMEMBERED:
                    known.clear()
                for word in distinct:
                    if word not in known:
                        a, c = _slots(word)
                        known[word] = float(own.weights[a] + own.weights[c])
                s = sum([known[w] for w in words]) / max(1, len(words)) + 0.25 * float(own.weights[_text_slots(len(words), len(distinct))].sum())
                p = own.probabilities(s)
                expected.append(own.grades[0] + sum(q * (hi - lo) for q, lo, hi in zip(p, own.grades, own.grades[1:])))
                first = next((i for i, g in enumerate(own.grades) if g >= goal), None)
                tail.append(0.0 if first is None else 1.0 if first == 0 else p[first - 1])
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in rest] + [pa.array(expected, pa.float64()), pa.array(tail, pa.float64())],
                                             names=[b.schema.names[i] for i in rest] + ["expected_grade", "tail_prob"])
    return src.mapInArrow(lean(run), schema).toDF(*keep, "expected_grade", "tail_prob").withColumn("keep", F.col("tail_prob") >= limit)
