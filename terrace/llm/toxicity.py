"""Toxicity by the nearest labelled examples: exact cosine of whole texts over a block-max inverted index.

Examples are a bounded sample of labelled documents (``EXAMPLES``, documented below).  Every word of
every text counts: its weight is TF-IDF, with document frequencies over all documents, times its
relevance, (1 + c) / (1 + c + ``EVEN``) where c is the chi-square of its presence in the classes of the
examples.  Relevance is never 0, and words that no example has stand in the norm with that of c = 0;
their document frequencies are in sorted hash arrays in the shared folder (64-bit hashes), which
workers memory-map.

The index keeps, for each word of the examples, its postings by example and the largest weight in
every block of examples that has it; its arrays are in the shared folder too, and workers map them.  Words of over 1 in ``COMMON`` examples are also columns of a matrix: their share
of all cosines is one product for many texts.  To that of a block a query adds the block maxima of its
other words: blocks are visited from the highest bound on, and those whose bound is below the k-th best
score are never scored, so the neighbours are exact.

Votes of the k nearest weigh by closeness; a logistic curve fitted to leave-one-out votes of the
examples, weighted to the class sizes of all training labels, turns votes into probabilities.  A text
that shares no word with any example has no neighbours and takes the rate of such examples.

Defined results: null and empty texts have no words; texts of any length are read whole; labels that
are null, or whose document is missing, are ignored; several labels of an id count as toxic if one
is; equal similarities go to the earlier example; without training labels every score is 0.
Other columns are left alone.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from ..session import scratch_path
from .common import fold, lean, plainly, release, staged, units, words_of
from .lm import _mapped, _opened, pack, summed, unpack, word_shard
from .shared_arrays import map_array, write_array

#: Most examples in the index (half of them toxic, as far as there are).
EXAMPLES = 4000
#: Chi-square (1 degree of freedom) at which a word has about half of the full relevance.
EVEN = 20.0
#: Distinct words that a task counts before it writes, and bytes of text for a shard of words.
FLUSH, WORD_BYTES = 500_000, 64_000_000
BLOCK, COMMON = 64, 20
#: Texts whose common words are multiplied at once.
TOGETHER = 64
#: Bytes of text whose words are counted before they are scored.
SLICE_BYTES = 1 << 20
#: Words whose codes a worker remembers.
REMEMBERED = 150_000
NEIGHBOURS = 15
U64 = np.uint64


def _relevance(chi: np.ndarray) -> np.ndarray:
    return (1 + chi) / (1 + chi + EVEN)


def _idf(df: np.ndarray, documents: int) -> np.ndarray:
    return np.log((1 + documents) / (1 + df)) + 1


def _hashes(words) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], U64)


@dataclass
class Frequencies:
    """In how many of ``documents`` rows each word stands: where the arrays are, and their number."""

    folder: str
    shards: int
    documents: int

    def of(self, words) -> np.ndarray:
        return self.of_hashes(_hashes(words))

    def of_hashes(self, h: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(h), np.int64), word_shard(h, self.shards)
        order = np.lexsort((h, shard))
        ends = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.unique(shard):
            at = order[ends[s]:ends[s + 1]]
            keys = _mapped(self.folder, f"hash-{s}")
            if keys is not None:
                place = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
                out[at] = np.where(keys[place] == h[at], _mapped(self.folder, f"documents-{s}")[place], 0)
        return out


def _spans(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places lo[0], lo[0] + 1, ... of all spans, one span after the other."""
    return np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())


#: Arrays of an index that workers map.
ARRAYS = ("value", "start", "place", "weight", "cell", "block", "first", "top", "column", "label", "ids", "matrix", "hashes", "numbers")


@dataclass
class Index:
    """Block-max inverted index of unit vectors with labels, and the curve from votes to probabilities."""

    terms: dict[bytes, int]
    value: np.ndarray  # IDF and relevance of each term
    start: np.ndarray  # [term] -> first place in the postings, and the place after the last
    place: np.ndarray  # example of each posting, by term and example
    weight: np.ndarray
    cell: np.ndarray  # [term] -> first of its cells, and the one after the last; a cell is a block with postings of a term
    block: np.ndarray  # block of each cell
    first: np.ndarray  # first posting of each cell; one more than there are
    top: np.ndarray  # largest weight of each cell
    column: np.ndarray  # [term] -> row of the matrix of common words, or -1
    label: np.ndarray
    ids: np.ndarray
    k: int = NEIGHBOURS
    curve: tuple[float, float] = (0.0, 0.0)
    without: float = 0.0
    frequencies: Frequencies | None = None
    matrix: np.ndarray | None = None  # weights of the common words by example
    hashes: np.ndarray | None = None  # of the terms, sorted
    numbers: np.ndarray | None = None  # the term of each hash
    codes: dict[bytes, float] = field(default_factory=dict)  # of words met lately, see _learn

    def _known(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """The term of each word, or -1, and 1 + log of its count."""
        if self.hashes is None:
            h = _hashes(self.terms)
            self.numbers = np.argsort(h)
            self.hashes = h[self.numbers]
        return self._terms(_hashes(counts)), 1 + np.log(np.fromiter(counts.values(), float, len(counts)))

    def _terms(self, h: np.ndarray) -> np.ndarray:
        if not len(h) or not len(self.hashes):
            return np.full(len(h), -1)
        place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[place] == h, self.numbers[place], -1)

    def _learn(self, texts: list[dict[bytes, int]]) -> dict[bytes, float]:
        """The code of every word of the texts: its term, or, for a word that is no term, its weight for one
        occurrence as a negative number.  A worker remembers a bounded number of codes."""
        new = {w for counts in texts for w in counts if w not in self.codes}
        if len(self.codes) + len(new) > REMEMBERED:
            self.codes.clear()
            new = {w for counts in texts for w in counts}
        h = _hashes(new)
        t = self._terms(h)
        code, bare = t.astype(float), t < 0
        if self.frequencies is None:
            code[bare] = -1e-200   # no part in the norm
        else:
            code[bare] = -_idf(self.frequencies.of_hashes(h[bare]), self.frequencies.documents) * _relevance(np.zeros(1))
        self.codes.update(zip(new, code.tolist()))
        return self.codes

    def share(self, folder: str) -> Index:
        """Writes the arrays to the shared folder; what is left is small and opens them where it is used."""
        self._known({})
        self._common()
        for name in ARRAYS:
            write_array(folder, name, getattr(self, name))
        return replace(self, terms={}, codes={}, frequencies=self.frequencies, **{name: None for name in ARRAYS})

    def opened(self, folder: str) -> Index:
        """The index with its arrays mapped: workers of a machine share them, and read what their texts ask for."""
        return replace(self, codes={}, **{name: np.asarray(map_array(folder, name)) for name in ARRAYS})

    def _common(self) -> None:
        if self.matrix is None:
            common = np.flatnonzero(self.column >= 0)
            lo = self.start[common, 0]
            size = self.start[common, 1] - lo
            at = _spans(lo, size)
            self.matrix = np.zeros((len(common), -(-len(self.label) // BLOCK) * BLOCK))
            self.matrix[np.repeat(np.arange(len(common)), size), self.place[at]] = self.weight[at]

    def _unit(self, t: np.ndarray, tf: np.ndarray, rest: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(t)
        order = order[np.searchsorted(t[order], 0):]
        t = t[order]
        v = tf[order] * self.value[t]
        return t, v / max(1e-12, math.sqrt(float(v @ v) + rest))

    def vector(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text whose words are all terms; others are left out."""
        return self._unit(*self._known(counts))

    def _shares(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the common words add to the cosines of each text with all examples."""
        self._common()
        query = np.zeros((len(vectors), len(self.matrix)))
        for i, (t, v) in enumerate(vectors):
            c = self.column[t]
            query[i, c[c >= 0]] = v[c >= 0]
        return query @ self.matrix

    def nearest(self, t: np.ndarray, v: np.ndarray, leave: int = -1, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples (without ``leave``) with a cosine above 0, and the cosines to 12 digits."""
        share = (self._shares([(t, v)])[0] if share is None else share).reshape(-1, BLOCK)
        rare = self.column[t] < 0
        t, v = t[rare], v[rare]
        size = self.cell[t, 1] - self.cell[t, 0]
        cells, weight = _spans(self.cell[t, 0], size), np.repeat(v, size)
        block = self.block[cells]
        bound = share.max(axis=1) + np.bincount(block, self.top[cells] * weight, len(share))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        cos, done, step, least = np.zeros(share.size), 0, 8, -1.0
        while done < len(order):
            go = order[done:done + step]
            go = go[bound[go] >= least - 1e-11]
            if not len(go):
                break
            own = np.zeros(len(bound), bool)
            own[go] = True
            cos.reshape(-1, BLOCK)[go] = share[go]
            own = np.flatnonzero(own[block])
            lo = self.first[cells[own]]
            long = self.first[cells[own] + 1] - lo
            at = _spans(lo, long)
            cos += np.bincount(self.place[at], self.weight[at] * np.repeat(weight[own], long), len(cos))
            if leave >= 0:
                cos[leave] = 0
            least = np.partition(cos, len(cos) - self.k)[len(cos) - self.k] if len(cos) >= self.k else -1.0
            done, step = done + step, step * 4
        found = np.flatnonzero(cos >= max(least - 1e-11, 1e-15))
        near = np.round(cos[found], 12)
        best = np.lexsort((found, -near))[:self.k]
        return found[best], near[best]

    def vote(self, near: np.ndarray, cos: np.ndarray) -> float:
        weight = 1 / (1.05 - np.minimum(cos, 1.0))
        return float(weight @ self.label[near] / weight.sum())

    def scores(self, texts: list[dict[bytes, int]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, nearest examples and cosines of each text, given by the counts of its words."""
        if self.hashes is None:
            self._known({})
        codes, known, rests = self._learn(texts), [], []
        for counts in texts:
            code = np.fromiter(map(codes.__getitem__, counts), float, len(counts))
            tf = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
            bare = code < 0
            known.append((code[~bare].astype(np.int64), tf[~bare]))
            rests.append(float(np.sum((tf[bare] * code[bare]) ** 2)))
        out = []
        for at in range(0, len(texts), TOGETHER):
            vectors = [self._unit(*k, rest) for k, rest in zip(known[at:at + TOGETHER], rests[at:at + TOGETHER])]
            for (t, v), share in zip(vectors, self._shares(vectors)):
                near, cos = self.nearest(t, v, share=share) if len(t) else (np.zeros(0, np.int64), np.zeros(0))
                a, b = self.curve
                out.append((1 / (1 + math.exp(-max(-500.0, min(500.0, a * self.vote(near, cos) + b)))) if len(near) else self.without, near, cos))
        return out


def build_index(terms: list[bytes], examples: list[tuple[int, int, dict[bytes, int]]], positives: int, total: int, k: int = NEIGHBOURS,
                frequencies: Frequencies | None = None) -> Index:
    """An index over (id, label, counts of words); ``positives`` of ``total`` training labels are toxic.
    Document frequencies are those of the examples unless ``frequencies`` has them."""
    n = len(examples)
    number = {w: i for i, w in enumerate(terms)}
    label = np.array([e[1] for e in examples], float)
    sizes = np.array([len(e[2]) for e in examples], np.int64)
    at = np.repeat(np.arange(n), sizes)
    t = np.fromiter((number[w] for e in examples for w in e[2]), np.int64, sizes.sum())
    tf = 1 + np.log(np.fromiter((c for e in examples for c in e[2].values()), float, sizes.sum()))
    a, both = (np.bincount(t, x, len(terms)) for x in (label[at], np.ones(len(at))))
    b, n1 = both - a, label.sum()
    n0 = n - n1
    chi = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(1.0, both * (n - both) * n1 * n0)
    df, documents = (both, n) if frequencies is None else (frequencies.of(terms), frequencies.documents)
    value = _idf(df, documents) * _relevance(chi)
    # like examples stand together, so that the block maxima are close bounds
    heavy = np.full((n, 2), [0.0, -1])
    by = np.lexsort((t, tf * value[t], at))
    last = by[(np.cumsum(sizes) - 1)[sizes > 0]]
    heavy[sizes > 0] = np.column_stack([(tf * value[t])[last], t[last]])
    ids = np.array([e[0] for e in examples], np.int64)
    order = np.lexsort((ids, heavy[:, 0], heavy[:, 1]))
    label, ids = label[order], ids[order]
    examples = [examples[i] for i in order]
    index = Index(number, value, *[np.zeros(0)] * 8, label, ids, k, frequencies=frequencies)
    vectors = [index.vector(e[2]) for e in examples]
    t = np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.int64)])
    at = np.repeat(np.arange(n), [len(v[0]) for v in vectors])
    w = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
    sort = np.lexsort((at, t))
    t, at, w = t[sort], at[sort], w[sort]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (at[1:] // BLOCK != at[:-1] // BLOCK)
    first = np.flatnonzero(fresh)
    index.place, index.weight, index.block = at.astype(np.int32), w, (at[first] // BLOCK).astype(np.int32)
    index.top = np.maximum.reduceat(w, first) if len(first) else w
    index.start, index.cell = (np.column_stack([np.searchsorted(x, np.arange(len(terms)), side) for side in ("left", "right")]) for x in (t, t[first]))
    index.first = np.append(first, len(t))
    common = both > n / COMMON
    index.column = np.where(common, np.cumsum(common) - 1, -1)
    # the curve: votes of the examples without themselves, each class at its size among all labels
    n1 = index.label.sum()
    share = np.where(index.label == 1, positives / max(1, n1), (total - positives) / max(1, n - n1))
    votes, labels, weights, bare = [], [], [], [[0.0, 0.0]]
    for i, (ti, vi) in enumerate(vectors):
        if i % TOGETHER == 0:
            shares = index._shares(vectors[i:i + TOGETHER])
        near, cos = index.nearest(ti, vi, i, shares[i % TOGETHER]) if len(ti) else ((), ())
        if len(near):
            votes.append(index.vote(near, cos))
            labels.append(index.label[i])
            weights.append(share[i])
        else:
            bare.append([index.label[i] * share[i], share[i]])
    bare_sum = np.sum(bare, axis=0)
    index.without = float((bare_sum[0]) / (bare_sum[1] + 1))
    index.curve = _logistic(np.array(votes), np.array(labels), np.array(weights))
    return index


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x with a light ridge, by Newton steps."""
    if not len(x):
        return 0.0, 0.0
    a, b = 1.0, 0.0
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        grad = design.T @ (w * (y - p)) - 0.1 * np.array([a, b])
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        a, b = a + float(np.clip(move[0], -2, 2)), b + float(np.clip(move[1], -2, 2))
    return max(a, 0.0), b


def _term_counts(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            own = Counter(words_of(batch.column(2)[i].as_py()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([list(own)], pa.list_(pa.binary())),
                                              pa.array([list(own.values())], pa.list_(pa.int64()))], names=["doc_id", "label", "words", "counts"])


def _word_documents(shards: int):
    """Distinct words of a task's documents by shard, with the number of documents that have them."""
    def rows(df: Counter):
        h, n = _hashes(df), np.fromiter(df.values(), np.int64, len(df))
        shard = word_shard(h, shards)
        order = np.lexsort((h, shard))
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            at = order[ends[s]:ends[s + 1]]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(h[at], n[at])], pa.binary())], names=["shard", "data"])

    def run(batches):
        df = Counter()
        for b in batches:
            for raw in b.column(0):
                df.update(set(words_of(raw.as_py())))
                if len(df) >= FLUSH:
                    yield from rows(df)
                    df = Counter()
        yield from rows(df)
    return run


def _word_shard_of(folder: str):
    """Writes a shard of words: sorted hashes with the number of documents."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        h, n = summed(*map(np.concatenate, zip(*map(unpack, group["data"]))))
        write_array(folder, f"hash-{int(key[0])}", h)
        write_array(folder, f"documents-{int(key[0])}", n)
        return pd.DataFrame({"words": [len(h)]})
    return run


def frequencies(docs: DataFrame, text: str = "text") -> Frequencies:
    """Counts the documents of every word of all texts, into the shared folder."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    shards = units(int(size["b"] or 0), WORD_BYTES)
    folder = scratch_path(docs.sparkSession, "toxicity-words")
    parts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(
        lean(_word_documents(shards)), StructType([StructField("shard", IntegerType()), StructField("data", BinaryType())]))
    parts.groupBy("shard").applyInPandas(_word_shard_of(folder), StructType([StructField("words", LongType())])).agg(F.sum("words")).first()
    release(docs.sparkSession)
    return Frequencies(folder, shards, size["n"])


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, text: str = "text", doc_id: str = "doc_id") -> Index:
    """An index over at most ``examples`` of the labelled documents (``labels``: doc_id, label 0/1), the
    first by a hash of their id in either class; class sizes come from all labels."""
    own = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    own, path = staged(own, "toxicity-labels")
    sizes = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}

    def some(label: int) -> DataFrame:
        return own.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples // 2)
    chosen = F.broadcast(some(1).unionAll(some(0)))  # at most ``examples`` ids
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(chosen, "doc_id").select("doc_id", "label", "text")
    schema = StructType([StructField("doc_id", LongType()), StructField("label", src.schema["label"].dataType), StructField("words", ArrayType(BinaryType())), StructField("counts", ArrayType(LongType()))])
    found = src.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(_term_counts, schema).orderBy("doc_id", "label").toArrow()  # of the examples only
    words = found["words"].combine_chunks().flatten().dictionary_encode()
    names, code = words.dictionary.to_pylist(), words.indices.to_numpy()
    counts, at, rows = found["counts"].combine_chunks().flatten().to_numpy(), 0, []
    for i, label, n in zip(found["doc_id"].to_pylist(), found["label"].to_pylist(), pc.list_value_length(found["counts"]).to_pylist()):
        rows.append((i, label, dict(zip(map(names.__getitem__, code[at:at + n].tolist()), counts[at:at + n].tolist()))))
        at += n
    release(docs.sparkSession, path)
    return build_index(names, rows, sizes.get(1, 0), sizes.get(1, 0) + sizes.get(0, 0), frequencies=frequencies(docs, text))


def _slices(texts: pa.Array):
    """Word counts of a few texts at a time: what a worker holds of them is bounded."""
    part, size = [], 0
    for raw in texts:
        raw = raw.as_py()
        part.append(Counter(words_of(raw)))
        size += len(raw or b"")
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def score(docs: DataFrame, index: Index, text: str = "text", keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with ``score`` and ``evidence`` (the nearest examples,
    their labels and cosines)."""
    keep = keep or ["doc_id"]
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"))
    kind = ArrayType(StructType([StructField("doc_id", LongType()), StructField("label", DoubleType()), StructField("cosine", DoubleType())]))
    schema = StructType([*src.schema.fields, StructField("score", DoubleType()), StructField("evidence", kind)])
    folder = scratch_path(docs.sparkSession, "toxicity-index")
    small = index.share(folder)   # bounded by EXAMPLES

    def run(batches):
        own = small.opened(folder)
        arrow = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.float64()), ("cosine", pa.float64())]))
        try:
            for b in batches:
                scores, evidence = [], []
                for texts in _slices(b.column(b.schema.get_field_index("_text"))):
                    for p, near, cos in own.scores(texts):
                        scores.append(p)
                        evidence.append([{"doc_id": int(own.ids[i]), "label": float(own.label[i]), "cosine": float(c)} for i, c in zip(near, cos)])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(evidence, arrow)], names=[*b.schema.names, "score", "evidence"])
        finally:   # nothing of the index stays in the worker for later stages
            _opened.cache_clear()
    out = src.mapInArrow(lean(run), schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *(["_text"] if with_text else []), "score", "evidence")


def training_labels(labels: DataFrame, folds: int = 5) -> DataFrame:
    """Toxic labels of the ids that are not held out (crc32 of the id as text, modulo ``folds``, is not 0)."""
    return labels.where(fold("doc_id", folds) != 0).select("doc_id", F.col("toxic").alias("label"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more; columns stay as they are."""
    plain, text, doc_id, names = plainly(docs, text, doc_id)
    index = fit(plain, training_labels(labels), text=text, doc_id=doc_id)
    clean = score(plain, index, text, [c for c in plain.columns if c != text], with_text=True).where(F.col("score") < limit)
    return clean.withColumn(text, F.col("_text").cast("string")).select(*plain.columns).toDF(*names)
