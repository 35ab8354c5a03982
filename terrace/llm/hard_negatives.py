"""Hard negatives by a secondary sort: per anchor, one stream of scored rows from the best to the worst.

Anchors lie in blocks of arrays in the cluster's shared folder.  Tasks read the candidates once, in
chunks, and score each chunk against one block of anchors after another.  What leaves a chunk is only
what can be in an answer: the first positives of each anchor, and, once the positives of the whole
table are known, the first negatives of each of its score windows.  The scored pairs are dealt by
anchor and sorted within partitions by (anchor, descending score, id); an iterator walks the stream,
opens a window at every positive it meets and emits the negatives that fall into open windows.  It
holds the open windows of one anchor, never its rows.

Defined results: rows whose id, label or vector is null, or whose vector holds a null or non-finite
component, take no part; shorter vectors count as filled up with zeros; the anchor's own row (equal in
id, label and vector) is neither positive nor negative of it, other rows of its id may be; repeated
rows count each; anchors that are equal rows are one anchor; equal scores go to the smaller id; an
anchor without positives, or a positive without negatives, gives no rows.  A positive score below 0
has an empty window.  Scores are 64-bit, so 100 * |score| must stay below 2^63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_path
from .common import bounded_batches, lean, release, staged, units
from .shared_arrays import map_array, write_array

#: Anchors in a block; rows and bytes of a chunk of candidates.
ANCHORS, CHUNK_ROWS, CHUNK_BYTES = 128, 32_768, 16 << 20
#: An anchor's key: its block, and its place there in the low bits.
PLACE = 20


def _longs(*names: str) -> StructType:
    return StructType([StructField(n, LongType()) for n in names])


PAIR = _longs("anchor", "anchor_id", "score", "id")


def whole_numbers(df: DataFrame, vec_id: str, label: str, embedding: str, scale: int = 256) -> DataFrame:
    """``id``, ``label`` and ``vec``: floor(scale * x) of each component x."""
    x = F.col(embedding)
    good = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    vec = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), vec.alias("vec"))


def _matrix(vecs: pa.ListArray) -> np.ndarray:
    """One row of numbers per vector, filled up with zeros."""
    ends = vecs.offsets.to_numpy() - vecs.offsets[0].as_py()
    flat, sizes = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(ends[:-1], sizes)] = flat
    return out


def _wide(m: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``; in floating point where that is exact."""
    dims = max(a.shape[1], b.shape[1])
    a, b = _wide(a, dims), _wide(b, dims)
    most = max(1.0, float(np.abs(a).max(initial=0))) * max(1.0, float(np.abs(b).max(initial=0))) * max(1, dims)
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if most < 2.0 ** 52 else a @ b.T


def first(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k first places of ``at`` by descending score, then by id."""
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


class Blocks:
    """The anchors: ids, labels and vectors of each block, and later the scores of their positives."""

    def __init__(self, anchors: DataFrame, folder: str):
        self.folder = folder
        anchors, path = staged(anchors.select("id", "label", "vec").distinct(), "negatives-anchors")
        n = self.n = units(anchors.count(), ANCHORS)

        def write(key, table):
            block, table = key[0].as_py(), table.drop(["block"])
            rows = sorted(table.to_pylist(), key=lambda r: (r["id"], r["label"], r["vec"]))   # the same places in every attempt
            write_array(folder, f"{block}-ids", np.array([r["id"] for r in rows], np.int64))
            write_array(folder, f"{block}-labels", np.array([r["label"] for r in rows], np.int64))
            write_array(folder, f"{block}-vecs", _matrix(pa.array([r["vec"] for r in rows], pa.list_(pa.int64()))))
            return pa.table({"block": pa.array([block], pa.int64())})

        dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "vec"), F.lit(n)))
        staged(dealt.groupBy("block").applyInArrow(write, _longs("block")), "negatives-blocks")
        release(anchors.sparkSession, path)

    def open(self, block: int, *names: str) -> list[np.ndarray] | None:
        """Arrays of a block, or None if nothing fell into it."""
        try:
            return [map_array(self.folder, f"{block}-{name}") for name in names]
        except FileNotFoundError:
            return None

    def write_windows(self, positives: DataFrame) -> None:
        """Adds the positives' places and scores to the blocks."""
        folder = self.folder

        def write(key, table):
            table = table.sort_by([("anchor", "ascending"), ("score", "descending"), ("id", "ascending")])
            place = table.column("anchor").to_numpy() & ((1 << PLACE) - 1)
            write_array(folder, f"{key[0].as_py()}-places", place)
            write_array(folder, f"{key[0].as_py()}-scores", table.column("score").to_numpy())
            return pa.table({"block": pa.array([key[0].as_py()], pa.int64())})

        rows = positives.withColumn("block", F.shiftright("anchor", PLACE))
        staged(rows.groupBy("block").applyInArrow(write, _longs("block")), "negatives-windows")


def _chunks(batches):
    """Ids, labels and vectors of the candidates of a task, a bounded chunk at a time."""
    part, rows, size = [], 0, 0
    for b in batches:
        part.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield part
            part, rows, size = [], 0, 0
    if rows:
        yield part


def _arrays(part: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = pa.Table.from_batches(part).combine_chunks()
    vecs = t.column("vec").combine_chunks()
    vecs = vecs.chunk(0) if isinstance(vecs, pa.ChunkedArray) else vecs
    return t.column("id").to_numpy(), t.column("label").to_numpy(), _matrix(vecs)


def _scored(blocks: Blocks, choose, names: tuple[str, ...]):
    """Pairs of anchors and candidates: ``choose(scores, ids, same, others, extra)`` gives the places of
    those that leave the chunk, for each anchor (``same``: of its label, ``others``: not)."""
    def run(batches):
        for part in _chunks(batches):
            ids, labels, vecs = _arrays(part)
            for block in range(blocks.n):
                found = blocks.open(block, "ids", "labels", "vecs", *names)
                if found is None:
                    continue
                a_ids, a_labels, a_vecs, *extra = found
                scores = products(a_vecs, vecs)
                out: list[tuple[np.ndarray, ...]] = []
                for j in range(len(a_ids)):
                    same = labels == a_labels[j]
                    own = np.flatnonzero(same & (ids == a_ids[j]))
                    if len(own):
                        dims = max(vecs.shape[1], a_vecs.shape[1])
                        mine = _wide(a_vecs[j:j + 1], dims)[0]
                        same = same.copy()
                        same[own[(_wide(vecs[own], dims) == mine).all(axis=1)]] = False
                    at = choose(scores[j], ids, same, labels != a_labels[j], [e for e in extra] + [j])
                    out.append((np.full(len(at), (block << PLACE) + j), np.full(len(at), a_ids[j]), scores[j][at], ids[at]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=PAIR.names)
    return run


def _first_positives(k: int):
    def choose(scores, ids, same, others, extra):
        return first(scores, ids, np.flatnonzero(same), k)
    return choose


def _first_negatives(k: int, low: int, high: int):
    def choose(scores, ids, same, others, extra):
        places, positives, j = extra
        at = [np.zeros(0, np.int64)]
        for p in positives[places == j].tolist():
            if p >= 0:
                at.append(first(scores, ids, np.flatnonzero(others & (100 * scores >= low * p) & (100 * scores <= high * p)), k))
        return np.unique(np.concatenate(at))
    return choose


def in_order(pairs: DataFrame) -> DataFrame:
    """The secondary sort: each anchor's pairs in one partition, from the highest score down, then by id."""
    return pairs.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "id")


def _leading(k: int):
    """The first k rows of every anchor of a sorted stream."""
    def run(batches):
        last, n = None, 0
        for b in batches:
            keep = []
            for anchor in b.column("anchor").to_pylist():
                last, n = (anchor, n + 1) if anchor == last else (anchor, 1)
                keep.append(n <= k)
            yield b.filter(pa.array(keep, pa.bool_()))
    return run


MINED = _longs("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def stream(rows, k: int, low: int, high: int):
    """Walks (anchor, anchor_id, score, id, positive?) from each anchor's highest score down and yields
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A window begins at or below its positive's score, so it is open before its negatives come; only
    score 0 has both at once, where smaller ids come first: the first k negatives of it are held."""
    last, windows, zeros = None, [], []   # windows: [positive_id, positive_score, rank of the last]
    for anchor, anchor_id, score, row_id, positive in rows:
        if anchor != last:
            last, windows, zeros = anchor, [], []
        if positive:
            windows.append([row_id, score, 0])
            if score == 0:
                for negative in zeros:
                    windows[-1][2] += 1
                    yield anchor_id, row_id, windows[-1][2], negative, 0, 0
            continue
        if score == 0 and len(zeros) < k:
            zeros.append(row_id)
        for w in windows:
            if w[2] < k and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor_id, w[0], w[2], row_id, w[1], score


def _mined(k: int, low: int, high: int):
    def rows(batches):
        for b in batches:
            yield from zip(*[b.column(c).to_pylist() for c in ("anchor", "anchor_id", "score", "id", "positive")])

    def run(batches):
        part = []
        for row in stream(rows(batches), k, low, high):
            part.append(row)
            if len(part) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], names=MINED.names)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], names=MINED.names)
    return run


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each of ``anchors`` and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    other labels whose score lies between ``low`` and ``high`` per cent of the positive's.  Both frames: id, label, vec.
    Result: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    blocks = Blocks(anchors, scratch_path(spark, "negatives-arrays"))
    found = vectors.mapInArrow(lean(_scored(blocks, _first_positives(positives), ())), PAIR)
    best, path = staged(in_order(found).mapInArrow(_leading(positives), PAIR), "negatives-positives")
    blocks.write_windows(best)
    near = vectors.mapInArrow(lean(_scored(blocks, _first_negatives(negatives, low, high), ("places", "scores"))), PAIR)
    both = best.withColumn("positive", F.lit(True)).unionByName(near.withColumn("positive", F.lit(False)))
    out, _ = staged(in_order(both).mapInArrow(_mined(negatives, low, high), MINED), "negatives-mined")
    release(spark, path, blocks.folder)
    return out.withColumn("rank", F.col("rank").cast("int"))
