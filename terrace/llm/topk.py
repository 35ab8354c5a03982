"""Exact top-k by inner product: columnar branch-and-bound.

Candidates are packed into blocks in vertical layout (one row of numbers per dimension).  A query
accumulates its products over one group of dimensions after another; what the remaining dimensions
can still add is bounded by the product of the remaining masses (norms) of query and candidate, and
candidates whose upper bound is below the k-th lower bound leave the block, which is compacted.
Survivors of all dimensions have exact scores.

Queries come in blocks too, and every block of queries meets every block of candidates: what one
task holds is bounded by the block sizes, and only k rows a query and block of candidates leave it.

Defined results: vectors that are null, or hold a null or non-finite number, take no part, as do
null ids; shorter vectors count as filled up with zeros (an empty one scores 0); equal rows are one
candidate, rows with one id and other vectors each are one, and as queries they share their id's k
places; a row's own id is never its candidate; equal scores go to the smaller id; fewer candidates
than k give fewer rows.  Scores are 64-bit, so |score| must stay below 2^62.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import release, staged, units

#: Vectors in a block of candidates, and of queries.
CANDIDATES, QUERIES = 8192, 256
#: Dimensions accumulated between two prunings.
STEP = 8


def whole_numbers(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``id`` and ``vec``: floor(scale * x) of each component x, as long; equal rows once."""
    x = F.col(embedding)
    good = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    vec = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    rows = df.where(F.coalesce(good, F.lit(False)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), vec.alias("vec"))
    return rows.distinct()


BLOCK = StructType([StructField("block", IntegerType()), StructField("n", IntegerType()), StructField("dims", IntegerType()),
                    StructField("ids", BinaryType()), StructField("data", BinaryType())])


def _pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("id")
    dims = max(1, max(map(len, group["vec"])))
    data = np.zeros((dims, len(group)), np.int64)
    for j, v in enumerate(group["vec"]):
        data[:len(v), j] = v
    return pd.DataFrame({"block": [int(key[0])], "n": [len(group)], "dims": [dims],
                         "ids": [group["id"].to_numpy(np.int64).tobytes()], "data": [data.tobytes()]})


def _blocks(vectors: DataFrame, each: int, rows: int) -> DataFrame:
    n = units(rows, each)
    return vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy("block").applyInPandas(_pack, BLOCK)


def search_block(query: np.ndarray, qid: int, ids: np.ndarray, data: np.ndarray, mass: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the query's k best candidates of a block, without itself.  ``mass[s]`` holds
    the candidates' norms over the dimensions from s * STEP on."""
    alive = np.flatnonzero(ids != qid)
    sums = np.zeros(len(alive), np.int64)
    dims = len(query)
    for s, at in enumerate(range(0, dims, STEP)):
        part = data[at:at + STEP] if len(alive) == data.shape[1] else data[at:at + STEP, alive]
        sums += query[at:at + STEP] @ part
        rest = query[at + STEP:].astype(float)
        if len(alive) > k and len(rest):
            room = mass[s + 1][alive] * (np.sqrt(rest @ rest) * (1 + 1e-9)) + 1  # rounding stays on the safe side
            least = np.partition(sums - room, len(alive) - k)[len(alive) - k]
            stay = sums + room >= least
            alive, sums = alive[stay], sums[stay]
    if len(alive) > k:
        least = np.partition(sums, len(alive) - k)[len(alive) - k]
        stay = sums >= least
        alive, sums = alive[stay], sums[stay]
    order = np.lexsort((ids[alive], -sums))[:k]
    return ids[alive[order]], sums[order]


def _meet(k: int):
    def run(batches):
        for b in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for r in b.to_pylist():
                ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                data = np.frombuffer(r["data"], np.int64).reshape(r["dims"], r["n"])
                asked = np.frombuffer(r["q_data"], np.int64).reshape(r["q_dims"], r["q_n"])
                dims = max(r["dims"], r["q_dims"])
                data = np.pad(data, ((0, dims - r["dims"]), (0, 0)))
                asked = np.pad(asked, ((0, dims - r["q_dims"]), (0, 0)))
                squares = np.cumsum(np.square(data.astype(float))[::-1], axis=0)[::-1]
                mass = [np.sqrt(squares[at]) * (1 + 1e-9) if at < dims else np.zeros(r["n"]) for at in range(0, dims + STEP, STEP)]
                for j, qid in enumerate(qids):
                    own, scores = search_block(np.ascontiguousarray(asked[:, j]), int(qid), ids, data, mass, k)
                    out.append((np.full(len(own), qid, np.int64), own, scores))
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of ``vectors`` for each of ``queries`` (both id, vec),
    a row's own id left out."""
    spark = vectors.sparkSession
    rows, asked = vectors.count(), queries.count()
    cand, path = staged(_blocks(vectors, CANDIDATES, rows), "topk-candidates")
    ask = _blocks(queries, QUERIES, asked).select(F.col("block").alias("q"), *[F.col(c).alias(f"q_{c}") for c in ("n", "dims", "ids", "data")])
    ask, own = staged(ask, "topk-queries")
    n = units(asked, QUERIES)
    grid = cand.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).repartition(min(units(rows, CANDIDATES) * n, 20_000), "block", "q").join(ask, "q")
    schema = StructType([StructField(c, LongType()) for c in ("query_id", "vec_id", "score")])
    best, _ = staged(grid.mapInArrow(_meet(k), schema), "topk-best")
    release(spark, path, own)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
