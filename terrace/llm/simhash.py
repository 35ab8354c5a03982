"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits, set where more than half of the hashes of a text's word shingles have them.
Search: correlated bits are grouped into partitions; each partition gets its own threshold, by
dynamic programming on candidate counts estimated from a bounded sample of fingerprints.  When the
thresholds t_i of m partitions sum to (distance - m + 1), two fingerprints within the distance are
within t_i in some partition i, so probing every value within t_i finds every link.  Partitions with
threshold -1 are not probed.  Candidates are verified by their whole distance.

Buckets over ``BUCKET`` members are split further: two fingerprints within distance d agree on one
of d + 1 groups of bits, so the members of a bucket are dealt by each group in turn, and so on until
the bucket is small.  No link is lost and no bucket is read whole by one task.  Within a bucket only
a spanning forest of its links is written, never all pairs.

Defined results: null and empty texts, and texts without words, have fingerprint zero and link like
any other; repeated rows are linked; a null id keeps its row and never names a component unless
nothing else could (then it is null); other columns are left alone.
"""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import lean, plainly, release, staged
from .components import components

BITS = 64
#: Members of a bucket that one task compares with each other; larger buckets are split exactly.
BUCKET = 512
#: Fingerprints that estimate candidate counts and bit correlations; they decide the plan, not the result.
SAMPLE = 4096
PARTITIONS = (2, 3, 4)
PIECE = 4_000_000


def _word_runs(text: bytes):
    """Words of a text in runs of about PIECE bytes, cut at blanks."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) and text[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        yield text[at:cut].lower().split()
        at = cut
    yield text[at:].lower().split()


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text, as a signed 64-bit number."""
    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for run in _word_runs(text or b""):
        words = carry + run
        if len(words) >= shingle:
            parts = zip(*[words[i:] for i in range(shingle)])
            hashes = np.array([digest(b" ".join(p), seed) for p in parts], "<u8")
            for i in range(0, len(hashes), 65_536):
                part = hashes[i:i + 65_536]
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carry = words[max(0, len(words) - shingle + 1):]
    if not total and carry:
        one = np.array([digest(b" ".join(carry), seed)], "<u8")
        ones, total = np.unpackbits(one.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """``keep`` columns (default doc_id) and ``fp`` (long) of every row."""
    keep = keep or ["doc_id"]
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"))
    schema = StructType([f for f in src.schema.fields if f.name != "_text"] + [StructField("fp", LongType())])

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("_text")
            fps = [fingerprint(x.as_py(), shingle) for x in b.column(at)]
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in rest] + [pa.array(fps, pa.int64())],
                                             names=[b.schema.names[i] for i in rest] + ["fp"])
    return src.mapInArrow(lean(run), schema).toDF(*keep, "fp")


# ------------------------------------------------------------------ plan of the search


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def group_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m groups of about equal size; each bit goes where it correlates most."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    dev = bits - bits.mean(axis=0)
    norm = np.sqrt((dev ** 2).sum(axis=0))
    near = np.abs(dev.T @ dev) / np.maximum(np.outer(norm, norm), 1e-9)
    left, groups = list(range(BITS)), []
    for g in range(m):
        most = BITS // m + (g < BITS % m)
        own = [left.pop(0)]
        while len(own) < most:
            best = max(left, key=lambda b: (near[b, own].sum(), -b))
            left.remove(best)
            own.append(best)
        groups.append(sorted(own))
    return groups


def _ball(width: int, t: int) -> int:
    return sum(1 if k == 0 else int(np.prod([width - i for i in range(k)]) // np.prod(range(1, k + 1))) for k in range(t + 1))


def allocate(sample: np.ndarray, groups: list[list[int]], rows: int, distance: int) -> tuple[float, list[int]]:
    """Cost and thresholds (-1 or more) of the groups, summing to distance - m + 1, with the least
    estimated number of probes and candidates over ``rows`` fingerprints."""
    n = len(sample)
    cost: list[dict[int, float]] = []
    for g in groups:
        part = sample & np.uint64(sum(1 << b for b in g))
        apart = np.zeros(BITS + 1, np.int64)
        for i in range(0, n, 256):
            apart += np.bincount(np.bitwise_count(part[i:i + 256, None] ^ part[None, :]).ravel(), minlength=BITS + 1)
        apart[0] -= n  # with itself
        pairs = np.cumsum(apart) / max(1, n * (n - 1))
        cost.append({-1: 0.0} | {t: rows * 4.0 * _ball(len(g), t) + float(rows) * rows * (pairs[t] + 2.0 ** -len(g) * _ball(len(g), t)) for t in range(distance + 1)})
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # spent: the sum of t + 1
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, ts) in best.items():
            for t, more in own.items():
                to = spent + t + 1
                if to <= distance + 1 and (to not in step or c + more < step[to][0]):
                    step[to] = (c + more, ts + [t])
        best = step
    return best[distance + 1]


def plan_search(sample: np.ndarray, rows: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed group."""
    plans = []
    for m in PARTITIONS:
        groups = group_bits(sample, m)
        plans.append((*allocate(sample, groups, rows, distance), groups))
    _, ts, groups = min(plans, key=lambda p: p[0])
    return [(g, t) for g, t in zip(groups, ts) if t >= 0]


# ------------------------------------------------------------------ probing and verification


def _probes(plan: list[tuple[list[int], int]]):
    """One bucket key for each value within the threshold, for each group."""
    keys = []
    for i, (bits, t) in enumerate(plan):
        flips = [sum(1 << b for b in own) for k in range(t + 1) for own in itertools.combinations(bits, k)]
        part = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        keys.extend(F.xxhash64(F.lit(i), part.bitwiseXOR(F.lit(_signed(f)))) for f in flips)
    return F.explode(F.array(*keys))


def _thirds(level: int, parts: int) -> list[int]:
    order = list(range(BITS))
    random.Random(level).shuffle(order)
    return [sum(1 << b for b in order[j::parts]) for j in range(parts)]


def _split(buckets: DataFrame, level: int, distance: int) -> DataFrame:
    keys = [F.xxhash64("key", F.lit(j), F.col("fp").bitwiseAND(F.lit(_signed(mask)))) for j, mask in enumerate(_thirds(level, distance + 1))]
    return buckets.select("fp", F.explode(F.array(*keys)).alias("key"))


def _forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is linked within the bucket, one for each member but the first of a tree."""
    if len(members) == 2:
        a, b = int(members[0]), int(members[1])
        return [(a, b)] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance else []
    own = members.view(np.uint64)
    linked = np.bitwise_count(own[:, None] ^ own[None, :]) <= distance
    left, out = np.ones(len(own), bool), []
    for i in range(len(own)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & left)
            left[new] = False
            out.extend((int(members[at]), int(members[j])) for j in new)
            todo.extend(new.tolist())
    return out


def _verify(distance: int):
    def run(batches):
        for b in batches:
            out = []
            lists = b.column(0)
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
            flat = np.ascontiguousarray(flat, np.int64)
            base = offsets[0]
            for i in range(len(lists)):
                out.extend(_forest(flat[offsets[i] - base:offsets[i + 1] - base], distance))
            if out:
                a, c = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])
    return run


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that connect whatever is within ``distance``."""
    spark = distinct.sparkSession
    rows = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    if rows < 2:
        return spark.createDataFrame([], "a long, b long")
    plan = plan_search(np.array([r["fp"] for r in sample], np.int64).view(np.uint64), rows, distance)
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    keys, found, level, paths = distinct.select("fp", _probes(plan).alias("key")), [], 0, []
    while True:
        sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        buckets, path = staged(keys.join(sizes, "key"), "simhash-buckets")
        small = buckets.where(F.col("n") <= BUCKET).groupBy("key").agg(F.array_distinct(F.collect_list("fp")).alias("own"))
        found.append(small.where(F.size("own") > 1).select("own").mapInArrow(lean(_verify(distance)), schema))
        paths.append(path)
        large = buckets.where(F.col("n") > BUCKET)
        if large.isEmpty():
            break
        keys, level = _split(large.select("fp", "key"), level, distance), level + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    done, _ = staged(out.distinct(), "simhash-links")
    release(spark, *paths)
    return done


def _placed(docs: DataFrame, text: str, doc_id: str, shingle: int, distance: int) -> DataFrame:
    """doc_id, fp, component_id and ``root``, the fingerprint that names the component."""
    fps, _ = staged(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle=shingle), "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = links(nodes.select("fp"), distance)
    roots, path = staged(components(found, "a", "b"), "simhash-roots")
    placed = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of, _ = staged(placed.join(least, "root").select("fp", "component_id", "root"), "simhash-components")
    release(docs.sparkSession, path)
    return fps.join(of, "fp").select("doc_id", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id``, ``fp`` (long) and ``component_id``: the smallest id reachable over links of at most
    ``distance`` differing bits."""
    return _placed(docs, text, doc_id, shingle, distance).drop("root")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, and of several rows with that id in the
    component one with the least fingerprint.  Rows with one id in several components count for each of
    them.  Where a component has no id at all, one row of each fingerprint stays.  Columns stay as they are."""
    plain, text, doc_id, names = plainly(docs, text, doc_id)
    near, _ = staged(_placed(plain, text, doc_id, shingle, distance), "simhash-near")
    first = near.where("doc_id = component_id").groupBy("root").agg(F.min("doc_id").alias(doc_id), F.min("fp").alias("fp"))
    several = near.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(doc_id)).agg((F.min("fp") != F.max("fp")).alias("several")).where("several")
    named = plain.join(first.select(doc_id), doc_id, "left_semi")
    if several.isEmpty():   # an id tells the text
        named = named.dropDuplicates([doc_id])
    else:
        by_id = named.join(several, doc_id, "left_anti").dropDuplicates([doc_id])
        told = fingerprints(named.join(several, doc_id, "left_semi").withColumn("_words", F.col(text)), "_words", plain.columns, shingle)
        told = told.join(first.select(doc_id, "fp"), [doc_id, "fp"], "left_semi").dropDuplicates([doc_id, "fp"])
        named = by_id.select(*plain.columns).unionAll(told.select(*plain.columns))
    bare = plain.where(F.col(doc_id).isNull())
    bare = fingerprints(bare.withColumn("_words", F.col(text)), "_words", plain.columns, shingle)
    bare = bare.join(near.where("component_id IS NULL").select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"])
    return named.select(*plain.columns).unionAll(bare.select(*plain.columns)).toDF(*names)
