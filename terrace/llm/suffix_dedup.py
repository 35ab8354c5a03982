"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.

Parsing.  A rolling hash over ``GRAM`` bytes triggers phrases: the trigger of a string of ``length``
bytes is its least gram hash, and a phrase is the text of neighbouring strings with the same trigger.
Phrases overlap by length - 1 bytes, so every string of that length lies in exactly one phrase, and
equal strings have equal triggers wherever they stand: the parse never depends on the surroundings.

Four passes over work units ("chunks") of about ``CHUNK`` bytes of whole documents:
1. triggers of every chunk meet by shard; those of one document only are done with;
2. phrases of the others meet by trigger: the distinct ones are the dictionary, and their documents
   in order the parse;
3. in each shard the suffix array of the dictionary (to the depth of ``length``) puts all strings in
   order; a run of equal prefixes, with the parse, has its smallest document, and each chunk
   hears which strings of its phrases start in a smaller one;
4. every chunk takes the bytes out.

Only distinct phrases of a chunk leave it, so copies, and passages that many documents share, cost
one row for each chunk.  A trigger in over ``HOT_CHUNKS`` chunks is not gathered: its strings are dealt
by their own hash, each as a phrase of one string.

Defined results: null and empty texts stay as they are; a document with a null id neither loses
anything nor makes others lose; documents with equal ids do not count for each other; matches
within one document and across documents' borders do not count; texts of any length are handled whole.
Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import give_back, lean, plainly, release, staged, text_bytes, units

LENGTH, GRAM = 50, 20
#: Bytes of documents in a chunk, of a piece that is hashed at once, and of text for a shard of triggers and of phrases.
CHUNK, PIECE, TRIGGER_BYTES, PHRASE_BYTES = 2_000_000, 500_000, 32_000_000, 8_000_000
HOT_CHUNKS = 2000
ZSTD = 7  # level: chunks are written once and shuffled twice
MOST = 31  # strings in a phrase: bits of a mask
SLICE = 8192  # phrases that are hashed or copied at once
U64 = np.uint64
#: Triggers travel as their upper 39 bits and a flag: a shard holds a bounded number of them, so few meet by
#: accident at any input size, and those that do are only looked at in vain.
FLAG = U64(24)
BASE = 0x5851F42D4C957F2D
_TABLE = np.random.default_rng(50).integers(1, 2 ** 64, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(31))) * U64(0x9E3779B97F4A7C15)
    return h ^ (h >> U64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def _marks(polynomial: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hash of a phrase: of its bytes' polynomial and its number of strings."""
    return _mixed(polynomial + count.astype(U64) * U64(0xD6E8FEB86659FD93))


_POWERS: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _POWERS:
        n = PIECE + 4 * LENGTH
        _POWERS.extend([_powers(BASE, n), _powers(pow(BASE, -1, 2 ** 64), n)])
    return _POWERS


class Phrases:
    """Phrases of a chunk: first string, number of strings, trigger, hash of the bytes, document."""

    def __init__(self, body: np.ndarray, sizes: np.ndarray, length: int):
        self.body, self.length = body, length
        ends = np.cumsum(sizes)
        strings = np.zeros(len(body), bool)  # where a string of that length starts
        for a, e in zip(ends - sizes, ends):
            strings[a:max(a, e - length + 1)] = True
        parts = [self._piece(at, strings) for at in range(0, max(1, len(body) - length + 1), PIECE)] if len(body) >= length else []
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)]
        self.start, self.count, self.trigger, self.mark = [np.concatenate(c) for c in zip(*parts)] if parts else empty
        self.doc = np.searchsorted(ends, self.start, side="right")

    def _piece(self, at: int, strings: np.ndarray) -> list[np.ndarray]:
        length = self.length
        raw = self.body[at:at + PIECE + length - 1]
        power, inverse = _power_tables()
        sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(_TABLE[raw] * power[:len(raw)], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[:len(raw) - GRAM + 1])
        width, least, have = length - GRAM + 1, grams, 1
        while 2 * have <= width:
            least = np.minimum(least[:len(least) - have], least[have:])
            have *= 2
        n = len(raw) - length + 1
        least = np.minimum(least[:n], least[width - have:width - have + n])
        good = strings[at:at + n]
        fresh = good.copy()
        fresh[1:] &= ~good[:-1] | (least[1:] != least[:-1])
        start = np.flatnonzero(fresh)
        over = good.copy()  # the last string of a phrase
        over[:-1] &= ~good[1:] | fresh[1:]
        count = np.flatnonzero(over) - start + 1
        cut = -(-count // MOST)
        part = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
        start = np.repeat(start, cut) + MOST * part
        count = np.minimum(np.repeat(count, cut) - MOST * part, MOST)
        end = start + count + length - 1
        mark = _marks((sums[end] - sums[start]) * inverse[start], count)
        return [start + at, count, least[start], mark]

    def split(self, hot: np.ndarray) -> None:
        """Makes phrases of one string of those with a hot trigger."""
        own = np.isin(_key(self.trigger), hot)
        if own.any():
            n = np.where(own, self.count, 1)
            part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            was = np.repeat(own, n)
            self.start = np.repeat(self.start, n) + np.where(was, part, 0)
            self.count = np.where(was, 1, np.repeat(self.count, n))
            self.doc, self.mark, self.trigger = np.repeat(self.doc, n), np.repeat(self.mark, n), np.repeat(self.trigger, n)
            at, h, power = self.start[was], np.zeros(was.sum(), U64), _power_tables()[0]
            for j in range(self.length):
                h += _TABLE[self.body[at + j]] * power[j]
            self.mark[was] = self.trigger[was] = _marks(h, np.ones(len(at), np.int64))

    def bytes_of(self, at: np.ndarray) -> np.ndarray:
        return _gather(self.body, self.start[at], self.count[at] + self.length - 1)


def _gather(body: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    if not len(start):
        return body[:0]
    out, at = np.empty(int(size.sum()), body.dtype), 0
    for a in range(0, len(start), SLICE):
        n = size[a:a + SLICE]
        many = int(n.sum())
        out[at:at + many] = body[np.repeat(start[a:a + SLICE] - (np.cumsum(n) - n), n) + np.arange(many)]
        at += many
    return out


def _words_at(body: np.ndarray):
    """Reads eight bytes from any place as a number whose order is that of the bytes."""
    view = np.ndarray((max(0, len(body) - 7),), ">u8", body.tobytes(), strides=(1,))
    return lambda at: view[at].astype(U64)


def _depths(length: int) -> list[int]:
    return [*range(0, length - 8, 8), length - 8]


def suffix_order(text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start at ``at`` in the order of their first ``length`` bytes, and the number of
    the run of equal prefixes of each: eight bytes at a time, and only where runs are left."""
    words = _words_at(text)
    order, run, left = np.arange(len(at)), np.zeros(len(at), np.int64), np.arange(len(at))
    for depth in _depths(length):
        if not len(left):
            break
        key = words(at[order[left]] + depth)
        sort = np.lexsort((key, run[left]))
        order[left], key = order[left][sort], key[sort]
        new = np.zeros(len(run), bool)
        new[1:] = run[1:] != run[:-1]
        fresh = np.ones(len(left), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (run[left][1:] != run[left][:-1])
        new[left] |= fresh
        run = np.cumsum(new)
        same = np.zeros(len(run), bool)
        same[1:] = run[1:] == run[:-1]
        same[:-1] |= same[1:]
        left = np.flatnonzero(same)
    return order, run


# ------------------------------------------------------------------ chunks


def _dump(*values) -> bytes:
    raw = pickle.dumps(values, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", ZSTD).compress(raw, asbytes=True)


def _load(raw: bytes):
    return pickle.loads(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True))


def _chunks(batches):
    """Whole rows as compressed Arrow data, cut after about CHUNK bytes of text."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", ZSTD))
    for b in batches:
        sizes = [len(x.as_py() or b"") for x in b.column(b.schema.get_field_index("_text"))]
        at, size = 0, 0
        for i, n in enumerate(sizes):
            size += n
            if size >= CHUNK or i == len(sizes) - 1:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema, options=options) as out:
                    out.write_batch(b.slice(at, i + 1 - at))
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "body"])
                at, size = i + 1, 0


def _opened(body: bytes, length: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, Phrases]:
    """Rows of a chunk, ids, sizes, and phrases of the rows that have an id."""
    rows = next(iter(pa.ipc.open_stream(body)))
    texts = [x.as_py() or b"" for x in rows.column(rows.schema.get_field_index("_text"))]
    ids = rows.column(rows.schema.get_field_index("_id"))
    sizes = np.array([len(t) for t in texts], np.int64)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    text = np.frombuffer(b"".join(texts), np.uint8)
    phrases = Phrases(text, sizes, length)
    own = known[phrases.doc] if len(phrases.doc) else np.zeros(0, bool)
    for name in ("start", "count", "trigger", "mark", "doc"):
        setattr(phrases, name, getattr(phrases, name)[own])
    return rows, ids.fill_null(0).to_numpy(), sizes, phrases


def _short(h: np.ndarray) -> bytes:
    return np.ascontiguousarray((h >> FLAG).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_short(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel() << FLAG


def _key(h: np.ndarray) -> np.ndarray:
    return h & ~U64(0x1FFFFFF)


def _flag(h: np.ndarray) -> np.ndarray:
    return (h >> FLAG) & U64(1)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((_mixed(h) >> U64(11)) % U64(shards)).astype(np.int64)


def _dealt(shard: np.ndarray, shards: int):
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if ends[s] < ends[s + 1]:
            yield s, order[ends[s]:ends[s + 1]]


SENT = StructType([StructField("shard", IntegerType()), StructField("chunk", StringType()), StructField("data", BinaryType())])
HEARD = StructType([StructField("chunk", StringType()), StructField("data", BinaryType())])


def _row(schema: StructType, *values) -> pa.RecordBatch:
    kinds = {"shard": pa.int32(), "chunk": pa.string(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[n]) for n, v in zip(schema.names, values)], names=schema.names)


def _triggers(length: int, shards: int):
    """Pass 1: distinct triggers of each chunk; the lowest bit tells of several documents."""
    def run(batches):
        for b in batches:
            for chunk, body in zip(b.column(0).to_pylist(), b.column(1)):
                _, ids, _, p = _opened(body.as_py(), length)
                order = np.lexsort((ids[p.doc], p.trigger))
                t, d = p.trigger[order], ids[p.doc[order]]
                if not len(t):
                    continue
                first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                last = np.append(first[1:], len(t)) - 1
                t, several = t[first], d[first] != d[last]
                said = _key(t) | (several.astype(U64) << FLAG)
                for s, own in _dealt(_shard(_key(t), shards), shards):  # all triggers of a key get one flag
                    yield _row(SENT, s, chunk, _short(np.sort(said[own])))
    return run


def _shared(hot: int):
    """Triggers of a shard that several documents have, told to their chunks; the lowest bit marks hot ones."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_from_short(d) for d in rows["data"]]
        t, chunk = np.concatenate(parts), np.repeat(np.arange(len(parts)), list(map(len, parts)))
        key = _key(t)
        order = np.argsort(key, kind="stable")
        key, several = key[order], _flag(t[order]).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(np.append(first, len(key)))
        stay = np.repeat((n > 1) | (np.add.reduceat(several, first) > 0), n)
        said = (key | (np.repeat(n > hot, n).astype(U64) << FLAG))[stay]
        to = chunk[order][stay]
        out = [(rows["chunk"].iloc[c], _short(said[own])) for c, own in _dealt(to, len(parts))]
        return pd.DataFrame(out, columns=HEARD.names)
    return run


def _phrases(length: int, shards: int):
    """Pass 2: distinct phrases of each chunk whose trigger is shared, with their first document."""
    def run(batches):
        for b in batches:
            for chunk, body, heard in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                said = np.concatenate([_from_short(x) for x in heard])
                _, ids, _, p = _opened(body.as_py(), length)
                own = np.isin(_key(p.trigger), _key(said))
                for name in ("start", "count", "trigger", "mark", "doc"):
                    setattr(p, name, getattr(p, name)[own])
                p.split(_key(said[_flag(said) == 1]))
                order = np.lexsort((ids[p.doc], p.mark))
                order = order[np.concatenate([[True], p.mark[order][1:] != p.mark[order][:-1]])] if len(order) else order
                for s, at in _dealt(_shard(p.trigger[order], shards), shards):
                    at = order[at]
                    yield _row(SENT, s, chunk, _dump(p.count[at].astype(np.uint8), ids[p.doc[at]], p.bytes_of(at)))
    return run


def _polynomials(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Polynomial hash of each phrase; in slices, since every byte takes several numbers on the way."""
    out, power = np.zeros(len(begin), U64), _power_tables()[0]
    for a in range(0, len(begin), SLICE):
        at, n = begin[a:a + SLICE], size[a:a + SLICE]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = text[at[0]:at[-1] + n[-1]]
        out[a:a + SLICE] = np.add.reduceat(_TABLE[own] * power[place], at - at[0])
    return out


def _smaller(length: int):
    """Pass 3: dictionary, parse and suffix array of a shard; masks of strings with a smaller document."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        give_back()
        parts = [_load(d) for d in rows["data"]]
        count, doc, text = (np.concatenate(c) for c in zip(*parts))
        count = count.astype(np.int64)
        chunk = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        size = count + length - 1
        begin = np.cumsum(size) - size
        mark = _marks(_polynomials(text, begin, size), count)
        # the parse: occurrences of each distinct phrase, by document
        parse = np.lexsort((doc, mark))
        first = np.concatenate([[True], mark[parse][1:] != mark[parse][:-1]])
        words = parse[first]  # the dictionary
        entry = np.empty(len(mark), np.int64)
        entry[parse] = np.cumsum(first) - 1
        dictionary = _gather(text, begin[words], size[words])
        many = count[words]
        ahead = np.cumsum(many) - many  # strings before those of an entry
        at = np.repeat(np.cumsum(size[words]) - size[words], many) + np.arange(many.sum()) - np.repeat(ahead, many)
        order, run_of = suffix_order(dictionary, at, length)
        # runs of the order, with the parse: the smallest document of each string
        least_doc = np.repeat(doc[words], many)[order]
        starts = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]]))
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(least_doc, starts), np.diff(np.append(starts, len(order))))
        mask = np.zeros(len(mark), np.uint32)
        for j in range(int(count.max())):
            own = np.flatnonzero(count > j)
            mask[own] |= (least[ahead[entry[own]] + j] < doc[own]).astype(np.uint32) << np.uint32(j)
        own = np.flatnonzero(mask)
        out = [(rows["chunk"].iloc[c], _dump(mark[own[i]], mask[own[i]])) for c, i in _dealt(chunk[own], len(parts))]
        return pd.DataFrame(out, columns=HEARD.names)
    return run


def removed_bytes(ids: np.ndarray, p: Phrases, heard: list[bytes], hot: np.ndarray) -> np.ndarray:
    """Which bytes of a chunk go, from the masks that it heard and its own repeats."""
    p.split(hot)
    said = [_load(x) for x in heard]
    marks = np.concatenate([m for m, _ in said]) if said else np.zeros(0, U64)
    masks = np.concatenate([m for _, m in said]) if said else np.zeros(0, np.uint32)
    sort = np.argsort(marks)
    marks, masks = marks[sort], masks[sort]
    order = np.lexsort((ids[p.doc], p.mark))
    mark, doc = p.mark[order], ids[p.doc[order]]
    first = np.concatenate([[True], mark[1:] != mark[:-1]]) if len(mark) else np.zeros(0, bool)
    least = doc[first][np.cumsum(first) - 1] if len(mark) else doc
    mask = np.where(doc > least, np.uint32(2 ** MOST - 1), np.uint32(0))
    if len(marks):
        place = np.minimum(np.searchsorted(marks, mark), len(marks) - 1)
        mask |= np.where(marks[place] == mark, masks[place], np.uint32(0))
    start, count = p.start[order], p.count[order]
    gone = np.zeros(len(p.body), bool)
    for j in range(MOST):
        gone[start[(count > j) & ((mask >> np.uint32(j)) & np.uint32(1) == 1)] + j] = True
    # a byte goes if one of the last ``length`` places starts such a string
    have = 1
    while 2 * have <= p.length:
        gone[have:] |= gone[:-have].copy()
        have *= 2
    if have < p.length:
        gone[p.length - have:] |= gone[:have - p.length].copy()
    return gone


def _taken_out(length: int, digest: bool):
    """Pass 4: every row with counts and what is left of its text, or the digest of that."""
    def run(batches):
        for b in batches:
            for body, heard, first in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                rows, ids, sizes, p = _opened(body.as_py(), length)
                said = np.concatenate([_from_short(x) for x in first]) if first else np.zeros(0, U64)
                gone = removed_bytes(ids, p, heard or [], _key(said[_flag(said) == 1]))
                kept, removed, spans = [], [], []
                ends = np.cumsum(sizes)
                texts = rows.column(rows.schema.get_field_index("_text"))
                for i, (a, e) in enumerate(zip(ends - sizes, ends)):
                    own = gone[a:e]
                    removed.append(int(own.sum()))
                    spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                    raw = p.body[a:e][~own].tobytes() if removed[-1] else texts[i].as_py()
                    kept.append(hashlib.sha256(raw or b"").hexdigest() if digest else raw if raw is None else raw.decode("utf-8", "ignore"))
                rest = [i for i, n in enumerate(rows.schema.names) if n not in ("_text", "_id")]
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in rest] + [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())],
                                                 names=[rows.schema.names[i] for i in rest] + ["n_bytes", "n_removed", "n_spans", "kept"])
    return run


def dedup(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, digest: bool = False, hot_chunks: int = HOT_CHUNKS) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with n_bytes, n_removed, n_spans and ``kept``: the text that is left
    (characters that were cut through go), or with ``digest`` the SHA-256 of the bytes that are left."""
    spark, keep = docs.sparkSession, keep or [doc_id]
    total = text_bytes(docs, text)
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("binary").alias("_text"))
    chunks, _ = staged(src.mapInArrow(lean(_chunks), StructType([StructField("chunk", StringType()), StructField("body", BinaryType())])), "dedup-chunks")
    triggers = chunks.mapInArrow(lean(_triggers(length, units(total, TRIGGER_BYTES))), SENT)
    shared, _ = staged(triggers.groupBy("shard").applyInPandas(_shared(hot_chunks), HEARD), "dedup-triggers")
    release(spark)
    heard = shared.groupBy("chunk").agg(F.collect_list("data").alias("heard"))  # of one chunk: bounded by its size
    phrases = chunks.join(heard, "chunk").mapInArrow(lean(_phrases(length, units(total, PHRASE_BYTES))), SENT)
    masks, _ = staged(phrases.groupBy("shard").applyInPandas(_smaller(length), HEARD), "dedup-masks")
    release(spark)
    told = masks.groupBy("chunk").agg(F.collect_list("data").alias("told"))
    schema = StructType([f for f in src.schema.fields if f.name.startswith("k")] + [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [StructField("kept", StringType())])
    both = chunks.join(told, "chunk", "left").join(heard, "chunk", "left").select("chunk", "body", "told", "heard")
    return both.mapInArrow(lean(_taken_out(length, digest)), schema).toDF(*keep, "n_bytes", "n_removed", "n_spans", "kept")


def drop_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated strings taken out of ``text``; rows of which nothing is left go.  Columns stay as they are."""
    plain, text, doc_id, names = plainly(docs, text, doc_id)
    others = [c for c in plain.columns if c != text]
    left = dedup(plain, length, text, doc_id, keep=others).where("n_removed < n_bytes OR n_removed = 0")
    return left.withColumnRenamed("kept", text).select(*plain.columns).toDF(*names)
