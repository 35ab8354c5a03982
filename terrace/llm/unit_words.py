"""Words of a corpus met once: local dictionaries of units of text, dealt to shards and brought back.

A unit is a run of documents that one task reads.  The task numbers the unit's distinct words in the
order in which they come, and sends each word once, to the shard its hash names.  A shard gathers a
word from all units that hold it, works out one result for it, and sends that back to each of them,
where it is written as one array per unit to the cluster's shared folder.  A word of every document
thus crosses the network once for a unit, not once for an occurrence, and no task holds more than a
unit or a shard; both grow with the input in number, not in size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import lean, staged, units
from .shared_arrays import write_array

#: UTF-8 bytes of text in a unit (one longer text is a unit of its own), and of all texts for each shard of words.
UNIT_BYTES, SHARD_BYTES = 32 << 20, 32 << 20
#: Rows that a task hands to its shard: ``data`` holds local numbers and words.
DEALT = [StructField("unit", LongType()), StructField("shard", IntegerType()), StructField("data", BinaryType())]
BACK = StructType([StructField("unit", LongType()), StructField("data", BinaryType())])


class Numbers(dict):
    """Gives every new word the next number."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed string of bytes."""
    head = "".join(f"{a.dtype.str}{len(a)};" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=3).compress(head + b"\n" + body)


def unpack(raw: bytes) -> list[np.ndarray]:
    head, _, body = zstandard.ZstdDecompressor().decompress(raw).partition(b"\n")
    out, at = [], 0
    for spec in head.decode().split(";")[:-1]:
        kind, n = np.dtype(spec[:3]), int(spec[3:])
        out.append(np.frombuffer(body, kind, n, at))
        at += n * kind.itemsize
    return out


def pack_words(local: np.ndarray, words: list[bytes]) -> bytes:
    """Words with their ascending local numbers, which are kept as steps."""
    lengths = np.fromiter(map(len, words), np.uint32, len(words))
    return pack(np.diff(local, prepend=0).astype(np.uint32), lengths, np.frombuffer(b"".join(words), np.uint8))


def unpack_words(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    steps, lengths, letters = unpack(raw)
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    text = letters.tobytes()
    return np.cumsum(steps, dtype=np.int64), [text[a:b] for a, b in zip([0, *ends], ends)]


def next_units():
    """Numbers for the units of this task: the same whenever the task is run again."""
    context = TaskContext.get()
    unit = (context.partitionId() if context else 0) << 32
    while True:
        yield unit
        unit += 1


def deal(words: list[bytes], shards: int):
    """(shard, data) for a unit's words; a word's number is its place in the list."""
    where = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(shards)
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order])) + 1
    for local in np.split(order, cuts) if len(words) else []:
        yield int(where[local[0]]), pack_words(local, [words[i] for i in local.tolist()])


def shard_count(total_bytes: int) -> int:
    return units(total_bytes, SHARD_BYTES)


def at_shards(dealt: DataFrame, work, extra: StructType | None = None):
    """Runs ``work(shard, words)`` on the distinct words of each shard, in byte order.  It returns one
    array of numbers per word (a list, or rows of one array), or these and an Arrow table of ``extra`` rows.
    The result has the rows of BACK; rows with ``extra`` columns carry no ``data``."""
    schema = StructType([*BACK.fields, *(extra.fields if extra else [])])

    def run(key, table):
        found = [unpack_words(raw.as_py()) for raw in table.column("data")]
        words = sorted({w for _, own in found for w in own})
        results = work(key[0].as_py(), words)
        results, rows = results if extra else (results, None)
        place = {w: i for i, w in enumerate(words)}
        sizes = np.fromiter(map(len, results), np.uint32, len(results))
        flat = results.ravel() if isinstance(results, np.ndarray) else np.concatenate([np.zeros(0, np.int64), *results])
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        data = []
        for local, own in found:
            at = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
            n = sizes[at]
            took = np.repeat(starts[at] - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(int(n.sum()))
            data.append(pack(np.diff(local, prepend=0).astype(np.uint32), n, flat[took]))
        out = pa.table({"unit": table.column("unit"), "data": pa.array(data, pa.binary())})
        for field in extra.fields if extra else []:
            out = out.append_column(field.name, pa.nulls(len(out), rows.schema.field(field.name).type))
        if extra and len(rows):
            none = pa.table({"unit": pa.nulls(len(rows), pa.int64()), "data": pa.nulls(len(rows), pa.binary())})
            for field in extra.fields:
                none = none.append_column(field.name, rows.column(field.name))
            out = pa.concat_tables([out, none])
        return out

    return dealt.where(F.col("shard").isNotNull()).select("unit", "shard", "data").groupBy("shard").applyInArrow(run, schema)


def to_units(back: DataFrame, folder: str, dtype) -> None:
    """Writes each unit's results to ``folder``: the array ``<unit>-n`` holds the number of figures of
    each word, ``<unit>-figures`` the figures, both in the order of the local numbers."""
    def run(key, table):
        parts = [unpack(raw.as_py()) for raw in table.column("data")]
        local = np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in parts])
        n = np.concatenate([p[1] for p in parts])
        flat = np.concatenate([p[2] for p in parts])
        order = np.argsort(local)
        starts = (np.cumsum(n, dtype=np.int64) - n)[order]
        n = n[order]
        took = np.repeat(starts - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(int(n.sum()))
        unit = key[0].as_py()
        write_array(folder, f"{unit}-n", n.astype(np.uint32))
        write_array(folder, f"{unit}-figures", flat[took].astype(dtype))
        return pa.table({"unit": pa.array([unit], pa.int64())})

    done = back.where(F.col("unit").isNotNull()).select("unit", "data").groupBy("unit").applyInArrow(run, StructType(BACK.fields[:1]))
    staged(done, "units-done")


__all__ = ["BACK", "DEALT", "Numbers", "UNIT_BYTES", "at_shards", "deal", "lean", "next_units", "pack", "shard_count", "to_units", "unpack"]
