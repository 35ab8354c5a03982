"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items build one automaton of all their substrings.  Training text
streams through it word by word; the state keeps the longest match that ends at the word.  Where it
reaches the window length, the window is hit, and the states above tell which items hold it.  An
item shorter than the window is matched whole.

Items are cut into blocks of at most ``BLOCK_WORDS`` words (long items overlap by a window less
one), so that one automaton has a bounded size, which is what is broadcast; several blocks are
passed one after the other over the same rows, without a shuffle.

Defined results: null and empty texts have no words and are clean; null and empty items have no
windows; items with equal ids count once; an item with a null id marks words but is not counted or
named; repeated rows give repeated results; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import lean, plainly, staged, words_of

#: Words of test items in one automaton: about 2 states and 600 bytes each in memory.
BLOCK_WORDS = 100_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """Substrings of word sequences, with the items that hold each window."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[tuple[int, list[bytes], str | None]] = []

    def _state(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word: bytes) -> int:
        new = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:  # another item has this prefix
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def add(self, words: list[bytes], item: str | None, whole: bool = True) -> None:
        """A word sequence of an item; ``whole`` is false for a part of a longer one."""
        last = 0
        for word in words:
            last = self._extend(last, word)
        if words and (len(words) >= self.window or whole):
            self.ends.append((len(words), words, item))

    def finish(self) -> "Automaton":
        """Marks states with the items whose windows they hold."""
        self.items: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        for n, words, item in self.ends:
            s = 0
            for i, word in enumerate(words):
                s = self.next[s][word]
                if i + 1 >= self.window:
                    t = s
                    while self.length[self.link[t]] >= self.window:
                        t = self.link[t]
                    self.items.setdefault(t, set()).add(item)
            if n < self.window:
                t = s
                while self.length[self.link[t]] >= n:
                    t = self.link[t]
                self.short.setdefault(t, {}).setdefault(n, set()).add(item)
        self.ends = []
        #: for each state the nearest state above that holds a window or a short item
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.above = [-1] * len(order)
        self.top = list(range(len(order)))
        for s in order[1:]:
            up = self.link[s]
            self.above[s] = s if s in self.short else self.above[up]
            if self.length[up] >= self.window:
                self.top[s] = self.top[up]
        return self

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans of words (start, end), merged, and the items whose windows occur."""
        follow, link, length, above, window = self.next, self.link, self.length, self.above, self.window
        root, s, n = follow[0], 0, 0
        spans: list[list[int]] = []
        items: set = set()
        for i, word in enumerate(words):
            t = follow[s].get(word)
            if t is None:
                if not s:
                    continue
                while t is None and s:
                    s = link[s]
                    t = follow[s].get(word)
                    n = length[s]
                if t is None:
                    s = n = 0
                    continue
            s, n = t, n + 1
            start = -1
            if n >= window:
                items |= self.items[self.top[s]]
                start = i + 1 - window
            up = above[s]
            while up >= 0:
                for size, own in self.short[up].items():
                    if size <= n:
                        items |= own
                        start = min(start, i + 1 - size) if start >= 0 else i + 1 - size
                up = above[link[up]]
            if start >= 0:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return [(a, b) for a, b in spans], items


def _automata(benchmark: DataFrame, window: int, item_id: str, text: str):
    """The automata of the benchmark's blocks, one at a time; a block is what one key of a bounded
    number of words brings to the driver."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    schema = StructType([StructField("item", StringType()), StructField("n", LongType()), StructField("whole", IntegerType()), StructField("words", BinaryType())])

    def parts(batches):
        step = BLOCK_WORDS // 10
        for b in batches:
            out: list[tuple] = []
            for item, raw in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(raw.as_py())
                for at in range(0, max(1, len(words) - window + 1), step):
                    own = words[at:at + step + window - 1]
                    if own:
                        out.append((item, len(own), int(len(own) == len(words)), b" ".join(own)))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out],
                                                 schema=pa.schema([("item", pa.string()), ("n", pa.int64()), ("whole", pa.int32()), ("words", pa.binary())]))
    pieces, _ = staged(rows.mapInArrow(parts, schema).distinct(), "benchmark-words")
    total = pieces.agg(F.sum("n").alias("n")).first()["n"] or 0
    # pieces hold a tenth of a block at most, so blocks dealt by hash stay near the bound
    blocks = max(1, -(-2 * total // BLOCK_WORDS)) if total > BLOCK_WORDS else 1
    for block in range(blocks if total else 0):
        own = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).orderBy("item", "words")
        auto = Automaton(window)
        for r in own.toLocalIterator():
            auto.add(bytes(r["words"]).split(), r["item"], bool(r["whole"]))
        yield auto.finish()


def _scanner(shared):
    def run(batches):
        auto = shared.value
        for b in batches:
            at, so_far, had = (b.schema.get_field_index(c) for c in ("_text", "_spans", "_items"))
            counts, spans, items = [], [], []
            texts = b.column(at)
            for i in range(len(texts)):
                words = words_of(texts[i].as_py())
                own, names = auto.scan(words)
                flat = b.column(so_far)[i].as_py() or []
                own = merged(list(zip(flat[::2], flat[1::2])) + own)
                counts.append(len(words))
                spans.append([x for span in own for x in span])
                items.append(sorted({n for n in names if n is not None} | set(b.column(had)[i].as_py() or [])))
            new = {"_n": pa.array(counts, pa.int64()), "_spans": pa.array(spans, pa.list_(pa.int32())), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(i)) for i, c in enumerate(b.schema.names)], names=b.schema.names)
    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """``keep`` columns (default doc_id) with ``n_words``, ``spans`` (starts and ends of hit runs of
    words, in turn) and ``items`` (ids, as sorted strings) of every row; the text too, if asked for."""
    spark, keep = docs.sparkSession, keep or ["doc_id"]
    state = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_text"),
                        F.lit(0).cast("long").alias("_n"), F.array().cast("array<int>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    automata = _automata(benchmark, window, item_id, item_text)
    auto = next(automata, None) or Automaton(window).finish()
    schema = StructType([StructField(f.name, f.dataType) for f in state.schema.fields])
    while auto is not None:
        state = state.mapInArrow(lean(_scanner(spark.sparkContext.broadcast(auto))), schema)
        auto = next(automata, None)
        if auto is not None:
            state, _ = staged(state, "decontamination")
    out = [F.col("_n").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items")]
    return state.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *out, *([F.col("_text").alias("_text")] if with_text else []))


def span_words():
    """Number of words in ``spans``."""
    return F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)


def _cut(batches):
    """Takes hit spans out of texts, with the blanks and signs between their words."""
    for b in batches:
        at, sp = b.schema.get_field_index("_text"), b.schema.get_field_index("spans")
        out = []
        for raw, flat in zip(b.column(at), b.column(sp)):
            raw, flat = raw.as_py(), flat.as_py()
            if raw is not None and flat:
                places = [(m.start(), m.end()) for m in WORD.finditer(raw)]
                done, parts = 0, []
                for a, e in zip(flat[::2], flat[1::2]):
                    parts.append(raw[done:places[a][0]])
                    done = places[e - 1][1]
                raw = b"".join(parts) + raw[done:]
            out.append(None if raw is None else raw.decode("utf-8", "replace"))
        rest = [i for i in range(b.num_columns) if i not in (at, sp)]
        yield pa.RecordBatch.from_arrays([b.column(i) for i in rest] + [pa.array(out, pa.string())], names=[b.schema.names[i] for i in rest] + ["_clean"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, coverage: float = 0.5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without test passages: rows of which more than ``coverage`` of the words are hit go;
    in the others the hit spans are cut out of ``text``.  Columns stay as they are."""
    plain, text, _, names = plainly(docs, text, doc_id)
    others = [c for c in plain.columns if c != text]
    hits = find_hits(plain, benchmark, window, text, keep=others, with_text=True)
    kept = hits.where(span_words() <= F.lit(coverage) * F.col("n_words")).drop("n_words", "items")
    schema = StructType([f for f in kept.schema.fields if f.name in others] + [StructField("_clean", StringType())])
    done = kept.mapInArrow(lean(_cut), schema).withColumnRenamed("_clean", text)
    return done.select(*plain.columns).toDF(*names)
