"""BPE encoding and decoding with a pair occurrence index.

All distinct pieces of a batch of texts that are not yet known to the worker are merged together:
the index holds the rank of the pair at every position, and in each round every piece's lowest rank is
applied at all its positions, from the left, before the index of the neighbours is brought up to date.
For short pieces, nearly all of them, the index is an array and a round works on all pieces at once; for
long ones it maps every rank to its positions, and a heap holds the active ranks.

Defined results: a null text counts as empty and has no tokens; an empty text has no tokens; text
of any length is encoded whole; repeated rows give repeated results; added tokens written out in a
text become their ids, as the tokenizers library does by default; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import bounded_batches, lean

# The piece pattern of the vocabulary file, and the same for ASCII text.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
YOUNG_PIECE = pre_tokenizers.Split(Regex(PIECE.pattern), "removed", invert=True)
NFC = normalizers.NFC()
YOUNG_LOWER = normalizers.Lowercase()
#: Pieces whose tokens a worker remembers in each of two generations: when the younger is full, it
#: becomes the older, so pieces that come often stay.
REMEMBERED = 80_000
#: Bytes of a short piece: it takes fewer rounds than this.
SHORT = 48
#: The rank of a pair that is never merged.
NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Codec:
    """Encoder and decoder for a vocabulary file of the tokenizers library: BPE with word ends."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.added.items()})
        self.split = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        #: (left id, right id) -> (rank, merged id)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.by_rank: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = self.vocab[a], self.vocab[b]
            self.merge[ids] = (rank, self.vocab[a + b])
            self.by_rank.append((*ids, self.vocab[a + b]))
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.end] for c in letters]
        #: the same as arrays: ids of the bytes, pairs as one number in ascending order with their ranks, and merged ids by rank
        self.inner_ids, self.last_ids = np.array(self.inner, np.int32), np.array(self.last, np.int32)
        self.span = max(self.token, default=0) + 1
        pairs = np.array([a * self.span + b for a, b in self.merge] + [-1], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], np.array([rank for rank, _ in self.merge.values()] + [NEVER], np.int32)[order]
        self.merged = np.array([new for _, _, new in self.by_rank], np.int32)
        self.digits = {i: str(i) for i in self.token}
        #: piece (or id of an added token) -> (number of tokens, ids joined by blanks, tokens joined by blanks)
        self.known: dict[str | int, tuple[int, str, str]] = {}
        self.older: dict[str | int, tuple[int, str, str]] = {}

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without added tokens: NFC, lower case by character, pattern matches.

        The Unicode tables of the tokenizers library are older in NFC and younger in classes than
        those of Python, so texts that differ by them go through the library's own tables."""
        if text.isascii():
            return ASCII_PIECE.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = NFC.normalize_str(text)
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            return [p for p, _ in YOUNG_PIECE.pre_tokenize_str(YOUNG_LOWER.normalize_str(text))]
        return PIECE.findall(text.replace("Σ", "σ").lower())

    def merge_all(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece, by one pair occurrence index over all short and one over all long ones."""
        raw = [p.encode() for p in pieces]
        out: list[list[int]] = [[]] * len(raw)
        for merging, own in ((self._merge_short, [i for i, r in enumerate(raw) if len(r) <= SHORT]), (self._merge_long, [i for i, r in enumerate(raw) if len(r) > SHORT])):
            if own:
                for i, ids in zip(own, merging([raw[i] for i in own])):
                    out[i] = ids
        return out

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids."""
        keys = left.astype(np.int64) * self.span + right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.ranks[at], NEVER)

    def _merge_short(self, raw: list[bytes]) -> list[list[int]]:
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        piece = np.repeat(np.arange(len(raw)), sizes)          # of each position
        last = np.cumsum(sizes) - 1                            # each piece's last position
        ids = self.inner_ids[data]
        ids[last] = self.last_ids[data[last]]
        rank = np.full(len(ids), NEVER, np.int32)              # of the pair that begins at each position
        rank[:-1] = self._rank_of(ids[:-1], ids[1:])
        rank[last] = NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            lengths = np.diff(np.append(first, len(ids)))
            lowest = np.minimum.reduceat(rank, first)
            going = np.repeat(lowest != NEVER, lengths)
            if not going.all():
                done.append((piece[~going], ids[~going]))
                piece, ids, rank, lowest, lengths = piece[going], ids[going], rank[going], lowest[lowest != NEVER], lengths[lowest != NEVER]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # pairs that overlap (a a a) follow one another: from the left, every other one is merged
            run = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            ids[at] = self.merged[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))                      # where the merged ids are after the others went
            piece, ids, rank = piece[keep], ids[keep], rank[keep]
            near = np.concatenate([now, now[now > 0] - 1])
            rank[near] = NEVER
            near = near[near + 1 < len(ids)]
            near = near[piece[near] == piece[near + 1]]
            rank[near] = self._rank_of(ids[near], ids[near + 1])
        piece, ids = (np.concatenate(parts) for parts in zip(*done))
        ids = ids[np.argsort(piece, kind="stable")].tolist()
        ends = np.cumsum(np.bincount(piece, minlength=len(raw))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, pieces: list[bytes]) -> list[list[int]]:
        ids: list[int] = []
        prev: list[int] = []
        after: list[int] = []
        starts: list[int] = []
        where: dict[int, list[int]] = {}
        merge, inner, last = self.merge, self.inner, self.last
        for raw in pieces:
            at = len(ids)
            starts.append(at)
            n = len(raw)
            ids.extend([inner[b] for b in raw[:-1]])
            ids.append(last[raw[-1]])
            prev.extend(range(at - 1, at + n - 1))
            after.extend(range(at + 1, at + n + 1))
            prev[at] = after[at + n - 1] = -1
            for p in range(at, at + n - 1):
                found = merge.get((ids[p], ids[p + 1]))
                if found is not None:
                    where.setdefault(found[0], []).append(p)
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.by_rank[rank]
            for p in sorted(where.pop(rank)):
                q = after[p]
                if ids[p] != a or q < 0 or ids[q] != b:
                    continue  # another merge took one of the two
                ids[p], ids[q] = new, -1
                after[p] = r = after[q]
                if r >= 0:
                    prev[r] = p
                for left, right in ((prev[p], p), (p, r)):
                    if left >= 0 and right >= 0:
                        found = merge.get((ids[left], ids[right]))
                        if found is not None:
                            if found[0] not in where:
                                where[found[0]] = []
                                heapq.heappush(active, found[0])
                            where[found[0]].append(left)
        out = []
        for at in starts:
            own = []
            while at >= 0:
                own.append(ids[at])
                at = after[at]
            out.append(own)
        return out

    def learn(self, pieces: set[str | int]) -> None:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, new, digits, token = self.known, self.older, [], self.digits, self.token
        for piece in pieces.difference(known):
            if piece in older:
                known[piece] = older[piece]
            elif piece.__class__ is str:
                new.append(piece)
            else:
                known[piece] = (1, digits[piece], token[piece])
        for piece, ids in zip(new, self.merge_all(new)):
            known[piece] = (len(ids), " ".join([digits[i] for i in ids]), " ".join([token[i] for i in ids]))

    def encode_batch(self, texts: list[str | None]):
        """Yields (number of tokens, ids joined by blanks, decoded text) for each text."""
        split = [self._pieces_and_added(t or "") for t in texts]
        self.learn(set().union(*split))
        find = self.known.__getitem__
        for own in split:
            n, ids, decoded = zip(*map(find, own)) if own else ((), (), ())
            yield sum(n), " ".join(ids), " ".join(decoded)

    def _pieces_and_added(self, text: str) -> list[str | int]:
        if self.split is None or "<|" not in text and not self.split.search(text):
            return self.pieces(text)
        out: list[str | int] = []
        for i, part in enumerate(self.split.split(text)):
            if i % 2:
                out.append(self.added[part])
            elif part:
                out.extend(self.pieces(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library without a decoder: the tokens joined by blanks; unknown ids are left out."""
        return " ".join([self.token[i] for i in ids if i in self.token])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _batches(texts: pa.Array, most: int = 1_000_000):
    """Runs of texts of about ``most`` characters, so that memory stays bounded."""
    part, size = [], 0
    for t in texts:
        part.append(t.as_py())
        size += len(part[-1] or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: Result columns: Arrow type, Spark type, and how each comes from the ids joined by blanks and the decoded text.
RESULTS = {
    "ids": (pa.list_(pa.int32()), ArrayType(IntegerType()), lambda ids, decoded: np.array(ids.split(), np.int32)),
    "decoded": (pa.string(), StringType(), lambda ids, decoded: decoded),
    "ids_sha256": (pa.string(), StringType(), lambda ids, decoded: _sha256(ids)),
    "decoded_sha256": (pa.string(), StringType(), lambda ids, decoded: _sha256(decoded)),
}


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None, results: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``keep`` columns (default doc_id) of every row with ``n_tokens`` and the asked-for ``results``: ids (array of
    int), decoded text, and their SHA-256 (ids_sha256, decoded_sha256).  What is not asked for never leaves the worker."""
    bounded_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = StructType([f for f in src.schema.fields if f.name != "_text"]
                        + [StructField("n_tokens", LongType())] + [StructField(r, RESULTS[r][1]) for r in results])

    def run(batches):
        own = codec(tokenizer_path)
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            rest, done = [i for i in range(batch.num_columns) if i != at], 0
            for part in _batches(batch.column(at)):
                n: list[int] = []
                columns: list[list] = [[] for _ in results]
                for count, ids, decoded in own.encode_batch(part):
                    n.append(count)
                    for column, result in zip(columns, results):
                        column.append(RESULTS[result][2](ids, decoded))
                arrays = [pa.array(n, pa.int64())] + [pa.array(c, RESULTS[r][0]) for c, r in zip(columns, results)]
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(done, len(part)) for i in rest] + arrays,
                                                 names=[batch.schema.names[i] for i in rest] + ["n_tokens", *results])
                done += len(part)
    return src.mapInArrow(lean(run), schema).toDF(*keep, "n_tokens", *results)


def encode_digest(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Number of tokens and SHA-256 of ids and decoded text."""
    return encode(docs, tokenizer_path, text, keep, ("ids_sha256", "decoded_sha256"))
