"""Byte-level BPE, filter audit and hard negatives against libraries, SQL and brute force."""

import base64
import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from conftest import SF_SMALL
from terrace.llm import byte_bpe, filter_audit, hard_negatives, unit_words
from terrace.llm.catalogue import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ------------------------------------------------------------------ byte-level BPE


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_digests_equal_the_library(spark, library):
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_byte_bpe"](spark, SF_SMALL).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        assert got[doc_id] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids)))


def test_replay_equals_the_library_on_odd_pieces(library):
    rng = random.Random(5)
    own = byte_bpe.ranks(RANKS)
    words = {bytes(rng.choice(alphabet) for _ in range(rng.randint(1, n))) for alphabet, n in ((b"ab", 30), (b"aeinrst ", 14), (bytes(range(256)), 9)) for _ in range(4000)}
    words |= {b"".join(own.token[rng.randrange(50_000)] for _ in range(3)) for _ in range(4000)} | {b"a" * 5000, b"ab" * 3000}
    words = sorted(words)
    assert [r.tolist() for r in own.replay(words)] == [library._core_bpe.encode_single_piece(w) for w in words]


def test_a_merge_that_brings_up_a_lower_rank_goes_on_there():
    """With made-up ranks: joining b and c brings up a+bc, which has a lower rank than b+c."""
    singles = {bytes([b]): b + 10 for b in range(256)}
    for ranks in (singles | {b"abc": 3, b"bc": 5, b"ca": 6}, singles | {b"abc": 3, b"bc": 5, b"cabc": 1}, singles | {b"aa": 4, b"aaa": 3}):
        own = byte_bpe.Ranks.__new__(byte_bpe.Ranks)
        own.of, own.most = ranks, 300
        own.token = {i: t for t, i in ranks.items()}
        own.single = [ranks[bytes([b])] for b in range(256)]
        own.pair = {ranks[t[:i]] * 300 + ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        for word in (b"abcabc", b"bcabca", b"abcbcabc", b"aaaaa", b"aaaaaaa"):
            parts = [word[i:i + 1] for i in range(len(word))]
            while True:
                joined = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not joined or word in ranks:
                    break
                i = min(joined)[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            assert own.replay([word])[0].tolist() == ([ranks[word]] if word in ranks else [ranks[p] for p in parts])


def test_pieces_of_any_character(library):
    rng = random.Random(9)
    letters = [chr(c) for c in (*range(0x3000), *range(0xA000, 0xD800, 7), *range(0x10000, 0x33480, 11))]
    for at in range(0, len(letters), 40):
        text = "".join(rng.choice(("a", "1", " ", "'", "\n", "", "'s")) + c for c in letters[at:at + 40])
        assert "".join(byte_bpe.pieces(text)) == text
        assert [i for p in byte_bpe.pieces(text) for i in library._core_bpe.encode_single_piece(p.encode())] == library.encode_ordinary(text)


@pytest.mark.parametrize("small", [False, True])
def test_round_trip_of_odd_rows(spark, library, monkeypatch, small):
    if small:   # many units and shards
        monkeypatch.setattr(unit_words, "SHARD_BYTES", 500)
        monkeypatch.setattr(byte_bpe, "UNIT_BYTES", 100)
    texts = [None, "", " ", "a", "a", "<|endoftext|> is text", "x" * 20_000, "word " * 9000, "Ünïcödé 東京 \U0001f600́\n\n  end", "it's  they'll\t\r\n"]
    rows = [(i % 4 if i % 3 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    got = byte_bpe.encode(docs, RANKS, keep=["doc_id", "n_tokens", "text"])
    assert got.columns == ["doc_id", "n_tokens", "text", "n_tokens_", "ids", "decoded"]
    found = got.collect()
    assert sorted((repr(r[0]), r[1], r[2]) for r in found) == sorted((repr(a), c, b) for a, b, c in rows)
    for r in found:
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and r["decoded"] == (r["text"] or "") and r["n_tokens_"] == len(r["ids"])
    back = byte_bpe.decode(got.select("text", "ids"), RANKS)
    assert all(r["decoded"].decode() == (r["text"] or "") for r in back.collect())
    assert byte_bpe.encode(docs.limit(0), RANKS).count() == 0


# ------------------------------------------------------------------ filter audit


def brute_audit(rows, labels):
    """rows: (doc_id, part, text); labels: (doc_id, quality, toxic)."""
    good, toxic = ({label[0] for label in labels if label[c] == 1 and label[0] is not None} for c in (1, 2))
    docs = []
    for i, part, text in rows:
        text = text or ""
        words = [w for w in re.split(r"[ \t-\r]+", text) if w]
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": re.search(r"[#$%&*|]", text) is not None, "E": any(i is not None and j is not None and j < i and (t or "") == text for j, _, t in rows)}
        docs.append((part or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        figures = {}
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                figures["".join(order), step] = (len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                                                 sum(d[2] for d in gone), sum(d[3] for d in gone))
        for (order, step), found in figures.items():
            f = order[step - 1]
            out.append((part, order, step, *found, sum(v[1] for (o, s), v in figures.items() if o[s - 1] == f)))
    return sorted(out)


def test_audit_counts_the_words_of_many_texts_together():
    texts = [None, b"", b" \x0b", b"a b a \t\r\na\x0cc", "\x1c \x85 é\u3000é日 本".encode(), b"\xff\xfe a", b"  lead b", b"long" * 99]
    asked, numbers = [], unit_words.Numbers()

    class Asked(dict):
        def __getitem__(self, word):
            asked.append(word)
            return numbers[word]
    rows = filter_audit._rows(pa.array([b"cut", *texts, *texts], pa.binary()).slice(1), Asked())
    assert len(asked) == len(numbers) and set(asked) == {w for t in texts for w in (t or b"").split()}   # each word once
    for text, row in zip([*texts, *texts], rows, strict=True):
        ids, counts = np.frombuffer(row, np.uint32).reshape(2, -1)
        want = Counter((text or b"").split())
        assert ids.tolist() == sorted(numbers[w] for w in want) and dict(zip(ids.tolist(), counts.tolist())) == {numbers[w]: n for w, n in want.items()}
    assert filter_audit._rows(pa.array([], pa.binary()), Asked()) == []


@pytest.mark.parametrize("small", [False, True])
def test_audit_of_odd_rows(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(unit_words, "SHARD_BYTES", 2000)
        monkeypatch.setattr(filter_audit, "UNIT_BYTES", 1500)
    rng = random.Random(11)
    long = " ".join(f"w{i}" for i in range(150))
    texts = [None, "", " \t\n", long, long, long + " $", "A" * 9 + "b" * 81, "a" * 50_000, "same words " * 80, "é" * 9 + "É", "w x \x1f y", "x\x0by", long.upper()]
    rows = [(rng.choice([None, 1, 2, 3, 4, 50]) if i % 2 else i, rng.choice(["en", "de", None, ""]), rng.choice(texts)) for i in range(120)]
    labels = [(1, 1, 0), (1, 0, 1), (2, 0, 1), (None, 1, 1), (4, None, None), (50, 1, 1), (6, 1, 0), (777, 1, 1)]
    docs = spark.createDataFrame([(i, p, t, 0, "z") for i, p, t in rows], "doc_id long, lang string, text string, n_words int, digest string").repartition(3)
    marks = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int, part int")
    got = filter_audit.audit(docs, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert {r["good_lost"] for r in filter_audit.audit(docs, marks.limit(0)).collect()} == {0}


def test_matrix_rows_are_the_documents(spark, monkeypatch):
    monkeypatch.setattr(unit_words, "SHARD_BYTES", 300)
    monkeypatch.setattr(filter_audit, "UNIT_BYTES", 200)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "The", "ünï", "c", "x" * 40, "\U0001f600"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    matrix = filter_audit.document_term_matrix(docs)
    words = {r["word_id"]: r["word"] for r in matrix.dictionary.collect()}
    assert len(words) == matrix.dictionary.count() == len(set(" ".join(texts).split()))
    seen = {}
    for shard in matrix.shards.collect():
        indices, counts = unit_words.unpack(shard["data"])
        for row, a, b in zip(shard["rows"], shard["indptr"], shard["indptr"][1:]):
            assert list(indices[a:b]) == sorted(indices[a:b])
            seen[row["k0"]] = {words[i]: c for i, c in zip(indices[a:b].tolist(), counts[a:b].tolist())}
    assert seen == {i: dict(Counter(t.split())) for i, t in enumerate(texts)}


# ------------------------------------------------------------------ hard negatives


def brute_negatives(rows, anchors, low=30, high=90):
    """rows: (id, label, whole numbers); anchors: places in rows."""
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for a_id, a_label, a_vec in {(rows[i][0], rows[i][1], tuple(rows[i][2])) for i in anchors}:
        scored = sorted((-dot(a_vec, v), i, label == a_label) for i, label, v in rows if (i, label, tuple(v)) != (a_id, a_label, a_vec))
        for s, p, same in [x for x in scored if x[2]][:5]:
            fits = [(n, t) for t, n, other in scored if not other and low * -s <= 100 * -t <= high * -s][:10]
            out += [(a_id, p, r, n, -s, -t) for r, (n, t) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [None, 7])
def test_negatives_are_exact(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
        monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", size)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    rng = random.Random(3)
    one = [rng.choice([0.25, 0.5]) for _ in range(6)]
    data = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.choice([-1.0, -0.3, 0.0, 0.2, 0.7]) for _ in range(6)]) for i in range(150)]
    data += [(i, i % 3, one) for i in range(300, 360)]   # one vector many times
    data += [(400, 1, None), (500, 1, [1.0, None]), (600, 1, [float("nan")]), (700, 1, [float("inf")]), (None, 1, [1.0]), (800, None, [1.0]), (900, 1, []), (1000, 1, [1.0, 2.0])]
    data += [(100, 2, [0.9] * 6), (100, 2, [0.1] * 6), (300, 0, one), (1100, 7, [0.5] * 6), (50, 1, [0.7] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, label int, embedding array<float>, anchor string, score int").repartition(3)
    try:
        vectors = hard_negatives.whole_numbers(df, "vec_id", "label", "embedding")
        got = sorted(tuple(r) for r in hard_negatives.mine(vectors, vectors.where("id % 100 = 0")).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (6 - len(v))) for i, label, v in data
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert got == brute_negatives(rows, [i for i, r in enumerate(rows) if r[0] % 100 == 0])
    assert any(r[4] == 0 for r in got)   # windows of score 0 were met


def test_negatives_of_none(spark):
    df = spark.createDataFrame([(0, 1, [1.0]), (1, 2, [0.5])], "vec_id long, label int, embedding array<float>")
    v = hard_negatives.whole_numbers(df, "vec_id", "label", "embedding")
    assert hard_negatives.mine(v, v.where("id = 0")).count() == 0      # no positive
    assert hard_negatives.mine(v.limit(0), v.limit(0)).count() == 0


def test_products_beyond_floating_point():
    a, b = np.array([[2 ** 30, 1]]), np.array([[2 ** 30, 1], [2 ** 30, 0]])
    assert hard_negatives.products(a, b).tolist() == [[2 ** 60 + 1, 2 ** 60]]
