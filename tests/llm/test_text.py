"""BPE, decontamination, SimHash and suffix-array dedup against brute force and the given libraries."""

import hashlib
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from pyspark.sql import functions as F
from terrace.llm import bpe, decontaminate, simhash, suffix_dedup
from terrace.llm.components import components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, _text string, spans string, fp string, k0 string, n_words string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, texts, ids=None):
    """Rows with columns whose names an operator might use itself."""
    rows = [(i, t, "x", "y", "z", "k", "n") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


# ------------------------------------------------------------------ BPE

HARD = [None, "", " ", "Hello, world's I'LL don't 123", "<|endoftext|>a<|startoftext|> <|end", "aaaaaaaaaaaaaaaaaaab" * 300,
        "ΑΣΣ İstanbul ǅ", "é é ö̈", "日本語 текст ١٢٣ ½", "\x1c\x1d\x85᠎​ x", "\U000198cf ͨ᷶", "tab\tline\nline"]


def test_bpe_as_the_library(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(TOKENIZER)
    rows = bpe.encode(docs_of(spark, HARD), TOKENIZER, results=("ids", "decoded", "ids_sha256", "decoded_sha256")).orderBy("doc_id").collect()
    for text, row in zip(HARD, rows):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == lib.decode(ids, skip_special_tokens=False) == bpe.codec(TOKENIZER).decode(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_bpe_any_text(texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(TOKENIZER)
    for text, (n, ids, decoded) in zip(texts, bpe.codec(TOKENIZER).encode_batch(texts)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want)
        assert decoded == lib.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aabbcnéthe日ıß🙂", min_size=1, max_size=70), min_size=1, max_size=30))
def test_bpe_rounds_over_all_pieces_merge_as_the_heap(pieces):
    own, raw = bpe.codec(TOKENIZER), [p.encode() for p in [*pieces, "a" * 9, "x"]]
    assert own._merge_short(raw) == own._merge_long(raw) == own.merge_all([r.decode() for r in raw])


def test_bpe_forgets_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Codec(TOKENIZER)
    first = list(own.encode_batch(["one two three four five six"]))
    assert list(own.encode_batch(["seven eight", "one two three four five six"]))[1] == first[0]
    assert bpe.encode(docs_of(spark, []), TOKENIZER).count() == 0


# ------------------------------------------------------------------ decontamination


def brute_hits(words, items, window):
    hit, found = set(), set()
    for name, own in items:
        size = min(window, len(own))
        for a in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == own[a:a + size]:
                    hit.update(range(i, i + size))
                    found.add(name)
    return hit, found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), max_size=4), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=40), st.integers(1, 5))
def test_automaton_finds_all_windows(items, words, window):
    auto = decontaminate.Automaton(window)
    for i, own in enumerate(items):
        auto.add(own, str(i))
    spans, found = auto.finish().scan(words)
    hit, names = brute_hits(words, [(str(i), own) for i, own in enumerate(items)], window)
    assert {x for a, b in spans for x in range(a, b)} == hit and found == names
    assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (1, "One two three four five six seven eight nine ten eleven"),
         (2, "short item"), (3, None), (4, ""), (None, "nameless words here"), (5, "Ünï cödé, " * 12)]
LEAKS = ["x one TWO three, four five six seven eight nine ten y", "a short item and a short, item", None, "", "clean text", "nameless words here!",
         "Ünï cödé " * 7, "one two three four five six seven eight nine", "w " * 3000 + "two three four five six seven eight nine ten eleven"]


@pytest.mark.parametrize("block", [100_000, 40])
def test_hits_with_nulls_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_hits(docs_of(spark, LEAKS), bench).orderBy("doc_id").collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = [(str(i) if i is not None else None, word.findall((t or "").translate(LOWER))) for i, t in ITEMS]
    for text, row in zip(LEAKS, got):
        words = word.findall((text or "").translate(LOWER))
        hit, names = brute_hits(words, split, 10)
        assert row["n_words"] == len(words)
        assert {x for a, b in zip(row["spans"][::2], row["spans"][1::2]) for x in range(a, b)} == hit
        assert row["items"] == sorted(n for n in names if n)


def test_spans_are_cut_and_covered_rows_go(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, LEAKS)
    out = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert list(out[4].asDict()) == docs.columns and out[4]["text"] == "clean text" and out[2]["text"] is None and out[3]["text"] == ""
    assert 0 not in out and 1 not in out and 5 not in out  # mostly test items
    assert out[8]["text"] == "w " * 3000 and out[8]["spans"] == "y"
    assert out[7]["text"] == LEAKS[7]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, empty).count() == len(LEAKS)
    assert decontaminate.find_hits(docs.limit(0), bench).count() == 0


# ------------------------------------------------------------------ SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aBc \t\n\x0bé ", max_size=60)))
def test_fingerprint(text):
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got & (2 ** 64 - 1) == brute_fingerprint(text)


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97} x{i}" for i in range(2000))
    monkeypatch.setattr(simhash, "PIECE", 500)
    assert simhash.fingerprint(text.encode()) & (2 ** 64 - 1) == brute_fingerprint(text)


@pytest.mark.parametrize("bucket", [512, 3])
def test_links_lose_nothing(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    fps = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(20):  # dense groups: chains of one to three flipped bits
            fps.add(centre)
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.links(df, 2)
    assert all(((r["a"] ^ r["b"]) & (2 ** 64 - 1)).bit_count() <= 2 for r in links.collect())
    roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    want = brute_components(dict(enumerate(fps)), list(range(len(fps))))
    groups = {}
    for i, f in enumerate(fps):
        s = simhash._signed(f)
        groups.setdefault(want[i], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_near_duplicates_with_nulls_and_ties(spark):
    texts = ["The same text of some words here", None, "", "the same TEXT of some words here", " \t", "another one entirely different now", "two words", "two  words"]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_components(fps, list(fps))
    assert {i: (r["fp"] & (2 ** 64 - 1), r["component_id"]) for i, r in got.items()} == {i: (fps[i], want[i]) for i in fps}
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_bare_rows(spark):
    docs = docs_of(spark, ["a b c d", "a b c d", "a b c d", "x y z", "p q r", "p q r", "s t u", "s t u"], [3, 1, 1, 2, None, None, None, 9])
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in out.where("doc_id IS NOT NULL").collect()) == [(False, 1, "a b c d"), (False, 2, "x y z"), (False, 9, "s t u")]
    assert [r["text"] for r in out.where("doc_id IS NULL").collect()] == ["p q r"]


def test_one_of_each_tells_texts_of_one_id_apart(spark):
    docs = docs_of(spark, ["a b c d", "q w e r t", "a b c d", "q w e r t", "q w e r t", "solo one text"], [1, 1, 2, 1, 7, 3])
    out = simhash.one_of_each(docs)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "a b c d"), (1, "q w e r t"), (3, "solo one text")]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 260)}


# ------------------------------------------------------------------ suffix-array dedup


def brute_removed(rows, length=50):
    first = {}
    for i, b in rows:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = b"\x01" * length
        out.append((i, bytes(gone)))
    return out


def fixture_texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "délta", "e"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(30), "= " * 40
    texts = [text(60), passage + text(40), text(20) + passage, line + text(5), line, None, "", "short", "ab" * 400, "ab" * 300 + "c", passage[:49], passage[:50], text(900), text(900)]
    return texts + [t for t in texts[:4]] + [text(10) + texts[12][300:700] + text(10)]


@pytest.mark.parametrize("hot,chunk", [(2000, 4_000_000), (0, 300), (1, 1500)])
def test_repeats_as_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    texts = fixture_texts()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    ids[3] = ids[4]  # equal ids do not count for each other
    got = suffix_dedup.dedup(docs_of(spark, texts, ids).repartition(3, "text"), hot_chunks=hot, digest=True).collect()
    want = []
    for t, (i, gone) in zip(texts, brute_removed([(i, (t or "").encode()) for i, t in zip(ids, texts)])):
        raw = (t or "").encode()
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        want.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def passes_here(texts, ids, shards, hot):
    """The four passes in this process, one chunk for each text: removed bytes by id."""
    import pandas as pd
    import pyarrow as pa
    chunks = []
    for i, t in zip(ids, texts):
        rows = pa.RecordBatch.from_arrays([pa.array([i]), pa.array([i]), pa.array([t], pa.binary())], names=["k0", "_id", "_text"])
        chunks += [tuple(c[0].as_py() for c in b.columns) for b in suffix_dedup._chunks([rows])]

    def batches(*told, all_of=False):
        kinds = [pa.string(), pa.binary(), *[pa.list_(pa.binary())] * len(told)]
        for chunk, body in chunks:
            if all_of or chunk in told[0]:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([chunk, body, *[t.get(chunk) for t in told]], kinds)], names=["chunk", "body", "a", "b"][:len(kinds)])

    def grouped(sent, run):
        out, sent = {}, pd.concat([b.to_pandas() for b in sent])
        for _, group in sent.groupby("shard"):
            for chunk, data in run(group.reset_index(drop=True)).itertuples(index=False):
                out.setdefault(chunk, []).append(data)
        return out
    heard = grouped(suffix_dedup._triggers(50, shards)(batches(all_of=True)), suffix_dedup._shared(hot))
    told = grouped(suffix_dedup._phrases(50, shards)(batches(heard)), suffix_dedup._smaller(50))
    done = [b.to_pylist()[0] for b in suffix_dedup._taken_out(50, True)(batches(told, heard, all_of=True))]
    return {r["k0"]: r["n_removed"] for r in done}


@pytest.mark.parametrize("seed", range(6))
def test_triggers_with_equal_keys_as_brute_force(monkeypatch, seed):
    import numpy as np
    monkeypatch.setattr(suffix_dedup, "_key", lambda h: h & np.uint64(0x1F << 59))
    rng = random.Random(seed)
    line = lambda n: bytes(rng.choices(b"abcdefgh", k=n))
    passages = [line(60) for _ in range(12)]
    texts = [rng.choice(passages) + (rng.choice(passages) + line(20) if rng.random() < 0.4 else b"") for _ in range(60)]
    ids = list(range(len(texts)))
    want = {i: sum(gone) for i, gone in brute_removed(list(zip(ids, texts)))}
    for hot in (2, 8, 20):
        assert passes_here(texts, ids, 16, hot) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=200), max_size=5))
def test_phrases_hold_every_string_once(texts):
    import numpy as np
    raw = [t.encode() for t in texts]
    p = suffix_dedup.Phrases(np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64), 50)
    got = sorted(s + j for s, c in zip(p.start, p.count) for j in range(c))
    at, want = 0, []
    for r in raw:
        want += range(at, at + max(0, len(r) - 49))
        at += len(r)
    assert got == want
    by_text = {}
    for s, c, t in zip(p.start, p.count, p.trigger):
        for j in range(c):
            assert by_text.setdefault(bytes(p.body[s + j:s + j + 50]), t) == t


def test_suffix_order_is_byte_order():
    import numpy as np
    rng = random.Random(2)
    text = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(600)) * 2, np.uint8)
    at = np.arange(len(text) - 49)
    order, run = suffix_dedup.suffix_order(text, at, 50)
    keys = [bytes(text[i:i + 50]) for i in at[order]]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(keys, keys[1:])] == [a == b for a, b in zip(run, run[1:])]


def test_drop_repeats_keeps_columns_and_rows_without_id(spark):
    texts = ["word " * 20, "word " * 20, "tail " + "word " * 20, "word " * 20, None, ""]
    docs = docs_of(spark, texts, [1, 2, 3, None, 4, 5])
    out = suffix_dedup.drop_repeats(docs)
    assert out.columns == docs.columns
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert got == {(1, texts[0]), (3, "tail"), (None, texts[3]), (4, None), (5, "")}
    assert suffix_dedup.drop_repeats(docs.limit(0)).count() == 0
    assert out.select(F.max("k0")).first()[0] == "k"
