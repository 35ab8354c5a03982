"""The pipeline against a brute-force version of every stage on a small fixture, and on the given tables."""

import hashlib
import random

import numpy as np

import corpus_pipeline
import public_tokenizers
from conftest import SF_SMALL
from terrace.llm import toxicity
from terrace.llm.common import words_of
from test_text import brute_components, brute_fingerprint, brute_hits, brute_removed


def fixture(spark, folder):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [text(25), text(14), "tiny item"]
    passage = text(60)
    texts = [text(rng.randint(20, 90)) for _ in range(150)]
    toxic = [0] * 150
    for i in range(0, 150, 4):
        texts[i] += " vile nasty " + text(3)
        toxic[i] = 1
    texts += [texts[1], texts[1], texts[2] + " end", text(40) + " " + items[0] + " " + text(40), items[1], text(30) + " " + passage, passage + " " + text(30), None, "", "tiny item", "Größe " * 30, "ein Größe " + "Größe " * 30]
    toxic += [None] * (len(texts) - 150)
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "extra") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if t is not None], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, items


def brute_nearest(index, counts):
    t, v = index.vector(counts)
    if not len(t):
        return index.without
    dense = np.zeros((len(index.terms), len(index.label)))
    for k in range(len(index.terms)):
        a, b = index.start[k, 0], index.start[k, -1]
        dense[k, index.place[a:b]] = index.weight[a:b]
    cos = v @ dense[t]
    near = sorted((i for i in range(len(cos)) if cos[i] > 0), key=lambda i: (-round(cos[i], 9), i))[:index.k]
    if not near:
        return index.without
    a, b = index.curve
    return 1 / (1 + np.exp(-(a * index.vote(np.array(near), cos[near]) + b)))


def test_pipeline_as_brute_force(spark, tmp_dir):
    texts, items = fixture(spark, tmp_dir)
    docs, labels = (spark.read.parquet(f"{tmp_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    # toxicity
    index = toxicity.fit(docs, toxicity.training_labels(labels))
    left = {}
    for i, t in enumerate(texts):
        words = words_of((t or "").encode())
        if brute_nearest(index, {w: words.count(w) for w in set(words) if w in index.terms}) < 0.5:
            left[i] = t
    assert all(i % 4 for i in left if i < 150) and len(left) > 100
    # SimHash
    fps = {i: brute_fingerprint(t) for i, t in left.items()}
    first = brute_components(fps, sorted(left))
    left = {i: t for i, t in left.items() if first[i] == i}
    # repeats
    cut = {}
    for i, gone in brute_removed([(i, (t or "").encode()) for i, t in left.items()]):
        raw = (left[i] or "").encode()
        if not raw or not all(gone):
            cut[i] = left[i] if not any(gone) else bytes(c for c, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    # benchmark
    from terrace.llm.decontaminate import WORD
    split = [(str(k), words_of(t.encode())) for k, t in enumerate(items)]
    clean = {}
    for i, t in cut.items():
        raw = (t or "").encode()
        words = words_of(raw)
        hit, _ = brute_hits(words, split, 10)
        if 2 * len(hit) > len(words):
            continue
        if hit:
            places = [(m.start(), m.end()) for m in WORD.finditer(raw)]
            gone = bytearray(len(raw))
            for k in hit:
                gone[places[k][0]:places[k][1]] = b"\x01" * (places[k][1] - places[k][0])
                if k + 1 in hit:
                    gone[places[k][1]:places[k + 1][0]] = b"\x01" * (places[k + 1][0] - places[k][1])
            t = bytes(c for c, g in zip(raw, gone) if not g).decode()
        clean[i] = t
    # tokens
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in clean.items()}
    assert {i: r["ids"] for i, r in got.items()} == want
    assert all(r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want[i])).encode()).hexdigest() for i, r in got.items())
    assert 154 not in got and 159 not in got and 150 not in got  # an item, a short item, a copy


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.tokenize(spark, docs.limit(0), SF_SMALL).count() == 0


def test_pipeline_on_given_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    n = out.count()
    assert 0.7 * docs.count() < n < docs.count() and out.select("doc_id").distinct().count() == n
