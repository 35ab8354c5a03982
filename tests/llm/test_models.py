"""Toxicity, language model and quality grades: exact search, exact probabilities, held-out accuracy, edge cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from terrace.llm import lm, quality, toxicity
from terrace.llm.catalogue import QUERIES
from terrace.llm.common import words_of

DOCS = "doc_id long, text string, score string, label string, k0 string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "s", "l", "k") for i, t in rows], DOCS)


# ------------------------------------------------------------------ toxicity


def random_index(seed, n=300, terms=40):
    rng = random.Random(seed)
    names = [f"w{i}".encode() for i in range(terms)]
    examples = [(i, rng.randrange(2), {w: rng.randint(1, 4) for w in rng.sample(names, rng.randint(0, 8))}) for i in range(n)]
    return toxicity.build_index(names, examples, 50, n), names, rng


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_are_exact(seed):
    index, names, rng = random_index(seed)
    dense = np.zeros((len(names), len(index.label)))
    for t in range(len(names)):
        a, b = index.start[t, 0], index.start[t, -1]
        dense[t, index.place[a:b]] = index.weight[a:b]
    assert np.allclose(np.linalg.norm(dense, axis=0)[dense.any(axis=0)], 1)
    for _ in range(50):
        t, v = index.vector({w: rng.randint(1, 3) for w in rng.sample(names, rng.randint(1, 10))})
        near, cos = index.nearest(t, v)
        full = v @ dense[t]
        order = np.lexsort((np.arange(len(full)), -np.round(full, 9)))[:index.k]
        order = order[full[order] > 0]
        assert np.allclose(np.sort(cos), np.sort(full[order])) and len(near) == len(order)
        assert np.allclose(full[near], cos)


def toxic_rows(n=300):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        rows.append((i, " ".join(rng.choices(words, k=40) + ["NASTY!", "vile"] * toxic)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_scores_follow_the_labels_and_ignore_held_out_ones(spark):
    rows, labels = toxic_rows()
    rows += [(900, None), (901, ""), (902, "vile " * 20_000), (903, "vile nasty"), (903, "vile nasty"), (None, "vile")]
    labels += [(900, None, None), (None, 1, 1), (5000, 0, 1)]
    docs = docs_of(spark, rows)
    truth = {i: t for i, _, t in labels[:300]}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, toxicity.training_labels(frame))).collect()
    scores = {r["doc_id"]: r["score"] for r in out}
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all((scores[i] >= 0.5) == bool(truth[i]) for i in held)
    assert scores[900] == scores[901] < 0.1 and scores[902] > 0.5 and scores[903] > 0.5
    flipped = frame.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    again = toxicity.score(docs, toxicity.fit(docs, toxicity.training_labels(flipped))).collect()
    assert {r["doc_id"]: r["score"] for r in again} == scores
    kept = toxicity.drop_toxic(docs, frame)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {i for i in held if not truth[i]} | {900, 901}


def test_neighbours_over_whole_texts_as_brute_force(spark):
    rows, labels = toxic_rows()
    rng = random.Random(4)
    rows += [(i, " ".join(rng.choices([f"w{k}" for k in range(300)] + [f"x{k}" for k in range(60)], k=30))) for i in range(400, 440)]
    rows += [(500, "calm only words here"), (501, "calm only words here"), (503, "nothing known")]  # 500 is labelled, 501 its copy
    assert zlib.crc32(b"500") % 5
    labels += [(500, 1, 1)]
    docs = docs_of(spark, rows)
    frame = toxicity.training_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, frame)).collect()}
    counts = {i: Counter(words_of(t.encode())) for i, t in rows}
    truth = {r["doc_id"]: r["label"] for r in frame.collect()}
    df = Counter(w for c in counts.values() for w in c)
    both, toxic = (Counter(w for i, t in truth.items() if t >= least for w in counts[i]) for least in (0, 1))
    n, n1 = len(truth), sum(truth.values())

    def vector(c):
        out = {}
        for w, k in c.items():
            a, ab = toxic[w], both[w]
            chi = n * (a * (n - n1 - ab + a) - (ab - a) * (n1 - a)) ** 2 / max(1, ab * (n - ab) * n1 * (n - n1))
            out[w] = (1 + math.log(k)) * (math.log((1 + len(rows)) / (1 + df[w])) + 1) * (1 + chi) / (21 + chi)
        norm = math.sqrt(sum(x * x for x in out.values()))
        return {w: x / norm for w, x in out.items()}
    vectors = {i: vector(c) for i, c in counts.items()}
    for i, v in vectors.items():
        full = {j: sum(x * vectors[j].get(w, 0) for w, x in v.items()) for j in truth}
        near = got[i]["evidence"]
        want = sorted((c for c in full.values() if c > 0), reverse=True)[:toxicity.NEIGHBOURS]
        assert np.allclose([e["cosine"] for e in near], want) and all(math.isclose(full[e["doc_id"]], e["cosine"]) for e in near)
    assert [e["doc_id"] for e in got[501]["evidence"]] == [500] and got[501]["score"] >= 0.5
    assert not got[503]["evidence"]


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, toxicity.training_labels(none))).collect()] == [0.0, 0.0]
    assert toxicity.drop_toxic(docs, none).count() == 2
    assert toxicity.drop_toxic(docs.limit(0), none).count() == 0


# ------------------------------------------------------------------ language model


def brute_model(texts):
    tokens = [[w for w in (t or "").lower().split()] + ["\n"] for t in texts]
    c = Counter(w for ws in tokens for w in ws)
    pairs = Counter(p for ws in tokens for p in zip([" "] + ws, ws))
    total, few, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, w), n in pairs.items():
        total[u] += n
        few[u][min(n, 3) - 1] += 1
        before[w] += 1

    def discount(values):
        n = [sum(1 for x in values if x == i) for i in (1, 2, 3, 4)]
        return lm.discounts(n)
    d, e = discount(list(pairs.values())), discount(list(before.values()))
    spare = sum(e[min(x, 3) - 1] for x in before.values()) / len(pairs) if pairs else 1.0

    def base(w):
        x = before.get(w, 0)
        return ((x - e[min(x, 3) - 1]) / len(pairs) if x else 0) + spare / (len(c) + 1)

    def p(u, w):
        if not total.get(u):
            return base(w)
        x = pairs.get((u, w), 0)
        return ((x - d[min(x, 3) - 1] if x else 0) + sum(a * b for a, b in zip(d, few[u])) * base(w)) / total[u]
    return c, p, spare, few, d, total


def test_model_as_brute_force(spark):
    rng = random.Random(4)
    words = ["the", "The", "of", "état", "x,", "y."] + [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, weights=[30, 10, 20, 5, 5, 5] + [1] * 40, k=rng.randint(0, 40))) for _ in range(120)] + [None, "", " \t", "the the the " * 900]
    docs = docs_of(spark, list(enumerate(texts)))
    train = [t for i, t in enumerate(texts) if i % 3]
    model = lm.train(docs.where("doc_id % 3 <> 0"))
    c, p, spare, few, d, total = brute_model(train)
    n, v = sum(c.values()), len(c)
    assert (model.tokens, model.types) == (n, v)
    for r in lm.score(docs, model).collect():
        ws = (texts[r["doc_id"]] or "").lower().split() + ["\n"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in c for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c.get(w, 0) + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r["score"] == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([" "] + ws, ws)), rel=1e-9)
    for u in ("the", " ", "w1"):
        rest = spare / (v + 1) * sum(a * b for a, b in zip(d, few[u])) / total[u]
        assert sum(p(u, w) for w in c) + rest == pytest.approx(1)


def test_model_of_nothing(spark):
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    model = lm.train(docs.limit(0))
    rows = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    assert rows[1]["score"] == rows[1]["base_score"] == 0 and rows[1]["n_tokens"] == 3 and rows[2]["n_tokens"] == 1
    assert lm.score(docs.limit(0), model).count() == 0


def test_counts_over_255_and_many_flushes(spark, monkeypatch):
    monkeypatch.setattr(lm, "FLUSH", 500)
    monkeypatch.setattr(lm, "SCORED", 300)
    docs = docs_of(spark, [(i, "a b a b c " * 40) for i in range(20)]).coalesce(1)
    model = lm.train(docs)
    c, p, *_ = brute_model(["a b a b c " * 40] * 20)
    ws = ("a b a b c " * 40).split() + ["\n"]
    want = sum(math.log10(p(u, w)) for u, w in zip([" "] + ws, ws))
    assert all(r["score"] == pytest.approx(want, rel=1e-9) for r in lm.score(docs, model).collect())


# ------------------------------------------------------------------ quality


def test_grades_are_learnt_in_order(spark):
    rng = random.Random(6)
    words = {0: ["spam###", "BUY!!"], 1: ["fair", "plain"], 2: ["fine", "prose"]}
    common = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(common, k=30) + rng.choices(words[i % 3], k=12))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "fine prose " * 20_000), (1003, "BUY!!"), (1003, "BUY!!")]
    docs = docs_of(spark, rows)
    ratings = spark.createDataFrame([(i, i % 3) for i in range(400)] + [(1000, None), (None, 2), (7777, 1)], "doc_id long, grade int")
    out = quality.grade(docs, quality.fit(docs, ratings)).collect()
    assert len(out) == len(rows) and all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail_prob"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    for i in range(400, 600):
        assert abs(by[i]["expected_grade"] - i % 3) < 0.75 and by[i]["keep"] == (i % 3 > 0)
    assert by[1000]["tail_prob"] == by[1001]["tail_prob"] and by[1002]["expected_grade"] > 1.5 and not by[1003]["keep"]


def test_grades_without_ratings(spark):
    docs = docs_of(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert {r["expected_grade"] for r in quality.grade(docs, quality.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 3)], "doc_id long, grade int")
    assert {(r["expected_grade"], r["keep"]) for r in quality.grade(docs, quality.fit(docs, one)).collect()} == {(3.0, True)}
    assert quality.grade(docs.limit(0), quality.fit(docs, one)).count() == 0


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    rows = [(int(g), rng.integers(0, 50, 5).astype(np.int32), rng.random(5).astype(np.float32)) for g in rng.integers(0, 4, 200)]

    def loss(model):
        out = 0.0
        for g, slots, values in rows:
            p = [1.0, *model.probabilities(float(model.weights[slots] @ values)), 0.0]
            out -= math.log(max(1e-12, p[g] - p[g + 1]))
        return out
    early, late = (quality.fit_grades(rows, epochs=e) for e in (1, 60))
    assert loss(late) < loss(early) and (np.diff(late.thresholds) > 0).all()


# ------------------------------------------------------------------ the queries on the given tables


@pytest.mark.parametrize("name", ["op2_toxicity", "op9_quality", "op5_lm"])
def test_model_queries_cover_all_documents(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = QUERIES[name](spark, SF_SMALL)
    assert out.count() == docs.count() == out.select("doc_id").distinct().count()
