"""Top-k, hosts and shards against brute force; every query with SQL against DuckDB."""

import math
import random

import pytest

from conftest import SF_SMALL
from oracle_compare import digest, duck, type_differences
from terrace.llm import hosts, sharding, topk
from terrace.llm.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duck(SF_SMALL)
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    want = digest([d[0] for d in res.description], res.fetchall())
    assert digest(df.columns, rows)[:3] == want[:3]
    assert not type_differences(df, con, ORACLES[name])


# ------------------------------------------------------------------ top-k


def brute_top(rows, k, queries):
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for j, own in rows if j == q for i, v in rows if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("size", [8192, 7])
def test_top_k_is_exact(spark, monkeypatch, size):
    monkeypatch.setattr(topk, "CANDIDATES", size)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rng = random.Random(8)
    data = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.2, 0.7]) for _ in range(20)], "x") for i in range(120)]
    data += [(200, None, "x"), (201, [1.0, None], "x"), (202, [float("nan")], "x"), (203, [float("inf")], "x"), (None, [1.0], "x"), (204, [], "x"), (205, [1.0, 2.0], "x"),
             (50, [9.0] * 20, "tie"), (7, [0.9] * 20, "other"), (7, [0.9] * 20, "again"), (206, [0.2] * 20, "x"), (207, [0.2] * 20, "x"), (100, [0.5], "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, id string")
    vectors = topk.whole_numbers(df, "vec_id", "embedding", 256)
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("id % 50 = 0"), 5).collect())
    rows = set()
    for i, v, _ in data:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            import numpy as np
            rows.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    assert got == brute_top(rows, 5, {i for i, _ in rows if i % 50 == 0})


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    v = topk.whole_numbers(df, "vec_id", "embedding", 256)
    assert [tuple(r) for r in topk.top_k(v, v.where("id = 0"), 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(v.limit(0), v.limit(0), 5).count() == 0
    assert topk.top_k(v, v.limit(0), 5).count() == 0


# ------------------------------------------------------------------ hosts

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "no scheme", None, "", "x://h.net/es/1", "x://net.org/es/", "x://example.com", "x://a.com?u=://b/c",
            "x://badexample.com/en/", "x://a.co.uk/p", "a\nb://h.org/q", "x:///p"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], "url string, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in hosts.judge(pages, none, RULES).collect()}
    assert got == {0: ("a.example.com", "/en/x", "example.com/en/", "block"), 1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
                   2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("h.net", "/es/1", "net/es/", "block"),
                   6: ("net.org", "/es/", None, "allow"), 7: ("example.com", "", None, "allow"), 8: ("a.com", "", None, "allow"),
                   9: ("badexample.com", "/en/", "com/", "allow"), 10: ("a.co.uk", "/p", None, "allow"), 11: ("h.org", "/q", None, "allow"), 12: ("", "/p", None, "allow")}
    assert hosts.judge(pages.limit(0), none, RULES).count() == 0


def test_bad_hosts_are_blocked_and_shrunk(spark):
    judged = [("x://bad.site.org/", 1)] * 60 + [("x://good.site.org/", 0)] * 60 + [("x://once.site.org/", 1)] + [(f"x://h{i}.other.org/", i % 2) for i in range(40)] + [("x://bad.site.org/", None)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(["x://bad.site.org/n", "x://good.site.org/n", "x://once.site.org/n", "x://new.site.org/n", "x://new.org/", "x://a.zz"])], "page_id long, url string")
    out = {r["page_id"]: r for r in hosts.judge(pages, spark.createDataFrame(judged, "url string, bad int"), []).collect()}
    assert [out[i]["verdict"] for i in range(6)] == ["block", "allow", "allow", "allow", "allow", "allow"]
    assert 0.3 < out[2]["bad_rate"] < 1 and out[2]["bad_low"] < 0.5 < out[0]["bad_low"] and out[5]["bad_rate"] is None


# ------------------------------------------------------------------ shards


def brute_capacity(sizes, shards):
    def fits(c):
        n, a = 1, 0
        for z in sizes:
            if z > c:
                return False
            if a + z > c:
                n, a = n + 1, 0
            a += z
        return n <= shards
    return next(c for c in range(max(sizes, default=0), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("texts", [
    [None, "", "a", "a", "b" * 50] + [f"text {i} " * (i % 13) for i in range(200)],
    ["same text " * 30] * 100 + [f"t{i}" for i in range(30)] + ["ü" * 3000],
    ["one"], ["one", "two", "three"],
])
def test_shards_are_minimal_and_gapless(spark, texts):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, shard string, h int")
    out = sharding.assign(df, 8).toPandas()
    own = dict(zip(out["doc_id"], out["shard"]))
    assert len(out) == len(texts) and set(own.values()) <= set(range(8))
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", set()).add(own[i])
    assert all(len(g) == 1 for g in groups.values())
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    hashed = df.selectExpr("xxhash64(coalesce(text, '')) AS h", "coalesce(octet_length(text), 0) + 1 AS size").toPandas().groupby("h")["size"].sum().sort_index()
    assert out.groupby("shard")["size"].sum().max() == brute_capacity([int(x) for x in hashed], 8)


def test_shards_of_nothing_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, "b")], "doc_id long, text string")
    assert sharding.assign(df.limit(0), 8).count() == 0
    out = sharding.assign(df, 2).toPandas()
    assert len(out) == 4 and out.groupby("shard")["slot"].apply(lambda s: sorted(s) == list(range(len(s)))).all()
