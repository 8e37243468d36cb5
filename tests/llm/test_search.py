"""Exact top-k against all scores, and the URL filter against its rules and formulas."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hourgrid.llm import queries, topk, url_filter


def brute_top_k(rows, every, k=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (i, v) in enumerate(fine):
        if i is not None and i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j) for other, (j, w) in enumerate(fine) if other != place and j is not None]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def search(spark, rows, every, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    vectors = df.where(topk.finite("embedding")).select(F.col("vec_id").alias("id"), topk.scaled("embedding").alias("weights"), "rank")
    return sorted(map(tuple, topk.top_k(vectors, F.col("id") % every == 0, k).collect()))


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 0.0])]
    rows += [(6, [0.0, 0.0]), (7, [1.0, 1.0]), (8, [-1.0, 2.0]), (10, [0.001, -0.001]), (None, [9.0, 9.0])]
    assert search(spark, rows, 2) == brute_top_k(rows, 2)
    assert search(spark, rows[:1], 2) == []
    assert search(spark, [], 2) == []


def test_copies_of_a_query_are_candidates(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5])]
    assert search(spark, rows, 2) == [(0, 1, 0, 65536), (0, 1, 0, 65536), (0, 2, 1, 32768), (0, 2, 1, 32768)]


def test_blocks_are_merged(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(6)]) for i in range(300)]  # many ties
    assert search(spark, rows, 9) == brute_top_k(rows, 9)


def test_large_components_take_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 30)
    rng = random.Random(4)
    sizes = (0.0, 0.5, 1.0, 3.0, 65537.0, 2.0**24 + 2, 2.0**31, 1e9, 1e12, 2.0**70, 1e30, 3.4e38)
    draw = lambda top: [rng.choice([-1, 1]) * rng.choice(sizes[:top]) * rng.choice([1, 0.75]) for _ in range(8)]
    rows = [(i, draw((4, 7, 9, len(sizes))[i % 4])) for i in range(150)] + [(1, [3.4e38] * 8), (50, [1e30] * 8), (50, [1e30] * 8)]
    rows += [(200, [float("inf")] * 8), (201, [float("nan")] * 8), (202, [None] * 8), (203, None), (204, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]  # as floats
    want = [(*r[:3], r[3] if abs(r[3]) < 2**63 else None) for r in brute_top_k(rows, 50)]
    got = queries.queries()["op10_exact_top_k"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    every = spark.read.parquet(f"{tmp_path}/embeddings.parquet").where(topk.finite("embedding"))
    every = every.select(F.col("vec_id").alias("id"), topk.scaled("embedding").alias("weights"))
    want = [(*r[:3], r[3] if abs(r[3]) < 2**63 else None) for r in brute_top_k(rows, 1, 200)]
    assert sorted(map(tuple, topk.top_k(every, F.lit(True), 200).collect()), key=repr) == sorted(want, key=repr)
    assert any(s is None for *_, s in want) and any(s is not None and abs(s) > 2**48 for *_, s in want)


def test_top_k_of_the_embeddings(spark, sf_dir, read):
    rows = [(r["vec_id"], r["embedding"]) for r in read("embeddings").collect()]
    got = queries.queries()["op10_exact_top_k"](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, 50)


URLS = {
    None: ("", "", None),
    "": ("", "", None),
    "no scheme/x": ("", "", None),
    "http://WWW.Example.NET/en/x?y#z": ("www.example.net", "/en/x", "example.net/en/"),
    "http://a.net": ("a.net", "", None),
    "http://a.net/": ("a.net", "/", "net/"),
    "http://net/q": ("net", "/q", "net/"),
    "http://internet/q": ("internet", "/q", None),
    "http://example.com/de/1": ("example.com", "/de/1", "example.com/de/"),
    "http://notexample.com/de/1": ("notexample.com", "/de/1", None),
    "x://b.org/fr/?a://c": ("b.org", "/fr/", "org/fr/"),
    "x://b.org?u=/fr/": ("b.org", "", None),
    "a\nb://h.net/p\nq#r": ("h.net", "/p\nq", "net/"),
    "://": ("", "", None),
}


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://a.net/"), (0, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "n", "rate", "bound", "rule")})
    got = url_filter.judge(pages, spark.createDataFrame([], "host string, bad int")).collect()
    says = {f"{h}{p}": v for h, p, v in url_filter.RULES}
    want = [(i, *URLS[u], says.get(URLS[u][2], "allow")) for i, u in rows]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)
    assert url_filter.judge(pages.limit(0), spark.createDataFrame([], "host string, bad int")).count() == 0


def outcomes(spark, counts):
    rows = [(h, int(i < bad)) for h, (bad, n) in counts.items() for i in range(n)]
    return spark.createDataFrame([*rows, (None, 1), ("a.x.com", None)], "host string, bad int")


def test_hosts_are_shrunk_towards_their_domain(spark):
    counts = {"a.x.com": (48, 50), "b.x.com": (1, 1), "c.x.com": (45, 48), "a.y.com": (0, 60), "b.y.com": (1, 1), "z.org": (0, 40)}
    got = {r["host"]: r for r in url_filter.reputation(outcomes(spark, counts)).collect()}
    assert got["a.x.com"]["verdict"] == "block" and got["a.y.com"]["verdict"] == got["z.org"]["verdict"] == "allow"
    assert got["b.x.com"]["rate"] > 0.7 > 0.5 > got["b.y.com"]["rate"]  # one bad page each
    assert all(r["bound"] < r["rate"] for r in got.values())
    assert {h: r["n"] for h, r in got.items()} == {h: n for h, (_, n) in counts.items()}


def test_hosts_that_do_not_differ_share_a_rate(spark):
    got = url_filter.reputation(outcomes(spark, {f"h{i}.x.com": (2, 10) for i in range(8)})).collect()
    assert len({round(r["rate"], 9) for r in got}) == 1 and all(r["verdict"] == "allow" for r in got)


@pytest.mark.parametrize("name", ["op4_decontamination", "op6_url_filter"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "InPandas", "Cartesian", "BroadcastNestedLoop"))
