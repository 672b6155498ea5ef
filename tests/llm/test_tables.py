"""Top-k search, URL rules and the pipeline."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patrimonia.llm.maxscore import search, top_k
from patrimonia.llm.urlrules import filed, holding, judge_urls, mine, tokens

HERE = Path("/root/testdata/sf0.001")


def brute(rows):
    fit = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in fit if i % 100 == 0}):
        own = next(v for i, v in fit if i == q)
        scored = sorted(((-sum(a * b for a, b in zip(own, v)), i) for i, v in fit if i != q))[:10]  # noqa: B905
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize("shard_rows", [16_384, 40])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.3, (450, 12)).astype(np.float32))]
    rows += [(1000 + i, rows[5][1]) for i in range(15)]  # ties
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (None, rows[0][1]), (2100, [0.0] * 12)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<float>, score string, rank int, shard int")
    got = [tuple(r) for r in top_k(df, shard_rows=shard_rows, block_queries=3).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == brute(rows)
    assert top_k(df.limit(0)).count() == 0
    few = top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in few] == [(1, 1024 * 2048)]


def test_search_keeps_what_may_win():
    rng = np.random.default_rng(3)
    for _ in range(60):
        v = rng.integers(-50, 50, (rng.integers(1, 20), rng.integers(1, 200)))
        q, ids = rng.integers(-50, 50, len(v)), np.arange(v.shape[1])
        rows, score = search(v, ids, q, -1, 10)
        want = np.sort(q @ v)[::-1][:10]
        assert np.array_equal(np.sort(score)[::-1][:10], want) and np.array_equal(q @ v[:, rows], score)


URLS = [
    ("https://WWW.Example.com/en/1?x=1", "www.example.com", "/en/1", "www.example.com/en/", "allow"), ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://example.com", "example.com", "", None, "allow"), ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("ftp://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
    ("x.net/fr/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://b.org#f/://c", "b.org", "", None, "allow"), ("http://xnet/fr/", "xnet", "/fr/", None, "allow"),
    ("a://b.net?c://d.com/en/", "b.net", "", None, "allow"), ("s://com/" + "y" * 50_000, "com", "/" + "y" * 50_000, "com/", "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0], "h", "k", 1.0) for i, u in enumerate(URLS)] + [(3, URLS[3][0], "h", "k", 1.0), (None, None, None, None, None)], "page_id long, url string, host string, rule string, confidence double")
    labels = spark.createDataFrame([(0, None, None), (1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = judge_urls(pages, labels).collect()
    assert len(got) == len(URLS) + 2
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is not None}
    assert all(by[i] == u[1:] for i, u in enumerate(URLS))
    assert judge_urls(pages.limit(0), labels).count() == 0 and judge_urls(pages, labels.limit(0)).count() == len(URLS) + 2


def test_mined_rules(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.3
        rows.append((i, f"http://{'bets' if bad and rng.random() < 0.9 else 'news'}.site{rng.randrange(5)}.org/{'win' if bad else 'read'}/{i}", int(bad)))
    pages = spark.createDataFrame(rows, "page_id long, url string, toxic int")
    labels = pages.where("page_id < 400").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("quality"), "toxic")
    got = {r.page_id: r for r in judge_urls(pages.drop("toxic"), labels).collect()}
    assert all((got[i].verdict == "block") == bool(bad) for i, _, bad in rows)
    items = pages.withColumns({"host": F.regexp_extract("url", "://([^/]*)", 1), "path": F.regexp_extract("url", "://[^/]*(/.*)", 1)}).select(tokens(F.col("url")).alias("items"), (F.col("toxic") == 1).alias("bad"))
    rules = mine(items, 0.01, 0.6).collect()
    assert ["path=win"] in [r.needs for r in rules] and not any("path=win" in r.needs and len(r.needs) > 1 for r in rules)


def test_rules_need_proof_at_every_size(spark):
    """Labels that don't depend on the tokens make no rule in tables of any size; those that do, make one from some 15 rows on."""
    rng = random.Random(2)
    for n in (1, 12, 90, 2500):
        rows = [([f"host={rng.randrange(6)}", f"path={rng.randrange(3)}", "scheme=http"], rng.random() < 0.24) for _ in range(n)]
        assert mine(spark.createDataFrame(rows, "items array<string>, bad boolean"), 0.002, 0.5).count() == 0
        sure = [(["host=win", "scheme=http"], True)] * 16
        rules = mine(spark.createDataFrame(rows + sure, "items array<string>, bad boolean"), 0.002, 0.5).collect()
        needs = [r.needs for r in rules]
        assert ["host=win"] in needs and (n <= 12 or len(needs) == 1)  # nearly all of a dozen rows are bad


def test_index_files_rules_under_rare_tokens(spark):
    sets = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["a", "b", "c", "d"],)], "items array<string>")
    rules = spark.createDataFrame([(["a", "b"], 0.9), (["a", "c", "d"], 0.8), (["a"], 0.7)], "needs array<string>, confidence double")
    index = filed(rules, sets)
    assert {tuple(r.needs): r.token for r in index.collect()} == {("a", "b"): "b", ("a", "c", "d"): "d", ("a",): "a"}
    assert sorted(r.confidence for r in holding(sets, index).collect()) == [0.7, 0.7, 0.7, 0.8, 0.9, 0.9]


def test_pipeline(spark):
    """Each stage keeps columns and works on what the one before kept; what is planted goes, and clean documents stay."""
    docs = spark.read.parquet(f"{HERE}/documents.parquet")
    bench = spark.read.parquet(f"{HERE}/benchmark.parquet").limit(1).first()
    copy = docs.where("n_chars > 600").orderBy("doc_id").first()
    planted = spark.createDataFrame([(10_001, "123 456", "en", None, None), (10_002, copy.text, copy.lang, None, None), (10_003, copy.text + " fin", copy.lang, None, None), (10_004, "the and of to in that it was " * 3 + bench.text, "en", None, None)], docs.schema)
    now = docs.unionByName(planted)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, str(HERE)).checkpoint()
        assert after.columns == docs.columns
        gone = {r.doc_id for r in now.select("doc_id").exceptAll(after.select("doc_id")).collect()}
        assert {"language": {10_001}, "near_duplicates": {10_002, 10_003}, "decontaminate": {10_004}, "mixing": set()}[name] <= gone
        if name == "language":
            assert gone == {10_001}
        now = after
    placed = corpus_pipeline.STAGES[-1][1](spark, now, str(HERE)).collect()
    assert len(placed) == now.count()
    assert corpus_pipeline.run(spark, str(HERE)).count() > 0
