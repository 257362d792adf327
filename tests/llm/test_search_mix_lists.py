"""Ops 7, 9 and 10, the pipeline and the guard of the entry module."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from episodica.llm import mixing, queries, search, url_lists

from .helpers import ODD, documents, prose, words_of


def test_top_k_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(0, 0.3, 24).astype(np.float32)]) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [None, *rows[1][1][1:]]), (304, [float("nan"), *rows[1][1][1:]]), (305, [1.0, 2.0]), (320, [float("inf")] * 24), (None, rows[2][1]), (340, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in ok if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], ok[c], strict=True)), c) for c in ok if c != q and len(ok[c]) == len(ok[q]))
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:20])]
    for chunk in (4096, 40):
        got = [tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in search.top_k(df, F.col("vec_id") % 20 == 0, chunk=chunk).collect()]
        assert sorted(got) == sorted(want)
    assert search.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(50, 64)), rng.normal(size=(40, 64))
    for n in search.LEVELS:
        assert (search.segment_stats(a, n) @ search.segment_stats(b, n).T >= a @ b.T - 1e-9).all()


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    sizes = {"a": 400, "b": 30, "c": 100, None: 60}
    rows = [(i, prose(rng, rng.randrange(5, 60)), s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    rows += [(10_000, None, "a"), (10_001, "", "b"), (0, rows[0][1], "a"), (None, "x y z", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    total = {s: sum(len(words_of(t)) for _, t, x in rows if x == s) for s in sizes}
    order = sorted((s for s in total if s is not None)) + [None]
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, free = 1.5 * sum(total.values()), {}, set(order)
    while True:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
            free.discard(s)
    target |= {s: level * w[s] for s in free}
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert abs(own[0]["target"] - target[s]) < 1e-6 and own[0]["source_size"] == total[s]
        assert abs(sum(r["taken"] for r in own) - target[s]) <= 60
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, mixing.mix(docs.repartition(3)).collect())) == sorted(map(key, got))
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r["taken"] for r in mixing.mix(spark.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")).collect()] == [0]


def test_better_documents_are_taken_first(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40) if i % 2 else " ".join(["#"] * 40), s) for i in range(2000) for s in ["abc"[i % 3]]]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1.0,), share=0.5).collect()
    good, bad = sum(r["taken"] > 0 for r in got if r["doc_id"] % 2), sum(r["taken"] > 0 for r in got if not r["doc_id"] % 2)
    assert good > 3 * bad


def test_lists_as_of_the_fetch(spark):
    day = lambda d: dt.date(2024, 1, d)
    entries = spark.createDataFrame([("Ex.org", "block", day(5)), ("ex.org", "allow", day(10)), ("a.ex.org", "block", day(8)), ("a.ex.org", "allow", day(8)), (None, "block", day(1)), ("x.org", "odd", day(1)), ("y.org", "block", None)], "name string, action string, listed_on date")
    caps = [("http://ex.org/a", 4), ("http://EX.org:80/a", 5), ("https://u@b.ex.org?x", 9), ("http://b.ex.org", 10), ("http://a.ex.org/", 9), ("http://a.ex.org/", 7), (None, 9), ("nonsense", 9), ("http://ex.org", None), ("http://notex.org", 6), ("http://ex.org/a", 5)]
    df = spark.createDataFrame([(i, u, day(d) if d else None, "x") for i, (u, d) in enumerate(caps)], "id int, url string, fetched_on date, name string")
    got = {r["id"]: (r["kept"], r["rule"]) for r in url_lists.judge(df, entries).collect()}
    assert got == {0: (True, None), 1: (False, "ex.org"), 2: (False, "ex.org"), 3: (True, "ex.org"), 4: (False, "a.ex.org"), 5: (False, "ex.org"), 6: (True, None), 7: (True, None), 8: (True, None), 9: (True, None), 10: (False, "ex.org")}
    assert url_lists.judge(df, entries.limit(0)).filter("not kept").count() == 0 and url_lists.judge(df.limit(0), entries).count() == 0


def test_lists_reach_every_name_under_an_entry(spark):
    entries = spark.createDataFrame([("example.com", "block"), ("b.c.d.example.com", "allow"), ("zip", "block")], "name string, action string").selectExpr("*", "date '2024-01-01' as listed_on")
    urls = {"http://w.x.y.z.example.com/": "example.com", "http://a.b.c.d.example.com/": "b.c.d.example.com", "http://u.v.w.x.b.c.d.example.com": "b.c.d.example.com", "http://some.zip": "zip", "http://a.b.c.d.e.f.zip": "zip", "http://zip.org": None}
    rows = url_lists.judge(spark.createDataFrame([(u,) for u in urls], "url string").selectExpr("*", "date '2024-02-01' as fetched_on"), entries).collect()
    assert {r["url"]: r["rule"] for r in rows} == urls and all(r["kept"] == (r["rule"] in (None, "b.c.d.example.com")) for r in rows)


def test_queries_equal_sql(spark):
    import duckdb

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("embeddings", "pages", "documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        df, rel = queries.QUERIES[name](spark, sf), con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        order = [rel.columns.index(c) for c in df.columns]
        assert sorted((str(tuple(r)) for r in df.collect())) == sorted(str(tuple(r[i] for i in order)) for r in rel.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    sf, docs = "/root/testdata/sf0.001", None
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == first.columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0] and counts[3] == counts[4]
    assert p.STAGES[-1][1](spark, docs, sf).count() == counts[-1]


def test_stages_take_odd_rows(spark, tmp_path):
    import corpus_pipeline as p

    docs = documents(spark, [*ODD, "some words in a line"]).union(documents(spark, ODD[:2]))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, docs.limit(0), docs.selectExpr("cast(null as long) as doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source", "cast(null as long) as n_chars", "node", "sig")):
        for _, stage in p.STAGES:
            assert stage(spark, given, str(tmp_path)).count() <= given.count()
