"""Repeated ids, hot keys and clashing columns; exact beliefs on a tree."""

import datetime as dt
import itertools

import numpy as np
from pyspark.sql import functions as F

from episodica.llm import ngram_join, personal_data, search, shared, url_lists

from .helpers import documents


def test_texts_of_one_id_are_different_documents(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    docs = documents(spark, [a, a, b]).withColumn("doc_id", F.element_at(F.array(F.lit(1), F.lit(5), F.lit(5)), F.col("doc_id").cast("int") + 1).cast("long"))
    docs = docs.union(docs.filter(F.col("text") == b))
    kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs).collect())
    assert kept == [(1, a), (5, b)]


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(shared, "HOT_ROWS", 3)
    rows = shared.written(spark.createDataFrame([(i % 4 if i < 40 else i, i) for i in range(60)], "k long, v long"), "rows")
    one = shared.written(spark.createDataFrame([(i, i * 10) for i in (0, 1, 45, 99)], "k long, w long"), "one")
    for how in ("inner", "left"):
        assert sorted(map(str, shared.spread_join(rows, one, "k", how).collect())) == sorted(map(str, rows.join(one, "k", how).collect()))


def test_least_valid_vector_of_a_repeated_query(spark):
    rows = [(20, [0.0, None]), (20, [1.0, 0.0]), (1, [1.0, 1.0])]
    for given in itertools.permutations([*rows, (20, [0.5, 0.0])]):
        got = search.top_k(spark.createDataFrame(list(given), "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
        assert [tuple(r) for r in got] == [(20, 1, 1, 32 * 64)]
        break
    got = search.top_k(spark.createDataFrame(rows[::-1], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, 64 * 64)]


def test_captures_keep_columns_of_the_results_names(spark):
    caps = spark.createDataFrame([("http://ex.org./", dt.date(2024, 1, 2), "mine", True)], "url string, fetched_on date, host string, kept boolean")
    entries = spark.createDataFrame([("EX.org.", "block", dt.date(2024, 1, 1))], "name string, action string, listed_on date")
    row = url_lists.judge(caps, entries).first().asDict()
    assert (row["host"], row["kept"], row["list_host"], row["list_kept"], row["rule"]) == ("mine", True, "ex.org", False, "ex.org")


def test_beliefs_on_a_tree_are_exact():
    rng = np.random.default_rng(3)
    graph = personal_data.Graph()
    graph.chain, graph.skip = [(0, 1), (1, 2)], [(1, 3)]
    node, tables = rng.normal(size=(4, 5)), rng.normal(size=(2, 5, 5))
    want = np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        p = np.exp(sum(node[i, y[i]] for i in range(4)) + tables[0][y[0], y[1]] + tables[0][y[1], y[2]] + tables[1][y[1], y[3]])
        for i in range(4):
            want[i, y[i]] += p
    got, edges = personal_data.Messages(graph).run(node, tables, 60)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)
    assert np.allclose(edges[0].sum(1), got[0], atol=1e-6) and np.allclose(edges[2].sum(0), got[3], atol=1e-6)


def test_numbers_run_together_are_labelled():
    """A card behind a telephone number fails both patterns; trained on plain ones, the field finds both, and spares orders."""
    rng = np.random.default_rng(4)

    def card():
        d = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        return next(d + str(k) for k in range(10) if personal_data.luhn(d + str(k)))

    def phone():
        return f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"

    texts = [f"call {phone()} about order {rng.integers(1, 99)} or card {card()} please" for _ in range(80)]
    together = [f"call {phone()} {card()} about order {rng.integers(1, 99)}" for _ in range(20)]
    graph = personal_data.Graph()
    for i, t in enumerate([*texts, *together]):
        graph.add(i, t, personal_data.base_spans(t))
    p = personal_data.beliefs(graph, personal_data.fit(graph))
    free = [i for i in range(len(graph.label)) if graph.label[i] < 0]
    found = {i: personal_data.KINDS[p[i].argmax() - 1] for i in free if p[i].argmax() > 0}
    part = [i for i in free if graph.part[i]]
    assert len(part) >= 40 and sum(i in found for i in part) >= 0.9 * len(part)
    assert not any(i in found for i in free if not graph.part[i])
