"""Op 5 and the linking of near copies against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from episodica.llm import near, ngram_join, vec

from .helpers import ODD, documents, edited, family, prose, shingles, union_find


def expected(texts, k=3, percent=90):
    sets = [shingles(t, k) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return union_find(len(sets), pairs), [len(s) for s in sets]


@pytest.mark.parametrize("limit", [128, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(near, "SMALL", limit)  # 3: families go through pivots
    rng = random.Random(1)
    texts = [*ODD, *family(2, 50), *family(3, 30, 40), *(prose(rng, rng.randrange(1, 60)) for _ in range(60))]
    texts += [edited(rng, t, 1) for t in texts[-20:]] + [texts[10]] * 5
    rows = {r["doc_id"]: r for r in ngram_join.jaccard_components(documents(spark, texts)).collect()}
    comp, sizes = expected(texts)
    assert [rows[i]["component_id"] for i in range(len(texts))] == comp
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == sizes


def test_frequent_shingles_use_pairs_of_neighbours(spark):
    texts = family(4, 40, 60)
    rows = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(documents(spark, texts), frequent=2).collect()}
    assert [rows[i] for i in range(len(texts))] == expected(texts)[0]


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    docs = documents(spark, ["a b c d", "a b c d"])
    more = docs.union(docs.limit(1)).union(docs.limit(1).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars", "node", "sig"))
    got = sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_components(more).collect())
    assert got == [(False, 0, 0), (False, 0, 0), (False, 1, 0), (True, None, None)]
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0
    kept = ngram_join.keep_one(more)
    assert kept.columns == more.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 0] or sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "None"]


def test_repeated_rows_lose_no_link(spark):
    rng = random.Random(5)
    texts = [t for base in [prose(rng, 60) for _ in range(8)] for t in (base, f"{base} end")]  # blocks of one size
    docs, want = documents(spark, texts), expected(texts)[0]
    rows = ngram_join.jaccard_components(docs.union(docs)).collect()
    assert len(rows) == 2 * len(texts) and all(r["component_id"] == want[r["doc_id"]] for r in rows)


def test_blocks_are_equal_only_with_equal_nodes(spark):
    blocks = {1: [7, 7, 9], 2: [9, 8, 8], 3: [7, 9], 4: [9, 7], 5: [7, 7, 9, 9], 6: [8, 8, 9, 9], 7: [5, 5]}
    got = {r["sig"] for r in near.one_of_equal(spark.createDataFrame([(s, n) for s, nodes in blocks.items() for n in nodes], "sig long, node long")).collect()}
    assert got == {1, 2, 3, 5, 6}


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["label"] for r in near.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_bitmaps_never_part_linked_sets():
    rng = np.random.default_rng(0)
    for _ in range(50):
        base = rng.integers(0, 2**63, 300).astype(np.uint64)
        x, y = np.unique(base[: 300 - int(rng.integers(0, 8))]), np.unique(base[int(rng.integers(0, 8)) :])
        a, b = (int.from_bytes(near.bitmap(s, 90), "little") for s in (x, y))
        assert (a ^ b).bit_count() <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("local", [500_000, 3])
def test_few_edges_are_joined_in_one_task(spark, monkeypatch, local):
    """Two tables for few edges, however long the chains; of more, the rounds give the same labels."""
    rng, names = random.Random(8), []
    order = rng.sample(range(60), 60)
    pairs = [*zip(order, order[1:], strict=False), *((rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(25)), (200, 200)]
    monkeypatch.setattr(near, "LOCAL", local, raising=False)
    monkeypatch.setattr(near, "written", lambda df, name, write=near.written: names.append(name) or write(df, name))
    root = union_find(201, pairs)
    got = {r["node"]: r["label"] for r in near.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root[x] for p in pairs for x in p if p[0] != p[1]}
    assert (names == ["given", "labels"]) == (local > 3)
    assert near.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_block_of_one_component_is_written(spark, monkeypatch):
    """Near copies that all link with their pivot share many signatures, none of which is needed again."""
    sizes, labels = [], []

    def write(df, name, write=near.written):
        out = write(df, name)
        if name == "labels":
            labels[:] = [out.collect()]
        if name == "blocks" and labels:
            of = {r["node"]: r["label"] for r in labels[0]}
            blocks = {}
            for r in out.filter("age = 0").collect():
                blocks.setdefault(r["sig"], set()).add(of.get(r["node"], r["node"]))
            sizes.extend(len(b) for b in blocks.values())
        return out

    monkeypatch.setattr(near, "SMALL", 3)
    monkeypatch.setattr(near, "written", write)
    rng = random.Random(9)
    base = prose(rng, 200).split()
    texts = [" ".join(base[: i % 7 * 9] + [f"edit{i % 7}"] + base[i % 7 * 9 + 1 : 150 + i]) for i in range(14)]
    rows = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(documents(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == expected(texts)[0]
    assert all(n > 1 for n in sizes)


def test_a_family_with_a_wide_rim_takes_few_rounds(spark, monkeypatch):
    """One block of near copies, many of them too far from any pivot: rows and rounds don't run away, and no link is lost."""
    names, rows = [], []

    def write(df, name, write=near.written):
        out = write(df, name)
        names.append(name)
        rows.append(out.count() if name in ("blocks", "dealt") else 0)
        return out

    monkeypatch.setattr(near, "SMALL", 24)
    monkeypatch.setattr(near, "written", write)
    rng = random.Random(1)
    base = prose(rng, 100)
    texts = [edited(rng, base, min(14, int(rng.expovariate(0.5)))) for _ in range(120)]
    sets = [shingles(t, 5) for t in texts]
    root = union_find(len(sets), [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    raw, offs = vec.text_buffer(pa.array(texts))
    own = list(vec.shingle_sets(vec.find_words(raw, offs, vec.SPACED, vec.SPACED_WORD), 5))
    keys = [near.set_key(x) for x in own]
    marks = {k: (k, len(x), bytearray(near.bitmap(x, 80))) for k, x in zip(keys, own, strict=True)}
    labels = near.link(
        spark.createDataFrame([(1, k, 0) for k in marks], "sig long, node long, r int"), spark.createDataFrame(list(marks.values()), "node long, n int, bits binary"),
        spark.createDataFrame(list(zip(keys, texts, strict=True)), "node long, text string").dropDuplicates(["node"]), 5, 80,
    )
    got = {r["node"]: r["label"] for r in labels.collect()}
    least = {c: min(k for k, r in zip(keys, root, strict=True) if r == c) for c in set(root)}
    assert [got.get(k, k) for k in keys] == [least[c] for c in root]
    assert names.count("sizes") <= 6 and sum(rows) <= 20 * len(texts)


def test_marks_of_many_sets_are_those_of_each():
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) for n in (1, 2, 46, 300, 5_000)]
    rows += [np.concatenate([rows[3], rows[3][:40]]), np.repeat(rows[0], 60), rows[3][::-1]]
    first = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    keys, n, bits = near.set_marks(np.concatenate(rows), first, 80)
    sets = [np.unique(x) for x in rows]
    assert keys.tolist() == [near.set_key(x) for x in sets] and n.tolist() == [len(x) for x in sets]
    assert bits.to_pylist() == [near.bitmap(x, 80) for x in sets]
    assert [len(x) for x in near.set_marks(np.zeros(0, np.uint64), np.zeros(1, np.int64), 80)] == [0, 0, 0]
