"""Op 12: all scores by brute force, ties, odd rows, and that lists aren't read to their ends."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from episodica.llm import lexical_search as ls

from .helpers import LOWER, ODD, prose


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(items, docs, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    texts = {}
    for i, t in items:
        if i is not None and t is not None:
            texts.setdefault(i, set()).add(t)
    out = []
    for item, own in texts.items():
        want = Counter(terms(" ".join(sorted(own))))
        found = []
        for doc, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in want.items() if t in c)
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    docs = [(i, prose(rng, rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, docs[i % 5][1].upper()) for i in range(40)]  # ties
    docs += [(n + 100 + i, t) for i, t in enumerate(ODD)] + [(None, docs[0][1]), (3, docs[4][1]), (n + 200, "Één ünï-code x_y 42" * 3)]
    items = [(i, " ".join(rng.sample(docs[i][1].split() * 2, min(12, len(docs[i][1].split()))))) for i in range(0, 60, 3)]
    items += [(900, None), (901, ""), (902, "nowhere"), (None, docs[0][1]), (903, docs[1][1]), (903, docs[2][1]), (903, docs[2][1]), (904, "ünï 42 42 42"), (905, "one ONE two")]
    return items, docs


@pytest.mark.parametrize(("postings", "block"), [(1 << 20, 4096), (500, 5)])
def test_equals_all_scores(spark, monkeypatch, postings, block):
    monkeypatch.setattr(ls, "POSTINGS", postings)
    items, docs = corpus(1)
    di = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as block")
    dd = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as terms")
    got = ls.search(di, dd, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(items, docs)


def test_empty_tables_and_long_texts(spark):
    items, docs = spark.createDataFrame([(1, "al bo")], "item_id long, text string"), spark.createDataFrame([(1, "al"), (2, "bo " * 700_000 + "al"), (3, "zz")], "doc_id long, text string")
    assert [tuple(r) for r in ls.search(items, docs).orderBy("rank").collect()] == brute([(1, "al bo")], [(1, "al"), (2, "bo " * 700_000 + "al"), (3, "zz")])
    assert ls.search(items.limit(0), docs).count() == 0
    assert ls.search(items, docs.limit(0)).count() == 0


def test_lists_end_early(monkeypatch):
    rng = np.random.default_rng(2)
    n, size = 4000, 30
    holds = rng.random((n, size)) < 0.3
    holds[:25] = True
    doc, term = np.nonzero(holds)
    tf = rng.integers(1, 4, len(doc))
    tf[doc < 25] = 60  # few documents lead by far
    weight = np.arange(1, size + 1) * 100
    shard = ls.Shard(np.arange(n), np.full(n, 100), doc, term, tf, weight)
    looked = []
    scores = ls.Shard.scores
    monkeypatch.setattr(ls.Shard, "scores", lambda s, d, *a: looked.append(len(d)) or scores(s, d, *a))
    none = np.zeros(0, np.int64)
    best = shard.search(np.arange(5), np.ones(5, np.int64), (none, none), 5)
    every = shard.scores(np.arange(n), np.arange(5), np.ones(5, np.int64))
    order = np.lexsort((np.arange(n), -every))[:5]
    assert best[1].tolist() == order.tolist() and best[0].tolist() == every[order].tolist()
    assert sum(looked[:-1]) < n / 4
