"""Benchmarks whose windows have more words than one letter can number, and hosts of odd urls."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.llm import decontaminate, secret_scan, url_lists, vec


def found_of(machine, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return machine.scan(vec.find_words(raw, np.array([0, len(raw)]), vec.ALNUM)).get(0, ([], set()))


@pytest.mark.parametrize("numbers", [decontaminate._ONE_LETTER, 5])
def test_words_of_two_letters_find_the_same(monkeypatch, numbers):
    monkeypatch.setattr(decontaminate, "_ONE_LETTER", numbers)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    windows = list(map(list, {tuple(rng.choices(vocabulary, k=rng.randrange(1, 6))): 0 for _ in range(800)}))  # distinct, as they come
    machine = decontaminate.Automaton([(" ".join(w).encode(), [str(i)]) for i, w in enumerate(windows)])
    assert machine.width == (2 if numbers == 5 else 1)
    for _ in range(40):
        words = [x for _ in range(8) for x in (rng.choice(windows) if rng.random() < 0.6 else [rng.choice([*vocabulary, "none"])])]
        hits, items = set(), set()
        for i, w in enumerate(windows):
            for a in range(len(words) - len(w) + 1):
                if words[a : a + len(w)] == w:
                    hits |= set(range(a, a + len(w)))
                    items.add(str(i))
        spans, who = found_of(machine, " ".join(words))
        assert {x for a, b in spans for x in range(a, b)} == hits and who == items


def test_long_windows_of_many_words(spark):
    """1.2 million distinct words in 30,000 windows of 40."""
    bench = spark.range(30_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(39)), lambda k: F.concat(F.lit("w"), (F.col("id") * 40 + k).cast("string")))).alias("text"))
    text = lambda i, n=40: " ".join(f"w{40 * i + k}" for k in range(n))
    docs = spark.createDataFrame([(1, f"a {text(7)} b"), (2, text(29_999)), (3, text(5, 39)), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.decontaminate(docs, bench, window=40).collect()}
    assert got == {1: (42, 40, ["7"]), 2: (40, 40, ["29999"]), 3: (39, 0, []), 4: (0, 0, [])}


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("http://[::1]/", "[::1]"), ("http://[2001:DB8::7]:8080/x", "[2001:db8::7]"), ("http://me@[::1]:80", "[::1]"), ("http://a@b@c.org/", "c.org"), ("http://u:p@ss@h.org:81/x@y", "h.org"),
        ("http://h.org/a@b", "h.org"), ("http://[::1", None), ("http://]/", None), ("http://h.org?x@y", "h.org"), ("http://H.org./", "h.org"), ("h.org/x", None), ("http:///x", None), (None, None),
    ],
)
def test_hosts(spark, url, host):
    assert spark.createDataFrame([(url,)], "url string").select(url_lists.host_of(F.col("url"))).first()[0] == host


@pytest.mark.parametrize(
    ("before", "known"),
    [("https://h.org/p", True), ("https://h.org/" + "p/" * 1500 + "x=", True), ("https://h.org/" + "p/" * 1500 + " x=", False), ("see https://h.org/a then b=", False), ("://", True), (":/ ", False), ("/", True), ("", False), ("https://a https://b?c=", True)],
)
def test_digests_in_urls_of_any_length(before, known):
    digest = "9f86d081884c7d659a2feaa0c55ad015"
    text = before + digest + " end"
    assert secret_scan.known_identifier(text, len(before), len(before) + 32, secret_scan.Urls(text)) is known
