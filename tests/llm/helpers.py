"""Small documents with odd rows, and brute-force versions of the operators."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, sig string"
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(rng, n):
    return " ".join(rng.choice(["al", "bo", "ci", "du", "en"]) + rng.choice(["ra", "se", "ti", "no", "mu"]) + str(rng.randrange(400)) for _ in range(n))


def edited(rng, text, edits):
    w = text.split()
    for i in rng.sample(range(len(w)), edits):
        w[i] = "edit" + str(rng.randrange(10**9))
    return " ".join(w)


def documents(spark, texts):
    """Rows of doc_id 0, 1, ... with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or ""), 7, "x") for i, t in enumerate(texts)], SCHEMA)


ODD = [None, "", "   ", "one", "one", "\x00 nul \U0001f600 ünï", "a b", "a b"]


def union_find(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def shingles(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def family(seed, n=60, size=120):
    rng = random.Random(seed)
    base = prose(rng, size)
    return [edited(rng, base, rng.randrange(0, 6)) for _ in range(n)]
