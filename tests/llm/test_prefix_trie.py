"""Op 11: every node by brute force over dictionaries; copies, seams between tasks, odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from episodica.llm import prefix_trie as pt


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    seqs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(turns.get(c - int(c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:])
    nodes = {}
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            nodes.setdefault(seqs[c][:d], []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], set()).add(p)
    for p, members in nodes.items():
        value = (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += value
            leaves[p[:d]] += p not in kids
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in nodes[p] if len(seqs[c]) == len(p)).encode()).hexdigest()
    return sorted((m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p], ends(p)) for p, m in nodes.items())


def found(df):
    out = pt.trie(df)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in out.collect())


def talks(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        copy = rng.random() < 0.3
        for t in range(2 if copy else rng.randrange(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"hello there {0 if copy else rng.randrange(2)}" if t < 4 else f"x{rng.randrange(3)} y"))
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_dictionaries(spark, seed):
    rows = talks(seed, 300)
    rows += [(7000, None, None, None), (7000, 0, "", ""), (7001, 5, "user", None), (7001, 5, "user", None), (-3, 0, "a", "bc"), (-4, 0, "ab", "c"), (None, 0, "user", "lost"), (7021, 0, "u", "only"), (7022, 0, "u", "\x0bonly\xa0x \U0001f600")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as d", "'x' as node")
    assert found(df) == brute(rows)


def test_long_chain_and_one_common_conversation(spark):
    rows = [(20 * c, t, "u", f"t{t}") for c in range(40) for t in range(1 + c * 3)]
    rows += [(20 * c, t, "u", "same") for c in range(100, 220) for t in range(3)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_no_turns_and_empty_tables(spark):
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(turnless, 0, "u", "gone")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]
    assert found(spark.createDataFrame([], SCHEMA)) == []
