"""Op 13: all pairs by brute force, the tree's rules, odd rows."""

import math

import numpy as np
import pytest

from episodica.llm import cover_trees as ct

from .helpers import union_find


def vectors(seed, n, dim, crowds=4, loose=0.25):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(crowds, dim))
    out = [rng.normal(size=dim) if i % 3 == 0 else base[i % crowds] + rng.normal(size=dim) * loose * rng.random() for i in range(n)]
    return [v.astype(np.float32).astype(float).tolist() for v in out]


def brute(rows):
    ok = {k: np.array(v) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    pairs = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= 0.95]
    n = [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    root = union_find(len(rows), pairs)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root[k]] = min(least.get(root[k], i), i) if i is not None else None
    return [(i, n[k], least[root[k]], None if i is None else i == least[root[k]]) for k, (i, _) in enumerate(rows)]


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize(("cells", "most"), [(12, 1 << 15), (5, 40), (1, 1 << 15)])
def test_equals_all_pairs(spark, monkeypatch, cells, most):
    monkeypatch.setattr(ct, "LEAST", 30)
    rows = [(1000 - i, v) for i, v in enumerate(vectors(1, 500, 16))]
    rows += [(2000 + i, rows[1][1]) for i in range(60)]  # equal rows
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [None, *rows[0][1][1:]]), (3004, [math.nan, *rows[0][1][1:]]), (3005, [math.inf] * 16), (None, rows[0][1]), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [-1.0, -2.0])]
    rows += [(3009, [v * 1e200 for v in rows[2][1]]), (3010, [v * 1e-200 for v in rows[2][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'l' as label", "1 as uid", "2 as chunk")
    scaled = [(i, v) if i not in (3009, 3010) else (i, rows[2][1]) for i, v in rows]
    got = ct.near_vectors(df, cells=cells, most=most)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert key(got.collect()) == key(brute(scaled))


def test_loose_chains_and_empty_tables(spark):
    turn = math.acos(0.951)
    rows = [(i, [math.cos(i * turn), math.sin(i * turn)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert key(ct.near_vectors(df).collect()) == key(brute(rows))
    assert ct.near_vectors(df.limit(0)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (9, [1.0, 0.1]), (7, [0.1, 1.0])]
    got = ct.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert key(got) == key([(5, 1, 5, True), (5, 1, 5, True), (9, 1, 5, False), (7, 1, 5, False)])


def test_levels_nest_cover_and_keep_apart():
    raw = np.array(vectors(3, 700, 8))
    order, path = ct.ordered(raw)
    unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True))[order]
    for level, radius in enumerate(ct.RADII):
        centres = np.unique(path[:, level])
        assert level == 0 or set(np.unique(path[:, level - 1])) <= set(centres)
        below = path[:, level + 1] if level + 1 < len(ct.RADII) else np.arange(len(unit))
        assert (np.linalg.norm(unit[below] - unit[path[:, level]], axis=1) <= radius + 1e-9).all()
        far = np.linalg.norm(unit[centres][:, None] - unit[centres][None], axis=2) + 9 * np.eye(len(centres))
        assert (far > radius - 1e-9).all()
        for c in centres:  # a node is a run of rows
            at = np.flatnonzero(path[:, level] == c)
            assert at[-1] - at[0] + 1 == len(at)


def test_crowds_are_counted_without_their_pairs(monkeypatch):
    rng = np.random.default_rng(5)
    raw = np.concatenate([rng.normal(size=(1, 32)) + rng.normal(size=(800, 32)) * 0.01, rng.normal(size=(200, 32))])
    asked = []
    dots = ct.Traversal.dots
    monkeypatch.setattr(ct.Traversal, "dots", lambda s, x, y, live: asked.append(x.shape[0] * y.shape[0] if live is None else int(live.sum())) or dots(s, x, y, live))
    order, path = ct.ordered(raw)
    tree, root = ct.Tree(raw[order], path), np.arange(len(raw))
    ct.Traversal(tree, tree, 0.95, root).run()
    assert sorted(tree.links() - 1) == [0] * 200 + [799] * 800
    assert sum(asked) < 200_000  # of a million pairs
