"""Embedding near-duplicates by cover trees and dual traversal, exact at the cosine threshold.

Vectors count by direction.  On the unit sphere cosine >= c means a chord of at most
t = sqrt(2 - 2c), and chords obey the triangle inequality, so trees of nested balls apply:

1. A bounded, hashed sample gives the top level: every row goes to its nearest centre, and
   there to the core (within `RADII[-1]`) or the shell.  Density decides how many centres lie
   in a crowd; cells of over `most` rows are dealt into parts by hash.
2. Every such chunk gets a cover tree with halving radii `RADII`.  Centres of a level stay
   centres of the next (nesting), lie farther apart than its radius (separation), and every
   node is within its parent's radius (covering).  Bounds use the measured covering radius.
3. Chunks meet by their roots: pairs whose roots lie farther apart than t and both radii are
   dropped, pairs that lie in t together with both radii link altogether and are counted from
   the roots.  Only the others are sent to tasks, each of which holds one host tree while
   guests pass.
4. Dual traversal takes pairs of nodes of a level: too far ones go, pairs within t with both
   radii link as wholes (sizes are multiplied, no pair is listed), the rest are taken to their
   children, in the end to single vectors whose cosine is computed.

What a task returns is a count per vector and edges between labels of local components, in
proportion to the rows it holds, never the pairs of a crowd.

Edge cases: null vectors, vectors of zero length or with null or non-finite components link
with nothing; neither do rows without a vec_id, whose component_id and kept are null.  Vectors
of different dimension don't link.  Equal vectors link.  Rows that repeat a vec_id are vectors
of their own, counted by row, but one point of the component graph.  Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .near import components
from .shared import discard, lean, small, spread_join, table, written

COSINE = 0.95
#: Radii of the levels of a tree; chords on the unit sphere are at most 2, so the first level is one root.
RADII = (2.0, 1.0, 0.5, 0.25, 0.125)
#: Room for rounding in bounds of chords; what lies within it is computed.
SLACK = 1e-6
#: Centres that the table is dealt to where it is small, rows that a centre should have, and rows of a chunk at most.
CELLS, LEAST, MOST = 12, 512, 1 << 15
#: Centres at most; they are rows of a sample by hash.
CENTRES = 4096
#: Pairs of nodes that a step of the traversal holds, and the share of live ones above which all are computed.
PAIRS, DENSE = 1 << 20, 1 / 16
#: Roots that a task holds when roots meet, and guests that a host gets in one task.
ROOTS, GUESTS = 1024, 8


def chords(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def unite(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the classes of u and v, pair by pair; root names the least member of every class."""
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v = u[apart], v[apart]
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(up := root[root], root):
            root[:] = up


def nest(unit: np.ndarray) -> np.ndarray:
    """For every row the centres above it, one per level, from the root down."""
    n, k = len(unit), len(RADII)
    path = np.empty((n, k), np.int64)
    is_centre = np.zeros(n, bool)
    is_centre[np.argmax(unit @ unit.mean(0))] = True
    own = np.full(n, np.argmax(is_centre))  # of every row, the centre of this level that covers it
    above = [np.full(n, -1)]
    born = np.where(is_centre, 0, k)
    for level in range(1, k):
        least = 1 - RADII[level] ** 2 / 2
        old, centres = own, np.flatnonzero(is_centre)
        own = np.where(is_centre, np.arange(n), -1)
        free = np.flatnonzero(~is_centre)
        step = max(1, PAIRS // len(centres))
        for a in range(0, len(free), step):
            some = free[a : a + step]
            dots = unit[some] @ unit[centres].T
            best = dots.argmax(1)
            near = dots[np.arange(len(some)), best] >= least
            own[some[near]] = centres[best[near]]
        left = free[own[free] < 0]
        while len(left):
            block = left[:256]
            dots = unit[block] @ unit[block].T >= least
            gone = np.zeros(len(block), bool)
            picked = []
            for i in range(len(block)):
                if not gone[i]:
                    picked.append(i)
                    gone |= dots[i]
            new = block[picked]
            is_centre[new], own[new], born[new] = True, new, level
            left = left[own[left] < 0]
            dots = unit[left] @ unit[new].T
            best = dots.argmax(1) if len(left) else np.zeros(0, np.int64)
            near = dots[np.arange(len(left)), best] >= least
            own[left[near]] = new[best[near]]
            left = left[~near]
        above.append(np.where(born == level, old, -1))
    # the path from the finest level up: a centre is its own parent until the level that it was born at
    path[:, k - 1] = own
    parent = np.where(born < k, np.max(above, axis=0), own)
    parent[born == 0] = np.flatnonzero(born == 0)
    for level in range(k - 1, 0, -1):
        at = path[:, level]
        path[:, level - 1] = np.where(born[at] < level, at, parent[at])
    return path


class Tree:
    """Rows of one chunk in the order of their tree: every node is a run of rows, told by its start."""

    def __init__(self, raw: np.ndarray, path: np.ndarray):
        self.raw, self.norm = raw, np.sqrt((raw * raw).sum(1))
        self.unit = raw / self.norm[:, None]
        n = len(raw)
        every = np.arange(n)
        self.starts, self.centres, self.sizes, self.radii = [], [], [], []
        for level in range(len(RADII) + 1):
            at = path[:, level] if level < len(RADII) else every
            start = np.flatnonzero(np.diff(at, prepend=-1) != 0)
            self.starts.append(start)
            self.centres.append(at[start])
            self.sizes.append(np.diff(np.append(start, n)))
            far = chords(np.einsum("ij,ij->i", self.unit, self.unit[at])) if level < len(RADII) else np.zeros(n)
            self.radii.append(np.maximum.reduceat(far, start) if n else far)
        self.counts = [np.zeros(len(s), np.int64) for s in self.starts]
        self.whole = [np.zeros(len(s), bool) for s in self.starts]

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of the next level below the given ones, and for each the place of its parent among them."""
        edge = np.append(self.starts[level], len(self.raw))
        lo, hi = np.searchsorted(self.starts[level + 1], edge[nodes]), np.searchsorted(self.starts[level + 1], edge[nodes + 1])
        place = np.repeat(np.arange(len(nodes)), hi - lo)
        return np.arange(len(place)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[place], place

    def links(self) -> np.ndarray:
        """Of every row, the links counted at it and at the nodes above it."""
        return sum((np.repeat(c, s) for c, s in zip(self.counts, self.sizes, strict=True)), np.zeros(len(self.raw), np.int64))


def ordered(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which every node of their cover tree is a run, and the paths in that order, by places."""
    path = nest(raw / np.sqrt((raw * raw).sum(1))[:, None])
    order = np.lexsort(path.T[::-1])
    place = np.empty(len(raw), np.int64)
    place[order] = np.arange(len(raw))
    return order, place[path[order]]


class Traversal:
    """Counts links between two trees (or within one) and joins the classes of what links."""

    def __init__(self, a: Tree, b: Tree, cosine: float, root: np.ndarray):
        """root: classes of a's rows, then of b's unless it is a itself."""
        self.a, self.b, self.cosine, self.root, self.same = a, b, cosine, root, a is b
        self.shift = 0 if self.same else len(a.raw)
        self.most = float(np.sqrt(2 - 2 * cosine))

    def run(self) -> None:
        self.visit(0, np.arange(len(self.a.starts[0])), np.arange(len(self.b.starts[0])), None)
        for tree, shift in ((self.a, 0), (self.b, self.shift)):
            for level in range(len(RADII)):
                inside = np.repeat(tree.whole[level], tree.sizes[level])
                unite(self.root, shift + np.flatnonzero(inside), shift + np.repeat(tree.centres[level], tree.sizes[level])[inside])

    def dots(self, x: np.ndarray, y: np.ndarray, live: np.ndarray | None) -> np.ndarray:
        if live is None or live.mean() > DENSE:
            return x @ y.T
        out = np.zeros(live.shape)
        q, c = np.nonzero(live)
        for at in range(0, len(q), 1 << 15):
            out[q[at : at + (1 << 15)], c[at : at + (1 << 15)]] = np.einsum("ij,ij->i", x[q[at : at + (1 << 15)]], y[c[at : at + (1 << 15)]])
        return out

    def visit(self, level: int, i: np.ndarray, j: np.ndarray, live: np.ndarray | None) -> None:
        """Decides the live pairs of nodes i and j, and takes those that are left to their children."""
        a, b = self.a, self.b
        at, of = a.centres[level][i], b.centres[level][j]
        dots = self.dots(a.unit[at], b.unit[of], live)
        live = np.ones(dots.shape, bool) if live is None else live
        last = level == len(RADII)
        if last:
            linked = live & (dots >= self.cosine)
            for p, q in np.argwhere(live & (np.abs(dots - self.cosine) < 1e-9)):
                x, y = at[p], of[q]
                linked[p, q] = float(a.raw[x] @ b.raw[y]) / (float(a.norm[x]) * float(b.norm[y])) >= self.cosine
        else:
            far, reach = chords(dots), a.radii[level][i][:, None] + b.radii[level][j][None, :]
            linked = live & (far + reach <= self.most - SLACK)
            live &= ~linked & (far - reach <= self.most + SLACK)
        if linked.any():
            a.counts[level][i] += linked @ b.sizes[level][j]
            a.whole[level][i] |= linked.any(1)
            if not self.same:
                b.counts[level][j] += a.sizes[level][i] @ linked
                b.whole[level][j] |= linked.any(0)
            p, q = np.nonzero(linked & (self.root[at][:, None] != self.root[of + self.shift][None, :]))
            unite(self.root, at[p], of[q] + self.shift)
        if last or not live.any():
            return
        rows, cols = live.any(1), live.any(0)
        live = live[np.ix_(rows, cols)]
        (down_i, pi), (down_j, pj) = a.children(level, i[rows]), b.children(level, j[cols])
        step = max(1, PAIRS // max(1, len(down_j)))
        for s in range(0, len(down_i), step):
            some = live[pi[s : s + step]]
            some_j = np.flatnonzero(some.any(0)[pj])
            for r in range(0, len(some_j), PAIRS):
                cut = some_j[r : r + PAIRS]
                if len(cut):
                    self.visit(level + 1, down_i[s : s + step], down_j[cut], some[:, pj[cut]])


def matrix(column: pa.Array) -> np.ndarray:
    return np.stack([v.values.to_numpy(zero_copy_only=False) for v in column]) if len(column) else np.zeros((0, 0))


def prepared(rows: DataFrame, cells: int, most: int) -> DataFrame:
    """Written: uid, vec_id, x (null where a row links with nothing), chunk, of every row."""
    good = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    sample = [np.array(r[0], float) for r in rows.filter(good).orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(min(cells, CENTRES)).select("embedding").collect()]
    sizes = [len(v) for v in sample]
    centres = np.stack([v / np.abs(v).max() for v in sample if len(v) == max(set(sizes), key=sizes.count)]) if sample else np.zeros((0, 0))
    centres = centres / np.sqrt((centres * centres).sum(1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, dim, cell, core = [], [], [], []
            for v in batch.column("embedding"):
                own = v.values.to_numpy(zero_copy_only=False).astype(float) if v.is_valid and v.values.null_count == 0 else np.zeros(0)
                scale = np.abs(own).max(initial=0)
                x.append(own / 2.0 ** np.frexp(scale)[1] if np.isfinite(scale) and scale > 0 else None)  # by a power of two: no cosine changes, no square overflows
                dim.append(0 if x[-1] is None else len(own))
                cell.append(0)
                core.append(False)
            at = [k for k, d in enumerate(dim) if d == centres.shape[1] and d]
            if at:
                own = np.stack([x[k] for k in at])
                dots = (own / np.sqrt((own * own).sum(1, keepdims=True))) @ centres.T
                best = dots.argmax(1)
                for k, c, d in zip(at, best.tolist(), dots[np.arange(len(at)), best], strict=True):
                    cell[k], core[k] = c, bool(d >= 1 - RADII[-1] ** 2 / 2)
            # rows without a vec_id take no part
            ids = batch.column("vec_id")
            none = ids.is_null().to_numpy(zero_copy_only=False)
            x = [None if n else v for v, n in zip(x, none, strict=True)]
            lists = pa.array(x, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), ids, lists, pa.array(dim, pa.int32()), pa.array(cell, pa.int32()), pa.array(core, pa.bool_())], ["uid", "vec_id", "x", "dim", "cell", "core"])
        vec.hand_back()

    dealt = written(rows.mapInArrow(run, "uid long, vec_id long, x array<double>, dim int, cell int, core boolean"), "vectors")
    parts = dealt.filter("x is not null").groupBy("dim", "cell", "core").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    # cells are few whatever the rows are: at most two for a centre and one for each other dimension
    out = dealt.join(F.broadcast(parts) if small(parts, 200_000) else parts, ["dim", "cell", "core"], "left")
    chunk = F.concat_ws(".", "dim", "cell", F.col("core").cast("int"), F.pmod(F.xxhash64("uid"), F.col("parts")))
    chunked = written(out.select("uid", "vec_id", "x", F.when(F.col("x").isNotNull(), chunk).alias("chunk")), "chunks")
    discard(dealt)
    return chunked


def _chunks(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows that agree in the columns `by`, whole, one at a time."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True))
        a = 0
        while a < len(keys):
            b = a
            while b < len(keys) and keys[b] == keys[a]:
                b += 1
            if keys[a] != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
            a = b
    if held:
        yield key, pa.Table.from_batches(held)


def _column(t: pa.Table, name: str) -> pa.Array:
    return t.column(name).combine_chunks() if t.num_rows else t.column(name)


def least_of(root: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of every row the least id of its class."""
    least = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    return least[root]


def planted(chunks: DataFrame, cosine: float) -> DataFrame:
    """Written: uid, vec_id, x, chunk, place, path, size, radius (of the root only), own (links within the chunk), label (least vec_id of the component within)."""
    names = ["uid", "vec_id", "x", "chunk", "place", "path", "size", "radius", "own", "label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), rows in _chunks(batches, "chunk"):
            raw = matrix(_column(rows, "x"))
            order, path = ordered(raw)
            raw, uid, ids = raw[order], _column(rows, "uid").to_numpy()[order], _column(rows, "vec_id").to_numpy()[order]
            tree, root = Tree(raw, path), np.arange(len(raw))
            Traversal(tree, tree, cosine, root).run()
            own, label = tree.links() - 1, least_of(root, ids)
            radius = np.where(np.arange(len(raw)) == path[0, 0], tree.radii[0][0], np.nan)
            for a in range(0, len(raw), 2048):
                s = slice(a, a + 2048)
                n = len(raw[s])
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m.shape[1], pa.int32()), pa.array(m[s].ravel(), kind)) for m, kind in ((raw, pa.float64()), (path, pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[s]), pa.array(ids[s]), lists[0], pa.array([chunk] * n), pa.array(np.arange(a, a + n), pa.int32()), lists[1], pa.array([len(raw)] * n, pa.int64()), pa.array(radius[s], from_pandas=True), pa.array(own[s]), pa.array(label[s])], names
                )
        vec.hand_back()

    dealt = chunks.filter("x is not null").repartition("chunk").sortWithinPartitions("chunk", "uid")
    return written(dealt.mapInArrow(run, "uid long, vec_id long, x array<double>, chunk string, place int, path array<int>, size long, radius double, own long, label long"), "trees")


def meeting(roots: DataFrame, cosine: float) -> DataFrame:
    """Written: a, b, na, nb, whole: pairs of chunks that their roots don't part; whole where all rows of one link with all of the other. Roots are dealt into blocks, each of which all roots pass."""
    blocks = max(1, -(-roots.count() // ROOTS))
    most = float(np.sqrt(2 - 2 * cosine))
    held = roots.select(F.pmod(F.xxhash64("chunk"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("role"), "chunk", "x", "radius", "size")
    pass_by = roots.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("role"), "chunk", "x", "radius", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, sizes, reach, units = None, [], [], [], []
        for (block, role, chunk), row in _chunks(batches, "block", "role", "chunk"):
            own = matrix(_column(row, "x"))[0]
            own, r, n = own / np.sqrt(own @ own), row.column("radius")[0].as_py(), row.column("size")[0].as_py()
            if block != now:
                now, names, sizes, reach, units = block, [], [], [], []
            if role == 0:
                names.append(chunk)
                sizes.append(n)
                reach.append(r)
                units.append(own)
                continue
            fit = [k for k, other in enumerate(names) if chunk < other and len(units[k]) == len(own)]
            far = chords(np.array([units[k] @ own for k in fit]))
            both = np.array([reach[k] for k in fit]) + r
            met = [(k, bool(w)) for k, w, ok in zip(fit, far + both <= most - SLACK, far - both <= most + SLACK, strict=True) if ok]
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(met), pa.string()), pa.array([names[k] for k, _ in met], pa.string()), pa.array([n] * len(met), pa.int64()), pa.array([sizes[k] for k, _ in met], pa.int64()), pa.array([w for _, w in met], pa.bool_())], ["a", "b", "na", "nb", "whole"])

    dealt = held.unionByName(pass_by).repartition("block").sortWithinPartitions("block", "role", "chunk")
    return written(dealt.mapInArrow(run, "a string, b string, na long, nb long, whole boolean"), "meeting")


def crossed(trees: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """Written: rows of uid, n (links with vectors of other chunks) and rows of a, b (labels that link)."""
    chunks = pairs.select("a").union(pairs.select("b")).distinct().count()
    swap = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    dealt = pairs.select(F.when(swap, F.col("a")).otherwise(F.col("b")).alias("host"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("chunk"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(max(1, chunks // GUESTS))).cast("int"))
    wanted = written(dealt.select("host", "part", F.lit(1).alias("role"), "chunk").union(dealt.select("host", "part").distinct().select("host", "part", F.lit(0), F.col("host"))), "wanted")
    rows = trees.select("chunk", "uid", "x", "place", "path", "label")
    sent = rows.join(F.broadcast(wanted) if small(wanted, 500_000) else wanted, "chunk")
    parts = max(1, wanted.filter("role = 0").count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host: tuple = ()
        for (name, part, role, _), rows in _chunks(batches, "host", "part", "role", "chunk"):
            path = np.stack([v.values.to_numpy() for v in _column(rows, "path")])
            tree, label, uid = Tree(matrix(_column(rows, "x")), path), _column(rows, "label").to_numpy(), _column(rows, "uid").to_numpy()
            if role == 0:
                host, held, held_label, held_uid = (name, part), tree, label, uid
                continue
            assert host == (name, part), "a host comes before its guests"
            labels = np.concatenate([held_label, label])
            _, first, place = np.unique(labels, return_index=True, return_inverse=True)
            root = first[place]
            for c in held.counts + held.whole:
                c[:] = 0
            Traversal(held, tree, cosine, root).run()
            n = np.concatenate([held.links(), tree.links()])
            ids = np.concatenate([held_uid, uid])
            least = least_of(root, labels)
            joined = np.unique(np.stack([least, labels], 1)[least != labels], axis=0)
            some = np.flatnonzero(n)
            none = [None] * len(joined)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids[some].tolist(), *none], pa.int64()), pa.array([*n[some].tolist(), *none], pa.int64()), *(pa.array([*([None] * len(some)), *joined[:, k].tolist()], pa.int64()) for k in (0, 1))], ["uid", "n", "a", "b"]
            )
        vec.hand_back()

    spread = sent.repartition(parts, "host", "part").sortWithinPartitions("host", "part", "role", "chunk", "place")
    found = written(spread.mapInArrow(run, "uid long, n long, a long, b long"), "crossed")
    discard(wanted)
    return found


def near_vectors(rows: DataFrame, cosine: float = COSINE, cells: int = CELLS, most: int = MOST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row. rows: vec_id, embedding."""
    lean(rows.sparkSession)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    total = rows.count()
    chunks = prepared(rows, max(1, min(cells, total // LEAST), -(-total // most)), most)
    trees = planted(chunks, cosine)
    pairs = meeting(trees.filter("radius is not null"), cosine)
    found = crossed(trees, pairs.filter("not whole"), cosine)
    links = found.filter("uid is not null").groupBy("uid").agg(F.sum("n").alias("n"))
    # chunks that link altogether: sizes of the partners, an edge between the least labels, and all labels of a chunk with one partner's
    both = pairs.filter("whole").select("a", "b", F.col("nb").alias("n")).unionByName(pairs.filter("whole").select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("na").alias("n")))
    partners = written(both.groupBy(F.col("a").alias("chunk")).agg(F.sum("n").alias("with_all"), F.min("b").alias("partner")), "partners")
    labels = trees.select("chunk", "label").distinct()
    least = written(labels.groupBy("chunk").agg(F.min("label").alias("least")), "least")
    edges = found.filter("a is not null").select("a", "b")
    edges = edges.union(both.join(least.withColumnsRenamed({"chunk": "a", "least": "x"}), "a").join(least.withColumnsRenamed({"chunk": "b", "least": "y"}), "b").filter("x < y").select("x", "y"))
    edges = edges.union(labels.join(partners, "chunk").join(least.withColumnsRenamed({"chunk": "partner", "least": "y"}), "partner").select("label", "y"))
    merged = components(edges.distinct())
    named = merged.select(F.col("node").alias("label"), F.col("label").alias("component"))
    own = trees.select("uid", "vec_id", "chunk", "own", "label").join(links, "uid", "left")
    own = own.join(F.broadcast(partners.drop("partner")) if small(partners, 500_000) else partners.drop("partner"), "chunk", "left")
    own = own.join(F.broadcast(named), "label", "left") if small(named, 500_000) else spread_join(written(own, "own"), named, "label", "left")
    n = F.col("own") + F.coalesce("n", F.lit(0)) + F.coalesce("with_all", F.lit(0))
    alone = chunks.filter("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = written(own.select("vec_id", n.cast("long").alias("n_links"), F.coalesce("component", "label").alias("component_id")).unionByName(alone), "near-vectors")
    discard(chunks, trees, pairs, found, partners, least, merged)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs and labels that spread along links.
ORACLE = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), u as (select vec_id, x, sqrt(list_dot_product(x, x)) as n from v),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95),
reach as (select vec_id as a, vec_id as b from embeddings union select reach.a, l.b from reach join l on reach.b = l.a),
least as (select a, min(b) as component_id from reach group by a)
select e.vec_id, (select count(*) from l where l.a = e.vec_id) as n_links, component_id, component_id = e.vec_id as kept
from embeddings e join least on least.a = e.vec_id
"""
