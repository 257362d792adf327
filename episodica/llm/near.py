"""Links between shingle sets: blocks of candidates, pivots, exact verification, components.

A *node* is one distinct shingle set, named by a 64-bit key of the set; copies share
a node.  Two nodes link if 100 * |intersection| >= percent * |union|.  Callers bring
*blocks* (sig, node): nodes that share a signature, such that linked nodes meet in a
block.  `link` finds the components of all links without listing the pairs of a block:

1. Blocks whose nodes are in one component are done; a comparison's signatures get the
   component of their node before they are spread to rows, so that done blocks aren't written.
2. Larger blocks that are one component but for at most half of `SMALL` nodes are dealt
   into small ones, each with all of these and a share of the others: pairs within the
   component count no more, and the rest are in one of them.
3. Blocks of at most `SMALL` nodes: every node has a parity bitmap of its set.  The bits
   in which two bitmaps differ are at most the shingles in which the sets differ, and
   linked sets differ in at most T = (100 - percent) / (100 + percent) * (|x| + |y|), so
   pairs with more such bits go.  Of the others a spanning forest of the closest is
   compared on whole texts first; where more are left than the forest has edges, and its
   links haven't brought them together, all are compared in the next round.
4. In other large blocks one node is the pivot h, and all nodes x are compared with it:
   one with the fewest rare shingles or, where none are told apart, nearest to the pivot
   before it, then one with the most nodes beside it.  A pivot at the rim would leave its
   own peculiar shingles to be shared by all others.  Let d(x) be the symmetric
   difference of x and h.  If x and y link, the symmetric difference of d(x) and d(y) is
   that of x and y, at most T.
   Either d(x) and d(y) are disjoint: then both link with h and need no comparison.  Or
   they share a part; fewer than T + 1 parts of d(x) are missing in d(y), so the first
   shared part is among the first T + 1 of both, in any order that depends on h only:
   rare parts that x adds, then what it lacks, then what h itself lacks or adds.  If x
   links with h and y does not, more than (1 - c) / 2 of d(x) is shared, c being
   T / (|x| + |y|), so fewer parts do.  These parts, with h, are the next round's
   signatures: rows in proportion to the sets, whatever a block's size.  The next
   round's blocks lie within this one's and lack their pivots, so rounds end.

A pivot with many nodes is dealt over many tasks, each with at most `PER_TASK`.  Every
round is written; tables that a round has superseded are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import discard, release, semi, small, written

PER_TASK = 64
SMALL = 1024
#: Edges up to so many are joined in one task, 16 bytes each; more of them in rounds over all tasks.
LOCAL = 500_000
U64 = np.uint64


def set_key(shingles: np.ndarray) -> int:
    """The key of a sorted set of shingles, as a signed 64-bit integer."""
    with np.errstate(over="ignore"):
        total = vec.mix(shingles + U64(len(shingles))).sum(dtype=U64)
        return int(vec.mix(np.array([total ^ U64(len(shingles))], U64)).view(np.int64)[0])


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and of each the smallest node reachable: roots hang on the least root beside them until edges lie within trees."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, low = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while (low[x] != low[y]).any():
        p, q = low[x], low[y]
        np.minimum.at(low, p, q)
        np.minimum.at(low, q, p)
        while (low[low] != low).any():
            low = low[low]
    return nodes, nodes[low]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    nodes, label = least_labels(table["a"].to_numpy(), table["b"].to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(label, pa.int64())], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) for every node of edges (a, b).

    Up to `LOCAL` edges are joined in one task.  Of more, smallest labels of neighbours and
    pointer jumping alternate until nothing changes; every round is a written table.  Group
    sizes don't matter: sums are pre-aggregated.
    """
    given = written(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b"), "given")
    if small(given, LOCAL):
        labels = written(given.coalesce(1).mapInArrow(_joined, "node long, label long"), "labels")
        discard(given)
        return labels
    both = written(given.union(given.select("b", "a")).distinct(), "edges")
    discard(given)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = written(hooked.join(up, "label", "left").select("node", F.least("label", "up").alias("label"), (F.least("label", "up") < F.col("old")).alias("changed")), "labels")
        done = not new.filter("changed").limit(1).count()
        discard(labels)
        labels = new
        if done:
            discard(both)
            return labels


def difference_most(n: int, k: int, percent: int) -> int:
    """How many shingles linked sets of n and k can differ in at most."""
    return (100 - percent) * (n + k) // (100 + percent)


def parts_of(own: np.ndarray, pivot: np.ndarray, percent: int, rare: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[bool, int, np.ndarray]:
    """Whether the sets link, the size of their symmetric difference, and its first parts."""
    added, lacked = np.setdiff1d(own, pivot, assume_unique=True), np.setdiff1d(pivot, own, assume_unique=True)
    s, n = len(added) + len(lacked), len(own)
    linked = s <= difference_most(n, len(pivot), percent)
    most = s - int(s * percent // (100 + percent)) if linked else difference_most(n, 100 * n // percent, percent) + 1
    if rare is not None:
        a, k = rare(added), rare(lacked)
        return linked, s, np.concatenate([added[a], lacked[~k], added[~a], lacked[k]])[:most]
    return linked, s, np.concatenate([added, lacked])[:most]


def bitmap(own: np.ndarray, percent: int) -> bytes:
    """Parity bits of a set, as many as a power of two that is at least ten times the shingles in which linked sets of its size can differ, 256 at least."""
    size = max(256, 1 << (10 * difference_most(len(own), len(own), percent) - 1).bit_length()) if len(own) > 1 else 256
    return np.packbits((np.bincount((own & U64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def set_marks(grams: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """`set_key`, size and `bitmap` of the sets of many rows at once. first: of each row its first shingle, one entry more than rows; shingles may repeat, every row has one."""
    own = grams.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own[a:b].sort()
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    new[first[:-1]] = True
    n = np.add.reduceat(new.astype(np.int64), first[:-1]) if len(own) else np.zeros(0, np.int64)
    own, start, width, most = own[new], np.cumsum(n) - n, np.full(len(n), 256), np.where(n > 1, 10 * difference_most(n, n, percent), 0)
    with np.errstate(over="ignore"):
        total = np.add.reduceat(vec.mix(own + np.repeat(n, n).astype(U64)), start) if len(own) else own
        keys = vec.mix(total ^ n.astype(U64)).view(np.int64)
    while (width < most).any():
        width[width < most] *= 2
    place = np.concatenate([[0], np.cumsum(width)])
    odd = np.bincount(np.repeat(place[:-1], n) + (own & np.repeat(width - 1, n).astype(U64)).astype(np.int64), minlength=int(place[-1])) & 1
    bits = np.packbits(odd.astype(np.uint8), bitorder="little")
    return keys, n, pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((place // 8).astype(np.int32)), pa.py_buffer(bits)])


def _apart(block: pa.StructArray, percent: int) -> np.ndarray:
    """Of all pairs of a block: how far their bitmaps differ beyond what linked sets may (scaled; over 0: not linked). Bitmaps of twice the size are folded: sets of linked sizes have no others."""
    n = block.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
    raw = block.field("bits").to_pylist()
    size = np.array([len(b) for b in raw])
    out = np.ones((len(n), len(n)), np.int64)
    for width in np.unique(size):
        same, twice = np.flatnonzero(size == width), np.flatnonzero(size == 2 * width)
        full = np.frombuffer(b"".join(raw[i] for i in same), U64).reshape(len(same), -1)
        wide = np.frombuffer(b"".join(raw[i] for i in twice), U64).reshape(len(twice), 2 * full.shape[1])
        other, bits = np.concatenate([same, twice]), np.concatenate([full, wide[:, : full.shape[1]] ^ wide[:, full.shape[1] :]])
        step = max(1, (1 << 20) // max(1, bits.size))
        for at in range(0, len(same), step):
            own = same[at : at + step]
            bits_apart = np.bitwise_count(full[at : at + step, None, :] ^ bits[None, :, :]).sum(2, dtype=np.int64)
            beyond = (100 + percent) * bits_apart - (100 - percent) * (n[own][:, None] + n[other][None, :])
            beyond[100 * np.minimum(n[own][:, None], n[other][None, :]) < percent * np.maximum(n[own][:, None], n[other][None, :])] = 1
            out[np.ix_(own, other)] = beyond
            out[np.ix_(other, own)] = beyond.T
    return out


def _forest(cost: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest over pairs of cost 0 or less, cheapest first; nodes of one label are joined beforehand."""
    far = 1 << 60
    cost = np.where(label[:, None] == label[None, :], -far, np.where(cost <= 0, cost, far))
    best, parent, done, edges = np.full(len(label), far), np.zeros(len(label), np.int64), np.zeros(len(label), bool), []
    for _ in range(len(label)):
        j = int(np.argmin(np.where(done, far + 1, best)))
        if best[j] < far and label[parent[j]] != label[j]:
            edges.append((int(parent[j]), j))
        done[j] = True
        nearer = cost[j] < best
        best[nearer], parent[nearer] = cost[j][nearer], j
    return edges


def close_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of a block, of different labels, that their bitmaps don't part; rows with sig alone: blocks with more of them. blocks: sig, age, nodes (array of node, label, n, bits).

    At age 0 only a forest of the closest pairs that joins the block's labels is asked
    for; at age 1, when its links have merged labels, all pairs that are left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[int, int]] = set()
            more: list[int] = []
            for sig, age, block in zip(batch.column("sig").to_pylist(), batch.column("age").to_pylist(), batch.column("nodes"), strict=True):
                node, label = (block.values.field(c).to_numpy(zero_copy_only=False) for c in ("node", "label"))
                cost = _apart(block.values, percent)
                left = (cost <= 0) & (label[:, None] < label[None, :])
                pairs = _forest(cost, label) if age == 0 else np.argwhere(left).tolist()
                if int(left.sum()) > len(pairs):
                    more.append(sig)
                out.update((max(a, b), min(a, b)) for a, b in ((int(node[i]), int(node[k])) for i, k in pairs))
            none = [None] * len(more)
            yield pa.RecordBatch.from_arrays([pa.array([*(x[i] for x in out), *none], pa.int64()) for i in (0, 1)] + [pa.array([*([None] * len(out)), *more], pa.int64())], ["a", "b", "sig"])
        vec.hand_back()

    return blocks.select("sig", "age", "nodes").mapInArrow(run, "a long, b long, sig long")


def compare(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, rare: Callable[[np.ndarray], np.ndarray] | None = None, table: np.ndarray = vec.SPACED, is_word: np.ndarray = vec.SPACED_WORD) -> DataFrame:
    """Written: a, b, linked, r (rare shingles of a; where none are told apart, those in which a and b differ), and of pairs with a pivot b the next round's signatures of a. pairs: a, b, pivot. texts: node, text."""
    hosts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("parts"))
    keyed = pairs.join(F.broadcast(hosts) if small(hosts, 500_000) else hosts, "b").select("a", "b", "pivot", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    keyed = written(keyed, "pairs")
    wanted = keyed.select("b", "part", F.when(F.col("pivot"), 2).otherwise(1).alias("role"), F.col("a").alias("node")).union(keyed.select("b", "part").distinct().select("b", "part", F.lit(0), F.col("b")))
    wanted = wanted.join(texts.select("node", "text"), "node") if not small(wanted, 500_000) else texts.select("node", "text").join(F.broadcast(wanted), "node")
    dealt = wanted.select("b", "part", "role", "node", "text").repartition("b", "part").sortWithinPartitions("b", "part", "role", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        host: tuple = ()
        last: tuple = ()
        kept = np.zeros(0, U64)
        for batch, raw, offs in vec.pieces(batches, "text"):
            sets = vec.shingle_sets(vec.find_words(raw, offs, table, is_word), shingle)
            a, hub, linked, r, sigs = [], [], [], [], []
            for b, part, role, node, own in zip(*(batch.column(c).to_pylist() for c in ("b", "part", "role", "node")), sets, strict=True):
                if (b, part, role, node) == last or set_key(own) != node:
                    continue  # a repeated row, or another text under the same id
                last = (b, part, role, node)
                if role == 0:
                    host, kept = (b, part), own
                elif host == (b, part):
                    yes, apart, parts = parts_of(own, kept, percent, rare)
                    a.append(node)
                    hub.append(b)
                    linked.append(yes)
                    r.append(apart if rare is None else int(rare(own).sum()))
                    sigs.append(vec.mix(parts ^ vec.mix(np.array([b], np.int64).view(U64))) if role == 2 else parts[:0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(hub, pa.int64()), pa.array(linked, pa.bool_()), pa.array(r, pa.int32()), vec.list_column(sigs, pa.int64())], ["a", "b", "linked", "r", "sigs"])

    found = written(dealt.mapInArrow(run, "a long, b long, linked boolean, r int, sigs array<long>"), "compared")
    discard(keyed)
    return found


def named(rows: DataFrame, labels: DataFrame, node: str) -> DataFrame:
    """Adds label: that of the node, or the node itself where it has none."""
    labels = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    met = rows.join(F.broadcast(labels) if small(labels, 500_000) else labels, F.col(node) == F.col("_node"), "left")
    return met.withColumn("label", F.coalesce("_label", node)).drop("_node", "_label")


def one_of_equal(postings: DataFrame, label: str = "node") -> DataFrame:
    """sig of blocks of two labels or more, one of those with the same nodes. postings: sig, node, label (of a node, the same in all its rows).

    Blocks are told apart by count, least and largest node and sums of hashes; in a sum, unlike a parity, a node that stands twice doesn't vanish."""
    h = F.xxhash64("node")
    prints = postings.groupBy("sig").agg(F.count("*").alias("k"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("x"), F.sum(F.shiftrightunsigned(h, 32)).alias("y"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.min(label).alias("least"), F.max(label).alias("most"))
    return prints.filter("least < most").groupBy("k", "x", "y", "lo", "hi").agg(F.min("sig").alias("sig")).select("sig")


def far_pairs(blocks: DataFrame, large: DataFrame) -> DataFrame:
    """a, b: every node a of a large block beside the block's pivot b. blocks: sig, node, r. large: sig, k (its nodes).

    The pivot has the least r of its block; of these, the most nodes beside it in all its large blocks, so that blocks over the same nodes take one pivot."""
    met = blocks.join(F.broadcast(large) if small(large, 500_000) else large, "sig").select("sig", "node", "r", "k")
    beside = met.groupBy("node").agg(F.sum("k").alias("beside"))
    pivots = met.join(beside, "node").groupBy("sig").agg(F.min_by("node", F.struct("r", -F.col("beside"), "node")).alias("b"))
    pivots = written(pivots, "pivots")
    far = blocks.join(F.broadcast(pivots) if small(pivots, 500_000) else pivots, "sig").filter("node <> b")
    return far.select(F.col("node").alias("a"), "b").distinct()


def dealt(blocks: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large blocks that are one component but for a few nodes, as small ones, and sig, k of the other large blocks. blocks: sig, node, r, age, label. large: sig, k (its nodes).

    Only pairs of different labels count, so each part holds all nodes beside the block's
    main label, at most half of `SMALL`, and a share of those with it: at most twice the
    block's rows."""
    met = blocks.join(F.broadcast(large) if small(large, 500_000) else large, "sig")
    mains = met.groupBy("sig", "k", "label").agg(F.count("*").alias("m")).groupBy("sig", "k").agg(F.max(F.struct("m", "label")).alias("main")).select("sig", "k", F.col("main.label").alias("main"), F.expr(f"k - main.m <= {SMALL // 2}").alias("few"), F.expr(f"cast(ceil(main.m / ({SMALL} - least(k - main.m, {SMALL // 2}))) as int)").alias("parts"))
    mains = written(mains, "mains")
    few = mains.filter("few").select("sig", "main", "parts")
    share = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    parts = blocks.join(F.broadcast(few) if small(few, 500_000) else few, "sig").withColumn("part", F.explode(share))
    return parts.select(F.xxhash64("sig", "part").alias("sig"), "node", "r", "age", "label"), mains.filter("not few").select("sig", "k")


def link(blocks: DataFrame, marks: DataFrame, texts: DataFrame, shingle: int, percent: int, rare: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """node, label of every node that is linked with another.

    All of these are written tables, which stay. blocks: sig, node, r (how many rare shingles). marks: node, n, bits. texts: node, text. rare: which shingles are."""
    given = blocks
    blocks = blocks.select("sig", "node", "r", F.lit(0).alias("age"), F.col("node").alias("label"))
    links = labels = None
    while True:
        info = blocks.groupBy("sig").agg(F.count("*").alias("k"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        info = written(info.select("sig", "k"), "sizes")
        small_blocks = semi(blocks, info.filter(F.col("k") <= SMALL).select("sig"), "sig")
        large, parts = info.filter(F.col("k") > SMALL), None
        if labels is not None and large.limit(1).count():
            parts, large = dealt(blocks, large)
            parts = written(parts, "dealt")
            small_blocks = small_blocks.unionByName(parts)
        marked = small_blocks.join(marks.select("node", "n", "bits"), "node")
        near = close_pairs(marked.groupBy("sig").agg(F.first("age").alias("age"), F.collect_list(F.struct("node", "label", "n", "bits")).alias("nodes")), percent)
        near = written(near, "near")
        far = far_pairs(blocks, large)
        asked = written(near.filter("a is not null").select("a", "b").distinct().withColumn("pivot", F.lit(False)).unionByName(far.withColumn("pivot", F.lit(True))), "asked")
        if labels is not None and not asked.limit(1).count():
            discard(info, parts, near, asked, blocks, *links)
            return labels
        found = compare(asked, texts, shingle, percent, rare)
        new = written(found.filter("linked").select("a", "b"), "links")
        if links is None or new.limit(1).count():
            links = [*(links or []), new]
            every = links[0]
            for more in links[1:]:
                every = every.union(more)
            done, labels = labels, components(every)
            discard(done)
        flat = named(found, labels, "a").select(F.explode("sigs").alias("sig"), F.col("a").alias("node"), "r", "label")
        shared = written(one_of_equal(flat, "label"), "shared")
        split = semi(flat, shared, "sig").withColumn("age", F.lit(0))
        again = semi((blocks if parts is None else blocks.unionByName(parts)).filter("age = 0"), near.filter("sig is not null").select("sig"), "sig").select("sig", "node", "r", F.lit(1).alias("age"))
        old, blocks = blocks, written(split.select("sig", "node", "r", "age", "label").unionByName(named(again, labels, "node")), "blocks")
        discard(old, info, parts, near, asked, found, shared)
        del info, small_blocks, large, parts, marked, near, far, asked, found, flat, shared, split, again, old
        release(given.sparkSession)
        if not blocks.limit(1).count():
            discard(blocks, *links)
            return labels
