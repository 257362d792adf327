"""N-gram Jaccard join: prefixes over single rare shingles and pairs of frequent ones.

A document's set holds its distinct `SHINGLE`-word shingles (words are runs without
white space, A-Z lowered); two documents link if 100 * |intersection| >=
`PERCENT` * |union|.

1. Documents with equal sets are one node.  A count sketch over nodes' shingles
   gives every shingle a class.  A quarter of all shingles, told by their hash, has
   counters of its own, about one for two of them, up to 2 ** `FINE_BITS`; the others
   share 2 ** `COARSE_BITS`, enough to tell the frequent ones.  Counts err upwards only;
   that changes the order below but no result.
2. Global order: finely counted shingles of few nodes by their counts, then those
   without a count, then counted ones of more nodes, then frequent ones; within a class
   by hash.  Of a set of n, at most e = n - ceil(t n)
   shingles are missing in a linked set.  If the first shingle that two linked sets
   share isn't frequent, it is among the first e + 1 of both: those single shingles are
   indexed, but for those that no other node has (a count of 1 proves it).  If it is
   frequent, so are all shared ones; then the prefix is extended until it holds more
   shared shingles than both sets' missing ones can part, so two neighbours of one set
   are neighbours of the other: these two-shingle combinations are indexed, a linear
   number.
3. Candidate blocks are verified on the whole sets and clustered (see `near`).

Edge cases: null and wordless texts have empty sets, link with nothing and are their
own component; texts of fewer words are one shingle; repeated rows share their
component; rows of one doc_id with different texts are different documents; rows
without a doc_id take no part in links and have a null component; an empty table
gives an empty table; other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .near import bitmap, link, one_of_equal, set_key
from .shared import discard, lean, release, semi, semi_anti, small, table, unused, written

SHINGLE = 3
PERCENT = 90
#: Counters of the sketch at most (powers of two), bytes of text for each, and the count from which a shingle is frequent, beside twice the mean load.
FINE_BITS = 24
COARSE_BITS = 18
CELL_BYTES = 64
FREQUENT = 64
#: Classes: counts as they are up to `_EXACT`, then halves of a power of two; `_UNCOUNTED` and more for counts above the common load; frequent ones.
_EXACT = 40
_UNCOUNTED = 100
_FREQUENT_CLASS = 255
_PART = 1 << 16
U64 = np.uint64


def missing_most(n: int, percent: int = PERCENT) -> int:
    """Of a set of n: how many shingles a linked set can lack at most."""
    return n - -(-percent * n // 100)


def fine_bits(total_bytes: int) -> int:
    """Fine counters, as a power of two, for so many bytes of text."""
    return min(FINE_BITS, max(16, (max(1, total_bytes) // CELL_BYTES).bit_length()))


def cells(shingles: np.ndarray, size: int) -> np.ndarray:
    """The counter of each shingle in a table of that size: a fine one if its first two bits are 0, else one of the coarse ones behind them."""
    fine = size - (1 << COARSE_BITS)
    own = (shingles >> U64(63 - fine.bit_length())) & U64(fine - 1)
    return np.where(shingles >> U64(62) == 0, own, U64(fine) + (shingles >> U64(64 - COARSE_BITS))).astype(np.int64)


def class_table(counts: np.ndarray, frequent: int = FREQUENT) -> np.ndarray:
    """A class, 0 to 255, for each counter. Works on a part at a time."""
    n = len(counts) - (1 << COARSE_BITS)
    fine, coarse = counts[:n], counts[n:]
    load, coarse_load = float(fine.mean()), float(coarse.mean()) * 4 / 3  # a quarter of the coarse ones stays empty
    out = np.full(len(counts), _UNCOUNTED, np.uint8)
    for at in range(0, n, _PART):
        part = fine[at : at + _PART]
        cls = np.minimum(part, _EXACT) + 2 * np.log2(np.maximum(part, _EXACT).astype(np.float32) / _EXACT)
        cls[part > 8 + 2 * load] += _UNCOUNTED
        cls[part >= frequent + 2 * load] = _FREQUENT_CLASS
        out[at : at + _PART] = cls.astype(np.uint8)
    out[n:][coarse >= frequent + 2 * coarse_load] = _FREQUENT_CLASS
    return out


def signatures(own: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Single shingles of the prefix that may have another node, and pairs of neighbouring frequent ones of the extended prefix."""
    n = len(own)
    e = missing_most(n, percent)
    other = missing_most(100 * n // percent, percent)  # of the largest set that can be linked
    cls = classes[cells(own, len(classes))]
    order = np.lexsort((own, cls))
    rare = int((cls < _FREQUENT_CLASS).sum())
    first = order[: min(rare, e + 1)]
    single = own[first[cls[first] > 1]]
    if rare > e:
        return single
    tail = own[order[rare : 2 * e + other + 2]]
    if len(tail) == 1:  # a set of one shingle, or of few beside rare ones that a linked set may lack
        return np.concatenate([single, vec.mix(tail ^ U64(1))])
    pairs = vec.mix(tail[:-1] * U64(0x9E3779B97F4A7C15) + vec.mix(tail[1:]))
    return np.concatenate([single, pairs])


def _pack(part: np.ndarray) -> bytes:
    """Counters as bytes: the gaps between those that are set and their counts, or all of them, compressed."""
    at = np.flatnonzero(part)
    if 2 * len(at) < len(part):
        return b"s" + zlib.compress(np.diff(at, prepend=0).astype(np.uint16).tobytes() + part[at].astype(np.uint32).tobytes(), 1)
    return b"z" + zlib.compress(part.astype(np.uint32).tobytes(), 1)


def _add(total: np.ndarray, packed: bytes) -> None:
    raw = zlib.decompress(packed[1:])
    if packed[:1] == b"z":
        total += np.frombuffer(raw, np.uint32)
    else:
        n = len(raw) // 6
        total[np.cumsum(np.frombuffer(raw, np.uint16, n).astype(np.int64))] += np.frombuffer(raw, np.uint32, n, 2 * n)


def _first_pass(docs: DataFrame, shingle: int, size: int) -> DataFrame:
    """Rows doc_id, text_key, node, n of every document, and the tasks' parts of the sketch. docs: doc_id, text_key, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        np.seterr(over="ignore")
        counts = np.zeros(size, np.uint16)
        seen: set[int] = set()
        names = ["doc_id", "text_key", "node", "n", "part", "salt", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

        def rows(k: int, **columns) -> pa.RecordBatch:
            columns["salt"] = [TaskContext.get().partitionId() % 4] * k
            return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns.get(c, [None] * k), t) for c, t in zip(names, kinds, strict=True)], names)

        for batch, raw, offs in vec.pieces(batches, "text"):
            nodes, n, new = [], [], []
            for own in vec.shingle_sets(vec.find_words(raw, offs, vec.SPACED, vec.SPACED_WORD), shingle):
                n.append(len(own))
                key = set_key(own) if len(own) else None
                nodes.append(key)
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append(own)
            if new:
                at, times = np.unique(cells(np.concatenate(new), size), return_counts=True)
                counts[at] = np.minimum(counts[at].astype(np.int64) + times, 65535)
            if len(seen) > 200_000:
                seen.clear()
            yield rows(len(n), doc_id=batch.column("doc_id"), text_key=batch.column("text_key"), node=nodes, n=n)
        parts = counts.reshape(-1, _PART)
        some = np.flatnonzero(parts.any(1))
        yield rows(len(some), part=some, counts=[_pack(parts[i]) for i in some])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, node long, n int, part int, salt int, counts binary")


def _classes(first: DataFrame, frequent: int, size: int) -> np.ndarray:
    """The class of each counter. A table of fixed size comes to the driver."""

    def add(got: pa.Table) -> pa.Table:
        total = np.zeros(_PART, np.uint32)
        for b in got.column("counts").to_pylist():
            _add(total, b)
        return pa.table({"part": got.column("part")[:1], "salt": got.column("salt")[:1], "counts": pa.array([_pack(total)], pa.binary())})

    kind = "part int, salt int, counts binary"
    parts = first.filter("part is not null").select("part", "salt", "counts").groupBy("part", "salt").applyInArrow(add, kind).groupBy("part").applyInArrow(add, kind)
    counts = np.zeros(size, np.uint32)
    for r in parts.toLocalIterator():
        _add(counts[r[0] * _PART : (r[0] + 1) * _PART], r[2])
    return class_table(counts, frequent)


def _linked(docs: DataFrame, shingle: int, percent: int, frequent: int) -> tuple[DataFrame, DataFrame]:
    """Rows doc_id, text_key, node, n of every document, and node, keep (least doc_id and its text_key of the component) of every node; both read written tables."""
    spark = lean(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    size = (1 << fine_bits(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)) + (1 << COARSE_BITS)
    first = written(_first_pass(docs, shingle, size), "sets")
    rows = first.filter("n is not null").select("doc_id", "text_key", "node", "n")
    classes = spark.sparkContext.broadcast(_classes(first, frequent, size))
    vec.hand_back()

    def rare(shingles: np.ndarray) -> np.ndarray:
        return classes.value[cells(shingles, len(classes.value))] < _FREQUENT_CLASS

    reps = written(rows.filter("node is not null and doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("keep")), "reps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch, raw, offs in vec.pieces(batches, "text"):
            keep, n, r, sigs, bits = [], [], [], [], []
            for node, own in zip(batch.column("node").to_pylist(), vec.shingle_sets(vec.find_words(raw, offs, vec.SPACED, vec.SPACED_WORD), shingle), strict=True):
                if len(own) and set_key(own) == node:
                    keep.append(node)
                    n.append(len(own))
                    sigs.append(signatures(own, classes.value, percent))
                    bits.append(bitmap(own, percent))
                    r.append(int(rare(own).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(n, pa.int32()), pa.array(r, pa.int32()), vec.list_column(sigs, pa.int64()), pa.array(bits, pa.binary())], ["node", "n", "r", "sigs", "bits"])

    of = reps.select("keep.*", "node")
    texts = docs.join(F.broadcast(of) if small(of, 500_000) else of, ["doc_id", "text_key"]).select("node", "text")
    postings = written(texts.mapInArrow(run, "node long, n int, r int, sigs array<long>, bits binary"), "postings")
    again = written(postings.groupBy("node").count().filter("count > 1").select("node"), "again")
    repeated = again.limit(1).count() > 0

    def once(df: DataFrame) -> DataFrame:
        """One row of each node. Only those of repeated rows are shuffled with their other columns."""
        return df if not repeated else semi_anti(df, again, "node").unionByName(semi(df, again, "node").dropDuplicates(["node"]))

    flat = once(postings).select("node", "r", F.explode("sigs").alias("sig"))
    shared = written(one_of_equal(flat), "shared")
    blocks = written(semi(flat, shared, "sig"), "meeting")
    nodes = written(blocks.select("node").distinct(), "nodes")
    marks = written(once(semi(postings.select("node", "n", "bits"), nodes, "node")), "marks")
    bodies = written(once(semi(texts, nodes, "node")), "bodies")
    discard(postings, again, shared, nodes)
    del postings, again, flat, shared, nodes
    release(spark)
    labels = link(blocks, marks, bodies, shingle, percent, rare)
    discard(blocks, marks, bodies)
    classes.destroy()
    keeps = reps.join(labels.select("node", "label"), "node").groupBy("label").agg(F.min("keep").alias("least"))
    of = reps.join(labels.join(keeps, "label").select("node", "least"), "node", "left").select("node", F.coalesce("least", "keep").alias("keep"))
    return rows, of


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id."""
    rows, of = _linked(docs, shingle, percent, frequent)
    found = rows.join(of.select("node", F.col("keep.doc_id").alias("component_id")), "node", "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """Of every component one row of `docs`, with all its columns.

    It is a row of the smallest doc_id, and where that id has several texts in the
    component, of the text with the least hash.  Other texts under the same id are
    documents of their own and stay or go with their own component.  Of rows that repeat
    id and text the least one stays, compared column by column (columns can't be maps
    then).  Documents without words, without text or without a doc_id all stay.
    """
    rows, of = _linked(docs, shingle, percent, frequent)
    own = F.struct("doc_id", "text_key")
    put = rows.filter("node is not null and doc_id is not null").join(of, "node").select("doc_id", "text_key", (own != F.col("keep")).alias("gone"))
    per = written(put.groupBy("doc_id", "text_key").agg(F.max("gone").alias("gone"), F.count("*").alias("rows")), "decided")
    id_name, key_name = unused(docs, "_id"), unused(docs, "_key")
    keyed = docs.withColumns({id_name: F.col("doc_id").cast("long"), key_name: F.xxhash64("text")})
    of = lambda cond: per.filter(cond).select(F.col("doc_id").alias(id_name), F.col("text_key").alias(key_name))
    kept = semi_anti(keyed, of("gone"), [id_name, key_name])
    again = of("not gone and rows > 1")
    if not again.limit(1).count():
        return kept.select(*docs.columns)
    columns = ["text", *(c for c in docs.columns if c != "text")]
    least = semi(kept, again, [id_name, key_name]).groupBy(id_name, key_name).agg(F.min(F.struct(*columns)).alias(key_name + "_row"))
    return semi_anti(kept, again, [id_name, key_name]).select(*docs.columns).unionByName(least.select(f"{key_name}_row.*").select(*docs.columns))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
