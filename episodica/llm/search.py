"""Exact top-k search by inner product with multi-resolution segment statistics.

Every component becomes floor(64 * x).  For segments of a vector of length L with means
m and deviations s,

    |q - x|^2 >= sum over segments of L * ((mq - mx)^2 + (sq - sx)^2),

so with |q|^2 and |x|^2 known, each level bounds the inner product from above.
Levels run coarse to fine; a candidate goes when its bound is under the query's
k-th best score so far, and survivors get exact integer scores.  Before it is cut into
segments a vector is turned by an orthogonal basis, which leaves inner products as they
are and packs the rows' spread into the first segments; it comes from the second moments
of at most `BASIS_ROWS` rows, chosen by hash, and its quality changes the work only.

Rows are dealt into chunks of `CHUNK` to `CHUNK_MOST` rows, whose statistics are made
once.  One job sends every query to its own chunk and gives a first k-th best score; a
second one sends it to all chunks with that score.  A task holds the rows of a chunk and
lets the queries pass in blocks of `BLOCK`; what it returns of a query is at most k rows.

Edge cases: null vectors, and vectors with null or non-finite components, take no
part; vectors of another length than the query are no candidates of it; where valid
vectors repeat the vec_id of a query, the least of them is the query and all are its own;
other repeated rows each count; ties go to the smaller vec_id; fewer than k candidates
are all returned; rows without a vec_id take no part; scores beyond 64 bits are held at
the ends of that range; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vec
from .shared import discard, lean, table, written

TOP = 20
SCALE = 64
LEVELS = (4, 16, 32)
#: Queries that pass at a time, rows of a chunk at least and at most, and chunks that a large table is dealt into.
BLOCK = 1024
CHUNK = 8192
CHUNK_MOST = 1 << 17
CHUNKS = 48
#: Rows that the basis is made from.
BASIS_ROWS = 4096
#: Pairs that are gathered at a time, and the share of pairs above which a level is tried with all of them.
PAIRS = 1 << 16
DENSE = 1 / 16


def lists(column: pa.Array) -> list[np.ndarray | None]:
    """Whole-number vectors of a list column; None where a vector takes no part."""
    out: list[np.ndarray | None] = []
    for x in column:
        v = None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(np.floor(SCALE * v) if v is not None and np.isfinite(v).all() else None)
    return out


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row sqrt(length) * mean and sqrt(length) * deviation of every segment."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(cuts)
    total, square = np.add.reduceat(x, cuts[:-1], axis=1), np.add.reduceat(x * x, cuts[:-1], axis=1)
    mean = total / np.sqrt(size)
    return np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0))], axis=1)


class Chunk:
    """Rows of one length with their statistics, which queries are scored against."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, basis: np.ndarray | None, k: int):
        self.ids, self.x, self.k, self.basis = ids, x, k, basis if basis is not None and len(basis) == x.shape[1] else None
        with np.errstate(all="ignore"):
            turned = x if self.basis is None else x @ self.basis
            self.levels = [segment_stats(turned, n) for n in LEVELS if n < x.shape[1]] if x.shape[1] else []
            self.square = float((x * x).sum(1).max(initial=0))
        self.most = float(np.abs(x).max(initial=0))
        self.useful = [True] * len(self.levels)
        self.tried, self.left = np.zeros(len(self.levels), np.int64), np.zeros(len(self.levels), np.int64)

    def exact(self, queries: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Integer inner products of pairs: one product of the two sides where many pairs are left, else pair by pair."""
        if self.most * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 2**52:
            if len(q) > DENSE * len(queries) * len(self.x):
                return (queries @ self.x.T)[q, c].astype(np.int64)
            return np.concatenate([np.einsum("ij,ij->i", queries[q[a : a + PAIRS]], self.x[c[a : a + PAIRS]]) for a in range(0, len(q), PAIRS)] or [np.zeros(0)]).astype(np.int64)
        return np.array([sum(int(a) * int(b) for a, b in zip(queries[i], self.x[j], strict=True)) for i, j in zip(q, c, strict=True)], object)

    def survivors(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Pairs of queries and rows that no level's bound parts. A level that parts next to nothing is left out from then on."""
        left = ids[:, None] != self.ids[None, :]
        if not np.isfinite(floor).any():
            return left
        with np.errstate(all="ignore"):
            turned = queries if self.basis is None else queries @ self.basis
            slack = 1e-9 * (1 + self.square + float((queries * queries).sum(1).max(initial=0)))
            for at, rows in enumerate(self.levels):
                if not self.useful[at]:
                    continue
                own = segment_stats(turned, rows.shape[1] // 2)
                before = int(left.sum())
                if before > DENSE * left.size:
                    left &= ~(own @ rows.T + slack < floor[:, None])
                else:
                    q, c = np.nonzero(left)
                    for a in range(0, len(q), PAIRS):
                        qs, cs = q[a : a + PAIRS], c[a : a + PAIRS]
                        left[qs, cs] = ~(np.einsum("ij,ij->i", own[qs], rows[cs]) + slack < floor[qs])
                after = int(left.sum())
                self.tried[at] += before
                self.left[at] += after
                self.useful[at] = bool(np.isinf(floor).any()) or after < 0.95 * max(1, before)
        return left

    def best(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """query, row, score: of each query the k best rows whose score reaches its floor."""
        step = max(1, (1 << 21) // max(1, len(self.ids)))  # bounds the matrix of pairs
        for at in range(0, len(ids), step):
            some, of = ids[at : at + step], queries[at : at + step]
            q, c = np.nonzero(self.survivors(some, of, floor[at : at + step]))
            score = self.exact(of, q, c)
            ok = score >= floor[at : at + step][q]
            q, c, score = q[ok], c[ok], score[ok]
            order = np.lexsort((self.ids[c], -score, q)) if score.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -score[i], self.ids[c[i]])), np.int64)
            q, c, score = q[order], c[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q, "left")
            for i in np.flatnonzero(place < self.k):
                yield int(some[q[i]]), int(self.ids[c[i]]), max(-(1 << 63), min((1 << 63) - 1, int(score[i])))


def prepared(rows: DataFrame, chunks: int) -> DataFrame:
    """Written: vec_id, x (whole numbers as doubles), chunk of every row that takes part. Rows come to chunks in runs, so equal rows don't meet in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_pylist(), lists(batch.column("embedding"))
            ok = [i for i, v in enumerate(vectors) if v is not None and ids[i] is not None]
            place = (seen + np.arange(len(ok))) // 256 + part * 7919
            seen += len(ok)
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in ok], pa.int64()), vec.list_column([vectors[i] for i in ok], pa.float64()), pa.array((vec.mix(place.astype(np.uint64)) % np.uint64(chunks)).astype(np.int32))], ["vec_id", "x", "chunk"])

    return written(rows.mapInArrow(run, "vec_id long, x array<double>, chunk int"), "vectors")


def basis_of(rows: DataFrame, sample: int = BASIS_ROWS) -> np.ndarray | None:
    """Directions by falling second moment, of a sample of rows of the most common length; None where it can't be made."""
    got = [np.array(r[0]) for r in rows.select("x").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    sizes = [len(v) for v in got]
    x = np.stack([v for v in got if len(v) == max(set(sizes), key=sizes.count)]) if got else np.zeros((0, 0))
    if not x.size:
        return None
    with np.errstate(all="ignore"):
        moments = x.T @ x
    return np.ascontiguousarray(np.linalg.eigh(moments)[1][:, ::-1]) if np.isfinite(moments).all() else None


def scored(rows: DataFrame, queries: DataFrame, basis: np.ndarray | None, k: int) -> DataFrame:
    """query_id, vec_id, score: of each query and each chunk that it goes to the k best rows. rows: vec_id, x, chunk; queries: also floor."""
    both = rows.select("chunk", F.lit(0).alias("role"), "vec_id", "x", F.lit(None).cast("double").alias("floor")).unionByName(queries.select("chunk", F.lit(1).alias("role"), "vec_id", "x", "floor"))
    parts = max(1, rows.select("chunk").distinct().count())
    dealt = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "role", "vec_id", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = [v.values.to_numpy(zero_copy_only=False) for v in batch.column("x")]
            chunk, role, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "role", "vec_id"))
            floor = np.nan_to_num(batch.column("floor").to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
            cuts = np.flatnonzero((np.diff(chunk, prepend=chunk[:1] - 1) != 0) | (np.diff(role, prepend=-1) != 0))
            found: list[tuple[int, int, int]] = []
            for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True):
                if chunk[a] != now:
                    now, held, ready = chunk[a], [], {}
                if role[a] == 0:
                    held += zip(ids[a:b].tolist(), vectors[a:b], strict=True)
                    continue
                if held:
                    ready = {x.shape[1]: Chunk(own, x, basis, k) for own, x in by_length([h[0] for h in held], [h[1] for h in held])}
                    held = []
                for at in range(a, b, BLOCK):
                    to = min(b, at + BLOCK)
                    lengths = np.array([len(v) for v in vectors[at:to]])
                    for size in set(lengths.tolist()) & set(ready):
                        own = at + np.flatnonzero(lengths == size)
                        found += ready[size].best(ids[own], np.stack([vectors[i] for i in own]), floor[own])
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])
        vec.hand_back()

    return dealt.mapInArrow(run, "query_id long, vec_id long, score long")


def by_length(ids: list[int], vectors: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    groups: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        groups.setdefault(len(v), []).append(i)
    for at in groups.values():
        yield np.array([ids[i] for i in at], np.int64), np.stack([vectors[i] for i in at])


def top_k(rows: DataFrame, is_query: Column, k: int = TOP, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row that `is_query` holds for. rows: vec_id, embedding."""
    lean(rows.sparkSession)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    total = rows.count()
    chunks = max(1, total // min(max(chunk, total // CHUNKS), max(chunk, CHUNK_MOST)))
    rows = prepared(rows, chunks)
    basis = basis_of(rows)
    queries = written(rows.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("x", "chunk")).alias("q")).select("vec_id", "q.*"), "queries")
    near = scored(rows, queries.withColumn("floor", F.lit(None).cast("double")), basis, k)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    sent = queries.drop("chunk").join(floors, "vec_id", "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    found = written(scored(rows, sent, basis, k), "scores")
    discard(rows, queries)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Spark's own arithmetic agrees with DuckDB's on these: whole numbers all along.
ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))::bigint) as x
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
