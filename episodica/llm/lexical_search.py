"""Ranked lexical search by Fagin's threshold algorithm.

The index keeps, for every document, how often it holds each term of the queries.  A task
gathers documents into shards of `POSTINGS` entries.  In a shard every term has a list of its
documents sorted by impact (the term's share of a score), and a forward index gives the impact
of any term in any document.  For each query the lists are read round robin, a block of places
at a time; a document that shows up for the first time gets its whole score by look-ups in the
forward index.  The sum of the impacts last read bounds what any other document can have; a
query ends where that falls strictly below its k-th best score, so ties are found too.  The k
best go on to the task's next shard, whose lists are read the less deep for it.  The k best of
all tasks are merged by a window.

All numbers but a term's weight are whole, `div` rounds down; N, L and document frequencies are
counted over all documents.  Queries pass in blocks of about `ITEMS`, each a pass over the
texts, so that neither their terms nor their results outgrow a task; documents are never
grouped, so no term or source can be hot.

Edge cases: a null text has no terms, and a document without terms counts nowhere; an item
without terms, or whose terms no document holds, has no rows; items without an item_id are
left out; the texts of rows that repeat an item_id are one text, distinct ones in order, a
space between; rows that repeat a doc_id are documents of their own; documents without a doc_id
count in all statistics but aren't ranked.  Words are told apart by 64 bits of a hash among the
terms of a block.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vec
from .shared import discard, lean, table, written

TOP = 20
#: Queries of a block, and entries of a shard.
ITEMS, POSTINGS = 4096, 1 << 20
#: Places of every list that the first round reads; each further round reads twice as many.
STEP = 32
#: Look-ups of a step, which bounds its arrays.
LOOKUPS = 1 << 20
#: Constants of the score: saturation and length normalisation in hundredths, and the unit of impacts.
K1_TENTHS, B_HUNDREDTHS, UNIT = 12, 25, 1_000_000_000


class Queries(NamedTuple):
    """Queries as runs of distinct terms with repeats; terms are places in `vocabulary`, sorted hashes."""

    ids: list
    first: np.ndarray
    term: np.ndarray
    times: np.ndarray
    vocabulary: np.ndarray


def read_queries(rows: list[tuple]) -> Queries:
    words = vec.find_words(*vec.text_buffer(pa.array([r[1] for r in rows], pa.string())), vec.ALNUM)
    vocabulary, place = np.unique(words.hash, return_inverse=True)
    size = max(1, len(vocabulary))
    pairs, times = np.unique(words.doc * size + place, return_counts=True)
    return Queries([r[0] for r in rows], np.searchsorted(pairs // size, np.arange(len(rows) + 1)), pairs % size, times, vocabulary)


def indexed(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Written: doc_id, n (terms with repeats), terms (places in the vocabulary, ascending), tfs, of documents with at least one term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary))
        for batch, raw, offs in vec.pieces(batches, "text"):
            words = vec.find_words(raw, offs, vec.ALNUM)
            n = np.diff(words.first)
            at = np.minimum(np.searchsorted(vocabulary, words.hash), size - 1)
            hit = vocabulary[at] == words.hash if len(vocabulary) else np.zeros(len(at), bool)
            pairs, tf = np.unique(words.doc[hit] * size + at[hit], return_counts=True)
            keep = np.flatnonzero(n)
            first = np.searchsorted(pairs // size, np.append(keep, batch.num_rows)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v.astype(np.int32))) for v in (pairs % size, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep)), pa.array(n[keep], pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return written(docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "index")


def counted(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all documents, and of every term the documents that hold it: added up per task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            docs += batch.num_rows
            terms += int(batch.column("n").to_numpy().sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int32()), pa.array([docs, terms, *df[some].tolist()], pa.int64())], ["term", "k"])

    found = dict(tuple(r) for r in index.select("n", "terms").mapInArrow(run, "term int, k long").groupBy("term").agg(F.sum("k")).collect())
    return found.pop(-2, 0), found.pop(-1, 0), np.array([found.get(t, 0) for t in range(size)], np.int64)


class Shard:
    """Impact-sorted lists and forward index of some documents."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        self.ids, self.size = ids, len(weight)
        tf = tf.astype(np.int64)
        impact = weight[term] * ((UNIT * tf) // (1000 * tf + K1_TENTHS * m[doc]))
        self.forward, self.forward_impact = doc * self.size + term, impact  # ascending, as documents come with ascending terms
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(self.size + 1))
        self.seen = np.zeros(len(ids), np.int32)
        self.turn = 0

    def scores(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Whole scores by random access."""
        out = np.zeros(len(docs), np.int64)
        step = max(1, LOOKUPS // len(terms))
        for a in range(0, len(docs), step):
            keys = docs[a : a + step, None] * self.size + terms[None, :]
            at = np.minimum(np.searchsorted(self.forward, keys), len(self.forward) - 1)
            out[a : a + step] = np.where(self.forward[at] == keys, self.forward_impact[at], 0) @ times
        return out

    def search(self, terms: np.ndarray, times: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best scores and ids of this shard and those given."""
        lo, hi = self.first[terms], self.first[terms + 1]
        terms, times, lo, hi = (x[hi > lo] for x in (terms, times, lo, hi))
        self.turn += 1
        depth, step = 0, STEP
        while len(terms):
            at = lo[:, None] + np.arange(depth, depth + step)[None, :]
            docs = self.doc[at[at < hi[:, None]]]
            docs = np.unique(docs[self.seen[docs] != self.turn])
            self.seen[docs] = self.turn
            if len(docs):
                score = self.scores(docs, terms, times)
                floor = best[0][k - 1] if len(best[0]) >= k else 1
                good = score >= floor
                score, ids = np.concatenate([best[0], score[good]]), np.concatenate([best[1], self.ids[docs[good]]])
                order = np.lexsort((ids, -score))[:k]
                best = score[order], ids[order]
            depth, step = depth + step, 2 * step
            more = lo + depth < hi
            bound = int((self.impact[(lo + depth - 1)[more]] * times[more]).sum())
            if bound == 0 or (len(best[0]) >= k and bound < best[0][k - 1]):
                break
        return best


def ranked(index: DataFrame, queries: Queries, stats: tuple[int, int, np.ndarray], kind: str, k: int) -> DataFrame:
    """item_id, doc_id, score: of each task the k best of every query."""
    docs, terms, df = stats
    weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(f) + 1))) if f else 0 for f in df], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(queries.ids)
        held: list[tuple] = []

        def search() -> None:
            ids, n, count, term, tf = (np.concatenate([h[c] for h in held]) for c in range(5))
            held.clear()
            m = np.array([100 - B_HUNDREDTHS + (B_HUNDREDTHS * x * docs) // terms for x in n.tolist()], np.int64)
            shard = Shard(ids, m, np.repeat(np.arange(len(ids)), count), term, tf, weight)
            for q in range(len(queries.ids)):
                own = slice(queries.first[q], queries.first[q + 1])
                best[q] = shard.search(queries.term[own], queries.times[own], best[q], k)

        waiting = 0
        for batch in batches:
            count = np.diff(batch.column("terms").offsets.to_numpy())
            held.append((batch.column("doc_id").to_numpy(), batch.column("n").to_numpy(), count, *(batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))))
            waiting += int(count.sum())
            if waiting >= POSTINGS:
                search()
                waiting = 0
        if waiting:
            search()
        got = [(queries.ids[q], d, s) for q, (score, ids) in enumerate(best) for s, d in zip(score.tolist(), ids.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], None if c == 0 and got else pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])
        vec.hand_back()

    some = index.filter("doc_id is not null and size(terms) > 0")
    return some.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, k: int = TOP, block: int = ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of every item. items: item_id, text; docs: doc_id, text."""
    lean(docs.sparkSession)
    texts = items.filter("item_id is not null and text is not null").groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), " ").alias("text"))
    blocks = max(1, -(-texts.count() // block))
    texts = written(texts.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    parts = []
    for b in range(blocks):
        queries = read_queries([tuple(r) for r in texts.filter(F.col("block") == b).orderBy("item_id").select("item_id", "text").collect()])
        index = indexed(docs, queries.vocabulary)
        found = ranked(index, queries, counted(index, len(queries.vocabulary)), kind, k)
        parts.append(written(found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k), "ranked"))
        discard(index)
    discard(texts)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
ORACLE = f"""
with q as (select item_id, term, count(*) as times from (select item_id, {_TERMS} as term from benchmark) group by all),
d as (select doc_id, term, count(*) as tf from (select doc_id, {_TERMS} as term from documents) group by all),
n as (select doc_id, cast(sum(tf) as bigint) as n from d group by 1),
s as (select count(*) as docs, cast(sum(n) as bigint) as terms from n),
w as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from d, s group by term, docs),
m as (select doc_id, 100 - 25 + ((25 * n * docs) // terms) as m from n, s),
r as (select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score from q join d using (term) join w using (term) join m using (doc_id) group by all)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from r where score > 0 qualify rank <= 20
"""
