"""The prefix trie of conversations by Patricia construction.

1. Turns are numbered and hashed, conversations rebuilt, and every prefix gets a fingerprint of
   128 bits: two parities of hashes of (place, role, text).  Text is read once; from there on a
   turn is a few numbers.
2. Equal conversations become one sequence with a count, so that copies, however many, are one
   row.  Digests of the members that end somewhere stream over their ids in order, joined
   beforehand in ranges of ids.
3. Sequences are sorted by their fingerprints, by ranges over tasks; each gets the number of
   turns that it shares with the one before, over the seams of tasks as well.
4. The points of the compressed tree are the root, the ends of sequences, and the prefixes that
   neighbours share.  What a point says of its subtree is a sum over its sequences: copies,
   leaves, words, and the words that a sequence has beyond those it shares with the one before.
5. Unary nodes lie on the path of their point's smallest member; a window along it gives them
   the point's figures and the suffix sum of the edge's words.

A node's members are never listed but for their digest; a common first turn is one point whose
sums are added up before they are shuffled, and whose rows meet it by broadcast.  A
conversation's turns are windowed together and its fingerprints, 16 bytes a turn, are one sort
key: a conversation must fit a row.

Edge cases: null role or text is empty; null turns come first; turns that tie are in order of
role and text; rows without a conv_id take no part; the prefix of a base conversation that is
absent or short is what there is; a rebuilt conversation without turns is a member of the root;
an empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import discard, lean, spread_join, table, written

#: Conversations of a block share the first turns of its first one; h is less than this.
BLOCK, HEADS = 20, 4
#: Ids that are joined to one text before they are hashed.
IDS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def numbered(conversations: DataFrame) -> DataFrame:
    """Written: conv_id, place (from 1), h1, h2 (hashes of role and text), words."""
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    return written(rows.select("conv_id", place.alias("place"), F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "turns")


def rebuilt(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """Written: conv_id, len, d (from 0), h1, h2, words: every conversation with the first turns of its block's first one in place of its own, and a textless row at 0."""
    turns = numbered(conversations)
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"))
    firsts = convs.filter("conv_id = base").select("base", F.col("n").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = written(convs.join(firsts, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("int").alias("len")), "conversations")
    head = turns.filter((F.col("place") < heads) & (F.col("conv_id") % block == 0)).withColumnRenamed("conv_id", "base")
    lead = convs.filter("taken > 0").join(head, "base").filter("place <= taken").select("conv_id", "len", F.col("place").alias("d"), "h1", "h2", "words")
    own = turns.join(convs, "conv_id").filter("place > h").select("conv_id", "len", (F.col("taken") + F.col("place") - F.col("h")).cast("int").alias("d"), "h1", "h2", "words")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", "len", F.lit(0).alias("d"), zero.alias("h1"), zero.alias("h2"), zero.alias("words"))
    out = written(own.unionByName(lead).unionByName(root), "rebuilt")
    discard(turns, convs)
    return out


def prefixes(turns: DataFrame) -> DataFrame:
    """Written: conv_id, len, d, f1, f2 (fingerprint of the first d turns), node (it and d as a text), words, upto (words of the first d turns)."""
    w = Window.partitionBy("conv_id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.select("conv_id", "len", "d", F.expr("bit_xor(if(d = 0, 0L, xxhash64(d, h1)))").over(w).alias("f1"), F.expr("bit_xor(if(d = 0, 0L, xxhash64(d, h2)))").over(w).alias("f2"), "words", F.sum("words").over(w).alias("upto"))
    return written(rows.withColumn("node", F.concat_ws(":", "d", "f1", "f2")), "prefixes")


def ends_of(last: DataFrame) -> DataFrame:
    """node, ends: the digest of the ascending ids of the conversations that end at a node. last: node, conv_id."""
    joined = last.groupBy("node", F.floor(F.col("conv_id") / IDS).alias("range")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in done], pa.string()) for c in (0, 1)], ["node", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["node", "ends"])

    return joined.repartition("node").sortWithinPartitions("node", "range").mapInArrow(run, "node string, ends string")


def neighbours(paths: DataFrame) -> DataFrame:
    """Written: conv_id, lcp (turns shared with the sequence before in order, -1 for the first), next_lcp. paths: conv_id, d, f1, f2."""
    keys = paths.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("d", "f1", "f2"))).alias("p")).select("conv_id", F.flatten(F.transform("p", lambda x: F.array(x["f1"], x["f2"]))).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before = held = None  # the key before; the row before, which waits for its next_lcp

        def rows(some: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in some], kinds[c]) for c in range(6)], ["conv_id", "part", "lcp", "next_lcp", "first_key", "last_key"])

        for batch in batches:
            out = []
            for conv, key in zip(batch.column("conv_id").to_pylist(), batch.column("key"), strict=True):
                key = key.values.to_numpy()
                lcp = None
                if before is not None:
                    size = min(len(key), len(before))
                    apart = np.flatnonzero(key[:size] != before[:size])
                    lcp = int(apart[0] if len(apart) else size) // 2 - 1
                    out.append((*held[:3], lcp, held[4], None))
                held, before = (conv, part, lcp, None, key if before is None else None), key
            yield rows(out)
        if held is not None:
            yield rows([(*held[:3], None, held[4], before)])

    sorted_ = written(keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, "conv_id long, part int, lcp int, next_lcp int, first_key array<long>, last_key array<long>"), "sorted")
    # seams: one row for each task that had rows
    seams = sorted_.groupBy("part").agg(F.max("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
    order = Window.orderBy("part")
    apart = F.array_position(F.zip_with("first_key", "before", lambda x, y: x.eqNullSafe(y)), False)
    seams = seams.withColumn("before", F.lag("last_key").over(order)).select("part", F.when(F.col("before").isNull(), -1).otherwise(F.floor((apart - 1) / 2) - 1).cast("int").alias("seam"))
    seams = written(seams.withColumn("next_seam", F.coalesce(F.lead("seam").over(order), F.lit(-1))), "seams")
    out = written(sorted_.join(F.broadcast(seams), "part").select("conv_id", F.coalesce("lcp", "seam").alias("lcp"), F.coalesce("next_lcp", "next_seam").alias("next_lcp")), "neighbours")
    discard(sorted_, seams)
    return out


def trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node. conversations: conv_id, turn, role, text."""
    lean(conversations.sparkSession)
    turns = rebuilt(conversations)
    rows = prefixes(turns)
    last = rows.filter("d = len").select("node", "conv_id")
    sequences = written(last.groupBy("node").agg(F.count("*").alias("copies"), F.min("conv_id").alias("conv_id")).drop("node"), "sequences")
    ends = written(ends_of(last), "ends")
    paths = written(rows.join(sequences, "conv_id"), "paths")
    order = neighbours(paths)
    one = Window.partitionBy("conv_id")
    paths_with = paths.join(order, "conv_id").withColumns({"all": F.max("upto").over(one), "shared": F.coalesce(F.max(F.when(F.col("d") == F.col("lcp"), F.col("upto"))).over(one), F.lit(0))})
    full = written(paths_with.select("conv_id", "len", "d", "node", "words", "upto", "copies", "lcp", "next_lcp", "all", "shared"), "full")
    discard(turns, rows, sequences, paths, order)

    points = written(full.filter("d = 0 or d = len or d = lcp").select("node").distinct(), "points")
    above = F.col("upto") - F.col("words")
    sums = spread_join(full, points, "node").groupBy("node").agg(
        F.sum("copies").alias("n"), F.min("conv_id").alias("rep"), F.sum((F.col("next_lcp") != F.col("len")).cast("long")).alias("leaves"), F.sum(F.col("copies") * F.col("all")).alias("words_all"),
        F.sum(F.col("all") - F.when(F.col("lcp") >= F.col("d"), F.col("shared")).otherwise(above)).alias("words_once"), F.sum((F.col("lcp") == F.col("d")).cast("long")).alias("more"), F.max(F.col("len") == F.col("d")).alias("ended"), F.min(above).alias("above"),
    )
    # a word counts once for every member but the first: all words below the point's parent, less what each member shares above, less every distinct node once
    saved = F.col("words_all") - F.col("n") * F.col("above") - F.col("words_once")
    stats = sums.join(ends, "node", "left").select("node", F.struct("n", "rep", "leaves", saved.alias("saved"), (F.col("more") + F.when(F.col("ended"), 0).otherwise(1)).alias("children"), "above", "ends").alias("point"))
    stats = written(stats, "stats")
    along = Window.partitionBy("conv_id").orderBy("d")
    down = along.rowsBetween(0, Window.unboundedFollowing)
    nodes = spread_join(full, stats, "node", "left").withColumn("below", F.first("point", ignorenulls=True).over(down)).withColumn("parent_conv_id", F.lag("below.rep").over(along))
    nodes = nodes.filter("below.rep = conv_id")
    own = F.col("point").isNotNull()
    out = written(nodes.select(
        "conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", F.col("below.n").alias("n_convs"), F.when(own, F.col("point.children")).otherwise(1).cast("long").alias("n_children"), F.col("below.leaves").alias("n_leaves"),
        (F.col("below.saved") + (F.col("below.n") - 1) * (F.col("below.above") - above)).alias("saved_tokens"), F.coalesce("point.ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    ), "trie")
    discard(full, points, ends, stats)
    return out


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: crc32 of an id's digits, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda y, i: case when y & 1 = 1 then xor(y >> 1, 3988292384::bigint) else y >> 1 end)), 4294967295::bigint)"
ORACLE = rf"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 as base, {_CRC} % 4 as h from (select distinct conv_id from t)),
r as (select c.conv_id, 0 as part, place, role, text from c join t on t.conv_id = c.base and place <= h union all select c.conv_id, 1, place, role, text from c join t on t.conv_id = c.conv_id and place > h),
s as (select c.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) order by part, place) filter (where r.role is not null), []) as seq from c left join r on r.conv_id = c.conv_id group by 1),
p as (select conv_id, len(seq) as n, d, seq[1:d] as prefix from (select conv_id, seq, unnest(range(len(seq) + 1)) as d from s)),
nodes as (select d, prefix, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = d), '')) as ends_sha256,
  (count(*) - 1) * coalesce(len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')), 0) as value from p group by d, prefix),
kids as (select a.d, a.prefix, count(b.d) as n_children from nodes a left join nodes b on b.d = a.d + 1 and b.prefix[1:a.d] = a.prefix group by all),
below as (select a.d, a.prefix, count(*) filter (where k.n_children = 0) as n_leaves, sum(b.value) as saved from nodes a join nodes b on b.d >= a.d and b.prefix[1:a.d] = a.prefix join kids k on k.d = b.d and k.prefix = b.prefix group by all)
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, kids.n_children, below.n_leaves, cast(below.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join kids on kids.d = n.d and kids.prefix = n.prefix join below on below.d = n.d and below.prefix = n.prefix left join nodes up on up.d = n.d - 1 and up.prefix = n.prefix[1:n.d - 1]
"""
