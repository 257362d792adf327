"""Mixing sources to target weights: Efraimidis-Spirakis sampling within token budgets.

Sources share a budget by weight; a source's target stops at `cap` times its size and
the excess is shared anew.  A source is taken in complete epochs as often as its
target holds it whole; the rest is sampled: each document draws u from a hash of its
id, its text and a seed, its exponential key is -ln(u) / weight, and documents are taken
in key order while the prefix sum of their sizes is nearest to what is left.

Prefix sums don't sort a source: keys fall into `BINS` bins, then the bin that the
budget ends in is cut into `BINS` again; only documents of that inner bin are
ordered, and rows that repeat id and text, which have one key, are one group there.  A
source with a third of all rows is pre-aggregated like any other.  Sources, too, may be
many: their order and the level of their targets come from sums.

The weight of a document's quality is a column of the table (`quality`), or else derived
from its text: the share of letters and spaces among its bytes times the share of
distinct words among its words, at least 0.05.

Edge cases: null texts have size 0 and are taken with 0 words; null sources are one
source, last in order; without any words all targets are 0; repeated rows are
documents of their own, in one place of the order; rows without an id are told apart by
their texts; null or negative weights count as the least; an empty table gives an empty
table; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vec
from .shared import discard, lean, small, table, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = 17
BINS = 4096
LEAST_WEIGHT = 0.05
#: Sources up to which their table is broadcast; beyond, rows meet it by a shuffle over `SALTS` parts of a source.
BROADCAST_SOURCES = 100_000
SALTS = 64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256), 32]] = True


def measured(docs: DataFrame, quality: str | None = None) -> DataFrame:
    """doc_id, text_key, source, size, weight of every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch, raw, offs in vec.pieces(batches, "text"):
            words = vec.find_words(raw, offs, vec.SPACED, vec.SPACED_WORD)
            size = np.diff(words.first)
            row = words.doc
            order = np.lexsort((words.hash, row))
            new = np.ones(len(order), bool)
            new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (row[order][1:] != row[order][:-1])
            distinct = np.bincount(row[order], new, minlength=len(size))
            sums = np.concatenate([[0], np.cumsum(_LETTER[raw])])
            letters = sums[offs[1:]] - sums[offs[:-1]]
            weight = letters / np.maximum(1, np.diff(offs)) * distinct / np.maximum(1, size)
            if quality is not None:
                weight = batch.column("given").to_numpy(zero_copy_only=False).astype(float)
            weight = np.where(weight > LEAST_WEIGHT, weight, LEAST_WEIGHT)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), batch.column("source"), pa.array(size, pa.int64()), pa.array(weight, pa.float64())], ["doc_id", "text_key", "source", "size", "weight"])

    given = F.lit(None).cast("double") if quality is None else F.col(quality).cast("double")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("source").cast("string").alias("source"), given.alias("given"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, source string, size long, weight double")


def ranked(sizes: DataFrame) -> DataFrame:
    """`sizes` with k, the place of each source by code point from 0, null last. Ranges of sources are counted, then numbered each on its own."""
    cut = written(sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    counts = cut.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    base = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return cut.join(F.broadcast(base), "part").withColumn("k", F.col("base") + own - 1).drop("part", "base")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Written: source, source_size, target. sizes: one row per source with source and source_size.

    What sources get at a level is the least of `cap` times their size and level x weight.
    The level that spends the budget is found from below: at each step the sources
    over their cap at the level so far are set to it and the rest is shared by weight,
    until no more pass it. Each step is one sum over the sources.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("k"), F.lit(len(weights))) + 1).cast("int"))
    known = written(ranked(sizes).select("source", "source_size", w.alias("w"), (cap * F.col("source_size")).alias("most")), "sources")
    budget = share * float(known.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("w") > F.col("most")
        full, open_, n = known.agg(F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0.0)), F.count_if(over)).first()
        if n == capped or not open_:
            break
        level, capped = (budget - full) / open_, n
    return known.select("source", "source_size", F.when(F.lit(level) * F.col("w") > F.col("most"), F.col("most")).otherwise(F.least(F.lit(level) * F.col("w"), F.col("most"))).alias("target"))


def meet(rows: DataFrame, of: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """rows with `columns` of their source. `of` has one row per source, which may be null; a source's rows are spread over `SALTS` tasks where it isn't broadcast."""
    of = of.select(F.col("source").alias("_of"), *columns)
    if small(of, BROADCAST_SOURCES):
        return rows.join(F.broadcast(of), rows["source"].eqNullSafe(of["_of"]), how).drop("_of")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int"))
    of = of.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(of, (rows["_salt"] == of["_part"]) & rows["source"].eqNullSafe(of["_of"]), how).drop("_of", "_salt", "_part")


def _place(key: Column) -> Column:
    """A place in 0 to 1 that grows with the key. Its bins stay fine for large keys too, those of documents of low weight."""
    return key / (1 + key)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED, bins: int = BINS, quality: str | None = None) -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target, taken, epochs, source. quality: a column of `docs` with weights."""
    lean(docs.sparkSession)
    rows = written(measured(docs, quality), "sizes")
    u = (F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    place = _place(-F.log(u) / F.col("weight"))
    fine = F.least(F.floor(place * bins * bins), F.lit(bins * bins - 1)).cast("long")
    keyed = rows.select("doc_id", "text_key", "source", "size", place.alias("place"), F.floor(fine / bins).cast("int").alias("bin"), (fine % bins).cast("int").alias("inner"))
    per_bin = written(keyed.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    aim = targets(per_bin.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long")
    aim = written(aim.withColumn("epochs", whole).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))), "targets")

    def before(col: str) -> Column:
        return F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def ending(sums: DataFrame, col: str) -> DataFrame:
        """Of each source the first bin whose words pass what is left, and the words before it. sums: source, the bin, words, before."""
        held = sums.join(aim.select(F.col("source").alias("_of"), "rest"), F.col("source").eqNullSafe(F.col("_of"))).filter("before <= rest and before + words > rest")
        return held.groupBy("source").agg(F.min(F.struct(col, "before")).alias("at")).select("source", f"at.{col}", "at.before")

    outer = written(ending(per_bin.withColumn("before", before("bin")), "bin"), "outer")
    inside = meet(keyed, outer.select("source", F.col("bin").alias("_bin"), F.col("before").alias("base")), ["_bin", "base"]).filter("bin = _bin")
    sums = inside.groupBy("source", "inner").agg(F.sum("size").alias("words"), F.first("base").alias("base"))
    inner = ending(sums.withColumn("before", F.col("base") + before("inner")).select("source", "inner", "words", "before"), "inner")
    o, i = outer.select(F.col("source").alias("s"), F.col("bin").alias("end_bin")), inner.select(F.col("source").alias("t"), F.col("inner").alias("end_inner"), F.col("before").alias("start"))
    edge = o.join(i, F.col("s").eqNullSafe(F.col("t")), "left").drop("t")
    plan = written(aim.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "plan")
    got = meet(keyed, plan, ["source_size", "target", "epochs", "rest", "end_bin", "end_inner", "start"])
    at_end = F.coalesce((F.col("bin") == F.col("end_bin")) & (F.col("inner") == F.col("end_inner")), F.lit(False))

    # rows of one key are alike: they are counted, and what is taken of the count is dealt out again
    alike = ["source", "place", "doc_id", "text_key", "size", "source_size", "target", "epochs", "rest", "start"]
    groups = got.filter(at_end).groupBy(*alike).agg(F.count("*").alias("n"))
    w = Window.partitionBy("source").orderBy("place", "doc_id", "text_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("rest") - F.col("start") - F.coalesce(F.sum(F.col("size") * F.col("n")).over(w), F.lit(0))
    some = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("n"), F.floor(upto / F.col("size") + 0.5)))).otherwise(0).cast("long")
    groups = groups.withColumn("some", some)
    step = 100_000
    dealt = groups.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step)))).withColumn("_i", F.explode(F.sequence(F.col("_b") * step, F.least(F.col("n"), (F.col("_b") + 1) * step) - 1)))
    cut = dealt.withColumn("more", (F.col("_i") < F.col("some")).cast("int"))
    sooner = (F.col("bin") < F.col("end_bin")) | ((F.col("bin") == F.col("end_bin")) & (F.col("inner") < F.col("end_inner")))
    clear = got.filter(~at_end).withColumn("more", F.when((F.col("rest") <= 0) & F.col("end_bin").isNull(), 0).when(F.col("end_bin").isNull() | sooner, 1).otherwise(0))
    out = ["doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("more"))).cast("long").alias("taken"), "epochs", "source"]
    discard(per_bin, aim, outer)
    return clear.select(*out).unionByName(cut.select(*out))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
