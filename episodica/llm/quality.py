"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Indicators of hashed n-grams (words and word pairs, token shapes and shape pairs,
and how much of the text repeats itself) are scaled by class log-count ratios; a
linear hinge-loss model is fit on the scaled, length-normalised rows by dual
coordinate descent; a sigmoid fit on rows kept aside turns margins into scores.

Labels are read only from rows whose crc32(doc_id as text) mod 3 is not 1.  The
log-count ratios count every such row, in the tasks; the hinge-loss model and the
sigmoid see at most `SAMPLE_ROWS` of them, chosen by a hash of the id.  Labels, lang, source
and doc_id never enter a score.

Edge cases: null and empty texts have no n-grams and get the score of the bias
alone; repeated rows give repeated results; with no usable labels, or one class
only, every score is 0.5 or that class's share; a label row without a text is
ignored, several labels of one doc_id all count; very long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .shared import lean, small, table

BITS = 18
SAMPLE_ROWS = 8000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
#: Rows of counts that travel together.
CHUNK = 1 << 10

SHAPES = np.arange(256, dtype=np.uint8)
SHAPES[65:91], SHAPES[97:123], SHAPES[48:58], SHAPES[128:] = 65, 97, 57, 97
SHAPES[[0x20, *range(0x09, 0x0E)]] = 0
REPEATS = np.array([0.0, 0.02, 0.1, 0.3, 0.6])


def features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indicators of every row, in row order: (row, indicator)."""
    rows, ids = [], []
    words = vec.find_words(raw, offs, vec.SPACED, vec.SPACED_WORD)
    shapes = vec.find_words(raw, offs, SHAPES)
    for k, found in enumerate((words, shapes)):
        for n in (1, 2):
            h, first = vec.grams(found, n)
            rows.append(np.repeat(np.arange(len(offs) - 1), np.diff(first)))
            ids.append(vec.mix(h + vec.U64(2 * k + n)) >> vec.U64(64 - BITS))
    h, first = vec.grams(words, 3)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    order = np.lexsort((h, row))
    again = np.zeros(len(h), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    total = np.diff(first)
    share = np.bincount(row[order], again, minlength=len(total)) / np.maximum(total, 1)
    some = np.flatnonzero(total)
    rows.append(some)
    ids.append(vec.mix(np.searchsorted(REPEATS, share[some], "left").astype(vec.U64) + vec.U64(99)) >> vec.U64(64 - BITS))
    both = np.unique((np.concatenate(rows).astype(np.int64) << BITS) | np.concatenate(ids).astype(np.int64))
    return both >> BITS, both & ((1 << BITS) - 1)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1


class Model:
    def __init__(self, weights: np.ndarray, ratios: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.squares, self.bias, self.slope, self.shift = weights.astype(np.float32), (ratios**2).astype(np.float32), bias, slope, shift

    def score(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        row, ids = features(raw, offs)
        top, norm = np.bincount(row, self.weights[ids], minlength=n), np.bincount(row, self.squares[ids], minlength=n)
        margin = self.bias + top / np.sqrt(np.maximum(norm, 1e-12))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def log_count_ratios(train: DataFrame) -> np.ndarray:
    """Per indicator, from all training rows; the sums come back as 2 x 2^BITS numbers, whatever the input's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), np.int64)
        for batch, raw, offs in vec.pieces(batches, "text", vec.PIECE_BYTES):
            y = np.asarray(batch.column("quality").to_pylist(), int)
            row, ids = features(raw, offs)
            for c in (0, 1):
                totals[c] += np.bincount(ids[y[row] == c], minlength=1 << BITS)
        for c in (0, 1):
            parts = totals[c].reshape(-1, CHUNK)
            some = np.flatnonzero(parts.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), c), pa.int32()), pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], ["class", "part", "counts"])

    def add(got: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in got.column("counts").to_pylist())
        return pa.table({"class": got.column("class")[:1], "part": got.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "class int, part int, counts binary"
    counts = np.zeros((2, 1 << BITS))
    for r in train.select("text", "quality").mapInArrow(count, kind).groupBy("class", "part").applyInArrow(add, kind).toLocalIterator():
        counts[r[0], r[1] * CHUNK : (r[1] + 1) * CHUNK] = np.frombuffer(r[2], np.int64)
    p, q = counts[1] + SMOOTHING, counts[0] + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model; the last weight is the bias. Costs are balanced by class."""
    w, b = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    cap = cost * 0.5 / np.maximum(share, 1e-9)
    q = np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cap[i])
            d = (new - alpha[i]) * y[i]
            if d:
                alpha[i] = new
                w[rows[i]] += d * values[i]
                b += d
                worst = max(worst, abs(d))
        if worst < 1e-3:
            break
    return w, b


def sigmoid_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make margins into chances (with the usual smoothed targets)."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, c = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -50, 50)))
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        ga, gc = (d * margin).sum() + 1e-3 * a, d.sum()
        haa, hac, hcc = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum() + 1e-9
        det = haa * hcc - hac * hac
        if det <= 1e-12:
            break
        a, c = a - (hcc * ga - hac * gc) / det, c - (haa * gc - hac * ga) / det
    return float(max(a, 0.0)), float(c)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on labelled rows outside the held-out fold."""
    lean(docs.sparkSession)
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", "quality")
    rows = docs.filter(~held_out() & F.col("text").isNotNull()).select("doc_id", "text")
    rows = rows.join(F.broadcast(known) if small(known, 1_000_000) else known, "doc_id").select("text", "quality", F.xxhash64("doc_id").alias("h"))
    ratios = log_count_ratios(rows)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in vec.pieces(batches, "text"):
            row, ids = features(raw, offs)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            packed = pa.array([ids[a:b].astype(np.int32).tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("quality"), packed], ["h", "quality", "ids"])

    total = known.count()
    some = rows if total <= sample_rows else rows.filter(F.col("h") <= int(-(2**63) + 2**64 * (sample_rows / total)))
    got = sorted((r[0], r[1], bytes(r[2])) for r in some.mapInArrow(pick, "h long, quality int, ids binary").toLocalIterator())[:sample_rows]
    y = np.array([1.0 if r[1] == 1 else -1.0 for r in got])
    if len(set(y.tolist())) < 2:
        share = (y > 0).mean() if len(y) else 0.5
        return Model(np.zeros(1 << BITS), ratios, 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    at = [np.frombuffer(r[2], np.int32) for r in got]
    val = [ratios[i].astype(np.float32) for i in at]
    val = [v / max(1e-6, float(np.sqrt(v @ v))) for v in val]
    aside = np.arange(len(y)) % 4 == 0
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    fit = np.flatnonzero(~aside)
    w, b = dual_coordinate_descent([at[i] for i in fit], [val[i] for i in fit], y[fit], 1 << BITS)
    check = np.flatnonzero(aside) if aside.any() else fit
    slope, shift = sigmoid_fit(np.array([w[at[i]] @ val[i] + b for i in check]), y[check])
    del got, at, val
    vec.hand_back()
    return Model(w * ratios, ratios, b, slope, shift)


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in vec.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(raw, offs), pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of `docs` that the classifier accepts (score of 0.5 or more), with all their columns.

    Null and empty texts stay or go by the bias alone; repeated rows stay or go together;
    rows without a doc_id are scored like others; without usable labels all stay; an empty
    table gives an empty table.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offs in vec.pieces(batches, "text"):
            yield batch.filter(pa.array(model.value.score(raw, offs) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
