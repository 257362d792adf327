"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered.  A
window is `window` consecutive words of an item; an item with fewer words, but
not none, is one window.  The distinct windows form one automaton whose letters are
words: every word of the windows has a number, all other words share one, so a node
stands for a word and not for a character.  A text is scanned once; matches are mapped
back to words and to offsets in the original text.  Texts in which none of the windows'
marks stands have no match and are only counted: a window's mark is the one of its runs
of three words with the least checksum, which neighbouring windows mostly share.

Edge cases: null or wordless texts have no words and no hits; null or wordless
items have no windows; items of equal text are counted each, items without an id
mark words but are not listed; repeated document rows give repeated result rows;
an empty benchmark leaves every document clean; very long texts are scanned whole.
Other columns are left alone.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .shared import lean, semi_anti, table, unused, written

WINDOW = 13
#: Windows in one automaton, about 650 bytes each in every worker: 50 MB. A larger benchmark is scanned in several shards.
SHARD_WINDOWS = 75_000
#: Words of the windows of an automaton; longer windows make more shards.
SHARD_WORDS = WINDOW * SHARD_WINDOWS
#: Numbers of words, as characters of a string; behind them the one for all other words.
_FIRST, _OTHER = 0x10000, 0x10FFFF
#: Words that one character can number. Beyond, a word is two: the second one from `_SECOND` on, which no first one is, so a match begins with a word.
_ONE_LETTER = _OTHER - _FIRST
_SECOND, _SECONDS = 0x3000, 1024

_ALNUM_BYTES = bytes(b or 0x20 for b in vec.ALNUM.tolist())


def normalise(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_ALNUM_BYTES).split()


def mark_of(words: list[bytes]) -> bytes:
    """The three neighbouring words of a window with the least checksum, or all words of a shorter one."""
    return min((b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))), key=lambda p: (zlib.crc32(p), p))


class Automaton:
    """Finds windows; made once per Python worker from the windows of a shard: (words joined by blanks, items)."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        raw, offs = b"".join(k for k, _ in windows), np.cumsum([0, *(len(k) for k, _ in windows)])
        words = vec.find_words(np.frombuffer(raw, np.uint8), offs, vec.ALNUM)
        self.words = np.unique(words.hash)  # a word's number is its place here
        self.width = 1 if len(self.words) <= _ONE_LETTER else 2
        letters = self.letters(words.hash)
        self.find = ahocorasick.Automaton()
        for i, (_, who) in enumerate(windows):
            a, b = words.first[i : i + 2]
            self.find.add_word(letters[a:b].tobytes().decode("utf-32-le"), (int(b - a), tuple(who)))
        self.marks = ahocorasick.Automaton()
        for mark in {mark_of(k.split()) for k, _ in windows}:
            self.marks.add_word(f" {mark.decode('latin-1')} ", True)
        if windows:
            self.find.make_automaton()
            self.marks.make_automaton()

    def may_match(self, words: list[bytes]) -> bool:
        return bool(len(self.words)) and next(self.marks.iter(f" {b' '.join(words).decode('latin-1')} "), None) is not None

    def letters(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word as a row of code points, others for all that stand in no window."""
        if not len(self.words):
            return np.full((len(hashes), self.width), _OTHER, "<u4")
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        code = [at + _FIRST] if self.width == 1 else [at // _SECONDS + _FIRST, at % _SECONDS + _SECOND]
        return np.where((self.words[at] == hashes)[:, None], np.stack(code, axis=1), _OTHER).astype("<u4")

    def scan(self, words: vec.Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Of each row with hits: runs of its words that are hit, merged and in order, and the items found. One pass over all rows' words."""
        if not len(self.words) or not len(words.hash):
            return {}
        rows = len(words.first) - 1
        text = np.full((len(words.hash) + rows, self.width), _OTHER, "<u4")  # a letter that no window has stands behind each row
        text[np.arange(len(words.hash)) + words.doc] = self.letters(words.hash)
        begin = words.first[:-1] + np.arange(rows)
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for last, (n, who) in self.find.iter(text.tobytes().decode("utf-32-le")):
            last //= self.width
            row = int(np.searchsorted(begin, last, "right")) - 1
            to = last - int(begin[row]) + 1
            spans, items = found.setdefault(row, ([], set()))
            spans.append((to - n, to))
            items.update(who)
        return {row: (merged(spans), items) for row, (spans, items) in found.items()}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def windows_of(benchmark: DataFrame, window: int) -> DataFrame:
    """Written: key (words joined by blanks), items (ids as text), n (its words) of every distinct window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, sizes = [], [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = normalise(text)
                own = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1) if words else 0)}
                keys += own
                names += [item] * len(own)
                sizes += [min(window, len(words))] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["key", "item", "n"])

    found = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null").mapInArrow(run, "key binary, item string, n long")
    return written(found.groupBy("key").agg(F.collect_set("item").alias("items"), F.first("n").alias("n")), "windows")


_SCHEMA = "doc_id long, n_words long, runs array<struct<start:int,stop:int>>, items array<string>, spans array<struct<start:long,stop:long>>"
_RUN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def scan(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One scan of `docs` with one automaton: words, hit runs of words, items found and original offsets. windows: key, items; at most `SHARD_WINDOWS` rows."""
    key = uuid.uuid4().hex
    shipped = docs.sparkSession.sparkContext.broadcast(sorted((bytes(r[0]), sorted(r[1])) for r in windows.select("key", "items").collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = vec.kept(("automaton", key), lambda: Automaton(shipped.value))
        for batch, _, _ in vec.pieces(batches, "text"):
            texts = [normalise(t) for t in batch.column("text").to_pylist()]
            some = [row for row, words in enumerate(texts) if words and machine.may_match(words)]
            raw, offs = vec.text_buffer(batch.column("text").take(pa.array(some, pa.int64())))
            words = vec.find_words(raw, offs, vec.ALNUM)
            hits = {some[i]: (i, *found) for i, found in machine.scan(words).items()}
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            runs, names, spans = [], [], []
            for row in range(batch.num_rows):
                i, hit, who = hits.get(row, (0, (), ()))
                a, base = int(words.first[i]), chars[offs[i]]
                runs.append([{"start": x, "stop": y} for x, y in hit])
                names.append(sorted(who))
                spans.append([{"start": chars[words.start[a + x]] - base, "stop": chars[words.end[a + y - 1]] - base} for x, y in hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, _RUN), pa.array(names, pa.list_(pa.string())), pa.array(spans, _SPAN)],
                ["doc_id", "n_words", "runs", "items", "spans"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, items, spans (code points of hit runs), contaminated.

    The benchmark's windows and their words are counted first. Up to `shard_windows` and
    `SHARD_WORDS` they are one automaton and one scan; beyond, they are dealt by hash into
    shards of about that size, every shard scans the texts, and runs are merged per row.
    """
    lean(docs.sparkSession)
    windows = windows_of(benchmark, window)
    count, words = windows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(-(-count // shard_windows), -(-words // SHARD_WORDS), 1)
    if shards == 1:
        found = scan(docs, windows)
    else:  # each shard scans the distinct texts of a document; rows that repeat come back by their count
        keyed = docs.select("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
        keyed = keyed.groupBy("doc_id", "text").agg(F.count("*").alias("rows"))
        once = keyed.select(F.monotonically_increasing_id().alias("row"), "*")
        once = written(once, "shards")
        parts = None
        for k in range(shards):
            part = scan(once, windows.filter(F.pmod(F.xxhash64("key"), F.lit(shards)) == k), id_col="row")
            parts = part if parts is None else parts.unionByName(part)
        by_row = parts.groupBy(F.col("doc_id").alias("row"), "n_words").agg(
            F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
        )
        copies = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
        found = once.select("row", "doc_id", "rows").join(by_row, "row").withColumn("copy", copies).drop("row", "rows", "copy")
    step = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")),
        lambda a, r: F.struct((a["n"] + F.greatest(F.lit(0), r["stop"] - F.greatest(a["to"], r["start"]))).alias("n"), F.greatest(a["to"], r["stop"]).alias("to")),
    )
    hit = found.withColumn("n_hit", step["n"].cast("long"))
    return hit.select("doc_id", "n_words", "n_hit", "items", "spans", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs` that aren't contaminated, with all their columns.

    Rows are told apart by id and text, so rows that repeat both go together; rows without
    an id are judged by their text; null and wordless texts stay; an empty benchmark keeps
    all; an empty table gives an empty table.
    """
    key, name = F.xxhash64("doc_id", "text"), unused(docs, "_key")
    found = decontaminate(docs.select(key.alias("doc_id"), "text"), benchmark)
    gone = written(found.filter("contaminated").select("doc_id").distinct(), "contaminated").withColumnRenamed("doc_id", name)
    return semi_anti(docs.withColumn(name, key), gone, name).select(*docs.columns)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("spans"),
    )
