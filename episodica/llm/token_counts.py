"""Token counts without token ids: pieces once per distinct pre-token, summed per document.

1. Every task cuts its texts into pre-tokens and keeps the distinct ones.
2. Distinct pre-tokens of all tasks are split by the vocabulary, each once.
3. A document's count is the sum over its pre-tokens of frequency x pieces. Pieces
   of the pre-tokens that most tasks have seen, at most `BROADCAST_ROWS` entries of
   12 bytes, are broadcast; the others are joined to (document, pre-token,
   frequency) rows with a shuffle.

Special strings in a text are found before it is normalised, as the library does
by default, and count one token each. No ids are made: only lengths of the
encodings of distinct pre-tokens.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows give
repeated results; an empty table gives an empty table; very long texts are cut
into pre-tokens whole; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .shared import lean, table, written

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
BROADCAST_ROWS = 3_000_000
#: Distinct pre-tokens that a task holds before it hands them on.
TASK_PIECES = 400_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PreTokens:
    """Cuts text into pre-tokens as the vocabulary's own normaliser and splitter do."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.marks = specials
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"]]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        #: With this setup a text of Latin-1 letters without odd white space needs only lower() and the pattern.
        self.pattern = regex.compile(splits[0]) if len(splits) == 1 and kinds == ["NFC", "Replace", "Lowercase"] else None
        self.odd = regex.compile(r"[^\x09-\x0d\x20-\x7e\xa1-\xff]|\xad")

    @classmethod
    def of(cls, path: str) -> PreTokens:
        return vec.kept(("pre-tokens", path), lambda: cls(path))

    def cut(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens (in byte-level letters where the slow way made them) and the number of special strings."""
        marks = 0
        if self.special is not None and any(m in text for m in self.marks):
            parts = self.special.split(text)
            marks = len(parts) - 1
        else:
            parts = [text]
        out: list[str] = []
        for part in parts:
            if self.pattern is not None and self.odd.search(part) is None:
                out += self.pattern.findall(part.lower())
            else:  # the mark keeps these apart from plain pre-tokens
                out += ["\0" + t for t, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part)]
        return out, marks

    def pieces(self, tokens: list[str]) -> list[int]:
        """Lengths of the pre-tokens' encodings."""
        fast = [t for t in tokens if t[:1] != "\0"]
        lengths = dict(zip(fast, (len(e) for e in self.tok.encode_batch(fast, add_special_tokens=False)), strict=True))
        return [lengths[t] if t[:1] != "\0" else len(self.tok.model.tokenize(t[1:])) for t in tokens]


def key_of(token: str) -> int:
    """A 64-bit key of a pre-token, the same in every task."""
    import xxhash

    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63)


def distinct_pretokens(docs: DataFrame, path: str) -> DataFrame:
    """token, spread (in how many hand-overs of tasks it was) of every distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, seen = PreTokens.of(path), set()
        for batch, _, _ in vec.pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(cutter.cut(text)[0])
            if len(seen) > TASK_PIECES:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["token"])
                seen = set()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["token"])

    return docs.select("text").mapInArrow(run, "token string").groupBy("token").agg(F.count("*").alias("spread"))


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """key, pieces, spread of every distinct pre-token of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = PreTokens.of(path)
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([key_of(t) for t in tokens], pa.int64()), pa.array(cutter.pieces(tokens), pa.int32()), batch.column("spread")], ["key", "pieces", "spread"])

    return distinct_pretokens(docs, path).mapInArrow(run, "key long, pieces int, spread long")


def least_spread(known: DataFrame, rows: int) -> int:
    """The least spread from which on at most so many pre-tokens are left."""
    total = 0
    for spread, n in sorted(((r[0], r[1]) for r in known.groupBy("spread").count().collect()), reverse=True):
        total += n
        if total > rows:
            return spread + 1
    return 0


def packed(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their pieces; travels as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes()], pa.binary()) for c, t in (("key", np.int64), ("pieces", np.int32))], ["key", "pieces"])

    parts = [(np.frombuffer(r[0], np.int64), np.frombuffer(r[1], np.int32)) for r in known.select("key", "pieces").mapInArrow(run, "key binary, pieces binary").toLocalIterator()]
    keys = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
    order = np.argsort(keys)
    return keys[order], np.concatenate([np.zeros(0, np.int32), *(p[1] for p in parts)])[order]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or vocabulary_path()
    spark = lean(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = written(piece_counts(docs, path), "pieces")
    least = least_spread(known, broadcast_rows)
    shipped = spark.sparkContext.broadcast(packed(known.filter(F.col("spread") >= least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cutter = PreTokens.of(path)
        keys, pieces = shipped.value
        memo: dict[str, int] = {}
        for batch, _, offs in vec.pieces(batches, "text"):
            doc, text_key, size, total, key, count = [], [], [], [], [], []
            for d, text, n in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), np.diff(offs).tolist(), strict=True):
                tokens, own = cutter.cut(text) if text else ([], 0)
                freq = Counter(tokens)
                missing = [t for t in freq if t not in memo]
                if missing and len(keys):
                    wanted = np.array([key_of(t) for t in missing])
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    memo.update((t, k) for t, k, hit in zip(missing, pieces[at].tolist(), (keys[at] == wanted).tolist(), strict=True) if hit)
                h = xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63) if least else 0
                rest = 0
                for t, k in freq.items():
                    if t in memo:
                        own += k * memo[t]
                    else:
                        rest += 1
                        key.append(key_of(t))
                        count.append(k)
                doc += [d] * (1 + rest)
                text_key += [h] * (1 + rest)
                size += [n] + [None] * rest
                total += [own] + [None] * rest
                key.insert(len(key) - rest, None)
                count.insert(len(count) - rest, None)
                if len(memo) > TASK_PIECES:
                    memo.clear()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, text_key, size, total, key, count)], ["doc_id", "text_key", "n_bytes", "own", "key", "n"])

    rows = docs.mapInArrow(run, "doc_id long, text_key long, n_bytes long, own long, key long, n long")
    if not least:
        counted = rows.select("doc_id", "n_bytes", F.col("own").alias("n_tokens"))
    else:
        rows = written(rows, "rows")
        per = rows.filter("key is not null").groupBy("doc_id", "text_key", "key").agg(F.max("n").alias("n")).join(known.filter(F.col("spread") < least).select("key", "pieces"), "key")
        sums = per.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
        own = rows.filter("n_bytes is not null")
        counted = own.join(sums, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left").select("doc_id", "n_bytes", (F.col("own") + F.coalesce("rest", F.lit(0))).alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
