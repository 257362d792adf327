"""Secret scan: fixed patterns and a token-efficiency test.

Base spans are the matches of three fixed patterns (leftmost, non-overlapping per
kind; matches that fail their test are dropped).  The token-efficiency test adds
spans of kind `random`: runs of key letters whose characters per token of a byte-level
vocabulary are at most a ratio that depends on their length: `ratio` from `min_chars`
on, less for runs of letters alone and for shorter ones, since words of that length may
come near it by chance.  Prose and identifiers made of words take few tokens; random
strings take many.
A run of key letters is cut at `/`, `=`, `_` and `-` wherever a part beside them is
a word by the same test, so names and paths about a key don't hide it; neighbouring
parts that are no words stay together and are tested as one, and where none passes,
the whole run is. UUIDs are cut out of runs. Known digests (hex after a digest name or
of a digest's length in a URL or path) are left out, as are parts inside base spans.

Edge cases: null and empty texts have no spans; spans are code points with an
exclusive end; equal starts keep the order assign, access, hex, random; repeated
rows give repeated results; an empty table gives an empty result; very long texts are
scanned whole in linear time; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .shared import lean, table
from .spans import SPAN, SPAN_SQL, digest, ordered

VOCABULARY = "byte_bpe_50k.tiktoken"
KINDS = ["assign", "access", "hex", "random"]
#: Runs from `MIN_CHARS` on are random at `RATIO` or less, letters alone at `LETTERS_RATIO`, shorter ones from `SHORT_CHARS` on at `SHORT_RATIO`.
MIN_CHARS = 20
RATIO = 1.9
LETTERS_RATIO = 1.85
SHORT_CHARS = 16
SHORT_RATIO = 1.55

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORT_CHARS)
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE)
DIGEST_NAME = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512)|digest|checksum|integrity|etag|commit|revision)\W{0,3}$", re.IGNORECASE)
SEPARATORS = "/=_-"
PART = re.compile(r"[^/=_-]+")
AFTER_SCHEME = re.compile(r"://\S*")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
ALL_HEX = re.compile(r"[0-9a-fA-F]+")


class Efficiency:
    """Characters per token under a public vocabulary; made once per Python worker."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> Efficiency:
        return vec.kept(("efficiency", path), lambda: cls(path))

    def ratio(self, run: str) -> float:
        return len(run) / max(1, len(self.enc.encode_ordinary(run)))


def base_spans(text: str) -> list[tuple[str, int, int, bool]]:
    out = []
    if ASSIGN_WORDS.search(text):
        out += [("assign", m.start(), m.end(), True) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), True) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end(), True) for m in HEX.finditer(text)]
    return out


class Urls:
    """Where a text has urls: looked up once for a text, and only if a place is asked for."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int]] | None = None

    def hold(self, at: int) -> bool:
        """Whether a url, however long, leads up to a place without a blank."""
        if self.spans is None:
            self.spans = [m.span() for m in AFTER_SCHEME.finditer(self.text)] if "://" in self.text else []
        k = bisect_right(self.spans, (at - 3, len(self.text)))
        return k > 0 and at <= self.spans[k - 1][1]


def known_identifier(text: str, start: int, stop: int, urls: Urls) -> bool:
    """Digests that texts quote on purpose."""
    if not ALL_HEX.fullmatch(text, start, stop):
        return False
    if DIGEST_NAME.search(text[max(0, start - 16) : start]):
        return True
    return stop - start in DIGEST_LENGTHS and ("/" in (text[stop : stop + 1], text[max(0, start - 1) : start]) or urls.hold(start))


def without_uuids(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """What is left of a run beside its UUIDs and the separators next to them."""
    at = start
    for m in UUID.finditer(text, start, stop):
        end = m.start()
        while end > at and text[end - 1] in SEPARATORS:
            end -= 1
        yield at, end
        at = m.end()
        while at < stop and text[at] in SEPARATORS:
            at += 1
    yield at, stop


def stretches(text: str, start: int, stop: int, test: Efficiency, ratio: float) -> list[tuple[int, int]]:
    """Neighbouring parts of a run that are no words, joined; the run itself if none of its parts is one."""
    out: list[tuple[int, int]] = []
    words, joined = 0, False
    for m in PART.finditer(text, start, stop):
        if test.ratio(m[0]) > ratio:
            words, joined = words + 1, False
        elif joined:
            out[-1] = (out[-1][0], m.end())
        else:
            out.append(m.span())
            joined = True
    if not words:
        return [(start, stop)]
    if out and not text[out[-1][1] : stop].strip("="):
        out[-1] = (out[-1][0], stop)
    return out


def random_spans(text: str, taken: list[tuple[str, int, int, bool]], test: Efficiency, ratio: float) -> list[tuple[str, int, int, bool]]:
    out, urls = [], Urls(text)

    def most(a: int, b: int) -> float:
        """The ratio up to which a part is random; 0 for one that is too short."""
        own = sum(c.isalnum() for c in text[a:b])
        if own < SHORT_CHARS:
            return 0.0
        if own < MIN_CHARS:
            return min(ratio, SHORT_RATIO)
        return ratio if any(c.isdigit() for c in text[a:b]) else min(ratio, LETTERS_RATIO)

    def passes(a: int, b: int) -> bool:
        return (limit := most(a, b)) > 0 and not any(s < b and a < e for _, s, e, _ in taken) and test.ratio(text[a:b]) <= limit

    for m in RUN.finditer(text):
        for a, b in without_uuids(text, *m.span()):
            if not most(a, b):
                continue
            parts = stretches(text, a, b, test, ratio)
            known = [p for p in parts if known_identifier(text, *p, urls)]
            found = [p for p in parts if p not in known and passes(*p)]
            if not found and not known and passes(a, b):
                found = [(a, b)]
            out += [("random", *p, False) for p in found]
    return out


def find_secrets(docs: DataFrame, ratio: float = RATIO, path: str | None = None) -> DataFrame:
    """Per row of `docs`: doc_id and spans (kind, start, stop, base)."""
    lean(docs.sparkSession)
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Efficiency.of(path)
        for batch, _, _ in vec.pieces(batches, "text"):
            spans = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                spans.append(ordered(base + random_spans(text, base, test, ratio), KINDS) if text else [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPAN)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans {SPAN_SQL}")


def redact(docs: DataFrame, ratio: float = RATIO, path: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in its text replaced by a mask and n_chars set anew where the text changed; all rows, columns, their order and types stay.

    Overlapping spans get one mask; null and empty texts stay as they are; repeated rows
    change alike; a table without n_chars, or an empty one, is fine.
    """
    lean(docs.sparkSession)
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Efficiency.of(path)
        for batch, _, _ in vec.pieces(batches, "text"):
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else None
            for i, text in enumerate(texts):
                base = base_spans(text) if text else []
                spans = sorted((a, b) for _, a, b, _ in base + random_spans(text, base, test, ratio)) if text else []
                if spans:
                    parts, at = [], 0
                    for a, b in spans:
                        if a >= at:
                            parts += [text[at:a], mask]
                        at = max(at, b)
                    texts[i] = "".join(parts) + text[at:]
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            columns = [
                pa.array(texts, f.type) if f.name == "text" else pa.array(sizes, f.type) if f.name == "n_chars" else batch.column(k)
                for k, f in enumerate(batch.schema)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents")), KINDS[:3])
