"""Personal data: fixed patterns, and a skip-chain conditional random field.

Base spans are the matches of four fixed patterns (leftmost, non-overlapping per
kind; failing matches are dropped).  The field then labels the document's other
number-like tokens.

Model.  Nodes are the tokens of a document that hold a digit or `@` (all other
tokens are outside by definition).  Each node has potentials from its shape, its
checks (Luhn, octets) and its neighbours' shapes; a token in a base span is held
at that label.  Chain edges join tokens that stand within three words.  Skip edges
join a token to the previous one with the same normal form (letters and digits,
lowered) anywhere in the document, and to the previous one that ends in the same
seven digits: repeated or similar tokens, a linear number of edges.  Loopy
sum-product messages run a fixed number of rounds over all documents of a slice
at once; tokens whose belief in a label passes one half become added spans, parts of
one number in one span.

Training.  Node, chain and skip potentials are fitted together, by the gradient of the
field's own log-likelihood: beliefs with the known labels held, less beliefs with
none held, both by the same messages.  Known are tokens in base spans (their kind) and
tokens outside (none), but for those whose label is what the field is to infer: tokens
that repeat or resemble one in a base span, and tokens within a longer match that failed
its test, such as a card number right behind a telephone number.  Those are summed out.
Skip potentials lean to agreement where the sample says nothing.  The sample are at most
`SAMPLE_DOCS` distinct texts that hold such tokens, those of least hash, and of each the
`SAMPLE_TOKENS` tokens of least hash with three words about them, from the whole text.
Scanning and inference cover every document.

Edge cases: null and empty texts have no spans; offsets are code points with an
exclusive end; repeated rows give repeated results; without any base span in the
sample nothing is added; an empty table gives an empty result; long texts are handled
whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vec
from .shared import lean, table, written
from .spans import SPAN, SPAN_SQL, digest, ordered

KINDS = ["email", "ip", "card", "phone"]
SAMPLE_DOCS = 3000
SAMPLE_TOKENS = 256
FEATURES = 1 << 12
ROUNDS = 12
#: Steps of the training, how strongly potentials are drawn to what they are without data, and what skip edges are then.
STEPS = 60
PULL = 1.0
AGREE = 2.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: The look-behind only keeps a run of digits from being tried again at each digit.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACE = re.compile(r"\s")
MARK = re.compile(r"[0-9@]")
TRIM = ".,;:!?\"'“”()[]{}<>#*&%$|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    return all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in s.split("."))


def dropped_spans(text: str) -> list[tuple[int, int]]:
    """Matches of the patterns for numbers that fail their tests."""
    out = [m.span() for m in IP.finditer(text) if not octets(m[0])]
    out += [m.span() for m in CARD.finditer(text) if len(d := digits_of(m[0])) >= 10 and not (14 <= len(d) <= 19 and luhn(d))]
    return out + ([m.span() for m in PHONE.finditer(text) if len(digits_of(m[0])) > 15] if "+" in text else [])


def base_spans(text: str) -> list[tuple[str, int, int, bool]]:
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at) if a < at else None
        if m:
            out.append(("email", a, m.end(), True))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", m.start(), m.end(), True) for m in IP.finditer(text) if octets(m[0])]
    for m in CARD.finditer(text):
        d = digits_of(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end(), True))
    if "+" in text:
        out += [("phone", m.start(), m.end(), True) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return out


def marked_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Runs without white space that hold a digit or `@`."""
    m = MARK.search(text)
    while m:
        a = m.start()
        while a and not text[a - 1].isspace():
            a -= 1
        end = SPACE.search(text, m.end())
        b = end.start() if end else len(text)
        yield a, b
        m = MARK.search(text, b)


def shape(s: str) -> str:
    """Character classes with runs shortened: `+1` is `+9`, `ab.12` is `a.9`."""
    return re.sub(r"(.)\1+", r"\1\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", s[:64])))


def feature_ids(tokens: list[tuple[int, int]], text: str, i: int) -> list[int]:
    a, b = tokens[i]
    s = text[a:b]
    d = digits_of(s[:64])
    near = [shape(text[slice(*tokens[j])]) if 0 <= j < len(tokens) and abs(tokens[j][0] - a) < 40 else "" for j in (i - 1, i + 1)]
    names = [
        "bias", f"shape {shape(s)}", f"digits {min(len(d), 20)}", f"length {min(len(s), 24)}", f"at {'@' in s}", f"dots {min(s.count('.'), 5)}",
        f"luhn {14 <= len(d) <= 19 and luhn(d)}", f"octets {s.count('.') == 3 and bool(re.fullmatch(r'[0-9]{1,9}([.][0-9]{1,9}){3}', s)) and octets(s)}",
        f"before {near[0]}", f"after {near[1]}", f"plus {s[:1] == '+'}", f"hyphens {min(s.count('-'), 3)}",
    ]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]


class Graph:
    """Nodes and edges of many documents."""

    def __init__(self):
        self.where: list[tuple[int, int, int]] = []  # row, start, stop
        self.label: list[int] = []  # held label, or -1
        self.part: list[bool] = []  # within a longer match that failed
        self.ids: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, row: int, text: str, base: list[tuple[str, int, int, bool]]) -> None:
        tokens = []
        for a, b in marked_tokens(text):
            while a < b and text[a] in TRIM:
                a += 1
            while b > a and text[b - 1] in TRIM:
                b -= 1
            tokens.append((a, b))
        spans = sorted((a, b, KINDS.index(k) + 1) for k, a, b, _ in base)
        dropped = sorted(dropped_spans(text))
        last: dict[str, int] = {}
        at = out = 0
        for i, (a, b) in enumerate(tokens):
            node = len(self.where)
            while at < len(spans) and spans[at][1] <= a:
                at += 1
            while out < len(dropped) and dropped[out][1] <= a:
                out += 1
            held = next((k for s, e, k in spans[at : at + 4] if s < b and a < e), -1)
            self.where.append((row, a, b))
            self.label.append(held)
            self.part.append(any(s <= a + 1 and b - 1 <= e and e - s > b - a for s, e in dropped[out : out + 4]))
            self.ids.append(feature_ids(tokens, text, i))
            if i and a - tokens[i - 1][1] < 40 and text.count(" ", tokens[i - 1][1], a) <= 3:
                self.chain.append((node - 1, node))
            s = text[a:b].lower()
            d = digits_of(s)
            for form in {"".join(c for c in s if c.isalnum() or c == "@"), *(["…" + d[-7:]] if len(d) >= 7 else [])}:
                if form in last:
                    self.skip.append((last[form], node))
                last[form] = node


def latent(graph: Graph) -> np.ndarray:
    """Nodes outside base spans whose label isn't known: they repeat or resemble a node in one, or are part of a longer match that failed."""
    held = np.array(graph.label, int) > 0
    near = held.copy()
    edges = np.array(graph.skip, int).reshape(-1, 2)
    while len(edges):
        more = near.copy()
        more[edges[near[edges[:, 0]], 1]] = True
        more[edges[near[edges[:, 1]], 0]] = True
        if (more == near).all():
            break
        near = more
    return (near | np.array(graph.part, bool)) & ~held


def _chances(z: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
    p = np.exp(z - z.max(axes, keepdims=True))
    return p / p.sum(axes, keepdims=True)


class Messages:
    """Loopy sum-product over all edges of a graph at once."""

    def __init__(self, graph: Graph):
        self.edges = np.array([*graph.chain, *graph.skip], int).reshape(-1, 2)
        self.kind = np.repeat([0, 1], [len(graph.chain), len(graph.skip)])
        self.source, self.target = np.concatenate([self.edges[:, 0], self.edges[:, 1]]), np.concatenate([self.edges[:, 1], self.edges[:, 0]])
        n = len(self.edges)
        self.back = np.concatenate([np.arange(n) + n, np.arange(n)])

    def run(self, node: np.ndarray, tables: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
        """Beliefs of nodes and of edges. node: log potentials, nodes x labels; tables: of chain and skip edges, 2 x labels x labels."""
        if not len(self.edges):
            return _chances(node, (1,)), np.zeros((0, *tables.shape[1:]))
        of = tables[self.kind]
        pair = np.concatenate([of, of.transpose(0, 2, 1)])
        message = np.zeros((len(self.source), node.shape[1]))
        total = node
        for _ in range(rounds):
            out = (total[self.source] - message[self.back])[:, :, None] + pair
            top = out.max(1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(1, keepdims=True)))[:, 0]
            message = 0.5 * message + 0.5 * (new - new.max(1, keepdims=True))
            total = np.stack([node[:, k] + np.bincount(self.target, message[:, k], len(node)) for k in range(node.shape[1])], 1)
        n = len(self.edges)
        left, right = total[self.edges[:, 0]] - message[n:], total[self.edges[:, 1]] - message[:n]
        return _chances(total, (1,)), _chances(left[:, :, None] + right[:, None, :] + of, (1, 2))


def held(node: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Potentials with known labels (0 or more) held."""
    out = node.copy()
    out[label >= 0] = -30.0
    out[np.flatnonzero(label >= 0), label[label >= 0]] = 0.0
    return out


def fit(graph: Graph, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Node weights (features x labels) and log potentials of chain and skip edges (2 x labels x labels), fitted together."""
    n = len(KINDS) + 1
    weights, tables = np.zeros((FEATURES, n)), np.stack([np.zeros((n, n)), AGREE * np.eye(n)])
    label = np.array(graph.label, int)
    if not len(label) or label.max() <= 0:
        return weights, tables
    label = np.where(label > 0, label, np.where(latent(graph), -1, 0))
    ids, messages, prior = np.array(graph.ids), Messages(graph), tables.copy()
    flat, size = ids.ravel(), len(label)
    grown = [np.full_like(weights, 1e-8), np.full_like(tables, 1e-8)]
    for _ in range(steps):
        node = weights[ids].sum(1)
        (clamped, with_known), (free, without) = messages.run(held(node, label), tables), messages.run(node, tables)
        off = np.repeat(clamped - free, ids.shape[1], axis=0)
        slope = np.stack([np.bincount(flat, off[:, k], FEATURES) for k in range(n)], 1)
        edge = np.stack([(with_known - without)[messages.kind == k].sum(0) for k in (0, 1)])
        for value, g, sum_, rest in ((weights, slope, grown[0], 0.0), (tables, edge, grown[1], prior)):
            g = (g - PULL * (value - rest) * 0.05) / size
            sum_ += g * g
            value += 0.5 * g / np.sqrt(sum_)
    return weights, tables


def beliefs(graph: Graph, model: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Beliefs in labels, nodes x labels; tokens in base spans are held."""
    weights, tables = model
    return Messages(graph).run(held(weights[np.array(graph.ids)].sum(1), np.array(graph.label)), tables, rounds)[0]


def complete(kind: str, token: str) -> bool:
    """Whether a token is a whole span of its kind and not a part of one."""
    n = len(digits_of(token))
    return {"email": "@" in token, "ip": token.count(".") == 3, "card": n >= 14, "phone": n >= 10}[kind]


def added_spans(text: str, tokens: list[tuple[str, int, int]]) -> list[tuple[str, int, int, bool]]:
    """Spans of labelled tokens (kind, start, stop) in order; neighbouring parts of one number are joined."""
    out: list[tuple[str, int, int, bool]] = []
    for kind, a, b in tokens:
        if out and out[-1][0] == kind and not complete(kind, text[a:b]) and not complete(kind, text[out[-1][1] : out[-1][2]]) and text[a] != "+" and a - out[-1][2] <= 3 and not text[out[-1][2] : a].strip(" ().-"):
            out[-1] = (kind, out[-1][1], b, False)
        else:
            out.append((kind, a, b, False))
    return out


GAP = "\n" + "·" * 48 + "\n"


def snippets(text: str, most: int = SAMPLE_TOKENS) -> str:
    """At most so many number-like tokens of a text, those whose normal form has the least hash, with three words about them."""
    tokens = list(marked_tokens(text))
    if len(tokens) > most:
        tokens.sort(key=lambda t: (zlib.crc32("".join(c for c in text[slice(*t)].lower() if c.isalnum()).encode("utf-8", "surrogatepass")), t))
        tokens = sorted(tokens[:most])
    out: list[list[int]] = []
    for a, b in tokens:
        before = [m.start() for m in re.finditer(r"\S+", text[max(0, a - 192) : a])][-3:]
        after = [m.end() for m in re.finditer(r"\S+", text[b : b + 192])][:3]
        lo, hi = max(0, a - 192) + before[0] if before else a, b + after[-1] if after else b
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return GAP.join(text[a:b] for a, b in out)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Fits the field on at most `sample_docs` distinct texts with number-like tokens."""
    some = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    hashes = written(some.select("h").distinct(), "marked")
    edge = hashes.orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if edge is None:
        return fit(Graph())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([snippets(t) for t in batch.column("text").to_pylist()], pa.string()), batch.column("h")], ["text", "h"])

    graph = Graph()
    picked = some.filter(F.col("h") <= edge).mapInArrow(cut, "text string, h long").groupBy("h").agg(F.min("text").alias("text"))
    for i, r in enumerate(sorted(picked.collect(), key=lambda r: r["h"])):
        graph.add(i, r["text"], base_spans(r["text"]))
    return fit(graph)


def find_personal_data(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row of `docs`: doc_id and spans (kind, start, stop, base)."""
    lean(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in vec.pieces(batches, "text"):
            spans: list[list] = []
            graph = Graph()
            texts = batch.column("text").to_pylist()
            for row, text in enumerate(texts):
                base = []
                if text and MARK.search(text):
                    base = base_spans(text)
                    graph.add(row, text, base)
                spans.append(base)
            if graph.where and model.value[0].any():
                p = beliefs(graph, model.value)
                best = p.argmax(1)
                found: dict[int, list[tuple[str, int, int]]] = {}
                for i in np.flatnonzero((best > 0) & (p.max(1) > 0.5) & (np.array(graph.label) < 0)):
                    row, a, b = graph.where[i]
                    if a < b:
                        found.setdefault(row, []).append((KINDS[best[i] - 1], a, b))
                for row, tokens in found.items():
                    spans[row] = [*spans[row], *added_spans(texts[row], tokens)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([ordered(s, KINDS) for s in spans], SPAN)], ["doc_id", "spans"])

    return docs.mapInArrow(run, f"doc_id long, spans {SPAN_SQL}")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(table(spark, sf_dir, "documents")), KINDS)
