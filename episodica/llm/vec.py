"""Array helpers for text columns inside Arrow tasks.

A string column arrives in a task as one byte buffer with offsets.  The helpers
below find words and hash them with numpy over that buffer, so no Python object
is made per word.  Hashes are 64 bit; two different words, shingles or sets are
taken as equal only if such hashes collide.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one step works on; bounds the memory of the arrays, about a hundred bytes for each.
PIECE_BYTES = 1 << 19

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_BASE = U64(0xD6E8FEB86659FD93)
_GRAM = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (the finaliser of splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def byte_table(separators: Iterable[int]) -> np.ndarray:
    """A 256-entry table: 0 for bytes between words, else the byte with A-Z lowered."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Words `[^\x20\x09-\x0D]+`, and words of letters, digits and bytes above 0x7F.
SPACED = byte_table([0x20, *range(0x09, 0x0E)])
ALNUM = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SPACED_WORD = SPACED != 0
SPACED_WORD[0] = True  # NUL is part of a word there


class Words(NamedTuple):
    doc: np.ndarray  # of each word, its row
    start: np.ndarray  # byte offset into the buffer
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each row, its first word; one entry more than rows


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def find_words(raw: np.ndarray, offs: np.ndarray, table: np.ndarray, is_word: np.ndarray | None = None) -> Words:
    """Words of every row, none across rows, with hashes of their lowered bytes."""
    is_word = table != 0 if is_word is None else is_word
    n = len(raw)
    rows = len(offs) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(U64), np.zeros(rows + 1, np.int64))
    inside = is_word[raw]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    first = np.searchsorted(start, offs)
    doc = np.repeat(np.arange(rows), np.diff(first))
    if not len(start):
        return Words(doc, start, end, np.zeros(0, U64), first)
    at = np.flatnonzero(inside)
    lens = end - start
    begins = np.cumsum(lens) - lens
    within = np.arange(len(at)) - np.repeat(begins, lens)
    value = mix((np.arange(256, dtype=U64) + U64(1)) * _ODD)[table]
    power = np.empty(int(lens.max()), U64)
    power[0] = 1
    if len(power) > 1:
        power[1:] = _BASE
        np.multiply.accumulate(power, out=power)
    h = np.add.reduceat(value[raw[at]] * power[within], begins)
    return Words(doc, start, end, mix(h + lens.astype(U64) * _ODD), first)


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of n words of a row, and of each row the first; rows of fewer words have none."""
    total = len(words.hash)
    counts = np.maximum(np.diff(words.first) - (n - 1), 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    if total < n:
        return np.zeros(0, U64), first
    h = np.zeros(total - n + 1, U64)
    for k in range(n):
        h += words.hash[k : total - n + 1 + k] * _GRAM[k % 5] ** U64(1 + k // 5)
    return mix(h)[words.doc[: total - n + 1] == words.doc[n - 1 :]], first


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """For every row its sorted distinct n-word shingles; a shorter text is one shingle, no words none."""
    g, first = grams(words, n)
    for i in range(len(first) - 1):
        if first[i + 1] > first[i]:
            yield np.unique(g[first[i] : first[i + 1]])
        else:
            own = words.hash[words.first[i] : words.first[i + 1]]
            if len(own):
                h = U64(len(own))
                for x in own:
                    h = mix(h * _ODD + x)
                own = np.array([h], U64)
            yield own


_kept: list[tuple[Any, Any]] = []


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What `make` gives for the key, kept for the worker's next tasks. Only the last one is: a worker goes from one operator to the next."""
    if not _kept or _kept[0][0] != key:
        _kept[:] = []
        _kept[:] = [(key, make())]
    return _kept[0][1]


def hand_back() -> None:
    """Gives memory that is free again back to the machine, so that workers that wait for tasks are small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches into slices of about `limit` bytes of text: (slice, bytes, offsets). A longer text stands alone."""
    for batch in batches:
        raw, offs = text_buffer(batch.column(text))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, "right")) - 1)
            yield batch.slice(row, to - row), raw[offs[row] : offs[to]], offs[row : to + 1] - offs[row]
            row = to
    hand_back()


def list_column(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == U64 else flat, kind))
