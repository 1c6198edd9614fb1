"""Words and fingerprints of whole Arrow text columns, computed with numpy inside tasks.

A block is a slice of rows of at most ``BLOCK_BYTES`` of UTF-8 (or one longer text). Nulls count as empty
texts. Fingerprints are 64-bit polynomial hashes, finished by a mixer; equal bytes give equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
#: Longer words are hashed one by one.
LONG_WORD = 4096
BASE = 0x9E3779B97F4A7C15

U64 = np.uint64


class Block(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray  # uint8, the texts behind each other
    bounds: np.ndarray  # int64, where each text starts, and the end


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[Block]:
    """Cut batches into blocks of few texts, so that memory hangs on the longest text only.

    Workers are used again by later tasks, so what a batch took is given back to the system behind it.
    """
    for batch in batches:
        yield from _cut(batch, column)
        del batch
        pa.default_memory_pool().release_unused()


def _cut(batch: pa.RecordBatch, column: str) -> Iterator[Block]:
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    at, rows = 0, batch.num_rows
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not rows:
        return
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + rows + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    while at < rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        own = bounds[at : to + 1]
        yield Block(batch.slice(at, to - at), whole[own[0] : own[-1]], own - own[0])
        at = to


def byte_class(predicate) -> np.ndarray:
    return np.array([bool(predicate(x)) for x in range(256)])


#: Bytes of words between white space: [^\x20\x09-\x0D]+
NOT_SPACE = byte_class(lambda x: x != 0x20 and not 0x09 <= x <= 0x0D)
#: Bytes of words of letters and digits, any byte above ASCII included: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
WORD_CHARS = byte_class(lambda x: 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A or x >= 0x80)
LOWER = np.array([x + 32 if 0x41 <= x <= 0x5A else x for x in range(256)], np.uint8)


def words(data: np.ndarray, bounds: np.ndarray, in_word: np.ndarray) -> Words:
    """Maximal runs of ``in_word`` bytes within each text."""
    inside = in_word[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= cut[1:-1] | ~inside[:-1]
    closes[:-1] &= cut[1:-1] | ~inside[1:]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds))


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        row = np.full(n, base, U64)
        row[0] = 1
        made.append(np.cumprod(row, dtype=U64))
    return made[0], made[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(29))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(32))


class Sums:
    """Prefix sums over a piece of bytes, from which the fingerprint of any span follows."""

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(16, int(len(data)).bit_length())
        self.inverse = powers(size)[1]
        self.total = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * powers(size)[0][: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.inverse[starts] + (ends - starts).astype(U64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of ascending spans that do not overlap (words, lines)."""
    out, at = np.empty(len(starts), U64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, "right")))
        low, lengths = starts[at], ends[at:to] - starts[at:to]
        if lengths.max() <= LONG_WORD:
            out[at:to] = Sums(data[low : ends[to - 1]]).of(starts[at:to] - low, ends[at:to] - low)
        else:
            short = lengths <= LONG_WORD
            for k in np.flatnonzero(~short) + at:
                digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
                out[k] = int.from_bytes(digest, "little")
            s, e = starts[at:to][short], ends[at:to][short]
            if len(s):
                packed = np.concatenate([data[a:b] for a, b in zip(s, e, strict=True)])
                ends_packed = np.cumsum(e - s)
                out[np.flatnonzero(short) + at] = Sums(packed).of(ends_packed - (e - s), ends_packed)
        at = to
    return out


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of each run of ``n`` neighbouring hashes; ``len(hashes) - n + 1`` of them."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * U64(0xD6E8FEB86659FD93) + hashes[k : len(hashes) - n + 1 + k])
    return out


def code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points in each span of UTF-8."""
    total = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return total[ends] - total[starts]
