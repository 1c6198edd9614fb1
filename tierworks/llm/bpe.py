"""BPE encoding and decoding of whole texts, with tree concatenation for long unsplit runs.

Texts are cut where the tokenizer's own pre-tokenizer cuts. A word is encoded once for each worker and kept by
its fingerprint, so that encoding a block is a lookup and a gather. A run of more than ``LONG_RUN`` bytes that
nothing splits is encoded as a tree: leaves on their own, then pairs are joined by encoding a window around the
join anew. The window grows until its first token equals the left side's and its last token the right
side's (or it reaches an end). A sequence whose neighbouring tokens are each the encoding of their own text is
the encoding of the whole, so the joined sequence is the one that encoding in one piece gives.

Nulls are empty texts and give no ids. ``ids`` are little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tierworks.llm import arrays
from tierworks.llm.arrays import U64

#: Bytes from which a word is encoded as a tree, and the bytes of its leaves.
LONG_RUN, LEAF = 256, 128
#: Words kept by a worker; beyond, it starts anew.
KEPT_WORDS = 1 << 19
#: Characters of a text that the library gets at once.
PIECE_CHARS = 1 << 18

# The normalizer and the split of the tokenizer files that the quick way knows.
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

SPACE, LETTER, DIGIT, SYMBOL = range(4)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, SYMBOL, np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = SPACE
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
    kinds[range(0x30, 0x3A)] = DIGIT
    return kinds


BYTE_KINDS = _byte_kinds()


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pool's runs behind each other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class Pool:
    """Ids of known words by fingerprint: an open-addressing table over numpy arrays."""

    def __init__(self) -> None:
        self.size = 4 * KEPT_WORDS
        self.keys = np.zeros(self.size, U64)
        self.slots = np.zeros(self.size, np.int32)
        self.starts, self.lengths = np.zeros(KEPT_WORDS, np.int64), np.zeros(KEPT_WORDS, np.int64)
        self.ids, self.used, self.count = np.zeros(1 << 20, np.uint32), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; -1 for unknown ones."""
        found = np.full(len(hashes), -1, np.int32)
        at = (hashes & U64(self.size - 1)).astype(np.int64)
        left = None
        while True:
            keys = self.keys[at]
            own = hashes if left is None else hashes[left]
            hit = keys == own
            if left is None:
                found[hit] = self.slots[at[hit]]
                left = np.flatnonzero(~hit & (keys != 0))
                at = at[left]
            else:
                found[left[hit]] = self.slots[at[hit]]
                on = ~hit & (keys != 0)
                left, at = left[on], at[on]
            if not len(left):
                return found
            at = (at + 1) & (self.size - 1)

    def add(self, hashes: np.ndarray, encoded: list[list[int]]) -> None:
        """New distinct words; no hash is 0."""
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        own = slice(self.count, self.count + len(encoded))
        self.starts[own] = self.used + np.cumsum(lengths) - lengths
        self.lengths[own] = lengths
        for h, k in zip(hashes.tolist(), range(own.start, own.stop), strict=True):
            at = h & (self.size - 1)
            while self.keys[at]:
                at = (at + 1) & (self.size - 1)
            self.keys[at], self.slots[at] = h, k
        self.used += len(flat)
        self.count += len(encoded)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = [x["content"] for x in spec["added_tokens"]]
        vocab = spec["model"]["vocab"]
        self.n_ids = 1 + max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])])
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        names = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.known = (
            names == KNOWN_NORMALIZERS
            and split.get("pattern", {}).get("Regex") == KNOWN_SPLIT
            and self.suffix == WORD_END
            and all(x.startswith("<|") for x in self.specials)
        )
        self.model = self.tokenizer.model
        if self.known:
            merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in spec["model"]["merges"]]
            self.inner = BPE(vocab=vocab, merges=merges)  # for parts before a word's end
        tokens = [self.tokenizer.id_to_token(k) or "" for k in range(self.n_ids)]
        self.plain = [x.removesuffix(WORD_END) for x in tokens]
        shown = [x.encode() + b" " for x in tokens]
        self.shown_lengths = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown_starts = np.cumsum(self.shown_lengths) - self.shown_lengths
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.letters = {b: c for b, c in enumerate(byte_alphabet())}
        self.pool = Pool()

    # --- words ---------------------------------------------------------------------------------

    def word(self, mapped: str) -> list[int]:
        """Ids of one word, given in the byte alphabet."""
        if len(mapped) <= LONG_RUN:
            return [x.id for x in self.model.tokenize(mapped)]
        return self.tree(mapped)

    def part(self, mapped: str, last: bool) -> list[int]:
        return [x.id for x in (self.model if last else self.inner).tokenize(mapped)]

    def tree(self, mapped: str) -> list[int]:
        cuts = range(0, len(mapped), LEAF)
        level = [self.part(mapped[k : k + LEAF], k + LEAF >= len(mapped)) for k in cuts]
        while len(level) > 1:
            pairs = [self.joined(level[k], level[k + 1], k + 2 == len(level)) for k in range(0, len(level) - 1, 2)]
            level = pairs + level[len(level) - len(level) % 2 :]
        return level[0]

    def joined(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of two neighbouring parts' text; ``last``: the right one ends the word."""
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            whole_left, whole_right = len(a) == len(left), len(b) == len(right)
            new = self.part("".join(self.plain[x] for x in a + b), last and whole_right)
            if (whole_left or new[0] == a[0]) and (whole_right or new[-1] == b[-1]):
                return left[: len(left) - len(a)] + new + right[len(b) :]
            k *= 2

    # --- blocks --------------------------------------------------------------------------------

    def encode(self, block: arrays.Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and where each text's ids start (and the end)."""
        data, bounds = block.data, block.bounds
        n = len(bounds) - 1
        slow = self._slow(data, bounds) if self.known else np.ones(n, bool)
        counts = np.zeros(n, np.int64)
        if slow.all():
            quick = np.zeros(0, np.uint32)
        else:
            quick, counts = self._quick(data, bounds, slow)
        if not slow.any():
            return quick, np.concatenate(([0], np.cumsum(counts)))
        parts, at = [], np.concatenate(([0], np.cumsum(counts)))
        for k in range(n):
            own = quick[at[k] : at[k + 1]]
            if slow[k]:
                own = np.array(self.library(data[bounds[k] : bounds[k + 1]].tobytes().decode()), np.uint32)
                counts[k] = len(own)
            parts.append(own)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(counts)))

    @staticmethod
    def _slow(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts with characters other than U+0000-7F and U+00C0-FF, or with what may open a special token."""
        high = data >= 0x80
        lead = data == 0xC3
        odd = high & ~lead
        odd[1:] &= ~lead[:-1]
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        return np.diff(np.concatenate(([0], np.cumsum(odd)))[bounds]) > 0

    def _quick(self, data: np.ndarray, bounds: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, kinds = arrays.LOWER[data], BYTE_KINDS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        second = data[lead + 1]
        sign = (second == 0x97) | (second == 0xB7)
        kinds[lead] = kinds[lead + 1] = np.where(sign, SYMBOL, LETTER)
        upper = (second <= 0x9E) & ~sign
        low[lead[upper] + 1] += 0x20
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        starts = np.ones(len(data), bool)
        starts[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        starts |= cut[:-1]
        self._contractions(low, kinds, cut, starts)
        starts &= kinds != SPACE
        begin = np.flatnonzero(starts)
        # A word ends where the next starts, or before white space or a text's end.
        stop = cut[1:].copy()
        stop[:-1] |= starts[1:] | (kinds[1:] == SPACE)
        end = np.flatnonzero(stop & (kinds != SPACE)) + 1
        if skip.any():
            keep = ~skip[np.searchsorted(bounds, begin, "right") - 1]
            begin, end = begin[keep], end[keep]
        hashes = arrays.span_hashes(low, begin, end)
        hashes[hashes == 0] = 1
        # A slice of so many words has no more distinct ones than an empty pool holds.
        parts, sizes = [], []
        for k in range(0, max(len(begin), 1), KEPT_WORDS):
            own = slice(k, k + KEPT_WORDS)
            found = self._known(hashes[own], low, begin[own], end[own])
            sizes.append(self.pool.lengths[found])
            parts.append(gather(self.pool.ids, self.pool.starts[found], sizes[-1]))
        ids = np.concatenate(parts)
        per_word = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        first = np.searchsorted(begin, bounds)
        return ids, np.diff(per_word[first])

    @staticmethod
    def _contractions(low: np.ndarray, kinds: np.ndarray, cut: np.ndarray, starts: np.ndarray) -> None:
        """'s 't 're 've 'm 'll 'd are words of their own where no other sign stands before them."""
        for q in np.flatnonzero((low == 0x27)).tolist():
            if q and kinds[q - 1] == SYMBOL and not cut[q]:
                continue
            tail = low[q + 1 : q + 3].tobytes()
            size = 2 if tail[:1] in (b"s", b"t", b"m", b"d") else 3 if tail in (b"re", b"ve", b"ll") else 0
            if size and not cut[q + 1 : q + size].any():
                starts[q], starts[q + 1 : q + size] = True, False
                if q + size < len(low) and kinds[q + size] != SPACE:
                    starts[q + size] = True

    def _known(self, hashes: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Word numbers of up to ``KEPT_WORDS`` words in the pool; what it does not hold yet is encoded."""
        found = self.pool.find(hashes)
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        new, first = np.unique(hashes[missing], return_index=True)
        if self.pool.count + len(new) > KEPT_WORDS:
            self.pool = Pool()
            new, first = np.unique(hashes, return_index=True)
            missing = np.arange(len(hashes))
            found[:] = -1
        where = missing[first]
        spelt = [low[b:e].tobytes().decode("latin-1").translate(self.letters) for b, e in zip(begin[where].tolist(), end[where].tolist(), strict=True)]
        self.pool.add(new, [self.word(x) for x in spelt])
        found[missing] = self.pool.find(hashes[missing])
        return found

    # --- the library's way ---------------------------------------------------------------------

    def library(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in pieces(text, PIECE_CHARS):
            if self.known and re.search(rf"\S{{{LONG_RUN * 16}}}", piece):
                out += self._unsplit(piece)
            else:
                out += self.tokenizer.encode(piece, add_special_tokens=False).ids
        return out

    def _unsplit(self, piece: str) -> list[int]:
        """A piece that holds long runs: special tokens first, then word by word."""
        out: list[int] = []
        special = "|".join(map(re.escape, self.specials)) or r"(?!)"
        for part in re.split(f"({special})", piece):
            if part in self.specials:
                out.append(self.tokenizer.token_to_id(part))
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                out += [i for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) for i in self.word(w)]
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The text of each run of ids in UTF-8, as the library decodes it."""
        if self.tokenizer.decoder is not None:
            runs = zip(bounds[:-1], bounds[1:], strict=True)
            return [self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False).encode() for a, b in runs]
        lengths = self.shown_lengths[ids]
        out = gather(self.shown, self.shown_starts[ids], lengths)
        at = np.concatenate(([0], np.cumsum(lengths)))[bounds]
        return [out[a : max(a, b - 1)].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def pieces(text: str, size: int) -> Iterator[str]:
    """Cut a long text before white space that follows something else; a run without any stays whole."""
    at = 0
    while len(text) - at > size:
        found = re.compile(r"(?<=\S)[ \t\n]").search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    if at < len(text) or not text:
        yield text[at:]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_ids(df: DataFrame, tokenizer: str, column: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``ids`` (binary) and, on request, ``decoded`` (string: the ids decoded again).

    ``tokenizer`` is a file that all executors see. Columns of ``df`` called ``ids`` or ``decoded`` are replaced.
    Repeated rows stay; an empty table gives an empty one.
    """
    added = [T.StructField("ids", T.BinaryType())] + [T.StructField("decoded", T.StringType())] * decoded
    kept = df.select(*(c for c in df.columns if c not in {f.name for f in added}))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for block in arrays.blocks(batches, column):
            ids, bounds = own.encode(block)
            cells = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            more = [pa.array(cells, pa.binary())]
            if decoded:
                texts = [x.decode() for x in own.decode(ids, bounds)]
                more.append(pa.array(texts, pa.string()))
            names = block.rows.schema.names + [f.name for f in added]
            yield pa.RecordBatch.from_arrays([*block.rows.columns, *more], names)

    return kept.mapInArrow(encode, T.StructType([*kept.schema.fields, *added]))
