"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

Words are lower-cased runs of letters, digits and bytes above ASCII, known by their 64-bit fingerprints. A
window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window. The automaton reads
candidate stretches of a text (runs whose neighbouring words also stand next to each other in some item,
found with numpy) and tracks the longest match that ends at each word; matches of a window's length give the
hit words and, through the state's class, the items.

The items are read in blocks of at most ``BLOCK_WORDS`` words (or one longer item). Each block has an automaton of
its own, built in the workers from the block's word numbers, so what is sent is bounded however large the
benchmark is; with several blocks every text is read once for each, and lineage is cut in between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.llm import arrays
from tierworks.llm.arrays import U64
from tierworks.llm.carry import packed, unpacked
from tierworks.plans.workspace import settle

WINDOW = 13
MAX_COVERAGE_PERCENT = 5
BLOCK_WORDS = 200_000
#: Words of a text that are searched at once.
PIECE_WORDS = 1 << 18

HIT_TYPE = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[arrays.Words, np.ndarray]:
    low = arrays.LOWER[data]
    found = arrays.words(low, bounds, arrays.WORD_CHARS)
    return found, arrays.span_hashes(low, found.starts, found.ends)


class Automaton:
    """Suffix automaton of several word sequences (numbers), with the items of each window."""

    def __init__(self, items: list[tuple[str, list[int]]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, sequence in items:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.items: dict[tuple[int, int], set[str]] = {}
        self.sizes = sorted({min(WINDOW, len(s)) for _, s in items})
        for name, sequence in items:
            size = min(WINDOW, len(sequence))
            for at in range(len(sequence) - size + 1):
                state = 0
                for word in sequence[at : at + size]:
                    state = self.next[state][word]
                self.items.setdefault((state, size), set()).add(name)

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            to = self.next[last][word]
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return new

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: int, to: int) -> int:
        """The shorter strings of state ``to`` get a state of their own."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def hits(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """``first, last, items`` of each window that occurs in the words (numbers, -1: unknown)."""
        state = matched = 0
        for k, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            else:
                state = matched = 0
            at = state
            for size in reversed(self.sizes):
                if size > matched:
                    continue
                while self.length[self.link[at]] >= size:
                    at = self.link[at]
                found = self.items.get((at, size))
                if found:
                    yield k - size + 1, k, found


class Matcher:
    """One block of items, ready to search texts."""

    def __init__(self, names: list[str], lengths: np.ndarray, hashes: np.ndarray) -> None:
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        ends = np.cumsum(lengths)
        sequences = [(name, numbers[e - n : e].tolist()) for name, e, n in zip(names, ends, lengths, strict=True)]
        self.automaton = Automaton(sequences)
        inside = np.ones(len(numbers), bool)
        inside[ends - 1] = False  # no pair across items
        at = np.flatnonzero(inside)
        self.pairs = np.unique(numbers[at] * len(self.vocabulary) + numbers[at + 1]) if len(at) else np.zeros(0, np.int64)
        self.least = int(lengths.min()) if len(lengths) else WINDOW

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def stretches(self, numbers: np.ndarray, text_of: np.ndarray) -> list[tuple[int, int]]:
        """Runs (first, behind the last) of known words that pairwise stand side by side in some item."""
        known = numbers >= 0
        size = min(WINDOW, self.least)
        joined = np.zeros(max(0, len(numbers) - 1), bool)
        both = np.flatnonzero(known[:-1] & known[1:] & (text_of[:-1] == text_of[1:]))
        if len(both) and len(self.pairs):
            keys = numbers[both] * len(self.vocabulary) + numbers[both + 1]
            at = np.searchsorted(self.pairs, keys)
            at[at == len(self.pairs)] = 0
            joined[both] = self.pairs[at] == keys
        starts = np.flatnonzero(known & np.concatenate(([True], ~joined))) if len(numbers) else np.zeros(0, np.int64)
        ends = np.flatnonzero(known & np.concatenate((~joined, [True]))) + 1 if len(numbers) else starts
        long = ends - starts >= size
        return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))

    def search(self, hashes: np.ndarray, first: np.ndarray) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Hit word ranges (within the text) and items, by text."""
        ranges: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for low in range(0, len(hashes), PIECE_WORDS):
            begin = max(0, low - WINDOW + 1)  # windows across pieces
            piece = slice(begin, low + PIECE_WORDS)
            numbers = self.numbers(hashes[piece])
            for a, b in self.stretches(numbers, text_of[piece]):
                text = int(text_of[begin + a])
                for f, last, names in self.automaton.hits(numbers[a:b].tolist()):
                    at = begin + a - int(first[text])
                    own = ranges.setdefault(text, [])
                    if own and f + at <= own[-1][1] + 1 and f + at >= own[-1][0]:
                        own[-1] = (own[-1][0], max(own[-1][1], last + at))
                    else:
                        own.append((f + at, last + at))
                    items.setdefault(text, set()).update(names)
        return ranges, items


_MATCHERS: dict[str, Matcher] = {}


def matcher(names: list[str], lengths: np.ndarray, hashes: np.ndarray) -> Matcher:
    """One per worker and block; the last one is kept."""
    key = hashlib.blake2b(repr(names).encode() + lengths.tobytes() + hashes.tobytes()).hexdigest()
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(names, lengths, hashes)
    return _MATCHERS[key]


def item_blocks(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Names, word counts and word hashes of the items, in blocks; at most one block is on the driver at a time."""
    names, counts, hashes, total = [], [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    for name, value in rows.toLocalIterator():
        data = np.frombuffer(value.encode(), np.uint8)
        own = word_hashes(data, np.array([0, len(data)]))[1]
        if not len(own):
            continue
        if names and total + len(own) > most:
            yield names, np.array(counts), np.concatenate(hashes)
            names, counts, hashes, total = [], [], [], 0
        names.append(name)
        counts.append(len(own))
        hashes.append(own)
        total += len(own)
    if names:
        yield names, np.array(counts), np.concatenate(hashes)


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def find_items(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``df`` with ``n_words``, ``hits`` (disjoint ranges of hit words, counted from 0), ``item_ids`` (sorted as
    strings), ``n_hit``, ``contaminated`` and ``cut_text``.

    ``contaminated``: some word is hit, and hit words are at least ``MAX_COVERAGE_PERCENT`` of all. ``cut_text``
    is the text without the bytes from each range's first to its last word. NULL texts have no words
    (``cut_text`` NULL); items without words never occur, an item without id is named ''. Repeated rows are
    judged alike; columns of ``df`` with these names are replaced.
    """
    added = ["n_words", "hits", "item_ids", "n_hit", "contaminated", "cut_text"]
    out = df.select(*(c for c in df.columns if c not in added))
    done = 0
    for block in item_blocks(benchmark, item_id, item_text, block_words):
        if done:
            out = settle(out)
        out = _search(out, text, block)
        done += 1
    if not done:
        out = _search(out, text, ([], np.zeros(0, np.int64), np.zeros(0, U64)))
    return out.withColumn("n_hit", _hit_words()).withColumn("contaminated", _contaminated()).select(
        *(c for c in df.columns if c not in added), *added
    )


def _hit_words() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= MAX_COVERAGE_PERCENT * F.col("n_words"))


def _search(df: DataFrame, text: str, items: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", HIT_TYPE),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("cut_text", T.StringType()),
    ]
    names = [f.name for f in added]
    schema = T.StructType([f for f in df.schema.fields if f.name not in names] + added)
    pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher(*items)
        for block in arrays.blocks(batches, text):
            found, hashes = word_hashes(block.data, block.bounds)
            ranges, named = own.search(hashes, found.first)
            rows = block.rows
            before = dict(zip(rows.schema.names, rows.columns, strict=True))
            n = rows.num_rows
            earlier = [[(r["first"], r["last"]) for r in x] for x in before["hits"].to_pylist()] if "hits" in before else [[]] * n
            known = before["item_ids"].to_pylist() if "item_ids" in before else [[]] * n
            hits, ids = [], []
            cut = before[text].to_pylist() if "hits" in before or ranges else None
            for k in range(n):
                hits.append(united(earlier[k] + ranges.get(k, [])))
                ids.append(sorted({*known[k], *named.get(k, ())}))
                if hits[k]:
                    spans = [(int(found.starts[found.first[k] + f]), int(found.ends[found.first[k] + last])) for f, last in hits[k]]
                    cut[k] = _without(block.data, int(block.bounds[k]), int(block.bounds[k + 1]), spans)
            kept = [c for c in rows.schema.names if c not in names]
            columns = [before[c] for c in kept] + [
                pa.array(np.diff(found.first), pa.int64()),
                pa.array([[{"first": f, "last": last} for f, last in x] for x in hits], pair),
                pa.array(ids, pa.list_(pa.string())),
                before[text] if cut is None else pa.array(cut, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, kept + names)

    return df.mapInArrow(search, schema)


def _without(data: np.ndarray, low: int, high: int, spans: list[tuple[int, int]]) -> str:
    parts, at = [], low
    for a, b in spans:
        parts.append(data[at:a].tobytes())
        at = b
    return (b"".join(parts) + data[at:high].tobytes()).decode()


def decontaminate(df: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of ``df`` that are not contaminated, hit ranges cut out of the others' texts.

    Columns of ``df`` come back as they are, whatever they are called. Texts of any length are searched whole, in pieces.
    """
    text = names.pop("text", "text")
    found = find_items(packed(df, text), benchmark, **names)
    return found.filter(~F.col("contaminated")).select(*unpacked(df.columns, text, F.col("cut_text")))
