"""Exact ranked lexical search by ball trees over sparse document vectors.

A document is the vector of its terms' impacts, an item the vector of its terms' weights, and a score is their
inner product, in whole numbers. Only terms that some item holds can add to a score, so documents are projected
on those (fingerprints of the terms, 64 bits).

Each task cuts its documents into trees. A node is a ball around its documents' mean: no document of it scores above
``<q, c> + |q| r``. Bounds are computed in doubles and rounded up by more than all rounding on the way can amount
to; a subtree is passed over only if its bound is below the score to beat. Subtrees are taken best first, the
score to beat rises from tree to tree, and starts with what a sample of the documents reaches: the k-th best score
of any part of the table is a lower bound of the whole table's. So neither trees nor sample touch the result.

Items are dealt into blocks by a hash of their ids, of about ``BLOCK_TERMS`` terms and ``BLOCK_ITEMS`` items, and each block is
searched in all documents. What tasks are sent is one block. With several blocks the documents' terms are counted once
and stored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.llm import arrays
from tierworks.plans.workspace import scratch_path, settle

BLOCK_TERMS = 100_000
BLOCK_ITEMS = 2_000
#: Documents and entries (terms of documents) that a tree holds at the most; one longer document is a tree of its own.
TREE_DOCS = 1 << 14
TREE_ENTRIES = 1 << 21
LEAF_DOCS = 32
#: Documents from which the scores to beat are started.
SEED_DOCS = 4096
#: The best of each item are merged in so many parts first.
PARTS = 64

#: Bytes of terms: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, after A-Z are lower-cased.
IN_TERM = arrays.WORD_CHARS

VECTORS = "doc long, n long, terms binary, counts binary"
_ROUND = 2.0**-50


def _terms(block: arrays.Block) -> tuple[np.ndarray, np.ndarray]:
    """Number of terms in each text, and all terms' fingerprints in order."""
    low = arrays.LOWER[block.data]
    found = arrays.words(low, block.bounds, IN_TERM)
    return np.diff(found.first), arrays.span_hashes(low, found.starts, found.ends)


def _counted(text_of: np.ndarray, codes: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``bounds, codes, counts`` of the distinct codes of each text."""
    order = np.lexsort((codes, text_of))
    text_of, codes = text_of[order], codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = (text_of[1:] != text_of[:-1]) | (codes[1:] != codes[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(codes)))
    return np.searchsorted(text_of[at], np.arange(n_texts + 1)), codes[at], counts


def _cells(bounds: np.ndarray, values: np.ndarray, kind: str) -> pa.Array:
    data = np.ascontiguousarray(values, kind)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _known(codes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes are in the sorted vocabulary, and where."""
    if not len(vocabulary):
        return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
    at = np.searchsorted(vocabulary, codes)
    at[at == len(vocabulary)] = 0
    return vocabulary[at] == codes, at


def vectors(texts: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """``doc, n, terms, counts`` of ``doc, text``: term numbers (or, without vocabulary, fingerprints) and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, "text"):
            n, codes = _terms(block)
            text_of = np.repeat(np.arange(len(n)), n)
            if vocabulary is not None:
                known, at = _known(codes, vocabulary)
                text_of, codes = text_of[known], at[known]
            bounds, codes, counts = _counted(text_of, codes, len(n))
            columns = [block.rows.column(0), pa.array(n, pa.int64()), _cells(bounds, codes, "<u8" if vocabulary is None else "<u4"), _cells(bounds, counts, "<u4")]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "counts"])

    return texts.mapInArrow(count, VECTORS)


def projected(stored: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Vectors over all terms (fingerprints) cut down to those of a vocabulary (numbers)."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, codes = _joined(batch.column(2), "<u8")
            counts = _joined(batch.column(3), "<u4")[1]
            known, at = _known(codes, vocabulary)
            kept = np.concatenate(([0], np.cumsum(known)))[bounds]
            columns = [batch.column(0), batch.column(1), _cells(kept, at[known], "<u4"), _cells(kept, counts[known], "<u4")]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "counts"])

    return stored.mapInArrow(project, VECTORS)


def _joined(cells: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of binary cells behind each other, and their bounds."""
    values = cells.to_pylist()
    data = np.frombuffer(b"".join(values), kind)
    size = np.dtype(kind).itemsize
    return np.concatenate(([0], np.cumsum([len(v) // size for v in values], dtype=np.int64))), data


class Items(NamedTuple):
    """One block of items: the sorted vocabulary, and each item's terms as places in it."""

    numbers: np.ndarray
    vocabulary: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray


class Corpus(NamedTuple):
    n_docs: int  # with a term
    n_terms: int  # with repeats
    weights: np.ndarray  # by place in the vocabulary


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def impacts(n: np.ndarray, counts: np.ndarray, of: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Impact of each entry; ``n``: length of each document, ``of``: the entry's document."""
    longest = int(n.max()) if len(n) else 0
    kind = np.int64 if 90 * longest * corpus.n_docs < 1 << 62 else object
    m = (10 + 90 * n.astype(kind) * corpus.n_docs // max(1, corpus.n_terms)).astype(np.int64)
    counts = counts.astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 8 * m[of])


class Best:
    """The k best of each item so far, by falling score, rising id, NULL ids last."""

    def __init__(self, n_items: int, k: int, floors: np.ndarray) -> None:
        self.k, self.floors = k, floors
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(n_items)]

    def to_beat(self, item: int) -> int:
        """A document below this score is not among the best."""
        heap = self.heaps[item]
        own = heap[0][0] if len(heap) == self.k else 1
        return max(own, int(self.floors[item]))

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.to_beat(item))
        if len(at) > self.k:
            at = at[np.lexsort((ids[at], null[at], -scores[at]))[: self.k]]
        heap = self.heaps[item]
        for score, is_null, doc in zip(scores[at].tolist(), null[at].tolist(), ids[at].tolist(), strict=True):
            entry = (score, not is_null, -doc)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


class Node:
    __slots__ = ("center", "where", "radius", "left", "right", "low", "high", "bounds")


class Tree:
    """A ball tree over sparse rows (all with entries); rows of a leaf lie behind each other."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.columns, terms = np.unique(terms, return_inverse=True)
        self.order: list[np.ndarray] = []
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of each leaf
        self.dense = np.zeros(len(self.columns))
        self.nodes_seen = self.docs_scored = 0
        self.root = self._build(np.arange(len(ids)), bounds, terms, values)
        self.ids, self.null = ids, null

    def _build(self, rows: np.ndarray, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray) -> Node:
        node = Node()
        floats, starts = values.astype(np.float64), bounds[:-1]
        center = np.bincount(terms, floats, len(self.columns)) / len(rows)
        node.where = np.flatnonzero(center)
        node.center = center[node.where]
        squares = np.add.reduceat(floats * floats, starts)
        own = float(node.center @ node.center)
        apart = own + squares - 2 * np.add.reduceat(floats * center[terms], starts)
        error = (own + squares) * ((len(node.where) + 8) * _ROUND)
        node.radius = math.sqrt(float(np.maximum(apart + error, 0).max())) * (1 + _ROUND)
        node.left = node.right = node.bounds = None
        if len(rows) <= LEAF_DOCS:
            node.low = len(self.rows)
            self.rows.append((bounds, terms, values))
            self.order.append(rows)
            return node
        far = int(np.argmax(apart))
        to_far = self._dots(far, bounds, terms, floats)
        other = int(np.argmax(squares + squares[far] - 2 * to_far))
        to_other = self._dots(other, bounds, terms, floats)
        side = (squares[far] - 2 * to_far) - (squares[other] - 2 * to_other)
        half = len(rows) // 2
        cut = np.argpartition(side, half)
        for name, chosen in (("left", np.sort(cut[:half])), ("right", np.sort(cut[half:]))):
            setattr(node, name, self._build(rows[chosen], *_taken(chosen, bounds, terms, values)))
        return node

    def _dots(self, row: int, bounds: np.ndarray, terms: np.ndarray, floats: np.ndarray) -> np.ndarray:
        own = slice(bounds[row], bounds[row + 1])
        self.dense[terms[own]] = floats[own]
        out = np.add.reduceat(floats * self.dense[terms], bounds[:-1])
        self.dense[terms[own]] = 0
        return out

    def search(self, items: Items, weights: np.ndarray, best: Best) -> None:
        """Raise ``best`` by this tree's documents."""
        known, at = _known(items.terms, self.columns)
        held = np.concatenate(([0], np.cumsum(known)))[items.bounds]
        used = np.flatnonzero(np.diff(held))
        if not len(used):
            return
        terms, own = at[known], weights[items.terms[known]]
        starts = held[used]
        norms = np.sqrt(np.add.reduceat(own.astype(np.float64) ** 2, starts)) * (1 + len(self.columns) * _ROUND)
        slack = 1 + (len(self.columns) + 8) * _ROUND
        row = np.zeros(len(self.columns), np.int64)

        def bounds_of(node: Node) -> np.ndarray:
            if node.bounds is None:
                self.nodes_seen += 1
                self.dense[node.where] = node.center
                dots = np.add.reduceat(own * self.dense[terms], starts)
                self.dense[node.where] = 0
                node.bounds = (dots + norms * node.radius) * slack
            return node.bounds

        for k, item in enumerate(used.tolist()):
            mine = slice(held[item], held[item + 1])
            row[terms[mine]] = own[mine]
            queue = [(-bounds_of(self.root)[k], 0, self.root)]
            pushed = 1
            while queue and -queue[0][0] >= best.to_beat(item):
                node = heapq.heappop(queue)[2]
                if node.left is None:
                    leaf, rows = self.rows[node.low], self.order[node.low]
                    self.docs_scored += len(rows)
                    scores = np.add.reduceat(row[leaf[1]] * leaf[2], leaf[0][:-1])
                    best.add(item, scores, self.ids[rows], self.null[rows])
                    continue
                for child in (node.left, node.right):
                    heapq.heappush(queue, (-bounds_of(child)[k], pushed, child))
                    pushed += 1
            row[terms[mine]] = 0


def _taken(rows: np.ndarray, bounds: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Some rows of a sparse table."""
    sizes = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1]) + np.repeat(bounds[rows] - (ends - sizes), sizes)
    return np.concatenate(([0], ends)), *(c[at] for c in columns)


def _trees(batches: Iterator[pa.RecordBatch], corpus: Corpus) -> Iterator[Tree]:
    """Trees of bounded size over documents with entries."""
    held: list[tuple[np.ndarray, ...]] = []
    docs = entries = 0

    def made() -> Tree:
        sizes, *rest = (np.concatenate(parts) for parts in zip(*held, strict=True))
        return Tree(np.concatenate(([0], np.cumsum(sizes))), *rest)

    for batch in batches:
        bounds, terms = _joined(batch.column(2), "<u4")
        counts = _joined(batch.column(3), "<u4")[1]
        n = batch.column(1).to_numpy(zero_copy_only=False)
        ids = batch.column(0)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        sizes = np.diff(bounds)
        values = impacts(n, counts, np.repeat(np.arange(len(n)), sizes), corpus)
        low = 0
        while low < len(n):
            high = min(len(n), low + TREE_DOCS - docs, int(np.searchsorted(bounds, bounds[low] + TREE_ENTRIES - entries, "right")) - 1)
            if high <= low:
                if docs:
                    yield made()
                    held, docs, entries = [], 0, 0
                    continue
                high = low + 1
            some = slice(bounds[low], bounds[high])
            full = np.arange(low, high)[sizes[low:high] > 0]
            if len(full):
                held.append((sizes[full], terms[some].astype(np.int64), values[some], ids[full], null[full]))
                docs += len(full)
                entries += int(bounds[high] - bounds[low])
            low = high
    if held:
        yield made()


def best_of(df: DataFrame, items: Items, corpus: Corpus, floors: np.ndarray, k: int) -> DataFrame:
    """``number, doc, score`` of each task's best documents of the vectors ``df``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.numbers), k, floors)
        for tree in _trees(batches, corpus):
            tree.search(items, corpus.weights, best)
        rows = [(number, doc, not has_id, score) for number, heap in zip(items.numbers.tolist(), best.heaps) for score, has_id, doc in heap]
        if rows:
            number, doc, null, score = zip(*rows)
            columns = [pa.array(number, pa.int64()), pa.array([-d for d in doc], pa.int64(), mask=np.array(null)), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "doc", "score"])

    return df.mapInArrow(search, "number long, doc long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc"), F.lit(PARTS))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("number", "part").orderBy(*order)))
    return (
        some.filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order)))
        .filter(F.col("rank") <= k)
        .drop("part")
    )


def _item_terms(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(``item, number``: one row for each item; ``number, term``: its distinct terms)."""
    ids = settle(items.select(F.col(item_id).alias("item")).distinct().withColumn("number", F.monotonically_increasing_id()))
    texts = items.select(F.col(item_id).alias("of"), F.col(text).alias("text"))
    texts = texts.join(ids, F.col("of").eqNullSafe(F.col("item"))).select("number", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, "text"):
            n, codes = _terms(block)
            numbers = np.repeat(block.rows.column(0).to_numpy(zero_copy_only=False), n)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(codes.view(np.int64))], ["number", "term"])

    return ids, settle(texts.mapInArrow(hashed, "number long, term long").distinct())


def _block_count(terms: DataFrame) -> int:
    """How many blocks by hash keep each one within twice the bounds, a single larger item aside."""
    per_item = settle(terms.groupBy("number").agg(F.count(F.lit(1)).alias("n")))
    total = per_item.agg(F.sum("n").alias("terms"), F.count(F.lit(1)).alias("items")).first()
    blocks = max(1, math.ceil((total["terms"] or 0) / BLOCK_TERMS), math.ceil(total["items"] / BLOCK_ITEMS))
    while True:
        sizes = per_item.groupBy(_block(blocks).alias("block")).agg(F.sum("n").alias("terms"), F.count(F.lit(1)).alias("items"))
        over = (F.col("items") > 1) & ((F.col("terms") > 2 * BLOCK_TERMS) | (F.col("items") > 2 * BLOCK_ITEMS))
        # a single large item beside small ones cannot be dealt better by more blocks for ever
        if blocks > 64 * total["items"] + 64 or not sizes.filter(over).limit(1).count():
            return blocks
        blocks *= 2


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("number"), F.lit(blocks))


def _collected(terms: DataFrame) -> Items:
    rows = terms.toArrow()
    numbers, codes = rows["number"].to_numpy(), rows["term"].to_numpy().view(np.uint64)
    vocabulary, places = np.unique(codes, return_inverse=True)
    own, of = np.unique(numbers, return_inverse=True)
    order = np.lexsort((places, of))
    return Items(own, vocabulary, np.searchsorted(of[order], np.arange(len(own) + 1)), places[order])


def _holding(df: DataFrame, size: int) -> np.ndarray:
    """How many of the vectors hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(_joined(batch.column(0), "<u4")[1], minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["place", "n"])

    counted = df.select("terms").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[counted["place"].to_numpy()] = counted["n"].to_numpy()
    return out


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 10
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 for each item.

    Equal scores go by rising id, NULL ids last. NULL and empty texts have no terms; they are not counted and never
    found. Every row of ``docs`` is a document of its own, also if rows or ids repeat; rows of one item id (NULL is one, too) make one
    item that has the terms of them all. Texts of any length are read whole. Other columns are not read, and names that
    clash with those of this module do not matter. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ids, terms = _item_terms(items, item_id, item_text)
    blocks = _block_count(terms)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    stored = _stored(vectors(texts, None), "terms") if blocks > 1 else None
    found, corpus_size = None, None
    for number in range(blocks):
        block = _collected(terms.filter(_block(blocks) == number))
        if not len(block.numbers):
            continue
        rows = _stored(projected(stored, block.vocabulary) if blocks > 1 else vectors(texts, block.vocabulary), "vectors")
        if corpus_size is None:
            corpus_size = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_docs, n_terms = corpus_size
        holding = _holding(rows, len(block.vocabulary))
        corpus = Corpus(n_docs, n_terms, np.array([weight(n_docs, h) for h in holding.tolist()], np.int64))
        none = np.zeros(len(block.numbers), np.int64)
        floors = _floors(rows, block, corpus, n_docs, k, none)
        best = settle(best_of(rows, block, corpus, floors, k))
        found = best if found is None else found.unionAll(best)
    if found is None:
        found = spark.createDataFrame([], "number long, doc long, score long")
    return _ranked(found, k).join(ids, "number").select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def _floors(rows: DataFrame, block: Items, corpus: Corpus, n_docs: int, k: int, none: np.ndarray) -> np.ndarray:
    """Scores that ``k`` documents of a sample reach; 0 where there are fewer."""
    if n_docs <= SEED_DOCS:
        return none
    some = rows.filter(F.pmod(F.xxhash64("doc", "n"), F.lit(math.ceil(n_docs / SEED_DOCS))) == 0)
    ranked = _ranked(best_of(some, block, corpus, none, k), k).filter(F.col("rank") == k).select("number", "score").toArrow()
    out = none.copy()
    out[np.searchsorted(block.numbers, ranked["number"].to_numpy())] = ranked["score"].to_numpy()
    return out


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
