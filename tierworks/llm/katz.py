"""Katz backoff language model of order 2 with Good-Turing discounts, over packed partitioned tables.

Counting and lookup move packed columns: a *chunk* is a run of texts (about ``CHUNK_TOKENS`` tokens) with its own
sorted vocabulary and the places of its tokens in it; a *part* is a share of the words or word pairs. Each chunk asks
each part once for what it needs, in sorted order, and gets an answer in the same order:

1. chunks are written, bucketed by chunk, so that answers meet them without moving them;
2. words: parts add up training counts; known words are numbered by falling count, so that a word's count
   follows from its number (at most sqrt(2 x tokens) steps, which is what is broadcast);
3. pairs: parts add up training counts of (word before, word); a word before that is so frequent that it would fill
   parts on its own is split over several by the second word, and its sums are added up;
4. discounts come from counts of counts, backoff weights from each context's own pairs;
5. chunks score their texts.

The model, with counts c of training tokens (N in all, one end token for each text, which also stands before a
text's first word):

* P(w) = d(c) c / N for known words; what is left is the probability of the class of all unknown words;
* P(w | v) = d'(c(v w)) c(v w) / c(v) for seen pairs, a(v) P(w) for others; for an unknown v it is P(w);
* a(v) = (1 - sum of P(w | v) over seen w) / (1 - sum of P(w) over seen w), so each distribution sums to 1.

d and d' are Katz's Good-Turing discounts for counts up to ``DISCOUNTED``; where counts of counts give none between 0
and 1, (r - 0.5) / r is taken. A distribution whose discounts leave nothing over is scaled by its total
/ (total + 1). Word numbers have 32 bits; more known words are an error.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tierworks.llm import arrays
from tierworks.llm.arrays import U64
from tierworks.plans.workspace import scratch_path, settle

CHUNK_TOKENS = 1 << 20
#: Requests of about so many words or pairs meet in a part.
PART_KEYS = 1 << 20
DISCOUNTED = 5
BASE_ADDED = 0.1
END = np.uint64(1)  # stands for the end token among word fingerprints
UNKNOWN = np.uint32(0xFFFFFFFF)
U32 = np.uint32


def packed(values: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1) if len(values) else b""


def unpacked(cell: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not cell:
        return np.zeros(0, kind)
    planes = np.frombuffer(zlib.decompress(cell), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def steps(values: np.ndarray) -> bytes:
    """Ascending whole numbers by their differences."""
    return packed(np.diff(values, prepend=values[:0].sum(dtype=values.dtype)) if len(values) else values)


def summed(cell: bytes, kind) -> np.ndarray:
    return np.cumsum(unpacked(cell, kind), dtype=kind)


# --- 1. chunks -------------------------------------------------------------------------------------

CHUNK_SCHEMA = (
    "chunk long, keys binary, key_nulls binary, held binary, sizes binary, tokens binary, vocabulary binary, counts binary, n_words long, n_tokens long"
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_chunks(df: DataFrame, table: str, buckets: int) -> DataFrame:
    """``df`` (``key, text, held``) as chunk rows in a table bucketed by chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        kept: list[tuple] = []
        held_tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal kept, held_tokens, number
            keys, nulls, held, sizes, tokens = (np.concatenate(x) for x in zip(*kept, strict=True))
            vocabulary, places = np.unique(tokens, return_inverse=True)
            training = np.repeat(~held, sizes)
            counts = np.bincount(places[training], minlength=len(vocabulary))
            row = {
                "chunk": TaskContext.get().partitionId() * (1 << 24) + number,
                "keys": packed(keys), "key_nulls": packed(nulls), "held": packed(held), "sizes": packed(sizes.astype(U32)),
                "tokens": packed(places.astype(U32)), "vocabulary": steps(vocabulary), "counts": packed(counts.astype(U32)),
                "n_words": len(vocabulary), "n_tokens": len(tokens),
            }
            number, kept, held_tokens = number + 1, [], 0
            return _batch(row)

        for block in arrays.blocks(batches):
            low = arrays.LOWER[block.data]
            found = arrays.words(low, block.bounds, arrays.NOT_SPACE)
            hashes = arrays.span_hashes(low, found.starts, found.ends)
            hashes[hashes == END] = END + U64(1)
            tokens = np.insert(hashes, found.first[1:], END)
            keys, held = block.rows.column(0), block.rows.column(2)
            kept.append((
                keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), keys.is_null().to_numpy(zero_copy_only=False),
                held.to_numpy(zero_copy_only=False).astype(bool), np.diff(found.first) + 1, tokens,
            ))
            held_tokens += len(tokens)
            if held_tokens >= CHUNK_TOKENS:
                yield flush()
        if kept:
            yield flush()

    rows = df.select(F.col("key").cast("long"), F.coalesce("text", F.lit("")).alias("text"), "held")
    rows.mapInArrow(work, CHUNK_SCHEMA).write.bucketBy(buckets, "chunk").format("parquet").option(
        "path", scratch_path(df.sparkSession, "chunks")
    ).saveAsTable(table)
    return df.sparkSession.table(table)


def _batch(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for k, v in row.items()})


def _parts_for(keys: int) -> int:
    """A power of two."""
    return 1 << max(0, int(np.ceil(np.log2(max(1, keys) / PART_KEYS))))


# --- 2. words --------------------------------------------------------------------------------------


def word_parts(chunks: DataFrame, parts: int) -> DataFrame:
    """One row for each part: known words' training counts, and for each chunk the places of its words among them."""
    shift = U64(64 - parts.bit_length() + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, counts = summed(row["vocabulary"], U64), unpacked(row["counts"], U32)
            part = (words >> shift).astype(np.int64) if parts > 1 else np.zeros(len(words), np.int64)
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(words)], strict=True):
                yield _batch({"part": int(part[a]), "chunk": row["chunk"], "words": steps(words[a:b]), "counts": packed(counts[a:b])})

    def add(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        words, counts = [summed(r["words"], U64) for r in rows], [unpacked(r["counts"], U32) for r in rows]
        known, places = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, places, np.concatenate(counts))
        number = np.where(total > 0, np.cumsum(total > 0), 0)[places].astype(U32)  # 0: never in training
        ends = np.cumsum([len(w) for w in words])
        own = [packed(number[e - len(w) : e]) for w, e in zip(words, ends, strict=True)]
        return pa.Table.from_pydict({
            "part": pa.array([rows[0]["part"]], pa.int64()), "counts": pa.array([packed(total[total > 0])], pa.binary()),
            "chunks": pa.array([[r["chunk"] for r in rows]], pa.list_(pa.int64())), "places": pa.array([own], pa.list_(pa.binary())),
        })

    asked = chunks.select("chunk", "vocabulary", "counts").mapInArrow(ask, "part long, chunk long, words binary, counts binary")
    return _stored(asked.groupBy("part").applyInArrow(add, "part long, counts binary, chunks array<long>, places array<binary>"), "words")


def word_numbers(words: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Answers ``chunk, part, numbers`` and the counts by number: ``count[k]`` holds for numbers below ``upto[k]``."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            counts, n = np.unique(unpacked(row["counts"], np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), row["part"])), pa.array(counts), pa.array(n)], ["part", "count", "n"])

    tallies = settle(words.select("part", "counts").mapInArrow(tally, "part long, count long, n long"))
    totals = tallies.groupBy("count").agg(F.sum("n").alias("n")).orderBy(F.desc("count")).toPandas()
    upto = np.cumsum(totals["n"].to_numpy(np.int64)) if len(totals) else np.zeros(0, np.int64)
    if len(upto) and upto[-1] >= int(UNKNOWN):
        raise ValueError("more known words than 32-bit numbers")
    counts = totals["count"].to_numpy(np.int64)
    first = dict(zip(counts.tolist(), (upto - totals["n"].to_numpy(np.int64)).tolist(), strict=True)) if len(upto) else {}
    shared = words.sparkSession.sparkContext.broadcast(first)
    before = Window.partitionBy("count").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tallies.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .groupBy("part")
        .agg(F.collect_list(F.struct("count", "before")).alias("offsets"))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = unpacked(row["counts"], np.int64)
            start = {x["count"]: x["before"] + shared.value[x["count"]] for x in row["offsets"] or []}
            order = np.argsort(own, kind="stable")
            distinct, begin, n = np.unique(own[order], return_index=True, return_counts=True)
            numbers = np.empty(len(own), np.int64)
            numbers[order] = np.repeat([start[c] for c in distinct.tolist()], n) + np.arange(len(own)) - np.repeat(begin, n)
            table = np.append(UNKNOWN, numbers.astype(U32))
            for chunk, cell in zip(row["chunks"], row["places"], strict=True):
                yield _batch({"chunk": chunk, "part": row["part"], "numbers": packed(table[unpacked(cell, U32)])})

    answers = words.join(offsets, "part", "left").mapInArrow(answer, "chunk long, part long, numbers binary")
    return _stored(answers, "numbers"), counts, upto


def _by_chunk(answers: DataFrame, buckets: int, name: str, *columns: str) -> DataFrame:
    """A chunk's answers in one row, dealt out as the chunks are."""
    return answers.repartition(buckets, "chunk").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", *columns))).alias(name))


# --- 3. pairs --------------------------------------------------------------------------------------


class Ranks(NamedTuple):
    """Counts of words by number."""

    counts: np.ndarray
    upto: np.ndarray

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """Training counts; 0 for unknown words."""
        at = np.searchsorted(self.upto, numbers, "right")
        return np.append(self.counts, 0)[np.minimum(at, len(self.counts))]


def chunk_pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and held-out marks of the texts, their tokens' numbers, and the numbers of the tokens before."""
    numbers = np.concatenate([unpacked(x["numbers"], U32) for x in row["answers"]])
    tokens = numbers[unpacked(row["tokens"], U32)]
    sizes = unpacked(row["sizes"], U32).astype(np.int64)
    end = numbers[np.searchsorted(summed(row["vocabulary"], U64), END)]
    before = np.concatenate(([end], tokens[:-1])) if len(tokens) else tokens
    before[np.cumsum(sizes)[:-1]] = end
    return sizes, unpacked(row["held"], bool), tokens, before


def known_pairs(tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which tokens stand behind a known one, their distinct pairs as 64-bit keys, and each one's place among them.

    The second word may be the class of unknown words, which training never sees but whose weight the chunk needs.
    """
    known = before != UNKNOWN
    keys = (before[known].astype(U64) << U64(32)) | tokens[known]
    pairs, places = np.unique(keys, return_inverse=True)
    return known, pairs, places


def part_of(pairs: np.ndarray, ranks: Ranks, parts: int, share: int) -> np.ndarray:
    """The context's part; contexts of more than ``share`` tokens are split by the second word."""
    first = pairs >> U64(32)
    split = (-(-ranks.count(first) // share)).astype(U64)
    second = arrays.mix((pairs & U64(0xFFFFFFFF)) + U64(7)) % np.maximum(split, U64(1))
    return (arrays.mix(first + U64(3) + second * U64(arrays.BASE)) % U64(parts)).astype(np.int64)


def pair_parts(placed: DataFrame, ranks: Ranks, parts: int, share: int) -> DataFrame:
    """One row for each part: its pairs with training counts, and for each chunk the places of its pairs among them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, held, tokens, before = chunk_pairs(row)
            known, pairs, places = known_pairs(tokens, before)
            training = np.repeat(~held, sizes)[known]
            counts = np.bincount(places[training], minlength=len(pairs)).astype(U32)
            part = part_of(pairs, ranks, parts, share)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[p] : edges[p + 1]]
                yield _batch({"part": p, "chunk": row["chunk"], "pairs": steps(pairs[own]), "counts": packed(counts[own])})

    def add(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        pairs, counts = [summed(r["pairs"], U64) for r in rows], [unpacked(r["counts"], U32) for r in rows]
        known, places = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, places, np.concatenate(counts))
        ends = np.cumsum([len(x) for x in pairs])
        own = [steps(places[e - len(x) : e].astype(U32)) for x, e in zip(pairs, ends, strict=True)]
        return pa.Table.from_pydict({
            "part": pa.array([rows[0]["part"]], pa.int64()), "pairs": pa.array([steps(known)], pa.binary()), "counts": pa.array([packed(total)], pa.binary()),
            "chunks": pa.array([[r["chunk"] for r in rows]], pa.list_(pa.int64())), "places": pa.array([own], pa.list_(pa.binary())),
        })

    asked = placed.mapInArrow(ask, "part long, chunk long, pairs binary, counts binary")
    added = asked.groupBy("part").applyInArrow(add, "part long, pairs binary, counts binary, chunks array<long>, places array<binary>")
    return _stored(added, "pairs")


# --- 4. the model ----------------------------------------------------------------------------------


def discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """Katz's discount for each count up to ``DISCOUNTED`` (at 0: 1)."""
    n = [counts_of_counts.get(r, 0) for r in range(DISCOUNTED + 2)]
    out = np.ones(DISCOUNTED + 1)
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d = (turing - common) / (1 - common) if common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def discounted(counts: np.ndarray, by: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, by[np.minimum(counts, DISCOUNTED)], 1.0)


class Unigrams(NamedTuple):
    """Probability of each count's words, and of the class of unknown words (last)."""

    ranks: Ranks
    chance: np.ndarray

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self.chance[np.minimum(np.searchsorted(self.ranks.upto, numbers, "right"), len(self.ranks.counts))]


def unigrams(ranks: Ranks) -> Unigrams:
    sizes = np.diff(ranks.upto, prepend=0)
    total = float((ranks.counts * sizes).sum())
    if not total:
        return Unigrams(ranks, np.ones(1))
    own = discounted(ranks.counts, discounts(dict(zip(ranks.counts.tolist(), sizes.tolist(), strict=True)))) / total
    left = 1 - float((own * sizes).sum())
    if left <= 1e-12:
        own, left = own * total / (total + 1), 1 / (total + 1)
    return Unigrams(ranks, np.append(own, left))


def pair_discounts(pairs: DataFrame) -> np.ndarray:
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = np.bincount(np.minimum(unpacked(row["counts"], np.int64), DISCOUNTED + 2), minlength=DISCOUNTED + 3)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["r", "n"])

    found = pairs.select("counts").mapInArrow(tally, "r long, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    return discounts({x["r"]: x["n"] for x in found if 0 < x["r"] <= DISCOUNTED + 1})


def context_sums(pairs: np.ndarray, counts: np.ndarray, by: np.ndarray, words: Unigrams) -> tuple[np.ndarray, ...]:
    """Contexts with the sums over their seen pairs: discounted counts, and the second words' own probability."""
    seen = counts > 0
    pairs, counts = pairs[seen], counts[seen]
    contexts, places = np.unique(pairs >> U64(32), return_inverse=True)
    own = np.bincount(places, discounted(counts, by), len(contexts))
    lower = np.bincount(places, words.of(pairs & U64(0xFFFFFFFF)), len(contexts))
    return contexts, own, lower


def split_sums(pairs: DataFrame, words: Unigrams, by: np.ndarray, share: int) -> dict[int, tuple[float, float]]:
    """The sums of contexts that are split over parts; there are at most tokens / ``share`` of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums = context_sums(summed(row["pairs"], U64), unpacked(row["counts"], np.int64), by, words)
            split = words.ranks.count(sums[0]) > share
            yield pa.RecordBatch.from_arrays([pa.array(x[split].astype(t)) for x, t in zip(sums, (np.int64, float, float), strict=True)], ["v", "own", "lower"])

    rows = pairs.select("pairs", "counts").mapInArrow(work, "v long, own double, lower double")
    found = rows.groupBy("v").agg(F.sum("own").alias("own"), F.sum("lower").alias("lower")).collect()
    return {x["v"]: (x["own"], x["lower"]) for x in found}


def weights(own: np.ndarray, lower: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weights of contexts with ``total`` tokens, and whether one more than that divides their counts."""
    full = own >= total * (1 - 1e-12)
    return (1 - own / (total + full)) / np.maximum(1 - lower, 1e-300), full


def answers_of(pairs: DataFrame, words: Unigrams, by: np.ndarray, split: dict[int, tuple[float, float]]) -> DataFrame:
    """``chunk, part, counts, backoffs, full``: training counts of the chunk's pairs; of its contexts log10 a(v), and
    whether one more than their count divides.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(split)
    split_heads = np.array(sorted(split), U64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, counts = summed(row["pairs"], U64), unpacked(row["counts"], np.int64)
            contexts, own, lower = context_sums(keys, counts, by, words)
            # A split context may have unseen pairs only in this part; its sums are known all the same.
            heads = np.unique(keys >> U64(32))
            at = np.searchsorted(contexts, heads)
            sums = np.zeros((2, len(heads)))
            inside = np.flatnonzero(np.append(contexts, U64(0))[at] == heads) if len(contexts) else at[:0]
            inside = inside[at[inside] < len(contexts)]
            sums[:, inside] = own[at[inside]], lower[at[inside]]
            for k in np.flatnonzero(np.isin(heads, split_heads)):
                sums[:, k] = shared.value[int(heads[k])]
            weight, full = weights(*sums, words.ranks.count(heads))
            logs = np.log10(weight)
            of_key = np.searchsorted(heads, keys >> U64(32))
            for chunk, cell in zip(row["chunks"], row["places"], strict=True):
                asked = summed(cell, U32)
                of_asked = of_key[asked]
                fresh = of_asked[np.flatnonzero(np.diff(of_asked, prepend=-1))]
                yield _batch({"chunk": chunk, "part": row["part"], "counts": packed(counts[asked].astype(U32)), "backoffs": packed(logs[fresh]), "full": packed(full[fresh])})

    answered = pairs.mapInArrow(work, "chunk long, part long, counts binary, backoffs binary, full binary")
    return _stored(answered, "answers")


# --- 5. scores -------------------------------------------------------------------------------------


def scores(placed: DataFrame, answers: DataFrame, words: Unigrams, by: np.ndarray, parts: int, share: int, buckets: int) -> DataFrame:
    known_words = int(words.ranks.upto[-1]) if len(words.ranks.upto) else 0
    sizes_by_count = np.diff(words.ranks.upto, prepend=0)
    train = int((words.ranks.counts * sizes_by_count).sum())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, held, tokens, before = chunk_pairs(row)
            counts = words.ranks.count(tokens)
            base = np.log10((counts + BASE_ADDED) / (train + BASE_ADDED * (known_words + 1)))
            value = np.log10(words.of(tokens))
            known, pairs, places = known_pairs(tokens, before)
            if len(pairs):
                part = part_of(pairs, words.ranks, parts, share)
                order = np.argsort(part, kind="stable")
                heads = pairs[order] >> U64(32)
                fresh = (np.diff(heads.astype(np.int64), prepend=-1) != 0) | (np.diff(part[order], prepend=-1) != 0)
                of_context = np.cumsum(fresh) - 1
                n, backoff, full = (
                    np.concatenate([unpacked(x[c], kind) for x in row["found"]])
                    for c, kind in (("counts", U32), ("backoffs", float), ("full", bool))
                )
                n = n.astype(np.int64)
                seen = n > 0
                chance = np.log10(np.where(seen, discounted(n, by), 1) / (words.ranks.count(heads) + full[of_context]))
                direct, back = np.empty(len(pairs)), np.empty(len(pairs))
                direct[order] = np.where(seen, chance, np.nan)
                back[order] = backoff[of_context]
                value[known] = np.where(np.isnan(direct[places]), back[places] + value[known], direct[places])
            ends = np.cumsum(sizes)
            per_text = [np.add.reduceat(x, ends - sizes) for x in (base, value, counts > 0)]
            nulls = unpacked(row["key_nulls"], bool)
            columns = [
                pa.array(unpacked(row["keys"], np.int64), mask=nulls), pa.array(held), pa.array(sizes), pa.array(per_text[2].astype(np.int64)),
                pa.array(np.full(len(sizes), train)), pa.array(per_text[0]), pa.array(per_text[1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    found = placed.join(_by_chunk(answers, buckets, "found", "counts", "backoffs", "full"), "chunk", "left")
    return found.mapInArrow(work, "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(df: DataFrame, key: str, text: str, held: str) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    Learned from the rows whose boolean ``held`` is false. Tokens are lower-cased words between white space and one
    end token; NULL texts are empty (the end token only), a NULL in ``held`` counts as false. ``n_known``: tokens
    that training has; ``base_score``: unigrams with ``BASE_ADDED`` added to each count. No training text: every
    token is unknown. Repeated rows are all counted and scored. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(held), F.lit(False)).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (6 * CHUNK_TOKENS)))
    table = f"katz_{uuid.uuid4().hex}"
    try:
        chunks = write_chunks(rows, table, buckets)
        n_words, n_tokens = (x or 0 for x in chunks.agg(F.sum("n_words"), F.sum("n_tokens")).first())
        answers, counts, upto = word_numbers(word_parts(chunks, _parts_for(n_words)))
        words = unigrams(Ranks(counts, upto))
        placed = chunks.join(_by_chunk(answers, buckets, "answers", "numbers"), "chunk")
        parts = _parts_for(n_tokens)
        share = max(1, n_tokens // (4 * parts))
        needed = placed.select("chunk", "sizes", "held", "tokens", "vocabulary", "answers")
        pairs = pair_parts(needed, words.ranks, parts, share)
        by = pair_discounts(pairs)
        found = answers_of(pairs, words, by, split_sums(pairs, words, by, share))
        return settle(scores(placed, found, words, by, parts, share, buckets))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
