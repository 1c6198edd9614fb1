"""Quality and toxicity from weak labels: EM over heuristic labellers, then a hashed linear scorer.

Each head (``quality``, ``toxic``) has labellers that vote bad (1), good (-1) or abstain (0) on whole texts: rules on
statistics, lists of insulting words, lists of words and word stems that stand in labelled toxic texts and hardly
elsewhere, and the given labels themselves, as one more labeller that may err and that abstains where there is no
label. Spark counts the vote patterns over all documents (at most 3 ^ labellers of them);
expectation-maximisation on the counts gives each labeller's accuracy and every pattern's posterior. A logistic
scorer over hashed words, word stems and bucketed statistics is fitted to the posteriors of at most
``SAMPLE_ROWS`` documents (labelled ones first, then by hash) and scores every document. The stem lists are
drawn from the same sample: that is the documented bound of the fit. Each head's threshold is the one that
errs least on the sample's labelled rows; without labels it is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.llm import arrays, quality_rules
from tierworks.llm.arrays import U64
from tierworks.plans.workspace import settle

SAMPLE_ROWS = 4_000
#: A stem is listed when it stands in so many toxic texts of the sample, once or twice each, and nearly only there; bytes of the stems.
STEM_TEXTS, STEM_PRECISION, STEM_LIST = 6, 0.9, 2_000
STEMS = (4, 6, 1 << 20)
HASH_BITS = 16
BUCKETS = 12
ROUNDS, STEPS, RATE, DECAY = 200, 150, 0.05, 1e-4

# Words that insult, in two lists that the labellers read apart and together.
INSULTS = ("idiot", "moron", "stupid", "dumb", "imbecile", "fool", "loser", "clown")
SLURS = ("scum", "trash", "garbage", "worthless", "pathetic", "disgusting", "vermin", "filth")

SIGNALS = ("n_insults", "n_slurs", "n_stems4", "n_stems6", "n_listed", "n_tokens")
Lists = tuple[np.ndarray, ...]


class Head(NamedTuple):
    """What one head has learned."""

    accuracies: dict[str, float]
    posteriors: dict[tuple[int, ...], float]
    weights: np.ndarray
    threshold: float


def flag(bad: Column) -> Column:
    """Bad, or no opinion: a text may be fine by one rule and bad by another."""
    return F.when(bad, 1).otherwise(0)


def said(label: str) -> Column:
    return F.when(F.col(label) > 0, 1).when(F.col(label) == 0, -1).otherwise(0)


def labellers() -> dict[str, dict[str, Column]]:
    f = quality_rules.features()
    ratio = F.col("n_tokens") / F.greatest(F.col("n_words"), F.lit(1))
    insults = F.col("n_insults") + F.col("n_slurs")
    return {
        "quality": {
            "length": flag(f["n_words"] < 10),
            "symbols": flag(f["symbols_per_word"] > 0.2),
            "upper": flag(f["upper_per_char"] > 0.3),
            "bangs": flag(f["bangs_per_word"] > 0.3),
            "repeats": flag(f["repeated_words"] > 0.2),
            "lines": flag(f["repeated_lines"] > 0.3),
            "variety": flag(f["distinct_words"] < 0.2),
            "words": flag((ratio < 0.75) | (f["mean_word_chars"] > 15)),
            "label": said("label_bad"),
        },
        "toxic": {
            "insults": flag(F.col("n_insults") > 0),
            "slurs": flag(F.col("n_slurs") > 0),
            "any": flag(insults > 1),
            "stems4": flag(F.col("n_stems4") > 1),
            "stems6": flag(F.col("n_stems6") > 1),
            "listed": flag(F.col("n_listed") > 0),
            "label": said("label_toxic"),
        },
    }


# --- signals and features of texts -------------------------------------------------------------


def _hashes(block: arrays.Block) -> tuple[list[np.ndarray], np.ndarray]:
    """Fingerprints of each word's stems (of ``STEMS`` bytes; the last is the word), and texts' first words."""
    low = arrays.LOWER[block.data]
    found = arrays.words(low, block.bounds, arrays.WORD_CHARS)
    return [arrays.span_hashes(low, found.starts, np.minimum(found.ends, found.starts + k)) for k in STEMS], found.first


def _word_set(words: tuple[str, ...]) -> np.ndarray:
    joined = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(arrays.span_hashes(joined, ends - [len(w) for w in words], ends))


def listed_stems(labelled: DataFrame) -> Lists:
    """For each of ``STEMS`` the sorted fingerprints that stand in toxic texts of ``labelled`` (``text, label_toxic``) and
    hardly in others, and after them those of which this holds for texts with two such words."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches):
            hashes, first = _hashes(block)
            text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
            toxic = block.rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, own in enumerate(hashes):
                order = np.lexsort((own, text_of))
                stem, text = own[order], text_of[order]
                fresh = np.flatnonzero(np.append(True, (stem[1:] != stem[:-1]) | (text[1:] != text[:-1]))[: len(stem)])
                times = np.diff(np.append(fresh, len(stem)))
                columns = [np.full(len(fresh), k), stem[fresh].view(np.int64), toxic[text[fresh]], times]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "stem", "toxic", "times"])

    rows = labelled.select("text", F.col("label_toxic").cast("long")).mapInArrow(spread, "k long, stem long, toxic long, times long")
    out = []
    for least in (1, 2):
        sure = (
            rows.filter(F.col("times") >= least)
            .groupBy("k", "stem")
            .agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
            .filter((F.col("bad") >= STEM_TEXTS) & (F.col("bad") >= STEM_PRECISION * F.col("all")))
        )
        for k in range(len(STEMS)):
            best = sure.filter(F.col("k") == k).orderBy(F.desc("bad"), "stem").limit(STEM_LIST).select("stem")
            out.append(np.sort(np.array([r[0] for r in best.collect()], np.int64).view(U64)))
    return tuple(out)


def with_signals(df: DataFrame, lists: Lists, text: str = "text") -> DataFrame:
    """``df`` with the statistics of ``quality_rules`` and counts of listed words; replaced where they exist."""
    added = [T.StructField(c, T.LongType()) for c in (*quality_rules.STATISTICS, *quality_rules.MORE_STATISTICS, *SIGNALS)]
    kept = df.select(*(c for c in df.columns if c not in {f.name for f in added}))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = _word_set(INSULTS), _word_set(SLURS)
        for block in arrays.blocks(batches, text):
            found = quality_rules.block_statistics(block) | block_signals(block, fixed, lists)
            more = [pa.array(np.asarray(found[f.name], np.int64)) for f in added]
            yield pa.RecordBatch.from_arrays([*block.rows.columns, *more], block.rows.schema.names + [f.name for f in added])

    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, *added]))


def block_signals(block: arrays.Block, fixed: Lists, lists: Lists) -> dict[str, np.ndarray]:
    hashes, first = _hashes(block)

    def count(words: np.ndarray, own: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(len(first) - 1, np.int64)
        at = np.minimum(np.searchsorted(words, own), len(words) - 1)
        return np.diff(np.concatenate(([0], np.cumsum(words[at] == own)))[first])

    once, twice = (np.stack([count(w, h) for w, h in zip(x, hashes, strict=True)]) for x in (lists[: len(STEMS)], lists[len(STEMS) :]))
    stems = {"n_stems4": twice[0], "n_stems6": twice[1], "n_listed": once.max(axis=0)}
    return {"n_insults": count(fixed[0], hashes[-1]), "n_slurs": count(fixed[1], hashes[-1]), "n_tokens": np.diff(first)} | stems


def block_features(block: arrays.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of each feature a text has: words and stems it holds, those it holds twice or more,
    and its statistics' buckets."""
    n = len(block.bounds) - 1
    hashes, first = _hashes(block)
    text_of = np.repeat(np.arange(n), np.diff(first)).astype(U64)
    keys = [(text_of << U64(HASH_BITS)) | (arrays.mix(h + U64(k)) >> U64(64 - HASH_BITS)) for k, h in enumerate(hashes)]
    cells, times = np.unique(np.concatenate(keys), return_counts=True)
    cells = np.concatenate((cells, cells[times > 1] ^ U64((1 << HASH_BITS) - 1)))
    rows, cols = (cells >> U64(HASH_BITS)).astype(np.int64), (cells & U64((1 << HASH_BITS) - 1)).astype(np.int64)
    per_text = np.maximum(np.bincount(rows, minlength=n), 1)
    found = quality_rules.block_statistics(block)
    words = np.maximum(found["n_words"], 1)
    shares = (
        found["n_symbols"] / words, found["n_upper"] / np.maximum(found["word_chars"], 1), found["n_bangs"] / words,
        found["n_repeat_words"] / words, found["n_dup_lines"] / np.maximum(found["n_lines"], 1), found["n_distinct_words"] / words,
    )
    buckets = [np.minimum((s * BUCKETS).astype(np.int64), BUCKETS - 1) + k * BUCKETS for k, s in enumerate(shares)]
    size = np.minimum(np.log2(words).astype(np.int64), BUCKETS - 1) + len(shares) * BUCKETS
    extra = (1 << HASH_BITS) + np.stack([*buckets, size], axis=1)
    return (
        np.concatenate((rows, np.repeat(np.arange(n), extra.shape[1]))),
        np.concatenate((cols, extra.ravel())),
        np.concatenate((1 / np.sqrt(per_text[rows]), np.ones(extra.size))),
    )


N_FEATURES = (1 << HASH_BITS) + 7 * BUCKETS


# --- the label model ------------------------------------------------------------------------------


def label_model(names: list[str], counts: dict[tuple[int, ...], int]) -> tuple[dict[str, float], dict[tuple[int, ...], float]]:
    """Accuracies and posteriors (of being bad) from vote patterns, by EM that starts from the sum of the votes."""
    if not counts:
        return {}, {}
    patterns = np.array(list(counts))
    weight = np.array(list(counts.values()), float)
    votes = patterns.sum(axis=1)
    bad = np.where(votes > 0, 0.9, np.where(votes < 0, 0.02, 0.05))
    for _ in range(ROUNDS):
        prior = (weight * bad).sum() / weight.sum()
        log = np.log(np.array([1 - prior, prior]))[None, :].repeat(len(patterns), 0)
        for j in range(len(names)):
            for value in (-1, 0, 1):
                here = patterns[:, j] == value
                for y, p in ((0, 1 - bad), (1, bad)):
                    log[here, y] += np.log(((weight * p)[here].sum() + 1) / ((weight * p).sum() + 3))
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - bad).max() < 1e-7:
            break
        bad = np.clip(new, 1e-6, 1 - 1e-6)
    accuracies = {}
    for j, name in enumerate(names):
        right = (weight * np.where(patterns[:, j] == 1, bad, np.where(patterns[:, j] == -1, 1 - bad, 0))).sum()
        accuracies[name] = float(right / max(1, weight[patterns[:, j] != 0].sum()))
    return accuracies, dict(zip(counts, bad.tolist(), strict=True))


# --- the scorer -----------------------------------------------------------------------------------


def fit_scorer(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer with soft targets (the last one is the bias), by Adam over all rows."""
    weights = np.zeros(N_FEATURES + 1)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    n = len(target)
    for step in range(1, STEPS + 1):
        margin = np.bincount(rows, values * weights[cols], n) + weights[-1]
        error = (1 / (1 + np.exp(-margin)) - target) / max(n, 1)
        slope = np.append(np.bincount(cols, values * error[rows], N_FEATURES), error.sum()) + DECAY / max(n, 1) * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return weights


def best_threshold(score: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the fewest errors, half way between neighbours; 0.5 where labels say nothing."""
    if not len(bad) or bad.all() or not bad.any():
        return 0.5
    order = np.argsort(-score, kind="stable")
    sorted_score, hit = score[order], np.cumsum(bad[order])
    errors = np.arange(1, len(bad) + 1) - hit + bad.sum() - hit
    errors[:-1][sorted_score[:-1] == sorted_score[1:]] = len(bad) + 1  # equal scores stay together
    k = int(np.argmin(errors))
    following = sorted_score[k + 1] if k + 1 < len(bad) else 0.0
    return float((sorted_score[k] + following) / 2)


def fit(df: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> dict[str, Head]:
    """Both heads from ``df`` (all of it is counted) and, for thresholds, ``labels`` (``doc_id, quality, toxic``)."""
    voted = labellers()
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    given = labels if labels is not None else df.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    marks = settle(
        given.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.col("quality") == 0).cast("int")).alias("label_bad"), F.max("toxic").alias("label_toxic"))
    )
    few = F.broadcast(marks.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))  # the documented bound of the fit
    labelled = docs.join(few, "id").orderBy(F.xxhash64("id", "text")).limit(SAMPLE_ROWS)
    sample = settle(labelled)
    missing = SAMPLE_ROWS - sample.count()
    if missing:
        others = docs.join(few, "id", "left_anti").orderBy(F.xxhash64("id", "text")).limit(missing)
        sample = settle(sample.unionByName(others, allowMissingColumns=True))
    lists = listed_stems(sample.filter("label_toxic IS NOT NULL"))

    def votes(rows: DataFrame) -> DataFrame:
        return rows.select("*", *(F.array(*own.values()).alias(head) for head, own in voted.items()))

    measured = with_signals(docs, lists).drop("text").join(marks, "id", "left")
    patterns = settle(votes(measured).groupBy(*voted).count())
    own_votes = votes(with_signals(sample, lists)).toPandas()
    rows, cols, values = _features_of(own_votes["text"].tolist())
    heads = {}
    for head, label in (("quality", "label_bad"), ("toxic", "label_toxic")):
        counted = {tuple(r[head]): r["n"] for r in patterns.groupBy(head).agg(F.sum("count").alias("n")).collect()}
        accuracies, posteriors = label_model(list(voted[head]), counted)
        target = np.array([posteriors[tuple(p)] for p in own_votes[head]])
        weights = fit_scorer(rows, cols, values, target)
        score = _sigmoid(np.bincount(rows, values * weights[cols], len(target)) + weights[-1])
        has = own_votes[label].notna().to_numpy(bool)
        heads[head] = Head(accuracies, posteriors, weights, best_threshold(score[has], (own_votes[label] == 1).to_numpy(bool)[has]))
    return heads


def _features_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, at = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))], 0
    for block in arrays.blocks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])):
        rows, cols, values = block_features(block)
        parts.append(((rows + at).astype(np.int32), cols.astype(np.int32), values.astype(np.float32)))
        at += len(block.bounds) - 1
    rows, cols, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    return rows, cols, values


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def classify(df: DataFrame, heads: dict[str, Head], text: str = "text") -> DataFrame:
    """``df`` with ``p_quality_bad``, ``p_toxic`` and ``kept`` (both below their thresholds).

    NULL and empty texts are scored like any text without words and are not kept. Repeated rows stay; columns of ``df``
    with these names are replaced.
    """
    added = [T.StructField("p_quality_bad", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    kept = df.select(*(c for c in df.columns if c not in {f.name for f in added}))
    shared = df.sparkSession.sparkContext.broadcast([(heads[h].weights, heads[h].threshold) for h in ("quality", "toxic")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, text):
            n = len(block.bounds) - 1
            rows, cols, values = block_features(block)
            scores = [_sigmoid(np.bincount(rows, values * w[cols], n) + w[-1]) for w, _ in shared.value]
            has_words = np.diff(arrays.words(block.data, block.bounds, arrays.NOT_SPACE).first) > 0
            good = (scores[0] < shared.value[0][1]) & (scores[1] < shared.value[1][1]) & has_words
            yield pa.RecordBatch.from_arrays([*block.rows.columns, *map(pa.array, (*scores, good))], block.rows.schema.names + [f.name for f in added])

    return kept.mapInArrow(work, T.StructType([*kept.schema.fields, *added]))
