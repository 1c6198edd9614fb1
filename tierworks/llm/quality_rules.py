"""Quality rules: a decision list learned from labelled text statistics, applied as Spark expressions.

Statistics of whole texts are computed with numpy inside tasks. The list is learned by sequential covering: a
rule grows, condition by condition, by FOIL gain on two thirds of the labelled rows, is pruned from its end
on the other third, and is kept while it is precise there; the rows that it covers leave, and the next one is
sought. The result is an ordered list of threshold conjunctions, evaluated by one ``CASE WHEN``.

Only the fit reads a bounded sample (``SAMPLE_ROWS`` labelled rows, the ones with the smallest hash of their id);
statistics and verdicts cover every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.llm import arrays
from tierworks.llm.arrays import U64

SAMPLE_ROWS = 10_000
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 48
MIN_PRECISION, MIN_COVERED = 0.9, 5

SYMBOLS = arrays.byte_class(lambda x: x in b"#*$%&|<>")
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_STATISTICS = ("n_lines", "n_upper", "n_bangs", "n_distinct_words")


class Condition(NamedTuple):
    feature: str
    at_least: bool
    threshold: float


Rule = tuple[Condition, ...]


def block_statistics(block: arrays.Block) -> dict[str, np.ndarray]:
    data, bounds = block.data, block.bounds
    n = len(bounds) - 1
    found = arrays.words(data, bounds, arrays.NOT_SPACE)
    hashes = arrays.span_hashes(data, found.starts, found.ends)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds])

    text_of = np.repeat(np.arange(n), np.diff(found.first))
    salt = arrays.mix(np.arange(1, n + 1, dtype=U64) * U64(arrays.BASE))
    chars = arrays.NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    upper = (data >= 0x41) & (data <= 0x5A)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    return {
        "n_words": np.diff(found.first),
        "word_chars": per_text(chars),
        "n_symbols": per_text(SYMBOLS[data]),
        "n_dup_lines": _repeated_lines(data, bounds, found.starts, salt)[1],
        "n_repeat_words": _repeated_words(hashes, found.first, text_of, salt, n),
        "n_lines": _repeated_lines(data, bounds, found.starts, salt)[0],
        "n_upper": per_text(upper),
        "n_bangs": per_text(data == 0x21),
        "n_distinct_words": _distinct(hashes + salt[text_of], text_of, n),
    }


def _distinct(keys: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each text has; keys of different texts differ."""
    _, first = np.unique(keys, return_index=True)
    return np.bincount(text_of[first], minlength=n)


def _repeated_lines(data: np.ndarray, bounds: np.ndarray, word_starts: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate((bounds[:-1], breaks + 1)))
    ends = np.sort(np.concatenate((breaks, bounds[1:])))
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    n = len(bounds) - 1
    text_of = np.searchsorted(bounds, starts, "right") - 1
    lines = np.bincount(text_of, minlength=n)
    keys = arrays.span_hashes(data, starts, ends) + salt[text_of]
    return lines, lines - _distinct(keys, text_of, n)


def _repeated_words(hashes: np.ndarray, first: np.ndarray, text_of: np.ndarray, salt: np.ndarray, n: int) -> np.ndarray:
    keys = arrays.chained(hashes, WINDOW)
    if not len(keys):
        return np.zeros(n, np.int64)
    own = text_of[: len(keys)]
    at = np.flatnonzero(own == text_of[WINDOW - 1 :])
    _, inverse, counts = np.unique(keys[at] + salt[own[at]], return_inverse=True, return_counts=True)
    again = at[counts[inverse] > 1]
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    covered = np.cumsum(edges)[:-1] > 0
    return np.diff(np.concatenate(([0], np.cumsum(covered)))[first])


def with_statistics(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with the statistics of its texts as longs; NULL and empty texts have zeros.

    Columns of ``df`` called like a statistic are replaced. Repeated rows stay.
    """
    added = [T.StructField(c, T.LongType()) for c in (*STATISTICS, *MORE_STATISTICS)]
    kept = df.select(*(c for c in df.columns if c not in {f.name for f in added}))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, column):
            found = block_statistics(block)
            more = [pa.array(np.asarray(found[f.name], np.int64)) for f in added]
            yield pa.RecordBatch.from_arrays([*block.rows.columns, *more], block.rows.schema.names + [f.name for f in added])

    return kept.mapInArrow(measure, T.StructType([*kept.schema.fields, *added]))


def features() -> dict[str, Column]:
    """What conditions are about: sizes and shares of the statistics, never NULL."""

    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "upper_per_char": share("n_upper", "word_chars"),
        "bangs_per_word": share("n_bangs", "n_words"),
        "distinct_words": share("n_distinct_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# --- learning --------------------------------------------------------------------------------------


def _covers(values: np.ndarray, at_least: bool, threshold: float) -> np.ndarray:
    return values >= threshold if at_least else values <= threshold


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0


def grow(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Add the condition of highest gain until no good row is covered or nothing is gained."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = int(bad[rows].sum()), int((~bad[rows]).sum())
        if not p0 or not n0:
            break
        best, chosen = 1e-9, None
        for name, values in table.items():
            own, is_bad = values[rows], bad[rows]
            cuts = np.unique(np.quantile(own[is_bad], np.linspace(0, 1, CUTS), method="nearest"))
            for at_least in (True, False):
                for cut in cuts:
                    hit = _covers(own, at_least, cut)
                    gain = _gain(p0, n0, int((hit & is_bad).sum()), int((hit & ~is_bad).sum()))
                    if gain > best:
                        best, chosen = gain, Condition(name, at_least, float(cut))
        if chosen is None:
            break
        rule.append(chosen)
        rows = rows[_covers(table[chosen.feature][rows], chosen.at_least, chosen.threshold)]
    return tuple(rule)


def covered(rule: Rule, table: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for condition in rule:
        rows = rows[_covers(table[condition.feature][rows], condition.at_least, condition.threshold)]
    return rows


def prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Rule, int, int]:
    """The prefix of the rule that is worth most on rows it was not grown on, with bad and good rows it covers."""

    def worth(prefix: Rule) -> tuple[float, int, int]:
        hit = covered(prefix, table, rows)
        p = int(bad[hit].sum())
        n = len(hit) - p
        return ((p - n) / (p + n) if p + n else -1.0, p, n)

    scored = [(worth(rule[:k]), -k) for k in range(1, len(rule) + 1)]
    (_, p, n), k = max(scored)
    return rule[:-k], p, n


def learn_rules(table: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject, from feature columns and labels; rows are taken in the order given."""
    rules: list[Rule] = []
    left = np.arange(len(bad))
    while len(rules) < MAX_RULES:
        growing, pruning = left[left % 3 != 0], left[left % 3 == 0]
        rule = grow(table, bad, growing)
        if not rule:
            break
        rule, p, n = prune(rule, table, bad, pruning)
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left = np.setdiff1d(left, covered(rule, table, left))
    return rules


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from ``labels`` (``doc_id, quality``: 0 is bad; NULLs are left out). No labels: no rules.

    At most ``sample_rows`` documents are learned from, the first by hashed id; ids that repeat count row by row.
    """
    labelled = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        labelled.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    wanted = features()
    order = ["h", "doc_id", *(f"f_{k}" for k in wanted)]
    rows = (
        with_statistics(texts)
        .select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", *(c.alias(f"f_{k}") for k, c in wanted.items()))
        .orderBy(*order)
        .limit(sample_rows)  # the documented bound of the fit, which repeated ids would pass otherwise
        .toPandas()
        .sort_values(order, kind="stable")
    )
    table = {k: rows[f"f_{k}"].to_numpy(float) for k in wanted}
    return learn_rules(table, rows["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects the row; 0 when none does."""
    known = features()

    def holds(rule: Rule) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & (known[c.feature] >= c.threshold if c.at_least else known[c.feature] <= c.threshold)
        return out

    chain = None
    for k, rule in enumerate(rules, 1):
        chain = F.when(holds(rule), k) if chain is None else chain.when(holds(rule), k)
    return F.lit(0) if chain is None else chain.otherwise(0)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` with statistics, ``base_failed``, ``rejected_by`` and ``kept``.

    NULL and empty texts have no words and fail the base rules. Needs ``doc_id`` and ``text``; the fit leaves
    rows with a NULL id out, the verdict covers them too.
    """
    rules = fit(documents, labels)
    added = {"base_failed", "rejected_by", "kept"}
    measured = with_statistics(documents.select(*(c for c in documents.columns if c not in added)))
    return measured.withColumns({"base_failed": base_failed(), "rejected_by": verdict(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rejected_by") == 0)
    )
