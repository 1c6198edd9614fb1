"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and read as code points; n-grams of 1 to ``MAX_N`` are hashed into ``BUCKETS``. Training
counts every n-gram of every training text: tasks count with numpy, Spark adds up (language, bucket). The
log-probability matrix (``BUCKETS`` x languages of 4 bytes: its size hangs on neither table) goes to the tasks,
which sum its rows over a text's n-grams. Languages are the learned values, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MAX_N, BUCKETS, ALPHA = 4, 1 << 16, 0.5
#: So many languages are counted at once in a task (512 KB each).
HELD_LANGUAGES = 64
#: Code points taken at once.
PIECE = 1 << 18
UNKNOWN = "und"


def buckets_of(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, piece by piece; n-grams across pieces are counted once."""
    for at in range(0, len(text), PIECE):
        piece = text[max(0, at - MAX_N + 1) : at + PIECE]
        skip = at - max(0, at - MAX_N + 1)
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        gram = np.zeros(len(points), np.uint32)
        for n in range(1, MAX_N + 1):
            # gram[i] stands for the n code points that end at i
            gram = np.concatenate((np.zeros(1, np.uint32), gram[:-1])) * np.uint32(0x01000193) if n > 1 else gram
            gram = (gram ^ points) * np.uint32(0x9E3779B1)
            own = gram[max(skip, n - 1) :]
            yield (own ^ (own >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def count_grams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, bucket, n`` over all rows with a language; ``bucket`` -1 counts the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for value, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if own not in counts:
                    if len(counts) >= HELD_LANGUAGES:  # what is counted so far goes to Spark, which adds up
                        yield from _counted(counts, texts)
                        counts, texts = {}, {}
                    counts[own], texts[own] = np.zeros(BUCKETS, np.int64), 0
                texts[own] += 1
                for found in buckets_of((value.as_py() or "").lower()):
                    counts[own] += np.bincount(found, minlength=BUCKETS)
        yield from _counted(counts, texts)

    rows = df.select(F.col(text), F.col(lang)).filter(F.col(lang).isNotNull())
    return rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _counted(counts: dict[str, np.ndarray], texts: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for own, row in counts.items():
        at = np.flatnonzero(row)
        cells = [pa.array([own] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(row[at], texts[own]), pa.int64())]
        yield pa.RecordBatch.from_arrays(cells, ["lang", "bucket", "n"])


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the log-probability matrix (bucket x language)."""
    counted = count_grams(df, text, lang)
    # At most BUCKETS + 1 rows for each language, whatever the size of the corpus.
    rows = counted.toPandas()
    langs = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((BUCKETS, len(langs)))
    texts = np.zeros(len(langs))
    for k, own in enumerate(langs):
        part = rows[rows["lang"] == own]
        grams = part[part["bucket"] >= 0]
        counts[grams["bucket"].to_numpy(), k] = grams["n"].to_numpy()
        texts[k] = part.loc[part["bucket"] < 0, "n"].sum()
    logs = np.log(counts + ALPHA) - np.log(counts.sum(axis=0) + ALPHA * BUCKETS)
    return langs, np.log(texts / texts.sum()) if len(langs) else texts, logs.astype(np.float32)


def predict(df: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (posterior probability of the prediction).

    NULL texts, texts without a letter (numerals are none) and a model without languages give ``und`` and 0. Ties go to the
    first language by name. Repeated rows are judged alike, texts of any length are read whole, in pieces. Columns of
    ``df`` with these names are replaced.
    """
    langs, priors, logs = model
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    kept = df.select(*(c for c in df.columns if c not in {"lang_pred", "score"}))
    shared = df.sparkSession.sparkContext.broadcast(logs)

    def judge(value: str | None) -> tuple[str, float]:
        if not langs or value is None or not any(map(str.isalpha, value)):
            return UNKNOWN, 0.0
        total = priors.copy()
        for found in buckets_of(value.lower()):
            counts = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS else None
            if counts is not None:
                total += counts @ shared.value.astype(np.float64)
            else:
                total += shared.value[found].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        return langs[best], float(1 / np.exp(total - total[best]).sum())

    def judge_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = [judge(value.as_py()) for value in batch.column(at)]
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], batch.schema.names + ["lang_pred", "score"])

    return kept.mapInArrow(judge_all, T.StructType([*kept.schema.fields, *added]))
