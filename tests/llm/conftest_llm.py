"""Helpers of these tests."""

import hashlib
import random
import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def prose(rng, n, words=("and", "the", "tion", "eau", "ción", "ung", "or", "in", "Thing", "été")):
    return " ".join("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(n))
