import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierworks.llm import arrays, bpe
from tierworks.llm.queries import tokenizer_path

PIECES = ["a", "b", "th", "'s", "'t", "'ll", " ", "  ", "\n", "É", "ß", "×", "1", "23", "!", "..", "'", "''", "<|", "<|endoftext|>", "Σ", "İ", "日本", "I'M", "don't", " ", "\x1c"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(tokenizer_path())
    made.no_padding()
    made.no_truncation()
    return made


def encoded(texts):
    for block in arrays.blocks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])):
        own = bpe.encoder(tokenizer_path())
        ids, bounds = own.encode(block)
        yield from zip(block.rows.column(0).to_pylist(), (ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])), own.decode(ids, bounds))


def test_equals_library_on_mixed_texts(library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(2000)] + [None, ""]
    for text, ids, back in encoded(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids == want
        assert back.decode() == library.decode(want, skip_special_tokens=False)


def test_tree_concatenation_equals_one_piece(library):
    rng = random.Random(2)
    alphabets = ["ab", "thingeranos", "éa", "!?.-'#", "aaaaab"]
    texts = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(200, 1500))) for _ in range(150)]
    texts += ["".join(rng.choices("thinger日é", k=9000)) + " x", "a" * 20_000]
    for text, ids, _ in encoded(texts):
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_pool_starts_anew_when_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 1 << 12)
    own = bpe.Encoder(tokenizer_path())
    rng = random.Random(3)
    for _ in range(4):
        text = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(3000))
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = own.encode(arrays.Block(None, data, np.array([0, len(data)])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_text_with_more_words_than_the_pool_holds(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 1 << 10)
    own = bpe.Encoder(tokenizer_path())
    rng = random.Random(4)
    long = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(5000))
    texts = ["a b", long, "", long[:9000] + " end"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, bounds = own.encode(arrays.Block(None, data, np.cumsum([0, *map(len, texts)])))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows_and_columns(spark, docs, library):
    odd = docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    rows = bpe.with_ids(odd, tokenizer_path(), decoded=True).collect()
    assert len(rows) == docs.count() and set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"}
    for row in rows:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert sha(bytes(row.ids)) == sha(np.array(want, "<u4").tobytes())
        assert row.decoded == library.decode(want, skip_special_tokens=False)


def test_empty_table(empty):
    assert bpe.with_ids(empty, tokenizer_path()).count() == 0
