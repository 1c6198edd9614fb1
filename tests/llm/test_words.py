import random

import numpy as np
import pyarrow as pa
from conftest_llm import WORD, lower

from tierworks.llm import arrays


def block_of(texts):
    return list(arrays.blocks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])))


def test_words_and_equal_fingerprints():
    rng = random.Random(4)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "\n", "\x1c", "日", "-", "\t"], k=rng.randint(0, 30))) for _ in range(300)] + [None, ""]
    seen = {}
    for block in block_of(texts):
        low = arrays.LOWER[block.data]
        found = arrays.words(low, block.bounds, arrays.NOT_SPACE)
        hashes = arrays.span_hashes(low, found.starts, found.ends)
        for k, text in enumerate(block.rows.column(0).to_pylist()):
            own = slice(found.first[k], found.first[k + 1])
            want = WORD.findall(lower(text))
            got = [low[a:b].tobytes().decode() for a, b in zip(found.starts[own], found.ends[own])]
            assert got == want
            for word, h in zip(want, hashes[own].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_small_blocks(monkeypatch):
    monkeypatch.setattr(arrays, "BLOCK_BYTES", 64)
    word = "x" * 10_000
    texts = [f"{word} a {word} b", "a " * 500, word, f"b {word}"]
    hashes = {}
    for block in block_of(texts):
        found = arrays.words(block.data, block.bounds, arrays.NOT_SPACE)
        for a, b, h in zip(found.starts, found.ends, arrays.span_hashes(block.data, found.starts, found.ends).tolist()):
            assert hashes.setdefault(block.data[a:b].tobytes(), h) == h
    assert len(hashes) == 3 and len(set(hashes.values())) == 3


def test_blocks_share_out_all_rows(monkeypatch):
    monkeypatch.setattr(arrays, "BLOCK_BYTES", 10)
    texts = ["abc", None, "", "defghijklmnopq", "r", "s" * 9, "t"]
    made = block_of(texts)
    assert [x for b in made for x in b.rows.column(0).to_pylist()] == texts
    assert b"".join(b.data.tobytes() for b in made) == "".join(t or "" for t in texts).encode()


def test_chained_needs_all_words():
    hashes = np.arange(6, dtype=np.uint64)
    assert len(arrays.chained(hashes, 7)) == 0
    assert len(set(arrays.chained(hashes, 3).tolist())) == 4
