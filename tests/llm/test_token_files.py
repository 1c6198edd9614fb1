import numpy as np
import pytest
from conftest_llm import DOCS
from tokenizers import Tokenizer

from tierworks.llm import token_files as F9
from tierworks.llm.queries import tokenizer_path


def encoded(text):
    library = Tokenizer.from_file(tokenizer_path())
    library.no_padding()
    library.no_truncation()
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("shards", [1, 5])
def test_round_trip(spark, corpus, tmp_path, shards):
    rows = [*corpus, (None, "no key", None, None, None), (None, None, None, None, None), *corpus[:2]]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    folder = str(tmp_path / "tokens")
    manifest = F9.write_token_files(df, folder, tokenizer_path(), 1, shards=shards)
    assert sum(r.n_docs for r in manifest.collect()) == len(rows)
    back = sorted(F9.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in back]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    texts = {r[0]: r[1] for r in corpus}
    for r in back:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.start == at
        at += len(ids)
        if r.doc_id is not None:
            assert ids == encoded(texts[r.doc_id])
    assert sorted(len(r.ids) for r in back if r.doc_id is None) == sorted(4 * len(encoded(t)) for t in ("no key", None))


def test_files_are_mapped_and_narrow(spark, docs, tmp_path):
    folder = str(tmp_path / "tokens")
    row = F9.write_token_files(docs, folder, tokenizer_path(), 1, shards=1).first()
    assert row.width == 2
    ids = F9.mapped(folder, f"{row['name']}.bin", np.dtype("<u2"), row.n_tokens)
    offsets = F9.mapped(folder, f"{row['name']}.idx", np.dtype("<u8"), row.n_docs + 1)
    assert isinstance(ids, np.memmap) and offsets[0] == 0 and offsets[-1] == len(ids)


def test_other_attempts_do_not_count(spark, docs, tmp_path):
    folder = tmp_path / "tokens"
    F9.write_token_files(docs, str(folder), tokenizer_path(), 1, shards=2)
    (folder / "0123.bin").write_bytes(b"left by a lost attempt")
    assert F9.read_token_files(spark, str(folder)).count() == docs.count()


def test_empty_table(spark, empty, tmp_path):
    F9.write_token_files(empty, str(tmp_path / "none"), tokenizer_path(), 1)
    assert F9.read_token_files(spark, str(tmp_path / "none")).count() == 0
