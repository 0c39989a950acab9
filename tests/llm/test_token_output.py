import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA
from odd import TEXTS, none, odd
from tokenizers import Tokenizer

from tracelake.llm import registry, token_file

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 2, 7, 8, 13, 16, 17, 31, 32])
def test_packing_is_exact_at_any_place(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 997, dtype=np.uint64).astype(np.uint32)
    packed = token_file.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    for begin, count in ((0, 997), (1, 5), (990, 7), (500, 0), (996, 1)):
        assert (token_file.unpack(packed, width, begin, count) == ids[begin : begin + count]).all()


def test_width_is_minimal():
    assert [token_file.width_of(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def expected(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def read_back(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=str)


def test_odd_rows_equal_the_library(spark):
    assert read_back(token_file.digest(token_file.token_file(odd(spark), PATH))) == expected([r[:2] for r in TEXTS])


def test_query_equals_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert read_back(registry.op1_token_file(spark, DATA)) == expected(rows)


def test_small_blocks_read_the_same(spark, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK", 7)
    assert read_back(token_file.digest(token_file.token_file(odd(spark), PATH))) == expected([r[:2] for r in TEXTS])


def test_empty(spark):
    assert token_file.token_file(none(spark), PATH).count() == 0
