import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import DATA
from odd import TEXTS, none, odd

from tracelake.llm import registry, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("chunk,overlap", [(1, 1), (16, 4), (50, 8), (1000, 100)])
def test_spliced_chunks_equal_the_whole(chunk, overlap):
    enc = token_counts.encoder(PATH)
    for text in [*(t or "" for _, t, _, _ in TEXTS), "a  b   c    d " * 30, " lead and trail ", "▁ ▁▁ a ▁b", "x" * 300 + " " + "y" * 300, "東京 " * 100, "l'été de l'île " * 50]:
        text = text[:4000]
        assert token_counts.count_document(enc, text, chunk, overlap)[0] == len(LIBRARY.encode(text)), text[:40]


def test_random_texts_and_forced_widenings():
    enc = token_counts.encoder(PATH)
    assert enc.local
    r = random.Random(4)
    widened = 0
    for _ in range(200):
        text = "".join(r.choice(" ab\n.é東▁\U0001f600thein") for _ in range(r.randint(0, 700)))
        for chunk, overlap in ((16, 2), (60, 8), (300, 30)):
            n, _, more = token_counts.count_document(enc, text, chunk, overlap)
            widened += more
            assert n == len(LIBRARY.encode(text))
    assert widened > 100
    # one word that fills several chunks: overlaps widen until the chunk is the whole text
    word = "the" * 2000
    n, parts, more = token_counts.count_document(enc, word, 64, 8)
    assert n == len(LIBRARY.encode(word)) and more > 5 and parts < len(word) / 64
    # ordinary text is cut into chunks without widening
    n, parts, more = token_counts.count_document(enc, "some plain words in a row " * 500, 1000, 50)
    assert parts == 13 and more == 0


def test_no_token_crosses_a_stable_place():
    enc = token_counts.encoder(PATH)
    text = "l'été de  l'île ▁ 東京 " * 20 + "\n\n the end"
    places = {len(text[:c].encode()) for c in enc.stable(text, 0, len(text))}
    begins = set(enc.begins(text).tolist())
    assert len(places) > 100 and places <= begins


def test_odd_rows_equal_the_library(spark):
    out = token_counts.token_counts(odd(spark), PATH).collect()
    want = sorted((str(d), len((t or "").encode()), len(LIBRARY.encode(t or "")), len(LIBRARY.encode(t or "")) > 4096) for d, t, _, _ in TEXTS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out) == want
    assert token_counts.token_counts(none(spark), PATH).count() == 0


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = {r.doc_id: len(LIBRARY.encode(r.text or "")) for r in rows}
    assert {r.doc_id: r.n_tokens for r in registry.op8_token_counts(spark, DATA).collect()} == want
