"""Token counts by overlap resynchronisation.

A text is encoded by the library. One longer than ``chunk`` characters is encoded in
overlapping chunks, each with the offsets of its tokens, and two neighbours are spliced
at a boundary inside their overlap that both encodings have and that is proven stable:
no piece of the vocabulary holds the characters before and behind it side by side (a
space counts as the mark that stands for it), so no token of any encoding crosses it and
nothing on one side changes the other. What lies left of the boundary is taken from the
left chunk's tokens, what lies right of it from the right chunk's. Where an overlap has
no such boundary, it is doubled; once it is the whole left chunk, that chunk is made
twice as long, in the end the whole text.

The proof needs a model that leaves its input as it is (identity normaliser, white space
kept); with any other, texts are encoded whole.

Defined results: null text counts as empty (0 tokens, 0 bytes); empty tables give
an empty result; repeated rows each get their row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK, OVERLAP = 32768, 512
_MARK = "▁"
_loaded: dict[str, "Encoder"] = {}


class Encoder:
    """A sentencepiece model with the pairs of characters that its pieces hold side by side."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        rules = spec.normalizer_spec
        self.local = not rules.precompiled_charsmap and not rules.normalization_rule_tsv and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        self.pairs = {p.piece[i : i + 2] for p in spec.pieces for i in range(len(p.piece) - 1)}

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def begins(self, text: str) -> np.ndarray:
        """Where each token of ``text`` begins, in bytes of its UTF-8 form."""
        tokens = self.model.encode(text, return_type="proto").pieces
        return np.fromiter((t.begin for t in tokens), np.int64, len(tokens))

    def stable(self, text: str, lo: int, hi: int) -> list[int]:
        """Places c from ``lo`` to ``hi`` (of characters, ends excluded) that no token of any encoding crosses."""
        around = text[lo:hi].replace(" ", _MARK)
        return [lo + k for k in range(1, len(around)) if around[k - 1 : k + 1] not in self.pairs]


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def count_document(enc: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int, int]:
    """(tokens, chunks, widened overlaps) of one text; the tokens are those of encoding it whole."""
    if len(text) <= chunk or not enc.local:
        return enc.count(text), 1, 0
    # the left chunk is text[begin:end]; its tokens count from the byte ``cut`` of it on
    begin, end, cut, wide = 0, chunk, 0, overlap
    total, parts, widened = 0, 1, 0
    own = enc.begins(text[begin:end])
    while end < len(text):
        start = max(end - wide, begin)
        places = enc.stable(text, start, end)
        # a boundary behind the last splice, in bytes of both chunks
        before, at = len(text[begin:start].encode()), np.array([0, *np.cumsum([len(c.encode()) for c in text[start:end]])])
        if places:
            stop = min(len(text), end + chunk)
            right = enc.begins(text[start:stop])
            inside = at[np.array(places) - start]
            inside = inside[(before + inside > cut) & np.isin(before + inside, own) & np.isin(inside, right)]
            if len(inside):
                c = int(inside[len(inside) // 2])
                total += int(np.searchsorted(own, before + c) - np.searchsorted(own, cut))
                begin, end, cut, own, wide, parts = start, stop, c, right, overlap, parts + 1
                continue
        widened += 1
        if start > begin:
            wide *= 2
            continue
        end, wide = min(len(text), begin + 2 * (end - begin)), overlap
        own = enc.begins(text[begin:end])
    # a token that begins at byte 0 may be the dummy prefix alone
    return total + len(own) - int(np.searchsorted(own, cut)), parts, widened


def token_counts(docs: DataFrame, model: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), n_chunks, n_widened of each row of ``docs(doc_id, text)``.

    One pass without a shuffle. The vocabulary's path is a parameter; each Python
    worker loads it once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            out = {"n_bytes": [], "n_tokens": [], "over_limit": [], "n_chunks": [], "n_widened": []}
            for text in batch.column("text"):
                text = text.as_py() or ""
                n, parts, widened = count_document(enc, text, chunk, overlap)
                for name, x in zip(out, (len(text.encode()), n, n > limit, parts, widened), strict=True):
                    out[name].append(x)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(out.values(), kinds, strict=True))], ["doc_id", *out])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_chunks int, n_widened int")
