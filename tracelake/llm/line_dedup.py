"""Line dedup by content-defined chunks of lines.

Lines get a hash; a rolling hash over two line hashes ends a chunk where it
is 0 modulo ``DIVISOR``, so boundaries move with the text. A chunk of two or more
lines whose bytes occur more than once in the corpus is removed everywhere but in
its first place (lowest doc_id, then lowest chunk).

First pass: chunks are counted by a 16-byte key, map-side first, so that a chunk that
a third of all documents hold is no hot group; of each key that repeats, the first
place and its bytes are written. Second pass: keys without bytes find the other places
(an equi-join, which Spark splits where a key is hot) and bring each document the bytes
of the first place, with which it compares its own chunk byte by byte before removal.

Defined results: null text stays null with 0 lines; the empty text is one empty
line; a null id sorts behind all others; rows that share an id are one document: a
chunk at the same place of a row with the same id is not its own copy; empty
tables give no rows; other columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_of, set_apart, written

#: A boundary depends on a line and the one before it.
DIVISOR, FACTOR = 3, 31


def chunks(lines: list[bytes], divisor: int = DIVISOR) -> list[tuple[int, int]]:
    """Line ranges [begin, end) of the chunks of a text."""
    out, begin, before = [], 0, 0
    for i, line in enumerate(lines):
        h = int.from_bytes(md5(line, usedforsecurity=False).digest()[:4], "big")
        if (before * FACTOR + h) % divisor == 0:
            out.append((begin, i + 1))
            begin = i + 1
        before = h
    if begin < len(lines):
        out.append((begin, len(lines)))
    return out


def _chunk_rows(docs: DataFrame, with_bytes: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                if text is None:
                    continue
                raw = text.encode()
                lines, tag = raw.split(b"\n"), md5(raw, usedforsecurity=False).digest() if doc_id is None else None
                for k, (a, b) in enumerate(chunks(lines)):
                    if b - a > 1:
                        body = b"\n".join(lines[a:b])
                        rows.append((doc_id, tag, k, md5(body, usedforsecurity=False).digest(), *([body] if with_bytes else [])))
                        size += len(body)
                if size > 8 << 20:
                    yield table(batch, rows)
                    rows, size = [], 0
            if rows:
                yield table(batch, rows)

    def table(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [batch.column("doc_id").type, pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=False)], ["doc_id", "tag", "chunk", "key", "body"][: 4 + with_bytes])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, tag binary, chunk int, key binary" + ", body binary" * with_bytes)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, tag (of the text, where the id is null: such rows are no group), chunk, original (bytes at the first place of the same key) of every chunk that stood before."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("chunk").alias("chunk"))
    keys = _chunk_rows(docs, True).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(place.alias("place"), F.col("body").alias("body"))).alias("first"))
    keys = written(keys.where("n > 1").select("key", F.col("first.place").alias("first"), F.col("first.body").alias("original")), "repeated")
    held = _chunk_rows(docs, False).select("key", "tag", place.alias("place")).join(keys, "key")
    return held.where(~F.col("place").eqNullSafe(F.col("first"))).select("place.doc_id", "tag", "place.chunk", "original")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks taken out of ``text``, and _n_lines, _n_removed (lines; own columns of these names are replaced)."""
    names, docs = docs.columns, set_apart(docs, "doc_id", "text")
    gone = repeated(docs).groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.collect_set(F.struct("chunk", "original")).alias("_gone"))
    tag = F.when(F.col("doc_id").isNull(), F.unhex(F.md5("text")))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & tag.eqNullSafe(F.col("_tag")), "left").drop("_id", "_tag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, n_lines, n_removed = [], [], []
            for text, gone in zip(batch.column("text"), batch.column("_gone"), strict=True):
                text, gone = text.as_py(), gone.as_py()
                if text is None:
                    body.append(None), n_lines.append(0), n_removed.append(0)
                    continue
                if not gone:
                    body.append(text), n_lines.append(text.count("\n") + 1), n_removed.append(0)
                    continue
                lines, same = text.encode().split(b"\n"), {(g["chunk"], g["original"]) for g in gone}
                # bytes decide; a key that two texts share leaves the other text alone
                left = [x for k, (a, b) in enumerate(chunks(lines)) if (k, b"\n".join(lines[a:b])) not in same for x in lines[a:b]]
                body.append(b"\n".join(left).decode()), n_lines.append(len(lines)), n_removed.append(len(lines) - len(left))
            columns = [pa.array(body, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names if n != "_gone"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], [*(n for n in batch.schema.names if n != "_gone"), "_n_lines", "_n_removed"])

    out = joined.mapInArrow(run, schema_of(docs) + ", _n_lines long, _n_removed long")
    added = ["_n_lines", "_n_removed"]
    return out.drop(*[f"own{i}" for i, c in enumerate(names) if c in added]).toDF(*[c for c in names if c not in added], *added)
