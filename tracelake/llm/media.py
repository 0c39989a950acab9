"""Media columns: bytes of text stored as lossless WebP, read back, and described.

A payload (the text's UTF-8 bytes, blanks appended up to a positive multiple of
``WIDTH``) is an image of grey 8-bit samples, ``WIDTH`` a row. It is stored as one
lossless WebP file for every ``ROWS`` rows, one file after another, so that a long text
neither exceeds the format's height nor has to be decoded whole. The stored table is a
Parquet folder in the shared folder; ``read`` decodes it (see ``webp``) to pixel arrays,
``features`` describes those.

Defined results: null text is empty and has one blank row; repeated rows are each
stored; equal texts give equal files; empty tables give empty folders; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import scratch, slices
from .webp import decode_many, split_files
from .webp_encode import gray_tiles

WIDTH, ROWS = 192, 64
#: Payload bytes that are encoded or decoded together.
TOGETHER = 4 << 20


def payload(text: str | None) -> tuple[bytes, int]:
    """The padded bytes of a text, and how many of them are its own."""
    own = (text or "").encode()
    return own + b" " * (-len(own) % WIDTH if own else WIDTH), len(own)


def encode(payloads: list[bytes]) -> list[bytes]:
    """The stored form of each payload."""
    step = WIDTH * ROWS
    tiles = [p[a : a + step] for p in payloads for a in range(0, len(p), step)]
    files, out, k = gray_tiles(tiles, WIDTH), [], 0
    for p in payloads:
        n = -(-len(p) // step)
        out.append(b"".join(files[k : k + n]))
        k += n
    return out


def decode(stored: list[bytes]) -> list[np.ndarray]:
    """Pixels (rows, WIDTH, 4) of each stored form."""
    files = [split_files(s) for s in stored]
    images, out, k = decode_many([f for own in files for f in own]), [], 0
    for own in files:
        out.append(images[k] if len(own) == 1 else np.concatenate(images[k : k + len(own)]))
        k += len(own)
    return out


def samples(pixels: np.ndarray) -> np.ndarray:
    """The grey samples of an image whose red, green and blue are equal."""
    green = pixels[..., 1]
    if (pixels[..., 0] != green).any() or (pixels[..., 2] != green).any():
        raise ValueError("the image isn't grey")
    return green


def features(gray: np.ndarray) -> str:
    """Rows, mean, deviation, and a 64-bit hash: which of 64 bands of columns are lighter than the image."""
    bands = gray.reshape(len(gray), 64, -1).sum(axis=(0, 2), dtype=np.int64)
    total, squares = int(bands.sum()), int(np.square(gray, dtype=np.uint32).sum(dtype=np.int64))
    mean = total / gray.size
    lighter = int.from_bytes(np.packbits(bands * 64 > total).tobytes(), "big")
    return f"{len(gray)}x{WIDTH}:{mean:.3f}:{max(0.0, squares / gray.size - mean * mean) ** 0.5:.3f}:{lighter:016x}"


def write(docs: DataFrame, path: str) -> None:
    """Store the payloads of ``docs(doc_id, text)``: doc_id, n_bytes, media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=TOGETHER):
            own = [payload(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for _, n in own], pa.int64()), pa.array(encode([p for p, _ in own]), pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # the files are compressed already
    docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary").write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode a stored table: doc_id, n_bytes, media and pixels (grey samples, row by row)."""
    return _decoded(spark.read.parquet(path), "media binary, pixels binary", lambda media, gray: (media, gray.tobytes()))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_bytes and digests of the stored form and of what is decoded from it."""

    def of(media: bytes, gray: np.ndarray) -> tuple:
        own = gray.tobytes()
        return len(own), sha256(own).hexdigest(), zlib.crc32(own[-16:]), len(media), sha256(media).hexdigest(), features(gray)

    return _decoded(spark.read.parquet(path), "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", of)


def _decoded(stored: DataFrame, schema: str, of) -> DataFrame:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", TOGETHER // 2):
            media = batch.column("media").to_pylist()
            rows = zip(*(of(m, samples(p)) for m, p in zip(media, decode(media), strict=True)), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(list(x), kinds[k]) for x, (_, k) in zip(rows, fields, strict=True))], ["doc_id", "n_bytes", *(n for n, _ in fields)])

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, {schema}")


def media_column(docs: DataFrame) -> DataFrame:
    """Store ``docs`` in a new folder of the shared one and return ``digest`` of it."""
    path = scratch(docs.sparkSession, "media")
    write(docs, path)
    return digest(docs.sparkSession, path)
