"""Token-ID output: fixed-width bit packing with block offsets.

Ids are stored in the fewest bits that hold the vocabulary (``width``), least
significant bit first, in blocks of whole documents of about ``BLOCK`` ids. The
file is a Parquet table in the shared folder, one row a block: shard, number in
the shard, first doc ids, ids per document, ids of the shard before the block,
width, and the packed bytes. A reader finds id ``i`` of a block at bit
``i * width``, so blocks and single ids can be unpacked with numpy at any place.

Documents are ordered by ``doc_id`` over shards (a range partition), nulls first,
equal ids by text. ``start`` counts the ids of all documents before: a sum over
the shards' totals plus a sum within the shard.

Defined results: null text is empty and has the end id alone; empty tables give
empty files; repeated rows are each encoded; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, texts

BLOCK = 1 << 16
_loaded: dict[str, "WordEncoder"] = {}


class WordEncoder(dict):
    """Bytes of little-endian ids of stretches between ASCII spaces, each encoded once by the library.

    White space never is part of a token or special token of such a vocabulary
    (``splits`` proves it on the file), so stretches are encoded apart.
    """

    MOST = 800_000
    #: Marks that follow a letter begin a token of their own: a space before them changes nothing.
    MARKS = re.compile("(?<=[a-zß-öø-ÿ])(?=[.,!#$%*&])")

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rules = json.dumps(spec["pre_tokenizer"])
        own = {"Lowercase"} <= {x.get("type") for x in (spec["normalizer"] or {}).get("normalizers", [])}
        self.splits = own and '"behavior": "Removed"' in rules and '"invert": true' in rules and "\\\\s\\\\p{L}" in rules and not any(" " in x["content"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"])

    def __missing__(self, word: str) -> bytes:
        out = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 48:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        if not self.splits:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # the library lower-cases each character after NFC; where that is the same, more words are equal
        low = text.lower()
        if "Σ" not in text and "İ" not in text and "<|" not in text and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low):
            text = self.MARKS.sub(" ", low)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive fields of ``width`` bits, least significant bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, begin: int, count: int) -> np.ndarray:
    """``count`` ids from the ``begin``-th on, reading only the bytes that hold them."""
    if width in (8, 16, 32):
        return np.frombuffer(packed, f"<u{width // 8}", count, begin * width // 8).astype(np.uint32)
    lo, hi = begin * width // 8, -(-(begin + count) * width // 8)
    bits = np.unpackbits(np.frombuffer(packed, np.uint8, hi - lo, lo), bitorder="little")
    bits = bits[begin * width - lo * 8 :][: count * width].reshape(count, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def write(docs: DataFrame, tokenizer: str, end_id: int, path: str, partitions: int | None = None) -> None:
    """Encode ``docs(doc_id, text)`` and write the blocks to ``path`` in ascending doc_id order."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer)
        width, shard, block, before = width_of(max(enc.size, end_id + 1)), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        doc_ids: list = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, before
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[shard], [block], [before], [width], [list(doc_ids)], [list(lengths)], [pack(ids, width)]]
            block, before = block + 1, before + len(ids)
            held.clear(), doc_ids.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary()), strict=True)], ["shard", "block", "before", "width", "doc_ids", "lengths", "packed"])

        held_ids = 0
        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = enc.ids(text.as_py() or "") + end
                held.append(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                held_ids += len(ids) // 4
                if held_ids >= BLOCK:
                    yield flush()
                    held_ids = 0
        if held:
            yield flush()

    n = partitions or max(docs.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, f"shard int, block int, before long, width int, doc_ids array<{kind}>, lengths array<long>, packed binary").write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Read a file back: doc_id, start, n_tokens, ids (packed as little-endian unsigned 32-bit integers), shard, block."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # one row for each shard, as many as the writer had partitions
    totals = blocks.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    starts = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in ("shard", "block", "before", "width", "shard_start", "lengths", "packed")}
                ids = unpack(row["packed"], row["width"], 0, sum(row["lengths"])).astype("<u4")
                ends = np.cumsum(row["lengths"])
                first = ends - row["lengths"]
                m = len(ends)
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[r].values, pa.array(first + row["before"] + row["shard_start"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array([ids[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()), pa.array([row["shard"]] * m, pa.int32()), pa.array([row["block"]] * m, pa.int32())], ["doc_id", "start", "n_tokens", "ids", "shard", "block"])

    return blocks.join(F.broadcast(starts), "shard").select("shard", "block", "before", "width", "shard_start", "doc_ids", "lengths", "packed").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary, shard int, block int")


def token_file(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new file in the shared folder and return what ``read`` gives of it."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, tokenizer, end_id, path)
    return read(docs.sparkSession, path)


def digest(read_back: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read`` returned."""
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "shard", "block")
