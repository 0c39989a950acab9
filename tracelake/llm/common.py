"""Helpers shared by the corpus operators: scratch tables, Arrow batches, byte-level words, bounded samples."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``; where that is unset a temporary folder serves a local session, and a cluster raises."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        base = "file://" + tempfile.gettempdir() + "/tracelake-scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bucketed(df: DataFrame, by: str, name: str) -> DataFrame:
    """The same as a table in buckets of ``by``: joins and groups by that column shuffle the other side alone."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"tracelake_{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, by).sortBy(by).option("path", scratch(spark, name)).saveAsTable(table)
    return spark.table(table)


def set_apart(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with all columns but the ``used`` ones renamed, so that no name clashes with those an operator adds; ``toDF(*docs.columns)`` gives them back."""
    return docs.toDF(*[c if c in used else f"own{i}" for i, c in enumerate(docs.columns)])


def schema_of(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is empty."""
    return [x or "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of ``column`` at the most (one row may be larger)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in a row, and the offsets of its rows (one more than rows); null is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, a-z and whatever is not ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15 | 1), 1 << 20
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int, base: np.uint64, name: str) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        size = max(1, -(-n // _STEP)) * _STEP
        _powers[name] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible finaliser)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of rows after lower-casing A-Z.

    ``begin``/``end`` are byte positions in ``raw``, ``first`` the number of the
    first word of each row (one more than rows), ``key`` a 64-bit hash of each word.
    """

    def __init__(self, column: pa.Array):
        raw, at = utf8(column)
        self.raw, self.at = _LOWER[raw], at
        inside = np.concatenate([[False], _WORD[self.raw], [False]])
        before, here = inside[:-1].copy(), inside[1:].copy()
        # a row's edge also ends a word
        edge = np.zeros(len(before), bool)
        edge[at] = True
        self.begin = np.flatnonzero(here & (~before | edge))
        self.end = np.flatnonzero(before & (~here | edge))
        self.first = np.searchsorted(self.begin, at)
        n = len(self.raw)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * _power(n, _BASE, "up"), out=total[1:])
        back = _power(n + 1, _INVERSE, "down")
        self._total, self._back = total, back
        self.key = self.key_to(self.end)

    def key_to(self, end: np.ndarray) -> np.ndarray:
        """Hash of each word's bytes up to ``end``."""
        return mix((self._total[end] - self._total[self.begin]) * self._back[self.begin] + (end - self.begin).astype(np.uint64))

    def word(self, k: int) -> bytes:
        return self.raw[self.begin[k] : self.end[k]].tobytes()


def held_out(column: str | Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` is ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column, F.lit("")).cast("binary")) % modulus == remainder


#: Most classes that a classifier learns.
CLASSES = 1000


def labelled_sample(docs: DataFrame, labels: DataFrame, each: int, seed: int, most: int = 1 << 30) -> tuple[DataFrame, dict]:
    """(doc_id, text, label) of about ``each`` ids of every class, ``most`` of all together, and the number of labelled ids of every class.

    Ids are drawn from ``labels(doc_id, label)`` alone, by a hash that gives the same
    ids on each run: no text is shuffled to draw them and one class may hold nearly all
    rows. The ids drawn (``each`` for a class in expectation, ``CLASSES`` classes at
    most) are broadcast to fetch their texts from ``docs``. Repeated labels of an id
    count once (the greatest), so do repeated texts; null ids and labels are left out.
    """
    own = labels.select("doc_id", "label").where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r[0]: r[1] for r in own.groupBy("label").count().limit(CLASSES + 1).collect()}
    if len(counts) > CLASSES:
        raise ValueError(f"more than {CLASSES} classes")
    each = min(each, most // max(len(counts), 1))
    rate = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, each / n))])[F.col("label")] if counts else F.lit(0.0)
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    chosen = own.where(u < rate)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label")), counts
