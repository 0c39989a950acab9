"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled rows (``EACH`` of each class in
expectation, by a hash of the id). Terms are lower-cased words and their first 4
and 5 bytes; that a term stands at least 2, 3 or 5 times in a text (``LEVELS``) is a term
of its own. Terms whose presence depends on the label in the sample (chi-square
above ``CHI``, at least ``LEAST`` rows, ``TERMS`` at most) make the vocabulary.
Two thirds of the sample are indexed, the others calibrate.

The index is inverted and block-max: examples are dealt to blocks of ``BLOCK``;
each term has its postings by block and its largest weight in each block. A query
adds up the largest weights to a bound for every block, scores blocks in
descending bounds from their postings and stops when no bound reaches its
``K``-th similarity, so the neighbours are exact (equal similarities: the example
with the lower number). The vote is weighted by similarity, and a logistic curve
fitted on the calibration rows, corrected to the labels' true shares, makes the
score. Learning reads at most 2 * EACH rows; the driver collects at most
2 * EACH * TERMS pairs; scoring is one pass without a shuffle.

Defined results: null, empty or neutral text has no neighbour and gets the
calibrated score of such texts; without labelled rows of both classes every score
is the share of label 1 (0 if there is none); other columns are not read;
repeated rows each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, labelled_sample, schema_of, set_apart, slices

EACH, TERMS, CHI, LEAST, K, BLOCK, STEP = 3000, 4096, 15.1, 4, 15, 64, 4
PREFIXES, LEVELS = (4, 5), (1, 2, 3, 5)
#: Bits for an example's number beside its similarity.
NUMBER = 22


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every term occurrence: words, and the first bytes of longer words."""
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    keys, rows = [words.key], [row]
    for n in PREFIXES:
        long = np.flatnonzero(words.end - words.begin > n)
        end = words.end.copy()
        end[long] = words.begin[long] + n
        keys.append(words.key_to(end)[long] ^ np.uint64(0x5851F42D4C957F2D * n & (1 << 64) - 1))
        rows.append(row[long])
    return np.concatenate(rows), np.concatenate(keys)


def counted(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs and how often each stands."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])[: len(row)])
    return row[begin], key[begin], np.diff(np.append(begin, len(row)))


def at_level(key: np.ndarray, level: int) -> np.ndarray:
    """The key of the term "this term at least ``level`` times"."""
    return key ^ np.uint64(0x2545F4914F6CDD1D * (level - 1) & (1 << 64) - 1)


class Vocabulary:
    """Sorted 64-bit keys of terms (a plain term and a level) with their idf."""

    def __init__(self, plain: np.ndarray, levels: np.ndarray, idf: np.ndarray):
        keys = plain.copy()
        for level in LEVELS:
            keys[levels == level] = at_level(plain[levels == level], level)
        order = np.argsort(keys)
        self.keys, self.idf = keys[order], idf[order].astype(np.float64)
        self.plain = np.unique(plain)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.plain >> np.uint64(44)] = True

    def vectors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) of the rows' unit TF-IDF vectors, by row and term."""
        row, key = terms(Words(column))
        likely = np.flatnonzero(self.maybe[key >> np.uint64(44)])
        row, key = row[likely], key[likely]
        if not len(self.keys) or not len(key):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        own = self.plain[np.minimum(np.searchsorted(self.plain, key), len(self.plain) - 1)] == key
        row, key, n = counted(row[own], key[own])
        found = []
        for level in LEVELS:
            enough = np.flatnonzero(n >= level)
            wanted = at_level(key[enough], level)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            known = self.keys[at] == wanted
            found.append((row[enough][known], at[known], (1 + np.log(n[enough][known]) if level == 1 else np.ones(known.sum())) * self.idf[at[known]]))
        row, term, x = (np.concatenate(v) for v in zip(*found, strict=True))
        order = np.lexsort((term, row))
        row, term, x = row[order], term[order], x[order]
        norm = np.sqrt(np.bincount(row, x * x, minlength=len(column)))
        return row, term, x / np.maximum(norm[row], 1e-12)


class Index:
    """Block-max inverted index over unit vectors."""

    def __init__(self, n_terms: int, n_rows: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.n_rows, self.n_blocks = n_rows, max(1, -(-n_rows // BLOCK))
        block = row // BLOCK
        slot = term * self.n_blocks + block
        order = np.argsort(slot * BLOCK + row % BLOCK, kind="stable")
        self.local, self.weight = (row % BLOCK)[order], weight[order]
        self.begin = np.searchsorted(slot[order], np.arange(n_terms * self.n_blocks + 1))
        self.most = np.zeros((n_terms, self.n_blocks))
        np.maximum.at(self.most, (term, block), weight)

    def nearest(self, n: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and numbers (n x k, -1: none) of the k nearest examples of n queries given by (row, term, weight)."""
        first = np.searchsorted(row, np.arange(n + 1))
        bound = np.zeros((n, self.n_blocks))
        filled = np.flatnonzero(np.diff(first))
        if len(filled):
            bound[filled] = np.add.reduceat(self.most[term] * weight[:, None], first[filled], axis=0)
        by_bound = np.argsort(-bound, axis=1, kind="stable")
        # similarity in units of 1e-12 and, below it, the number: one key orders both, lower numbers first where similarities are equal
        top = np.zeros((n, k), np.int64)
        live = filled
        for a in range(0, self.n_blocks, STEP):
            picked = by_bound[live, a : a + STEP]
            # a little slack: sums in another order may differ in the last digit
            alive = np.take_along_axis(bound[live], picked[:, :1], 1)[:, 0] > np.maximum((top[live, k - 1] >> NUMBER) * 1e-12 - 1e-9, 0)
            live, picked = live[alive], picked[alive]
            if not len(live):
                break
            width = picked.shape[1]
            pair_row, pair_block = np.repeat(live, width), picked.ravel()
            terms_of = first[pair_row + 1] - first[pair_row]
            pair = np.repeat(np.arange(len(pair_row)), terms_of)
            entry = np.arange(len(pair)) - np.repeat(np.cumsum(terms_of) - terms_of, terms_of) + first[pair_row][pair]
            slot = term[entry] * self.n_blocks + pair_block[pair]
            size = self.begin[slot + 1] - self.begin[slot]
            some = np.flatnonzero(size)
            pair, entry, slot, size = pair[some], entry[some], slot[some], size[some]
            post = np.repeat(self.begin[slot] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            score = np.bincount(np.repeat(pair * BLOCK, size) + self.local[post], np.repeat(weight[entry], size) * self.weight[post], minlength=len(pair_row) * BLOCK)
            number = ((picked[:, :, None] * BLOCK) + np.arange(BLOCK)).reshape(len(live), -1)
            key = np.rint(score * 1e12).astype(np.int64).reshape(len(live), -1)
            key = np.where(key > 0, key << NUMBER | (1 << NUMBER) - 1 - number, 0)
            key = np.concatenate([top[live], key], axis=1)
            key.partition(key.shape[1] - k, axis=1)
            top[live] = -np.sort(-key[:, -k:], axis=1)
        return (top >> NUMBER) * 1e-12, np.where(top > 0, (1 << NUMBER) - 1 - (top & (1 << NUMBER) - 1), -1)


class Model:
    """Vocabulary, index, labels and ids of the examples, and the calibration curve."""

    def __init__(self, vocabulary: Vocabulary, index: Index, labels: np.ndarray, ids: list):
        self.vocabulary, self.index, self.labels, self.ids = vocabulary, index, labels, ids
        self.slope, self.offset, self.none = 1.0, 0.0, 0.0
        self.constant: float | None = None

    def votes(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vote of each row (-1: no neighbour), similarities and neighbours."""
        best, who = self.index.nearest(len(column), *self.vocabulary.vectors(column))
        total = best.sum(axis=1)
        vote = (best * np.where(who >= 0, self.labels[who], 0)).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where(total > 0, vote, -1.0), best, who

    def calibrated(self, vote: np.ndarray) -> np.ndarray:
        return np.where(vote < 0, self.none, 1 / (1 + np.exp(-(self.slope * vote + self.offset))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve (Newton steps, a little ridge)."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (p - y) * x).sum() + 0.01 * a, (weight * (p - y)).sum() + 0.01 * b])
        h = weight * p * (1 - p)
        m = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        d = np.linalg.solve(m, g)
        a, b = a - d[0], b - d[1]
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, each: int = EACH) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` with labels 0 and 1."""
    spark = docs.sparkSession
    drawn, shares = labelled_sample(docs, labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")), each, 2)
    empty = Model(Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)), Index(1, 0, *(np.zeros(0, np.int64),) * 3), np.zeros(0), [])
    if len(shares) < 2:
        empty.constant = float(bool(shares.get(1)))
        return empty
    sample = drawn.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(22)), F.lit(3))).repartition(12).cache()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, key, times = counted(*terms(Words(batch.column("text"))))
            label = batch.column("label").to_numpy()
            for level in LEVELS:
                some = times >= level
                keys, at = np.unique(key[some], return_inverse=True)
                n, n1 = np.bincount(at, minlength=len(keys)), np.bincount(at, label[row[some]], minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array([level] * len(keys), pa.int32()), pa.array(n, pa.int64()), pa.array(n1.astype(np.int64))], ["key", "level", "n", "n1"])

    total = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    t1, t0 = float(total.get(1, 0)), float(total.get(0, 0))
    if not t1 or not t0:
        empty.constant = shares[1] / sum(shares.values())
        return empty
    found = sample.select("text", "label").mapInArrow(count, "key long, level int, n long, n1 long").groupBy("key", "level").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1")).where(F.col("n") >= LEAST)
    a, b = F.col("n1"), F.col("n") - F.col("n1")
    c, d = F.lit(t1) - a, F.lit(t0) - b
    chi = (a * d - b * c) * (a * d - b * c) * F.lit(t1 + t0) / (F.lit(t1) * F.lit(t0) * F.col("n") * F.greatest(F.lit(t1 + t0) - F.col("n"), F.lit(1.0)))
    top = found.withColumn("chi", chi).where(F.col("chi") > CHI).orderBy(F.desc("chi"), "key", "level").limit(TERMS).collect()
    vocabulary = Vocabulary(np.array([r.key for r in top], np.int64).view(np.uint64), np.array([r.level for r in top], np.int64), np.log((1 + t1 + t0) / (1 + np.array([r.n for r in top], np.float64))) + 1)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, term, x = vocabulary.vectors(batch.column("text"))
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            cut = lambda v, kind: pa.array([v[a:b].astype(kind).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), cut(term, "<u2"), cut(x, "<f8")], ["doc_id", "label", "term", "x"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.where("part > 0").select("doc_id", "text", "label").mapInArrow(vectors, f"doc_id {kind}, label int, term binary, x binary").orderBy("doc_id", "term", "label").collect()
    # examples that share their heaviest terms share a block, so that blocks differ and bounds tell
    heavy = [np.frombuffer(r.term, "<u2")[np.argsort(-np.frombuffer(r.x, "<f8"), kind="stable")[:2]].tolist() for r in got]
    got = [got[i] for i in sorted(range(len(got)), key=lambda i: (got[i].label, heavy[i], i))]
    n = [len(r.term) // 2 for r in got]
    row = np.repeat(np.arange(len(got)), n)
    term = np.frombuffer(b"".join(bytes(r.term) for r in got), "<u2").astype(np.int64)
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), "<f8")
    model = Model(vocabulary, Index(max(len(top), 1), len(got), row, term, x), np.array([r.label for r in got] + [0], np.float64), [r.doc_id for r in got])

    shared = spark.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            v, _, _ = shared.value.votes(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(v), batch.column("label")], ["vote", "label"])

    held = sample.where("part = 0").select("text", "label").mapInArrow(vote, "vote double, label int").collect()
    sample.unpersist()
    v, y = np.array([r.vote for r in held]), np.array([r.label for r in held], np.float64)
    # the sample has as many rows of each class; weights bring back the true shares
    all_rows = shares[0] + shares[1]
    w = np.where(y == 1, shares[1] / all_rows / max((y == 1).sum(), 1), shares[0] / all_rows / max((y == 0).sum(), 1)) * len(y)
    some = v >= 0
    model.slope, model.offset = _logistic(v[some], y[some], w[some]) if some.any() else (0.0, -3.0)
    model.none = float((w * y)[~some].sum() + 0.01) / float(w[~some].sum() + 1)
    return model


def predict(docs: DataFrame, model: Model, evidence: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with _score, _vote and _evidence (doc_id, similarity, label of the nearest examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_kind = "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, text, 1 << 20):
            if own.constant is not None:
                score, vote, shown = np.full(batch.num_rows, own.constant), np.full(batch.num_rows, -1.0), [[] for _ in range(batch.num_rows)]
            else:
                vote, best, who = own.votes(batch.column(text))
                score = own.calibrated(vote)
                shown = [[{"doc_id": str(own.ids[w]), "similarity": float(s), "label": int(own.labels[w])} for s, w in zip(best[r, :evidence], who[r, :evidence], strict=True) if w >= 0] if vote[r] >= 0 else [] for r in range(batch.num_rows)]
            kind = pa.list_(pa.struct([("doc_id", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(vote), pa.array(shown, kind)], [*batch.schema.names, "_score", "_vote", "_evidence"])

    return docs.mapInArrow(run, schema_of(docs) + f", _score double, _vote double, _evidence array<struct<doc_id: {id_kind}, similarity: double, label: int>>")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with their columns as they are."""
    kept = predict(set_apart(docs, "text"), model, evidence=0).where(F.col("_score") < threshold).drop("_score", "_vote", "_evidence")
    return kept.toDF(*docs.columns)
