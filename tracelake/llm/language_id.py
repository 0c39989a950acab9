"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Learning takes a bounded sample (``EACH`` rows in expectation for each language, ``ROWS``
in all, chosen by a hash of the id; whole texts). Spark counts n-gram document
frequencies over the sample; the vocabulary is the ``FEATURES`` most frequent n-grams of
1 to 3 characters. The weights are learned by follow-the-regularised-leader
(FTRL-Proximal) with L1 and L2 penalties, so most are exactly 0; a part of the
sample that training leaves out then fits the softmax temperature.

Characters: letters of every script, lower-cased; whatever is no letter is a blank, and a
run of blanks is one. An n-gram is its code points side by side in 63 bits, so no two are
confused. Texts are scored whole, ``PIECE`` characters at a time.

Defined results: ``und`` with score 0 where the text is null or has no letter, or
where no labelled row exists; with one language that language; of equal scores the
language that sorts first; other columns are not read; repeated rows each get their row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, slices

EACH, ROWS, FEATURES, PIECE = 400, 20_000, 6000, 1 << 20
_tables: dict[str, np.ndarray] = {}


def _symbols() -> np.ndarray:
    """The symbol of each code point: 1 for a blank, else 1 and the lower-case code point."""
    if not _tables:
        own = np.ones(0x110000, np.int64)
        for c in range(0x110000):
            if unicodedata.category(ch := chr(c))[0] == "L":
                own[c] = 1 + (ord(low) if len(low := ch.lower()) == 1 else c)
        _tables["symbols"] = own
    return _tables["symbols"]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(text: str, piece: int = PIECE) -> Iterator[np.ndarray]:
    """Codes of all n-grams of 1 to 3 symbols of a text, piece by piece."""
    symbols, before = _symbols(), np.zeros(0, np.int64)
    for a in range(0, len(text), piece):
        s = symbols[code_points(text[a : a + piece])]
        blank = s == 1
        s = s[~(blank & np.concatenate([[len(before) > 0 and before[-1] == 1], blank[:-1]]))]
        if not len(s):
            continue
        n = len(before)
        s = np.concatenate([before, s])
        two = (s[:-1] << 21) | s[1:]
        three = (two[:-1] << 21) | s[2:]
        # those that lie in the pieces before whole were given there
        yield np.concatenate([s[n:], two[max(n - 1, 0) :], three])
        before = s[-2:]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


class Model:
    """Sorted n-gram codes with their idf, weights by language and the temperature."""

    def __init__(self, codes: np.ndarray, idf: np.ndarray, languages: list[str]):
        order = np.argsort(codes)
        self.codes, self.idf, self.languages = codes[order], idf[order].astype(np.float32), languages
        self.weights = np.zeros((len(codes), len(languages)), np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.temperature = 1.0

    def open(self) -> Model:
        # a table of hashes leaves most other n-grams out before they are searched for
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.codes)] = True
        return self

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and TF-IDF values of unit length."""
        n = np.zeros(len(self.codes), np.int64)
        for codes in grams(text):
            codes = codes[self.maybe[self._slot(codes)]]
            at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
            n += np.bincount(at[self.codes[at] == codes], minlength=len(self.codes))
        at = np.flatnonzero(n)
        x = (1 + np.log(n[at])).astype(np.float32) * self.idf[at]
        return at, x / max(float(np.sqrt((x * x).sum())), 1e-12)

    def scores(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = (x @ self.weights[at] + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def learn_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, epochs: int = 6, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-Proximal with elastic net for the softmax loss: weights (features x classes) and bias."""
    z, n = np.zeros((n_features + 1, n_classes)), np.zeros((n_features + 1, n_classes))

    def now(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, n_features), np.append(x, 1.0)
            w = now(at)
            p = x @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = now(np.arange(n_features + 1))
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def _temperature(model: Model, rows: list) -> float:
    """The temperature with the least log loss on rows that training did not see."""
    if not rows:
        return 1.0
    z = np.array([x @ model.weights[at] + model.bias for at, x, _ in rows])
    y = np.array([r[2] for r in rows])

    def loss(t: float) -> float:
        s = z / t
        s -= s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    return min((float(t) for t in np.geomspace(0.05, 5, 60)), key=loss)


def fit(labelled: DataFrame, each: int = EACH, features: int = FEATURES) -> Model | None:
    """Learn from ``labelled(doc_id, text, lang)``; None if it has no labelled text."""
    own = labelled.where("text is not null")
    sample = labelled_sample(own, own.select("doc_id", F.col("lang").alias("label")), each, 10, ROWS)[0].withColumnRenamed("label", "lang").repartition(12).cache()
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    if not languages:
        return None

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            each = [np.unique(np.concatenate(list(grams(t.as_py())) or [np.zeros(0, np.int64)])) for t in batch.column("text")]
            c, n = np.unique(np.concatenate(each), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n, pa.int64())], ["c", "n"])

    df = sample.select("text").mapInArrow(count_grams, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))
    top = df.orderBy(F.desc("n"), "c").limit(features).collect()
    n_rows = sample.count()
    model = Model(np.array([r[0] for r in top], np.int64), np.log((1 + n_rows) / (1 + np.array([r[1] for r in top], np.float64))) + 1, languages)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.open()
        for batch in batches:
            rows = [own.vector(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([a.astype("<u4").tobytes() for a, _ in rows], pa.binary()), pa.array([x.tobytes() for _, x in rows], pa.binary())], ["doc_id", "lang", "at", "x"])

    # at most ROWS rows of at most `features` pairs
    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(vectors, f"doc_id {kind}, lang string, at binary, x binary").select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)).alias("k"), "lang", "at", "x").orderBy(F.xxhash64("at", "x", "lang")).collect()
    sample.unpersist()
    rows = [(r.k, np.frombuffer(r.at, "<u4").astype(np.int64), np.frombuffer(r.x, np.float32), languages.index(r.lang)) for r in got]
    train, rest = [r[1:] for r in rows if r[0]], [r[1:] for r in rows if not r[0]]
    model.weights, model.bias = learn_ftrl(train or rest, len(model.codes), len(languages))
    model.temperature = _temperature(model, rest)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of each row of ``docs(doc_id, text)``; one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value and shared.value.open()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                if own is None or not has_letter(text):
                    langs.append("und"), scores.append(0.0)
                    continue
                s = own.scores(*own.vector(text))
                k = int(s.argmax())
                langs.append(own.languages[k]), scores.append(float(s[k]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
