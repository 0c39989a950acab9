"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read by ``FILTERS`` learned filters of ``TAPS`` positions,
``STRIDE`` bytes apart. Each position offers two channels: the byte, and whether
the last ``ECHO`` bytes stood in the text already a short while before (within
``REACH`` bytes; repetition that no fixed filter can see). Activations are
max-pooled over chunks of ``CHUNK`` bytes that overlap by half and cover the whole
text; a hidden layer scores each chunk; the mean and the smooth maximum over chunks
make one probability.

Learning takes a bounded sample (``EACH`` labelled rows of each class in
expectation, by a hash of the id), of each at most ``CHUNKS`` chunks spread over
the whole text; the driver holds at most 2 * EACH * CHUNKS * CHUNK * 2 bytes. Scoring
reads every byte.

Defined results: null and empty text are scored as one blank chunk; without
labelled rows of both classes every score is the share of label 1 (0.5 if there is
none); other columns are not read; repeated rows each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, slices, utf8

FILTERS, TAPS, STRIDE, CHUNK, HIDDEN = 16, 8, 2, 256, 16
ECHO, REACH = 6, 512
EACH, CHUNKS = 1500, 12
#: A longer row is scored by itself, so many bytes at a time.
LONG = 1 << 20


def echo(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 where the ECHO bytes from a position on stood already at most REACH bytes before, in the same row."""
    n = len(raw)
    out = np.zeros(n, np.uint8)
    if n <= ECHO:
        return out
    key = np.zeros(n, np.uint64)
    for k in range(ECHO):
        key[: n - k] |= raw[k:].astype(np.uint64) << np.uint64(8 * k)
    # hash and place in one number: a plain sort puts equal keys side by side in text order
    bits = np.uint64(n.bit_length())
    key = ((key * np.uint64(0x9E3779B97F4A7C15)) >> bits << bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    same = np.flatnonzero(key[1:] >> bits == key[:-1] >> bits)
    place = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    later, earlier = place[same + 1], place[same]
    near = later - earlier <= REACH
    later, earlier = later[near], earlier[near]
    row = np.searchsorted(at, later, "right") - 1
    out[later[(earlier >= at[row]) & (later + ECHO <= at[row + 1])]] = 1
    return out


class Net:
    """Weights; ``bytes_`` has a table of 512 rows for each tap: the byte, with and without the echo."""

    def __init__(self, seed: int = 4):
        r = np.random.default_rng(seed)
        self.bytes_ = (r.standard_normal((TAPS, 512, FILTERS)) * 0.1).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.w1 = (r.standard_normal((FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, np.float32)
        self.w2 = (r.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
        self.b2 = np.zeros(1, np.float32)
        # how the mean and the smooth maximum of chunk scores combine
        self.top = np.array([0.5, 0.5, 0.0], np.float32)
        self.constant: float | None = None

    def convolve(self, x: np.ndarray) -> np.ndarray:
        """Activations of whole rows of symbols: (positions, FILTERS)."""
        n = (len(x) - TAPS) // STRIDE + 1
        out = np.broadcast_to(self.bias, (n, FILTERS)).copy()
        for k in range(TAPS):
            out += self.bytes_[k].take(x[k : k + (n - 1) * STRIDE + 1 : STRIDE], axis=0)
        return np.maximum(out, 0, out)

    def chunk_scores(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.w1 + self.b1, 0) @ self.w2 + self.b2[0]

    def combine(self, s: np.ndarray) -> float:
        m = float(s.max())
        m += float(np.log(np.exp(s - m).mean()))
        z = self.top[0] * float(s.mean()) + self.top[1] * m + self.top[2]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def pool(net: Net, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled activations of the half-overlapping chunks of each row, and the first chunk of each row."""
    half = CHUNK // 2
    # each row is padded with blanks to whole half chunks (two at the least)
    n = np.diff(at)
    halves = np.maximum(2, -(-n // half))
    begin = np.concatenate([[0], np.cumsum(halves * half)])
    x = np.full(begin[-1] + TAPS, 32, np.int64)
    x[np.arange(len(symbols)) + np.repeat(begin[:-1] - at[:-1], n)] = symbols
    a = net.convolve(x)[: begin[-1] // STRIDE]
    a = a.reshape(-1, half // STRIDE, FILTERS).max(axis=1)
    # chunk k of a row: its halves k and k + 1
    both = np.maximum(a[:-1], a[1:]) if len(a) > 1 else a
    keep = np.ones(len(a), bool)
    keep[np.cumsum(halves) - 1] = False
    return both[keep[:-1]], np.concatenate([[0], np.cumsum(halves - 1)])


def pool_long(net: Net, raw: np.ndarray, window: int) -> np.ndarray:
    """The same for one long row of bytes, ``window`` halves of chunks at a time: memory does not grow with the row."""
    half = CHUNK // 2
    halves = max(2, -(-len(raw) // half))
    best = []
    for h in range(0, halves, window):
        begin, end = h * half, min(h + window, halves) * half
        # echoes look back REACH bytes, and a position reads TAPS bytes from its own on
        first = max(0, begin - REACH - ECHO)
        own = raw[first : end + TAPS + ECHO]
        symbols = own.astype(np.int64) + 256 * echo(own, np.array([0, len(own)])).astype(np.int64)
        x = np.full(end - begin + TAPS, 32, np.int64)
        inside = symbols[begin - first : end - first + TAPS]
        x[: len(inside)] = inside
        best.append(net.convolve(x)[: (end - begin) // STRIDE].reshape(-1, half // STRIDE, FILTERS).max(axis=1))
    a = np.concatenate(best)
    return np.maximum(a[:-1], a[1:])


def symbols_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, at = utf8(column)
    return raw.astype(np.int64) + 256 * echo(raw, at).astype(np.int64), at


def score_column(net: Net, column: pa.Array) -> list[float]:
    if net.constant is not None:
        return [net.constant] * len(column)
    if len(column) == 1 and column.nbytes > LONG:
        return [net.combine(net.chunk_scores(pool_long(net, utf8(column)[0], LONG // CHUNK)))]
    pooled, first = pool(net, *symbols_of(column))
    s = net.chunk_scores(pooled)
    return [net.combine(s[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def train(net: Net, docs: list[tuple[np.ndarray, int]], epochs: int = 10, batch: int = 32, rate: float = 0.004, seed: int = 5) -> None:
    """Adam on the log loss; ``docs``: (chunks x CHUNK symbols, label)."""
    r = np.random.default_rng(seed)
    params = [net.bytes_, net.bias, net.w1, net.b1, net.w2, net.b2, net.top]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    positions = (CHUNK - TAPS) // STRIDE + 1
    for _ in range(epochs):
        order = r.permutation(len(docs))
        for a in range(0, len(docs), batch):
            picked = [docs[k] for k in order[a : a + batch]]
            x = np.concatenate([d[0] for d in picked]).astype(np.int64)
            owner = np.repeat(np.arange(len(picked)), [len(d[0]) for d in picked])
            y = np.array([d[1] for d in picked], np.float32)
            c = len(x)
            conv = np.broadcast_to(net.bias, (c, positions, FILTERS)).copy()
            for k in range(TAPS):
                conv += net.bytes_[k].take(x[:, k : k + (positions - 1) * STRIDE + 1 : STRIDE], axis=0)
            best = conv.argmax(axis=1)
            raw = np.take_along_axis(conv, best[:, None], 1)[:, 0]
            pooled = np.maximum(raw, 0)
            hid = pooled @ net.w1 + net.b1
            act = np.maximum(hid, 0)
            s = act @ net.w2 + net.b2[0]
            count = np.bincount(owner)
            mean = np.bincount(owner, s) / count
            big = np.full(len(picked), -np.inf)
            np.maximum.at(big, owner, s)
            e = np.exp(s - big[owner])
            total = np.bincount(owner, e)
            soft = big + np.log(total / count)
            z = net.top[0] * mean + net.top[1] * soft + net.top[2]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            dz = (p - y) / len(picked)
            dtop = np.array([(dz * mean).sum(), (dz * soft).sum(), dz.sum()])
            ds = dz[owner] * (net.top[0] / count[owner] + net.top[1] * e / total[owner])
            dact = ds[:, None] * net.w2 * (hid > 0)
            draw = (dact @ net.w1.T) * (raw > 0)
            dbytes = np.zeros_like(net.bytes_)
            for k in range(TAPS):
                at = x[np.arange(c)[:, None], best * STRIDE + k]
                flat = at * FILTERS + np.arange(FILTERS)
                dbytes[k] = np.bincount(flat.ravel(), draw.ravel(), minlength=512 * FILTERS).reshape(512, FILTERS)
            grads = [dbytes, draw.sum(0), pooled.T @ dact, dact.sum(0), act.T @ ds, np.array([ds.sum()]), dtop]
            step += 1
            for i, (q, g) in enumerate(zip(params, grads, strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                q -= (rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, each: int = EACH) -> Net:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` with labels 0 and 1."""
    sample, _ = labelled_sample(docs, labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")), each, 4)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = CHUNK // 2
        for batch in slices(batches):
            symbols, at = symbols_of(batch.column("text"))
            chunks = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                n = max(2, -(-(b - a) // half))
                x = np.full(n * half, 32, np.int64)
                x[: b - a] = symbols[a:b]
                picks = np.unique(np.linspace(0, n - 2, min(CHUNKS, n - 1)).astype(int))
                chunks.append(np.stack([x[k * half : k * half + CHUNK] for k in picks]).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(chunks, pa.binary())], ["label", "chunks"])

    rows = sample.select("label", "text").mapInArrow(cut, "label int, chunks binary").collect()
    docs = sorted(((bytes(r.chunks), r.label) for r in rows), key=lambda d: (d[1], d[0]))
    net, ones = Net(), sum(y for _, y in docs)
    if not 0 < ones < len(docs):
        net.constant = ones / len(docs) if docs else 0.5
        return net
    train(net, [(np.frombuffer(x, "<u2").reshape(-1, CHUNK), y) for x, y in docs])
    return net


def predict(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, score of each row of ``docs(doc_id, text)``; one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=256 << 10):  # a longer row comes alone
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score_column(shared.value, batch.column("text")), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
