import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from conftest import DATA
from odd import TEXTS, none, odd
from pyspark.sql import functions as F

from tracelake.llm import context_tree, registry
from tracelake.llm.context_tree import DEPTH, score


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


class Plain:
    """Context-tree weighting by dictionaries and recursion."""

    def __init__(self, texts):
        self.counts, self.children = {}, {}
        for text in texts:
            for context, prefix, bit in self.bits(text):
                for d in range(DEPTH + 1):
                    node = (context[:d], prefix)
                    self.counts.setdefault(node, [0, 0])[bit] += 1
                    if d:
                        self.children.setdefault((context[: d - 1], prefix), set()).add(node)
        self.memo = {}

    @staticmethod
    def bits(text):
        """(bytes before, the last one first; bits before in this byte; bit)."""
        stream = b"\xff" * DEPTH + lowered(text) + b"\xff"
        for i in range(DEPTH, len(stream)):
            for b in range(8):
                yield stream[i - DEPTH : i][::-1], (b, stream[i] >> (8 - b)), stream[i] >> (7 - b) & 1

    def own(self, node):
        zeros, ones = self.counts[node]
        return sum(math.log((k + 0.5) / (k + j + 1)) for j, n in ((0, zeros),) for k in range(n)) + sum(math.log((k + 0.5) / (zeros + k + 1)) for k in range(ones))

    def below(self, node):
        return sum(self.weighted(c) for c in self.children.get(node, ()))

    def weighted(self, node):
        if node not in self.memo:
            own = self.own(node)
            if len(node[0]) == DEPTH:
                self.memo[node] = own
            else:
                below = self.below(node)
                top = max(own, below)
                self.memo[node] = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
        return self.memo[node]

    def predict(self, context, prefix, bit, d=0):
        node = (context[:d], prefix)
        if node not in self.counts:
            return 0.5
        counts = self.counts[node]
        own = (counts[bit] + 0.5) / (sum(counts) + 1)
        if d == DEPTH or (context[: d + 1], prefix) not in self.counts:
            return own
        share = 1 / (1 + math.exp(min(700, self.below(node) - self.own(node))))
        return share * own + (1 - share) * self.predict(context, prefix, bit, d + 1)

    def log10(self, text):
        return sum(math.log10(self.predict(*x)) for x in self.bits(text))


def expected(rows, modulus):
    """doc_id, tokens, known, N, base, score of (doc_id, text) rows."""
    learnt = [t for d, t in rows if crc32(str(d).encode() if d is not None else b"") % modulus]
    words = Counter(w for t in learnt for w in [*lowered(t).split(), b""])
    n, v = sum(words.values()), len(words)
    tree, out = Plain(learnt), []
    for d, t in rows:
        own = [*lowered(t).split(), b""]
        out.append((d, len(own), sum(words[w] > 0 for w in own), n, sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), tree.log10(t)))
    return out


def close(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[5], 5))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(a[:4]) == tuple(b[:4])
        assert a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9) and a[5] == pytest.approx(b[5], rel=1e-8, abs=1e-8), (a, b)


TALE = ["The cat sat on the mat.", "the cat ran", "A dog ran on the mat, a dog sat.", "größe 東京", "zebra quagga", "", None, "the cat sat on the mat. The end\n\tof  it"]


def scores(docs, modulus):
    out = score(docs, ~registry.held_out("doc_id", modulus, 0))
    return [(r["doc_id"], r["_n_tokens"], r["_n_known"], r["_train_tokens"], r["_base"], r["_log10"]) for r in out.collect()]


def test_equals_recursion(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TALE * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows, 3)
    close(scores(docs, 3), want)
    # small slices and pieces, several batches and many partitions give the same
    monkeypatch.setattr(context_tree, "SLICE", 40)
    monkeypatch.setattr(context_tree, "PIECE", 16)
    close(scores(docs.repartition(3), 3), want)


def test_odd_rows(spark):
    rows = [(d, t if t is None or len(t) < 1000 else t[::25][:900]) for d, t, *_ in TEXTS]
    docs = odd(spark).drop("text").limit(0)
    docs = spark.createDataFrame([(d, t, "extra", "extra", "extra") for d, t in rows], "doc_id long, text string, _kind string, own0 string, _learn string")
    close(scores(docs, 2), expected(rows, 2))
    out = score(odd(spark), F.lit(True))
    assert out.count() == len(TEXTS) and set(odd(spark).columns) < set(out.columns)
    assert score(none(spark), F.lit(True)).count() == 0


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, "ab c"), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in score(docs, F.lit(None).cast("boolean")).collect()}
    assert out[1]["_log10"] == pytest.approx(-5 * math.log10(256)) and out[1]["_base"] == pytest.approx(0) and out[1]["_n_known"] == 0
    assert out[2]["_n_tokens"] == 1 and out[2]["_log10"] == pytest.approx(-math.log10(256)) and out[2]["_bits_per_byte"] == pytest.approx(8)


def test_krichevsky_trofimov_estimates():
    zeros, ones = np.array([0, 1, 3, 5000, 10**6, 10**9]), np.array([0, 0, 2, 4095, 4097, 10**9])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(zeros.tolist(), ones.tolist(), strict=True)]
    assert np.allclose(context_tree.kt(zeros + ones, ones), want, rtol=1e-9, atol=1e-9)


def test_whole_query(spark):
    out = registry.op13_context_tree(spark, DATA).toPandas()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    learnt = [t for d, t in docs.items() if crc32(str(d).encode()) % 10]
    words = Counter(w for t in learnt for w in [*lowered(t).split(), b""])
    assert len(out) == len(docs) and set(out.train_tokens) == {sum(words.values())}
    for r in out.itertuples():
        own = [*lowered(docs[r.doc_id]).split(), b""]
        assert (r.held_out, r.n_tokens, r.n_known) == (crc32(str(r.doc_id).encode()) % 10 == 0, len(own), sum(words[w] > 0 for w in own))
    held = out[out.held_out]
    assert held.bits_per_byte.mean() < 2.5


def test_learnt_passages_and_noise(spark):
    r = np.random.default_rng(3)
    lines = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega"], 30)) for _ in range(50)]
    noise = ["".join(map(chr, r.integers(97, 123, 150))) for _ in range(5)]
    rows = [(k, t, k < 50) for k, t in enumerate(lines + lines[:5] + noise)]
    out = {x.doc_id: x["_bits_per_byte"] for x in score(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), F.col("train")).collect()}
    assert max(out[k] for k in range(50, 55)) < 1 and min(out[k] for k in range(55, 60)) > 4


def test_a_very_long_text(spark):
    text = " ".join(str(k * 7919 % 100_003) for k in range(800_000))
    docs = spark.createDataFrame([(1, text), (2, text[:2000])], "doc_id long, text string")
    out = {x.doc_id: x for x in score(docs, F.lit(True)).collect()}
    assert out[1]["_n_tokens"] == 800_001 and out[2]["_n_tokens"] == len(text[:2000].split()) + 1
    assert out[1]["_log10"] < out[2]["_log10"] < 0
