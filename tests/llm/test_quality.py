import numpy as np
import pyarrow as pa
from conftest import DATA
from odd import none, odd

from tracelake.llm import quality_cnn, registry


def test_every_byte_counts():
    net = quality_cnn.Net()
    text = "a" * 5000
    base = quality_cnn.score_column(net, pa.array([text]))[0]
    for at in (0, 2500, 4990):
        assert quality_cnn.score_column(net, pa.array([text[:at] + "#%&!@$#%" + text[at + 8 :]]))[0] != base


def test_pooling_equals_a_plain_loop():
    net, r = quality_cnn.Net(), np.random.default_rng(0)
    raw = r.integers(0, 512, 700)
    pooled, first = quality_cnn.pool(net, raw, np.array([0, 700]))
    full = np.concatenate([raw, np.full(6 * 128 - 700 + quality_cnn.TAPS, 32)])
    for k in range(first[1]):
        best = np.zeros(quality_cnn.FILTERS)
        for p in range(k * 128, k * 128 + 256, quality_cnn.STRIDE):
            a = net.bias + sum(net.bytes_[j, full[p + j]] for j in range(quality_cnn.TAPS))
            best = np.maximum(best, a)
        assert np.allclose(best, pooled[k], atol=1e-5)


def test_query_separates_held_out_rows(spark):
    sf = DATA.replace("0.001", "0.01")
    got = {r.doc_id: r for r in registry.op4_quality(spark, sf).collect()}
    rows = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([g.predicted == y for g, y in rows]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 0), (4, 1), (6, 1), (7, 0), (3, 1), (None, 1), (2, None)], "doc_id long, label int")
    for own, n in ((docs, docs.count()), (none(spark), 0)):
        out = quality_cnn.predict(own, quality_cnn.fit(docs, labels)).collect()
        assert len(out) == n and all(0 <= r.score <= 1 for r in out)
    assert quality_cnn.fit(docs, labels.limit(0)).constant == 0.5


def test_windows_of_a_long_row_give_what_the_whole_gives():
    r = np.random.default_rng(6)
    net = quality_cnn.Net()
    text = "".join("abcdefghij \n"[k] for k in r.integers(0, 12, 9000)) + "again and again " * 300
    raw = np.frombuffer(text.encode(), np.uint8)
    whole, _ = quality_cnn.pool(net, *quality_cnn.symbols_of(pa.array([text])))
    for window in (1, 2, 5, 1000):
        assert np.allclose(quality_cnn.pool_long(net, raw, window), whole, atol=1e-6)


def test_a_very_long_text_takes_bounded_memory():
    import tracemalloc

    net, text = quality_cnn.Net(), pa.array(["some words of a long text, " * 500_000])
    tracemalloc.start()
    score = quality_cnn.score_column(net, text)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 <= score <= 1 and peak < 250 << 20


def test_scores_equal_a_plain_loop():
    net, r = quality_cnn.Net(), np.random.default_rng(8)
    for n in (0, 5, 300, 1000):
        raw = r.integers(97, 100, n).astype(np.uint8)
        seen = [int(k + quality_cnn.ECHO <= n and any((raw[k - d : k - d + quality_cnn.ECHO] == raw[k : k + quality_cnn.ECHO]).all() for d in range(1, min(k, quality_cnn.REACH) + 1))) for k in range(n)]
        halves = max(2, -(-n // 128))
        x = np.full(halves * 128 + quality_cnn.TAPS, 32)
        x[:n] = raw + 256 * np.array(seen, int)
        act = np.array([np.maximum(net.bias + sum(net.bytes_[j, x[p + j]] for j in range(quality_cnn.TAPS)), 0) for p in range(0, halves * 128, quality_cnn.STRIDE)])
        chunks = [act[k * 64 : k * 64 + 128].max(axis=0) for k in range(halves - 1)]
        s = np.array([np.maximum(c @ net.w1 + net.b1, 0) @ net.w2 + net.b2[0] for c in chunks])
        z = net.top[0] * s.mean() + net.top[1] * np.log(np.exp(s).mean()) + net.top[2]
        assert np.isclose(quality_cnn.score_column(net, pa.array([raw.tobytes().decode()]))[0], 1 / (1 + np.exp(-z)), atol=1e-4)
