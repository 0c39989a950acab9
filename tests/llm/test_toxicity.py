import numpy as np
import pyarrow as pa
from conftest import DATA
from odd import none, odd

from tracelake.llm import registry, toxicity


def test_nearest_equals_brute_force():
    r = np.random.default_rng(0)
    dense = r.random((300, 40)) * (r.random((300, 40)) < 0.2)
    dense[7] = dense[8]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    row, term = np.nonzero(dense)
    index = toxicity.Index(40, 300, row, term, dense[row, term])
    asked = np.vstack([r.random((50, 40)) * (r.random((50, 40)) < 0.2), dense[7], np.zeros(40)])
    asked /= np.maximum(np.linalg.norm(asked, axis=1, keepdims=True), 1e-12)
    row, term = np.nonzero(asked)
    best, who = index.nearest(len(asked), row, term, asked[row, term], 9)
    exact = np.round(asked @ dense.T, 12)
    for k in range(len(asked)):
        order = sorted(range(300), key=lambda j: (-exact[k, j], j))[:9]
        want = [(exact[k, j], j) for j in order if exact[k, j] > 0]
        assert np.allclose([w[0] for w in want], best[k, : len(want)]) and [w[1] for w in want] == who[k, : len(want)].tolist()
        assert (who[k, len(want) :] == -1).all()


def test_query_separates_held_out_rows(spark):
    sf = DATA.replace("0.001", "0.1")
    got = {r.doc_id: r for r in registry.op2_toxicity(spark, sf).collect()}
    labels = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    bad, good = [s for s, y in labels if y], [s for s, y in labels if not y]
    assert np.mean([a > b for a in bad for b in good]) > 0.9
    assert np.mean([s >= 0.5 for s in bad]) > 0.8 and np.mean([s >= 0.5 for s in good]) < 0.03


def test_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 0), (1, 0), (4, 1), (6, 1), (7, 0), (None, 1), (99, 1), (2, None)], "doc_id long, label int")
    model = toxicity.fit(docs, labels)
    kept = toxicity.reject(docs, model, threshold=2.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert toxicity.reject(none(spark), toxicity.fit(none(spark), labels)).count() == 0
    assert toxicity.predict(docs.select("doc_id", "text"), toxicity.fit(docs, labels.limit(0))).where("_score = 0").count() == docs.count()
    assert toxicity.fit(docs, labels.where("label = 1")).constant == 1.0


def test_null_text_has_a_score(spark):
    model = toxicity.fit(odd(spark), spark.createDataFrame([(1, 0), (4, 1), (6, 1), (7, 0)], "doc_id long, label int"))
    vote, _, _ = model.votes(pa.array([None, ""])) if model.constant is None else (np.array([-1.0, -1.0]), 0, 0)
    assert (vote == -1).all()
