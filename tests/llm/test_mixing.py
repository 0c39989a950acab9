from collections import Counter, defaultdict

from conftest import DATA, same_rows
from odd import TEXTS, none, odd

from tracelake.llm import mixing, oracles, registry


def test_query_equals_its_sql_and_targets(spark):
    out = registry.op9_mixing(spark, DATA)
    same_rows(out, oracles.OP9, {"documents": f"{DATA}/documents.parquet"})
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in out.collect():
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(r.size for r in out.collect())) < 1


def test_joined_plan_gives_the_same(spark, monkeypatch):
    want = Counter(map(str, registry.op9_mixing(spark, DATA).collect()))
    monkeypatch.setattr(mixing, "BROADCAST", 0)
    assert Counter(map(str, registry.op9_mixing(spark, DATA).collect())) == want


def test_heavier_documents_come_first(spark):
    rows = [(d, "word " * 50 if d % 2 else "extraordinarilylongwords " * 50, "s") for d in range(400)] + [(1000 + d, "word " * 500, "t") for d in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r.copies for r in mixing.mix(docs, total=0.25).collect()}
    assert sum(out[d] for d in range(1, 400, 2)) > 1.1 * sum(out[d] for d in range(0, 400, 2))


def test_odd_rows(spark):
    docs = odd(spark)
    out = mixing.mix(docs).collect()
    assert len(out) == len(TEXTS) and all(r.taken == r.size * r.copies and r.taken <= 2 * r.size for r in out)
    same_rows(mixing.mix(docs), oracles.OP9.replace("SELECT doc_id,", "SELECT doc_id,", 1), {"documents": docs.select("doc_id", "text", "source").toArrow()})
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(none(spark)).count() == 0 and mixing.mixture(none(spark)).count() == 0
