from collections import Counter

from conftest import DATA, same_rows
from odd import TEXTS, none, odd

from tracelake.llm import line_dedup, oracles, registry


def brute(rows):
    """rows: distinct (doc_id, text); chunks of two or more lines stay in their first place alone."""
    place, kept = {}, {}
    cut = lambda text: [b"\n".join(text.encode().split(b"\n")[a:b]) for a, b in line_dedup.chunks(text.encode().split(b"\n"))]
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, body in enumerate(cut(text) if text is not None else ()):
            place.setdefault(body, (doc_id, k))
    for doc_id, text in rows:
        if text is None:
            kept[doc_id] = None
            continue
        kept[doc_id] = b"\n".join(b for k, b in enumerate(cut(text)) if b"\n" not in b or place[b] == (doc_id, k)).decode()
    return kept


def test_query_equals_brute_force_and_sql(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    out = registry.op5_line_dedup(spark, DATA)
    assert {r.doc_id: r.text for r in out.collect()} == brute(rows)
    same_rows(out, oracles.OP5, {"documents": f"{DATA}/documents.parquet"})


def test_a_passage_moved_elsewhere_is_found(spark):
    passage = "\n".join(f"line {k} of the passage that repeats" for k in range(60))
    docs = spark.createDataFrame([(1, "head\n" + passage + "\ntail"), (2, "other\nwords\nhere\n" + passage), (3, "clean\ntext")], "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.remove_repeats(docs).collect()}
    assert out[1]._n_removed == 0 and out[3]._n_removed == 0 and out[2]._n_removed > 40 and out[2].text.startswith("other\nwords")


def test_odd_rows(spark):
    docs = odd(spark)
    out = line_dedup.remove_repeats(docs)
    want = brute({r[:2] for r in TEXTS})
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r[0], want[r[0]]) for r in TEXTS)
    assert [c for c in out.columns if c not in ("_n_lines", "_n_removed")] == [c for c in docs.columns if c not in ("_n_lines", "_n_removed")]
    assert line_dedup.remove_repeats(none(spark)).count() == 0
