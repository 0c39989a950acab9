import re
import time

import numpy as np
import pyarrow as pa
from conftest import DATA, same_rows
from odd import TEXTS, none, odd

from tracelake.llm import decontamination, oracles, registry
from tracelake.llm.common import Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    """n_words, hit words, items and longest match of each text."""
    out = []
    for text in docs:
        own, hit, names, longest = words(text), set(), set(), 0
        for name, body in items:
            test = words(body)
            n = min(10, len(test))
            for j in range(len(test) - n + 1 if n else 0):
                for i in range(len(own) - n + 1):
                    if own[i : i + n] == test[j : j + n]:
                        hit |= set(range(i, i + n))
                        names.add(name)
                        k = n
                        while i + k < len(own) and j + k < len(test) and own[i + k] == test[j + k]:
                            k += 1
                        longest = max(longest, k)
        out.append((len(own), len(hit), sorted(names), longest))
    return out


def test_suffix_array_is_sorted():
    ids = np.random.default_rng(0).integers(0, 4, 500)
    order = decontamination.suffix_array(ids)
    tail = lambda p: [*ids[p : p + 16].tolist(), *[0] * max(0, p + 16 - 500)]
    assert sorted(order.tolist()) == list(range(500)) and all(tail(a) <= tail(b) for a, b in zip(order[:-1], order[1:], strict=True))


def test_words_equal_the_pattern():
    for _, text, _, _ in TEXTS:
        w = Words(pa.array([text], pa.string()))
        assert [w.word(k).decode() for k in range(len(w.key))] == words(text)


def test_random_texts_equal_brute_force():
    r = np.random.default_rng(1)
    text = lambda n: " ".join("abc"[k] for k in r.integers(0, 3, n))
    docs = [text(int(r.integers(0, 60))) for _ in range(60)] + [None, "", "a"]
    items = [(f"i{k}", text(int(r.integers(0, 25)))) for k in range(12)] + [("short", "a b"), ("none", "..."), ("i0", "c c c c c c c c c c")]
    got = decontamination._hits(pa.array(docs, pa.string()), decontamination.Tests(items))
    assert [(n, sum(s["end"] - s["begin"] for s in spans), names, longest) for n, spans, names, longest in got] == brute(docs, items)


def test_query_equals_its_sql(spark):
    same_rows(registry.op7_decontamination(spark, DATA), oracles.OP7, {t: f"{DATA}/{t}.parquet" for t in ("documents", "benchmark")})


def test_blocks_of_a_large_benchmark_give_the_same(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    pick = lambda df: sorted((r.doc_id, str(r._spans), r._items, r._longest) for r in df.collect())
    assert pick(decontamination.matches(docs, bench, limit=2000)) == pick(decontamination.matches(docs, bench))


def test_odd_rows(spark):
    docs = odd(spark)
    bench = spark.createDataFrame([(1, "second line of it"), (None, "naïve"), (3, None), (4, ""), (4, "lorem ipsum"), (4, "lorem ipsum")], "item_id long, text string")
    out = decontamination.decontaminate(docs, bench)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in (1, 4, 6))
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontamination.report(none(spark), bench).count() == 0


def test_many_items_that_share_one_window():
    r = np.random.default_rng(3)
    shared = " ".join(f"w{k}" for k in range(10))
    more = lambda: " ".join(f"x{k}" for k in r.integers(0, 3, 4))
    items = [(f"i{k}", f"{shared} {more()}") for k in range(2000)]
    docs = [f"a b {shared} {more()}" for _ in range(3000)] + ["none of it"]
    tests = decontamination.Tests(items)
    begun = time.process_time()
    got = decontamination._hits(pa.array(docs), tests)
    assert time.process_time() - begun < 5
    few = [0, 1, 2, 3000]
    assert [(got[d][0], sum(s["end"] - s["begin"] for s in got[d][1]), got[d][2], got[d][3]) for d in few] == brute([docs[d] for d in few], items)
    assert len(tests.size) <= 1 + 4 * 3**4 and len(got[0][2]) == 2000
