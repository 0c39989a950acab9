from collections import Counter, defaultdict

from conftest import DATA, same_rows
from odd import none, odd

from tracelake.llm import divergence, oracles, registry


def test_query_equals_its_sql(spark):
    same_rows(registry.op12_divergence(spark, DATA), oracles.OP12, {"documents": f"{DATA}/documents.parquet"})


def plain(rows):
    """The audit by loops over dictionaries."""
    terms = lambda text: "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or c > "\x7f" else " " for c in text or "").split(" ")
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        own = [t for t in terms(text) if t]
        counts[lang, source].update(own)
        held[lang].update(set(own))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= 3]
        every = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}
        p, q = {s: share(counts[lang, s]) for s in sources}, share(every)
        for s in sources:
            parts = {"pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]}
            parts["term"] = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked[: 200 if part == "term" else None], 1)]
    return sorted(out)


def test_equals_loops(spark, monkeypatch):
    rows = [("Alpha beta beta GAMMA x1y", "en", "a"), ("alpha, beta; Größe", "en", "b"), ("alpha beta größe größe", "en", "b"), ("größe", "en", "c"), ("东京 东京 alpha", "en", None), (None, None, "z"), ("", "xx", "only")]
    rows += [("alpha " * 5000 + "beta", "en", "a"), ("\U0001f600 beta", None, "z"), ("12 34", "yy", "p"), ("nothing three times", "yy", "q")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = plain(rows)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == want
    assert {r[4] for r in want if r[0] == "yy"} == {0}
    monkeypatch.setattr(divergence, "BROADCAST", 0)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == want


def test_only_the_first_ranks_of_terms_stay(spark):
    letters = "abcdefghijklmnopqrst"
    words = [a + b for a in letters for b in letters]
    rows = [(" ".join(words), "en", "a")] * 3 + [("other words", "en", "b")] * 3
    out = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))
    ranks = [r.rank for r in out.where("part = 'term' and source = 'a'").collect()]
    assert sorted(ranks) == list(range(1, 201))
    assert sorted(map(tuple, out.collect())) == plain(rows)


def test_odd_rows(spark):
    docs = odd(spark)
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert sorted(map(tuple, divergence.audit(docs).collect())) == plain(rows)
    assert divergence.audit(none(spark)).count() == 0
