import hashlib
import random
import time
from zlib import crc32

import pytest
from conftest import DATA, same_rows
from odd import TEXTS, none, odd

from tracelake.llm import oracles, periodic_runs, registry
from tracelake.llm.periodic_runs import collapsed, find_runs, looped, runs


def plain(words, least, power):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least, power", [(24, 3), (4, 2), (1, 2), (7, 4)])
def test_equals_all_periods(least, power):
    r = random.Random(least)
    for letters in (1, 2, 3, 6):
        for _ in range(120):
            words = [r.randrange(letters) for _ in range(r.randrange(90))]
            for _ in range(r.randrange(3)):
                ring = [r.randrange(letters + 2) for _ in range(r.randrange(1, 12))]
                at = r.randrange(len(words) + 1)
                words[at:at] = (ring * 9)[: r.randrange(60)]
            assert runs(words, least, power) == plain(words, least, power), words


def test_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    assert runs(list(b), 2, 2) == plain(list(b), 2, 2)
    assert runs(list(b)) == plain(list(b), 24, 3)


def test_blocks_of_ordered_sets(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", 2)
    words = list("abcab" * 60 + "xy" + "abc" * 40)
    assert runs(words) == plain(words, 24, 3)


def test_long_texts():
    began = time.time()
    assert runs(["a"] * 200_000) == [(0, 200_000, 1)]
    ring = [str(k * k % 99_991) for k in range(50_000)]
    assert runs(ring * 4) == [(0, 200_000, 50_000)]
    r = random.Random(1)
    noise = [str(r.randrange(1000)) for _ in range(300_000)]
    assert runs(noise + ["x", "y"] * 20) == [(300_000, 40, 2)]
    assert time.time() - began < 60


def test_collapsed_keeps_the_first_period():
    words = list("abcabcabcabcabcabcabcabcX")
    assert "".join(collapsed(words, runs(words))) == "abcX"


def test_query_equals_its_sql(spark):
    out = registry.op11_periodic_runs(spark, DATA)
    assert out.where("n_runs > 0").count() > 5
    same_rows(out, oracles.OP11, {"documents": f"{DATA}/documents.parquet"})


def test_query_equals_loops(spark):
    docs = odd(spark)
    out = sorted(map(str, periodic_runs.digest(docs).collect()))
    want = []
    for doc_id, text, *_ in TEXTS:
        words = (text or "").encode().split()
        h = crc32(str(doc_id).encode() if doc_id is not None else b"")
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain(words[:400], 24, 3) if len(words) < 400 else runs(words)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(kept))))
    assert out == sorted(str(x) for x in spark.createDataFrame(want, periodic_runs.digest(docs).schema).collect())


def test_odd_rows(spark):
    docs = odd(spark)
    out = find_runs(docs)
    assert out.columns == [*docs.columns, "_runs", "_collapsed"] and out.count() == len(TEXTS)
    long = [r for r in out.where("doc_id = 4").collect()][0]
    assert [tuple(x) for x in long["_runs"]] == [(0, 15000, 5)] and long["_collapsed"].startswith("lorem ipsum dolor sit amet xxx")
    assert find_runs(none(spark)).count() == 0 and periodic_runs.digest(none(spark)).count() == 0


def test_planted_circles():
    words = [str(k) for k in range(100)]
    ids = [k for k in range(200) if crc32(str(k).encode()) % 10 == 0]
    assert ids and all(len(looped(words, k)) == 100 for k in ids) and looped(words, next(k for k in range(9) if k not in ids)) == words
