"""Temporal operators on small cases: ties, stored nils, nothing recorded, bounds."""

import random

import pytest
from pyspark.sql import functions as F

from tracelake.operators import sets, temporal

NONE = object()


def samples(spark, rows):
    return spark.createDataFrame([(s, float(t), i, v) for i, (s, t, v) in enumerate(rows)], "s string, t double, pos int, v string")


def probes(spark, rows):
    return spark.createDataFrame([(i, s, float(t)) for i, (s, t) in enumerate(rows)], "probe int, s string, t double")


def brute(rows, asked, strict):
    out = []
    for s, t in asked:
        hits = [(x, i, v) for i, (k, x, v) in enumerate(rows) if k == s and (x < t or x == t and not strict)]
        out.append(max(hits, key=lambda h: h[:2])[2] if hits else NONE)
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("bucketed", [False, True])
def test_asof_equals_brute_force(spark, strict, bucketed):
    draw = random.Random(1)
    rows = [(draw.choice("abc"), draw.randrange(30), draw.choice(["x", "y", None])) for _ in range(200)]
    asked = [(draw.choice("abcd"), draw.randrange(-2, 33)) for _ in range(150)]
    bucket = (lambda t: F.floor(t / 7)) if bucketed else None
    got = temporal.asof(probes(spark, asked), samples(spark, rows), ["s"], "t", ["v"], ["pos"], strict, bucket=bucket).orderBy("probe").collect()
    assert [r.v if r.matched else NONE for r in got] == brute(rows, asked, strict)


def test_nearest(spark):
    rows = [("a", 0, "a"), ("a", 10, "b"), ("a", 20, "c"), ("n", 10, None)]
    asked = [("a", 10), ("a", 7), ("a", 3), ("a", 5), ("a", 25), ("a", 25.1), ("n", 11), ("z", 1)]
    got = temporal.nearest(probes(spark, asked), samples(spark, rows), ["s"], "t", ["v"], 5.0, ["pos"]).orderBy("probe").collect()
    assert [r.v for r in got] == ["b", "b", "a", "a", "c", None, None, None]
    assert [r.matched for r in got] == [True] * 5 + [False, True, False]


def bounded(spark, rows, events):
    s = spark.createDataFrame([("s", float(t), float(tp), i, v) for i, (t, tp, v) in enumerate(rows)], "s string, t double, tp double, pos int, v string")
    e = spark.createDataFrame([("s", i, float(t), float(tp)) for i, (t, tp) in enumerate(events)], "s string, event int, t double, tp double")
    return [("AMBIGUOUS" if r.ambiguous else r.v if r.matched else NONE) for r in temporal.bounded_asof(e, s, ["s"], "t", "tp", ["v"], ["pos"]).orderBy("event").collect()]


def test_bounded_asof(spark):
    assert bounded(spark, [(1, 1, "A"), (3, 3.002, "B")], [(3, 3.001)]) == ["B"]
    assert bounded(spark, [(3, 3.002, "A"), (3, 3.012, "B")], [(3, 3.001), (3, 3.011)]) == ["A", "B"]
    assert bounded(spark, [(1, 1, "A"), (3, 3.002, "B")], [(3, 3.001), (3, 3.002)]) == ["AMBIGUOUS", "B"]
    assert bounded(spark, [(1, 1, "G"), (2, 2, None)], [(3, 3.001)]) == [None]
    assert bounded(spark, [(1, 1, "G")], [(3, 3.001), (3, 3.001)]) == [NONE, NONE]


def test_changes_keep_the_first_nil(spark):
    rows = samples(spark, [("a", 1, None), ("a", 2, None), ("a", 3, "x"), ("a", 3, "x"), ("a", 4, None), ("b", 1, "y")])
    assert [(r.s, r.t) for r in temporal.changes(rows, ["s"], "t", ["v"], ["pos"]).orderBy("s", "t").collect()] == [("a", 1), ("a", 3), ("a", 4), ("b", 1)]


def test_sets_at(spark):
    rows = [("s", None, -1, "add", 1), ("s", None, -1, "add", 2), ("s", 5.0, 0, "add", 3), ("s", 10.0, 1, "add", 4), ("s", 10.0, 1, "remove", 1), ("s", 20.0, 2, "add", 5), ("e", 0.0, -1, "add", 9), ("e", 1.0, 0, "remove", 9)]
    d = spark.createDataFrame(rows, "s string, t double, pos int, op string, id long").withColumn("t", F.coalesce("t", F.lit(float("-inf"))))
    at = lambda t: {r.s: r.ids for r in sets.sets_at(d, ["s"], "t", "op", "id", F.lit(t), ["pos"]).collect()}
    assert at(0.0) == {"s": [1, 2], "e": [9]} and at(15.0) == {"s": [2, 3, 4], "e": []} and at(25.0)["s"] == [2, 3, 4, 5]


def test_set_changes(spark):
    d = spark.createDataFrame([("a", 1, [1, 2]), ("a", 2, [1, 2]), ("a", 3, [2, 5, 4]), ("a", 4, [])], "s string, t int, ids array<long>")
    assert [(r.t, r.added, r.removed) for r in sets.set_changes(d, ["s"], "t", "ids").orderBy("t").collect()] == [(1, [1, 2], []), (3, [4, 5], [1]), (4, [], [2, 4, 5])]


def test_many_streams_in_one_pass_give_what_single_lookups_give(spark):
    r = random.Random(7)
    make = lambda n, name: spark.createDataFrame([(r.choice("ab"), float(r.randrange(30)), k, None if r.random() < 0.2 else f"{name}{k}") for k in range(n)], "sid string, t double, pos int, v string")
    probes = spark.createDataFrame([(r.choice("abc"), float(r.randrange(35)), k) for k in range(60)], "sid string, t double, id int")
    streams = {"x": make(40, "x"), "y": make(15, "y"), "z": make(3, "z")}
    for strict in (False, True):
        want = probes
        for n, s in streams.items():
            want = temporal.asof(want, s, ["sid"], "t", ["v"], ["pos"], strict, names=[n]).withColumnRenamed("matched", f"{n}_known")
        want = sorted(str((x.id, *[(x[f"{n}_known"], x[n]) for n in streams])) for x in want.collect())
        for bucket in (None, lambda t: F.floor(t / 7)):
            got = temporal.asof_many(probes, streams, ["sid"], "t", ["pos"], strict, bucket)
            assert sorted(str((x.id, *[(x[n] is not None, x[n] and x[n].v) for n in streams])) for x in got.collect()) == want


def test_cooldown_takes_what_a_loop_takes(spark):
    r = random.Random(11)
    rows = [(r.choice("ab") if r.random() < 0.9 else None, float(r.randrange(120)) / 2, k) for k in range(250)] + [("once", 1.0, 999)]
    df = spark.createDataFrame(rows, "sid string, t double, pos int")
    for gap in (0.5, 3.0, 100.0):
        want = []
        for key in {x[0] for x in rows}:
            last = None
            for x in sorted((x for x in rows if x[0] == key), key=lambda x: x[1:]):
                if last is None or x[1] >= last + gap:
                    want.append(x)
                    last = x[1]
        for bucket in (None, lambda t: F.floor(t / 10)):
            assert sorted(map(tuple, temporal.cooled(df, ["sid"], "t", gap, ["pos"], bucket).collect()), key=str) == sorted(want, key=str)
    assert temporal.cooled(df.limit(0), ["sid"], "t", 1.0, ["pos"]).count() == 0
