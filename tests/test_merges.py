"""Merges on small cases: thresholds, ties, sessions against rows."""

from pyspark.sql import functions as F

from tracelake.operators import merges, relations


def summary(spark, rows):
    """rows: value, session, session_time, t, confidence."""
    df = spark.createDataFrame([(1, v, s, None if at is None else float(at), float(t), c, i) for i, (v, s, at, t, c) in enumerate(rows)], "entity int, value string, session int, at double, t double, c int, seq int")
    return merges.scalar_summary(df, ["entity"], "value", t="t", session="session", session_time="at", seen=["seq"], confidence=F.col("c"))


def fact(df):
    return [(r.value, r.observations, r.alternatives) for r in df.collect()]


def test_default_merge(spark):
    assert fact(merges.default_merge(summary(spark, [("low", 1, 1, 0, 1), ("low", 2, 2, 0, 1), ("high", 1, 1, 0, 3)]), ["entity"], "value")) == [("high", 3, 1)]
    assert fact(merges.default_merge(summary(spark, [("rare", 1, 1, 9, 3), ("common", 1, 1, 0, 3), ("common", 1, 1, 0, 3)]), ["entity"], "value")) == [("common", 3, 1)]
    assert fact(merges.default_merge(summary(spark, [("older", 1, 1, 0, 3), ("newer", 1, 1, 10, 3)]), ["entity"], "value")) == [("newer", 2, 1)]
    assert fact(merges.default_merge(summary(spark, [("first", 1, 1, 0, 3), ("second", 1, 1, 0, 3)]), ["entity"], "value")) == [("first", 2, 1)]


def test_newest_merge(spark):
    old = [("Old", k, 100 * k, 0, 3) for k in (1, 2, 3)]
    assert fact(merges.newest_merge(summary(spark, old + [("New", k, 100 * k, 0, 3) for k in (4, 5)]), ["entity"], "value"))[0][0] == "New"
    assert fact(merges.newest_merge(summary(spark, old[:2] + [("New", 3, 300, 0, 3)] * 2), ["entity"], "value"))[0][0] == "Old"
    untimed = [("Frequent", k, None, 0, 3) for k in range(3)] + [("Rare", k, None, 0, 3) for k in range(2)]
    assert fact(merges.newest_merge(summary(spark, untimed), ["entity"], "value"))[0][0] == "Frequent"


def supported(spark, counts):
    rows = [(1, "npc", i, s) for i, n in counts.items() for s in range(n)]
    out = merges.supported_ids(spark.createDataFrame(rows, "entity int, kind string, id int, session int"), ["entity"], "kind", "id", "session").collect()
    return out[0].ids if out else []


def test_supported_ids(spark):
    assert supported(spark, {7: 5, 8: 4}) == [7]
    assert supported(spark, {7: 1001, 8: 5}) == [7] and supported(spark, {7: 1000, 8: 5}) == [7, 8]
    rows = spark.createDataFrame([(1, "npc", 9, s % 4) for s in range(40)], "entity int, kind string, id int, session int")
    assert merges.supported_ids(rows, ["entity"], "kind", "id", "session").count() == 0


def levels(spark, values):
    return spark.createDataFrame([(1, v, s) for v, s in values], "entity int, v int, session int")


def test_ranges_and_modes(spark):
    low_high = lambda values: [(r.low, r.high) for r in merges.supported_range(levels(spark, values), ["entity"], "v", "session").collect()]
    each = lambda *vs: [(v, i) for i, v in enumerate(vs)]
    assert low_high(each(12, 12, 13, 13)) == [(12, 13)] and low_high(each(12, 12, 20)) == [(12, 12)] and low_high(each(*[23] * 30, 22, 22)) == [(23, 23)] and low_high([(5, 1), (5, 1)]) == []
    mode = lambda values: [r.v for r in merges.strict_mode(levels(spark, values), ["entity"], "v", "session").collect()]
    assert mode(each(1, 1, 4)) == [1] and mode(each(1, 1, 4, 4)) == [] and mode([(1, 1), (1, 1)]) == [] and mode(each(0, 0)) == []


def side(spark, rows):
    df = spark.createDataFrame([(1, v, s, None if at is None else float(at)) for s, (v, at) in enumerate(rows)], "entity int, side boolean, session int, at double")
    return [r.side for r in merges.undecided_switch(df, ["entity"], "side", "session", "at").collect()]


def test_switches(spark):
    t, f = True, False
    assert side(spark, [(t, None), (t, None)]) == [t] and side(spark, [(t, 1)]) == []
    assert side(spark, [(f, 1), (f, 2), (t, 3), (t, 4)]) == [t] and side(spark, [(f, 1), (t, 2)]) == []
    assert side(spark, [(f, 1), (t, 2), (f, 3), (t, 4), (t, 5)]) == [] and side(spark, [(f, 1), (t, 1), (t, 2)]) == [] and side(spark, [(f, None), (t, 2), (t, 3)]) == []


def test_relations(spark):
    quests = spark.createDataFrame([(200, [7]), (100, [7, 8])], "quest long, givers array<long>")
    assert {r.giver: r.owners for r in relations.inverted(quests, "quest", "givers", "giver").collect()} == {7: [100, 200], 8: [100]}
    copies = spark.createDataFrame([("k1", 1), ("k1", 2), (None, 3), (None, 4)], "key string, n int")
    assert sorted(r.n for r in relations.newest_copies(copies, "key", [F.desc("n")]).collect()) == [2, 3, 4]


def test_sessions_dealt_once_and_counted(spark):
    rows = spark.createDataFrame([(1, "a", 7), (1, "a", 7), (1, "a", 8), (1, "b", None), (2, "a", 7)], "entity int, value string, session int")
    out = merges.sessions_of(rows.repartition(3, "session"), ["entity", "value"], "session")
    assert sorted(map(tuple, out.collect())) == [(1, "a", 2), (1, "b", 0), (2, "a", 1)]
    # no shuffle of single rows beside the one by session
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning(") == 2


def test_merge_rows_are_dealt_by_their_number(spark, monkeypatch):
    from conftest import DATA

    from tracelake.plans import merge_queries

    monkeypatch.setattr(merge_queries, "_TASK", 100)
    rows = merge_queries._rows(lambda name: spark.read.parquet(f"{DATA}/{name}.parquet"))
    n = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert rows.rdd.getNumPartitions() == n // 100 and rows.count() == n
