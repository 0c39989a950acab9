"""Ways in graphs with cycles, and forests."""

import random

from tracelake.operators import relations


def test_reachable_equals_a_search(spark):
    r = random.Random(4)
    edges = [(r.randrange(40), r.randrange(40)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(130)] + [(230, 100), (7, 7), (None, 1), (1, None), (100, 101)]
    out = relations.reachable(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()
    ways = {}
    for a, b in edges:
        if a is not None and b is not None:
            ways.setdefault(a, set()).add(b)
    want = set()
    for start in ways:
        todo = set(ways[start])
        while todo:
            n = todo.pop()
            if (start, n) not in want:
                want.add((start, n))
                todo |= ways.get(n, set())
    assert len(out) == len(want) and {(x.a, x.b) for x in out} == want
    assert relations.reachable(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_two_forests_at_once(spark):
    one = relations.roots(spark.createDataFrame([(1, None), (2, 1)], "n int, p int"), "n", "p")
    two = relations.roots(spark.createDataFrame([(5, None), (6, 5), (7, 6)], "n int, p int"), "n", "p")
    assert sorted(map(tuple, one.collect())) == [(1, 1, 0), (2, 1, 1)] and sorted(map(tuple, two.collect())) == [(5, 5, 0), (6, 5, 1), (7, 5, 2)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("_")]


def test_forest_higher_and_larger_than_a_recursive_query_takes(spark):
    # one chain of 300, stars of 1,000,100 rows, a cycle, an orphan, a node named twice
    stars = spark.range(1000, 1_001_100).selectExpr("id as n", "case when id >= 2000 then id % 1000 + 1000 end as p")
    rest = [(0, None)] + [(k, k - 1) for k in range(1, 300)] + [(500, 501), (501, 500), (502, 500), (600, 999), (700, 0), (700, 2)]
    out = relations.roots(stars.unionByName(spark.createDataFrame(rest, "n long, p long")), "n", "p").cache()
    low = sorted(map(tuple, out.where("node < 1000").collect()))
    assert low == sorted([(k, 0, k) for k in range(300)] + [(700, 0, 1), (700, 0, 3)])
    assert out.where("node >= 1000 and depth = case when node < 2000 then 0 else 1 end and root = node % 1000 + 1000").count() == 1_000_100
    assert out.count() == 300 + 2 + 1_000_100
    out.unpersist()


def test_reachable_makes_each_way_of_a_long_circle_about_once(spark):
    n, Frame = 256, type(spark.range(0))
    made, join = [], Frame.join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if on == "_by":
            made.append(out.count())
        return out

    Frame.join = counted
    try:
        circle = relations.reachable(spark.createDataFrame([(k, (k + 1) % n) for k in range(n)], "a int, b int"), "a", "b")
        assert circle.count() == circle.distinct().count() == n * n
    finally:
        Frame.join = join
    # the last round meets pairs that are known: twice the result at the most
    assert sum(made) <= 2 * n * n


def _walks(edges):
    ways, out = dict(edges), set()
    for start in ways:
        n = start
        while n in ways and (start, ways[n]) not in out:
            n = ways[n]
            out.add((start, n))
    return out


def test_reachable_where_each_node_has_one_edge_equals_a_walk(spark):
    r = random.Random(8)
    maps = [[(k, r.randrange(150)) for k in range(150)], [(k, r.randrange(60)) for k in range(40)], [(k, k + 1) for k in range(90)] + [(90, 60), (200, 90), (300, 300), (301, 300), (400, 401)]]
    for edges in maps:
        out = [(x.a, x.b) for x in relations.reachable(spark.createDataFrame([*edges, (None, 1), (999, None), edges[0]], "a int, b int"), "a", "b").collect()]
        assert len(out) == len(set(out)) and set(out) == _walks(edges)


def test_reachable_writes_no_pairs_where_each_node_has_one_edge(spark, monkeypatch):
    # walks of 32^2 nodes and more; a circle of 1,500 with a tail of 40
    n, rows, written = 1540, [], relations.written
    monkeypatch.setattr(relations, "written", lambda df, *by: (out := written(df, *by), rows.append(out.count()))[0])
    out = relations.reachable(spark.range(n).selectExpr("id as a", f"case when id = {n - 1} then 40 else id + 1 end as b"), "a", "b")
    pairs = out.count()
    assert pairs == out.distinct().count() == 1500 * 1500 + sum(1499 + k for k in range(1, 41))
    # each round wrote its pairs before: as many as the result
    assert sum(rows) < pairs / 8
