"""Copies, keys, names and relations: the joins of the engine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def newest_copies(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; rows without a key are all kept."""
    # keyless rows are set aside, so that they are not one group
    w = Window.partitionBy(key).orderBy(*order)
    keyed = rows.where(F.col(key).isNotNull()).withColumn("_copy", F.row_number().over(w)).where("_copy = 1").drop("_copy")
    return keyed.unionByName(rows.where(F.col(key).isNull()))


def retained(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key (Spark limits each task's rows of a key before it shuffles)."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= n).drop("_place")


def placed(rows: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "place") -> DataFrame:
    """``rows`` numbered within each key in ``order``."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def holders(rows: DataFrame, keys: DataFrame, key: str, holder: str) -> DataFrame:
    """Distinct ``holder`` values of the rows whose key is among ``keys``."""
    return rows.join(keys.select(key).distinct(), key, "left_semi").select(holder).distinct()


def key_diff(listed: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, change): ``new`` keys are listed but not stored, ``gone`` ones stored but not listed."""
    new = listed.select(key).distinct().join(stored.select(key), key, "left_anti").withColumn("change", F.lit("new"))
    return new.unionByName(stored.select(key).distinct().join(listed.select(key), key, "left_anti").withColumn("change", F.lit("gone")))


def without(rows: DataFrame, excluded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose ``on`` columns are not in ``excluded``."""
    return rows.join(excluded.select(*on).distinct(), list(on), "left_anti")


def records(facts: DataFrame, entity: str, field: str, value: str, fields: Sequence[str]) -> DataFrame:
    """One row for each entity with a nullable column for each field, from facts in long form."""
    return facts.groupBy(entity).pivot(field, list(fields)).agg(F.first(value, ignorenulls=True))


def inverted(relations: DataFrame, owner: str, members: str, name: str) -> DataFrame:
    """From owner -> members to member -> sorted owners."""
    return relations.select(owner, F.explode(members).alias(name)).groupBy(name).agg(F.array_sort(F.collect_set(owner)).alias("owners"))


def clamped(rows: DataFrame, other: DataFrame, on: str, value: str, limit: str) -> DataFrame:
    """``value`` no greater than the other table's ``limit``, where it has one."""
    return rows.join(other.select(on, limit), on, "left").withColumn(value, F.least(F.col(value), F.coalesce(limit, F.col(value)))).drop(limit)


def resolve_names(wanted: DataFrame, evidence: DataFrame, name: Column, known: Column, kind: Column, id_: str) -> DataFrame:
    """``wanted`` with the id of the evidence that has the same name: highest ``kind``, lowest id.

    Evidence is reduced to one row a name before the join.
    """
    best = evidence.withColumn("_name", known).where("_name <> ''").groupBy("_name").agg(F.max_by(F.col(id_), F.struct(kind, -F.col(id_))).alias("resolved"))
    return wanted.withColumn("_name", name).join(best, "_name", "left").drop("_name")


def resolve_in_order(wanted: DataFrame, evidence: DataFrame, names: Sequence[Column], known: Column, kind: Column, id_: str) -> DataFrame:
    """The same with several spellings: the first that is known counts. One join over the distinct spellings of each list."""
    best = evidence.withColumn("_name", known).where("_name <> ''").groupBy("_name").agg(F.max_by(F.col(id_), F.struct(kind, -F.col(id_))).alias("_id"))
    out = wanted.withColumn("_names", F.array(*names))
    lists = out.select("_names").distinct()
    found = lists.select("_names", F.posexplode("_names").alias("_k", "_name")).join(best, "_name").groupBy("_names").agg(F.min_by("_id", "_k").alias("resolved"))
    return out.join(found, "_names", "left").drop("_names")


def by_display_name(left: DataFrame, right: DataFrame, left_name: Column, right_name: Column, right_id: str) -> DataFrame:
    """``left`` with the lowest id of the ``right`` rows of the same display name."""
    lowest = right.groupBy(right_name.alias("_name")).agg(F.min(right_id).alias("matched_id"))
    return left.withColumn("_name", left_name).join(lowest, "_name", "left").drop("_name")


def unique_inverse(rows: DataFrame, steps: DataFrame, on: str, value: str, columns: Sequence[str], rounded) -> DataFrame:
    """``rows`` with the number of the one column of ``steps`` whose rounded entry is their value; null where several or none are."""
    long = steps.select(F.col(on).alias("_on"), F.posexplode(F.array(*columns)).alias("_step", "_x")).withColumn("_x", rounded(F.col("_x")))
    unique = long.groupBy("_on", "_x").agg(F.count(F.lit(1)).alias("_n"), F.min("_step").alias("step")).where("_n = 1")
    return rows.join(unique, (F.col(on) == F.col("_on")) & (F.col(value) == F.col("_x")), "left").drop("_on", "_x", "_n")


def split_spillover(gains: DataFrame, by: Sequence[str], part: str, amount: str, lowest: bool = False) -> DataFrame:
    """``gains`` with the part each is a quarter of: a larger gain of the same sign whose quarter lies within 1 of it (the largest such; of equals the greatest part, or the lowest).

    An equi-join on whole numbers: a gain meets the quarters in its own bin and its neighbours.
    """
    other = gains.select(*by, F.col(part).alias("_part"), F.col(amount).alias("_amount"), F.floor(F.col(amount) / 4).alias("_bin"))
    asked = gains.select(*by, part, amount, F.explode(F.array(*[F.floor(amount) + d for d in (-1, 0, 1)])).alias("_bin"))
    near = (F.abs(F.col(amount) - F.col("_amount") / 4) <= 1) & (F.signum(amount) == F.signum("_amount")) & (F.abs("_amount") > F.abs(F.col(amount))) & (F.col(part) != F.col("_part"))
    source = asked.join(other, [*by, "_bin"]).where(near).groupBy(*by, part).agg(F.max_by("_part", F.struct(F.abs("_amount"), -F.col("_part") if lowest else F.col("_part"))).alias("source"))
    return gains.join(source, [*by, part], "left")


def roots(rows: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth) of a forest of any size and height; nodes without a root above them, as in a cycle, have no row.

    Each node knows one ancestor and how far above it stands; the ancestor's own takes its
    place, so the distance doubles each round and a chain of n nodes takes log2(n) rounds.
    Rounds are written.
    """
    top, height = F.col(parent).isNull(), 1
    known = written(rows.select(F.col(node).alias("node"), F.coalesce(parent, node).alias("root"), F.when(top, 0).otherwise(1).alias("depth"), top.alias("_top")))
    parts, todo, most = [known.where("_top")], known.where("not _top"), known.count()
    # a way longer than there are nodes goes in a circle
    while height <= most and todo.take(1):
        above = reduce(DataFrame.unionByName, parts, todo).select(F.col("node").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_more"), F.col("_top").alias("_ends"))
        met = todo.drop("_top").join(above, "root").select("node", F.col("_root").alias("root"), (F.col("depth") + F.col("_more")).alias("depth"), F.col("_ends").alias("_top"))
        met = written(met)
        parts.append(met.where("_top"))
        todo, height = met.where("not _top"), height * 2
    return reduce(DataFrame.unionByName, parts).select("node", "root", "depth")


#: Fixed value: so many steps of a walk are kept as one list.
SPAN = 32


def reachable(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(source, target) of every pair with a way from one to the other, in graphs that may have cycles.

    Where each node has one edge at the most its ways are one walk, and every pair is made
    once, by the join that returns it (``_walked``): pairs are neither shuffled nor written.
    Elsewhere pairs carry the length of their shortest way. Each round doubles the length that is
    known: a pair of exactly that length goes on to all that is known behind its end, so a
    shortest way is made from one middle node at its half, not from each node on it, and a
    way of n edges takes log2(n) rounds. Rounds are written, not kept in a growing plan.
    Edges with a null end lead nowhere.
    """
    pair, length = [source, target], 1
    fresh = written(edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(*pair).distinct().withColumn("_steps", F.lit(1)))
    if not fresh.groupBy(source).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").take(1):
        return _walked(fresh.select(F.col(source).alias("node"), F.col(target).alias("at"))).toDF(*pair)
    parts = [fresh]
    # a shortest way of more than ``length`` edges begins with one of exactly ``length``
    while (far := fresh.where(F.col("_steps") == length)).take(1):
        every = reduce(DataFrame.unionByName, parts)
        on = far.select(source, F.col(target).alias("_by")).join(every.withColumnRenamed(source, "_by"), "_by")
        met = on.groupBy(*pair).agg((F.min("_steps") + length).cast("int").alias("_steps"))
        fresh = written(met.join(every.select(*pair), pair, "left_anti"))
        parts.append(fresh)
        length *= 2
    return reduce(DataFrame.unionByName, parts).select(*pair)


def _onward(steps: DataFrame) -> DataFrame:
    """``steps(node, at)`` taken twice; walks that end before have no row."""
    return written(steps.withColumnRenamed("at", "_mid").join(steps.withColumnRenamed("node", "_mid"), "_mid").select("node", "at"))


def _circles(edges: DataFrame) -> DataFrame:
    """(node, circle, size) of the nodes of ``edges(node, at)`` that stand on a cycle, where each node has one edge at the most; ``circle`` is the cycle's least node."""
    # what 2^k steps lead to becomes the nodes on cycles; where twice as many lead to as many nodes, all of them are
    steps, ends, n = edges, edges.select("at").distinct(), -1
    while (now := (ends := written(ends)).count()) != n:
        steps, n = _onward(steps), now
        ends = steps.select("at").distinct()
    own = edges.join(ends.withColumnRenamed("at", "node"), "node", "left_semi")
    low = written(own.select("node", "at", F.least("node", "at").alias("low")))
    while True:
        behind = low.select(F.col("node").alias("at"), F.col("at").alias("_to"), F.col("low").alias("_low"))
        met = written(low.join(behind, "at").select("node", F.col("_to").alias("at"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("_fell")))
        low = met.drop("_fell")
        if not met.where("_fell").take(1):
            break
    size = low.groupBy("low").agg(F.count(F.lit(1)).alias("size"))
    return written(low.join(size, "low").select("node", F.col("low").alias("circle"), "size"))


def _listed(steps: DataFrame, most: int) -> DataFrame:
    """(node, near): the next ``SPAN`` nodes (at least ``most``, if that is less) of each node's walk by ``steps(node, at)``; fewer where it ends."""
    near, length = steps.select("node", F.array("at").alias("near")), 1
    while length < min(SPAN, most):
        behind = near.select(F.col("node").alias("_last"), F.col("near").alias("_on"))
        near = written(near.withColumn("_last", F.element_at("near", -1)).join(behind, "_last", "left").select("node", F.concat("near", F.coalesce("_on", F.slice("near", 1, 0))).alias("near")))
        length *= 2
    return near


def _walked(edges: DataFrame) -> DataFrame:
    """(node, at) of all nodes of each node's walk by ``edges(node, at)``, where each node has one edge at the most.

    A walk ends where there is no edge, or once it has gone around its cycle: its number of
    steps to the cycle and the cycle's size tell how many nodes it meets. Their places are
    numbers of digits to the base ``SPAN``: lists hold the next ``SPAN`` nodes by jumps of
    1, ``SPAN``, ``SPAN``^2 steps, each digit is a join with one of them, and the last
    one makes the pairs.
    """
    circles = _circles(edges)
    nodes = edges.select("node", F.col("at").alias("_parent")).unionByName(edges.select(F.col("at").alias("node"), F.lit(None).cast(edges.schema["at"].dataType).alias("_parent")))
    nodes = nodes.groupBy("node").agg(F.max("_parent").alias("_parent")).join(circles.select("node", F.lit(True).alias("_on")), "node", "left")
    ways = roots(nodes.select("node", F.when(F.col("_on").isNull(), F.col("_parent")).alias("_parent")), "node", "_parent")
    size = circles.select(F.col("node").alias("root"), "size")
    # the node where a walk enters a cycle counts once; one that begins there comes back to where it began
    left = (F.col("depth") + F.when(F.col("size").isNull(), 0).otherwise(F.col("size") - (F.col("depth") > 0).cast("int"))).cast("long").alias("left")
    rows = written(ways.join(size, "root", "left").select("node", F.col("node").alias("at"), left).where("left > 0"))
    most, steps, jumps, length = rows.agg(F.max("left")).first()[0] or 0, edges, [], 1
    while length < most:
        jumps.append(_listed(steps, -(-most // length)))
        steps, length = jumps[-1].where(F.size("near") == SPAN).select("node", F.element_at("near", SPAN).alias("at")), length * SPAN
    jumps = jumps or [_listed(edges, 1)]
    for k in range(len(jumps) - 1, 0, -1):
        # a jump of no steps, or of 1 to SPAN - 1 times the length: the rest is one or more steps
        far = F.least(F.lit(SPAN - 1), F.floor((F.col("left") - 1) / SPAN**k)).cast("int")
        on = rows.join(jumps[k].withColumnRenamed("node", "at"), "at", "left")
        ends = F.concat(F.array("at"), F.coalesce(F.slice("near", 1, far), F.slice(F.array("at"), 1, 0)))
        rows = written(on.select("node", "left", F.posexplode(ends).alias("_k", "at")).select("node", "at", (F.col("left") - F.col("_k") * SPAN**k).alias("left")))
    return rows.join(jumps[0].withColumnRenamed("node", "at"), "at").select("node", F.explode(F.slice("near", 1, F.least(F.col("left"), F.lit(SPAN)).cast("int"))).alias("at"))


def by_id_or_name(rows: DataFrame, dimension: DataFrame, id_: str, name: Column, dim_id: str, dim_name: Column, value: str) -> DataFrame:
    """``rows`` with the dimension's ``value`` of their id, or else of their display name (of its lowest id)."""
    by_id = dimension.groupBy(F.col(dim_id).alias("_id")).agg(F.min(value).alias("_by_id"))
    by_name = dimension.groupBy(dim_name.alias("_name")).agg(F.min_by(value, dim_id).alias("_by_name"))
    out = rows.withColumn("_n", name).join(by_id, F.col(id_) == F.col("_id"), "left").join(by_name, F.col("_n") == F.col("_name"), "left")
    return out.withColumn(value, F.coalesce("_by_id", "_by_name")).drop("_n", "_id", "_name", "_by_id", "_by_name")


def indexed(rows: DataFrame, lists: DataFrame, values: DataFrame, by: Sequence[str], t: str, index: str) -> DataFrame:
    """``rows`` with the ``v`` that held, at their time, for the key at place ``index`` (from 1) of the list that held then: ``lists(by, t, pos, keys)``, ``values(by, key, t, pos, v)``."""
    from . import temporal

    found = temporal.asof(rows, lists, by, t, ["keys"], ["pos"], names=["_keys"]).drop("matched")
    keyed = found.withColumn("key", F.try_element_at("_keys", F.col(index).cast("int"))).drop("_keys")
    return temporal.asof(keyed, values, [*by, "key"], t, ["v"], ["pos"]).drop("matched")


def single_of(rows: DataFrame, relation: DataFrame, on: str, members: str) -> DataFrame:
    """``rows`` whose relation (``on`` -> array ``members``) has exactly one member, as ``member``."""
    return rows.join(relation.where(F.size(members) == 1).select(on, F.col(members)[0].alias("member")), on)
