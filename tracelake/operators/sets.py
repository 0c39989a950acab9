"""Sets that are recorded as a first set and changes to it, and sets of evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def set_at(deltas: DataFrame, by: Sequence[str], t: str, op: str, id_: str, at: Column, order: Sequence[str] = ()) -> DataFrame:
    """(``by``, id) of the members at a time: those whose last change up to it is an ``add`` (within one change adds stand before removes)."""
    last = F.max_by(F.col(op), F.struct(F.col(t), *[F.col(c) for c in order], (F.col(op) == "remove").alias("_removes")))
    return deltas.where(F.col(t) <= at).groupBy(*by, id_).agg(last.alias("_op")).where("_op = 'add'").select(*by, id_)


def sets_at(deltas: DataFrame, by: Sequence[str], t: str, op: str, id_: str, at: Column, order: Sequence[str] = ()) -> DataFrame:
    """The sorted members of every recorded set at a time; recorded but empty is the empty array."""
    members = set_at(deltas, by, t, op, id_, at, order).groupBy(*by).agg(F.array_sort(F.collect_list(id_)).alias("ids"))
    known = deltas.where(F.col(t) <= at).select(*by).distinct()
    return known.join(members, list(by), "left").withColumn("ids", F.coalesce("ids", F.expr("filter(array(0L), x -> false)").cast(members.schema["ids"].dataType)))


def set_changes(sets: DataFrame, by: Sequence[str], t: str, ids: str, order: Sequence[str] = ()) -> DataFrame:
    """What came and went between a set and the one before it, sorted; nothing where they are equal. The first set of a key adds all."""
    before = F.coalesce(F.lag(ids).over(Window.partitionBy(*by).orderBy(t, *order)), F.expr("filter(array(0L), x -> false)").cast(sets.schema[ids].dataType))
    out = sets.withColumn("_before", before)
    out = out.withColumn("added", F.array_sort(F.array_except(ids, "_before"))).withColumn("removed", F.array_sort(F.array_except("_before", F.col(ids))))
    return out.where("size(added) > 0 or size(removed) > 0").drop("_before", ids)


def preferred(streams: DataFrame, by: Sequence[str], stream: str, ids: str, order: Sequence[str]) -> DataFrame:
    """Of each key's streams the first in ``order`` that is not empty, else the first there is."""
    rank = F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)])[F.col(stream)]
    return streams.groupBy(*by).agg(F.min_by(F.struct(stream, ids), F.struct((F.size(ids) == 0).alias("empty"), rank.alias("rank"))).alias("_v")).select(*by, "_v.*")


def union_of(rows: DataFrame, by: Sequence[str], id_: str) -> DataFrame:
    """The sorted distinct ids of each entity."""
    return rows.groupBy(*by).agg(F.array_sort(F.collect_set(id_)).alias("ids"))


def cardinality(deltas: DataFrame, by: Sequence[str], t: str, op: str, id_: str, order: Sequence[str] = ()) -> DataFrame:
    """First and current size of each set, and its number of changes."""
    end = deltas.groupBy(*by).agg(F.count_if(F.col(t).isNull()).alias("initial"), F.count_distinct(F.when(F.col(t).isNotNull(), F.col(t))).alias("changes"))
    last = F.max_by(F.col(op), F.struct(F.col(t).isNotNull(), F.col(t), *[F.col(c) for c in order], (F.col(op) == "remove").alias("_r")))
    now = deltas.groupBy(*by, id_).agg(last.alias("_op")).groupBy(*by).agg(F.count_if(F.col("_op") == "add").alias("current"))
    return end.join(now, list(by))
