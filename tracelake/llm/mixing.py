"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target number of words: sources in code point order (null
last) weigh 5, 2, 1, 5, 2, 1, ... and share ``total`` times all words; no target
exceeds ``repeat`` times its source, the excess going to the others by weight
until none is above. A target is met by complete epochs of the source first; the
rest by documents in order of the exponential keys ``-ln(u) / quality``, u from a
hash of the id, until the words are reached.

One source may hold a third of all rows, so no row is dealt by its source. Keys fall
into ``BUCKETS`` squared buckets of equal probability for each source; bucket sums
(pre-aggregated) are added up in order, first coarse and then fine, and only documents
of the one fine bucket of each source in which the budget ends, about its 65,536th
part, are put in the order of their keys. What each source takes is one written row a
source; up to ``BROADCAST`` sources it is broadcast to the documents, beyond that it is
joined (Spark splits a hot source there). Ranking sources and sharing the total out
sorts these rows, one a source, in one task.

Defined results: a null or blank text has size 0 and takes 0; a source without
words has target 0; ids may repeat (equal keys then go by text hash); a null id
hashes as the empty text; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BUCKETS, WEIGHTS, BROADCAST = 256, (5, 2, 1), 10_000


def size_of(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """A weight from 1 to 2 by mean word length near 6 and few marks: a cheap stand-in for any quality column."""
    n, words = F.length(text), F.greatest(size_of(text), F.lit(1))
    mean = (n / words).cast("double")
    return F.coalesce(F.lit(1.0) + F.when((mean >= 3) & (mean <= 12), 0.75).otherwise(0.0) + F.when(n >= 200, 0.25).otherwise(0.0), F.lit(1.0))


def targets(sizes: DataFrame, total: float, repeat: float, weights: tuple[int, ...]) -> DataFrame:
    """source, source_size, target: water-filling over one row for each source."""
    # one row a source: the number of sources bounds this window
    ranked = sizes.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_k") - 1) % len(weights) + 1).cast("int")))
    # a source is full at the level repeat * size / weight; below it every source gets level * weight
    everything = Window.partitionBy(F.lit(1))
    rising = Window.orderBy("_level", "_k")
    r = ranked.withColumn("_level", F.lit(repeat) * F.col("source_size") / F.col("_w"))
    r = r.withColumn("_all", F.lit(total) * F.sum("source_size").over(everything)).withColumn("_weight", F.sum("_w").over(everything))
    r = r.withColumn("_full", F.sum(F.lit(repeat) * F.col("source_size")).over(rising)).withColumn("_open", F.col("_weight") - F.sum("_w").over(rising))
    # the water level once the first sources in the order of levels are full
    before_full, before_open = F.col("_full") - F.lit(repeat) * F.col("source_size"), F.col("_open") + F.col("_w")
    r = r.withColumn("_water", (F.col("_all") - before_full) / before_open)
    r = r.withColumn("_fits", F.when(F.col("_water") < F.col("_level"), F.col("_water")))
    r = r.withColumn("_stop", F.first("_fits", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return r.select("source", "source_size", F.when(F.col("_stop").isNull() | (F.col("_level") <= F.col("_stop")), F.lit(repeat) * F.col("source_size")).otherwise(F.col("_w") * F.col("_stop")).cast("double").alias("target"))


def mix(docs: DataFrame, total: float = 1.5, repeat: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix", quality=quality_of, whole: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, epochs, copies (times the mix has the row), taken of each row of ``docs``; ``whole``: and the row as struct ``row``."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), ids)), 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))
    key = -F.log(u) / quality(F.col("text"))
    # the keys' distribution mapped near to uniform, and its digits: one bucket a level
    spread = F.least(F.lit(1.0) - F.exp(-key), F.lit(1.0 - 2**-50))
    tie = F.substring(F.md5(F.coalesce(F.col("text"), F.lit(""))), 1, 12)
    rows = docs.select("doc_id", "source", *([F.struct(*docs.columns).alias("row")] if whole else []), size_of(F.col("text")).alias("size"), key.alias("_key"), tie.alias("_tie"), F.floor(spread * BUCKETS * BUCKETS).cast("int").alias("_b2"))

    # at most BUCKETS ** 2 rows a source
    sums = written(rows.groupBy("source", "_b2").agg(F.sum("size").alias("_n")), "bucket-sums").withColumn("_b1", F.floor(F.col("_b2") / BUCKETS).cast("int"))
    coarse = sums.groupBy("source", "_b1").agg(F.sum("_n").alias("_n"))
    plan = targets(coarse.groupBy("source").agg(F.sum("_n").alias("source_size")), total, repeat, weights)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    def edge_of(sums: DataFrame, bucket: str, base: str | None) -> DataFrame:
        """Per source (as _s): the bucket in which the rest ends, and the words before it."""
        upto = F.sum("_n").over(Window.partitionBy("source").orderBy(bucket)) + (F.col(base) if base else F.lit(0))
        placed = sums.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
        return placed.where((F.col("_before") <= F.col("_rest")) & (F.col("_upto") > F.col("_rest"))).select(F.col("source").alias("_s"), F.col(bucket).alias("_e"), F.col("_before").alias("_base"))

    rest = plan.select(F.col("source").alias("_p"), "_rest")
    first = edge_of(coarse.join(rest, F.col("source").eqNullSafe(F.col("_p"))), "_b1", None)
    inner = sums.join(first, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b1") == F.col("_e"))).drop("_s", "_e")
    last = edge_of(inner.join(rest, F.col("source").eqNullSafe(F.col("_p"))), "_b2", "_base")
    plan = written(plan.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_s"), "mix-plan")
    if plan.count() <= BROADCAST:
        plan = F.broadcast(plan)

    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # documents of the last bucket alone are put in the order of their keys
    at_edge = F.col("_b2").eqNullSafe(F.col("_e"))
    edge = placed.where(at_edge).withColumn("_upto", F.col("_base") + F.sum("size").over(Window.partitionBy("source").orderBy("_key", "_tie", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    # the document on the line goes in if most of it lies below the line
    edge = edge.withColumn("_in", (F.col("_rest") > 0) & (F.col("_upto") - F.col("size") / 2 <= F.col("_rest"))).drop("_upto")
    # no last bucket: the rest is the whole source or nothing
    other = placed.where(~at_edge).withColumn("_in", (F.col("_rest") > 0) & (F.col("_e").isNull() | (F.col("_b2") < F.col("_e"))))
    copies = F.col("epochs") + F.col("_in").cast("long")
    return edge.unionByName(other).select("doc_id", *(["row"] if whole else []), "size", "source_size", "target", "epochs", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns as they are."""
    mixed = mix(docs, whole=True, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
