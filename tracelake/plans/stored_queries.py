"""Clusters, streams and the store applied to whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import spatial
from ..sources.scratch import scratch
from ..sources.store import Store, update
from ..streaming import changes as streams
from .query import Family

QUERIES = Family()

#: Files of a micro-batch: so many tasks write and read it.
FILES = 8


def _stream(read, name: str) -> DataFrame:
    table = read(name)
    # the folder of the table's files, or of its only file
    folder, _, file = table.inputFiles()[0].rpartition("/")
    reader = table.sparkSession.readStream.schema(table.schema)
    return reader.option("pathGlobFilter", file if folder.rpartition("/")[2] != f"{name}.parquet" else "*").parquet(folder)


@QUERIES()
def cluster_spawns(read):
    """Medians of greedy clusters of the first two dimensions, by label; compared with brute force in the tests."""
    rows = read("embeddings").select(F.col("label").cast("long").alias("entity"), (F.col("vec_id") % 3).alias("zone"), (F.element_at("embedding", 1).cast("double") * 10).alias("x"), (F.element_at("embedding", 2).cast("double") * 10).alias("y"), (F.col("vec_id") % 40).alias("session"))
    return spatial.spawns(rows, "entity", "zone", "x", "y", "session")


@QUERIES()
def cluster_spawns_compact(read):
    """The variant with means, of which near ones of a zone collapse."""
    rows = read("embeddings").select(F.col("label").cast("long").alias("entity"), (F.col("vec_id") % 3).alias("zone"), F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"), (F.col("vec_id") % 40).alias("session"))
    return spatial.spawns(rows, "entity", "zone", "x", "y", "session", reducer="mean", least=1, share=0.0, compact=2.0)


@QUERIES("""
WITH g AS (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type FROM g WHERE n = 1 OR b IS DISTINCT FROM event_type""")
def stream_change_only(read):
    """The stateful stream over the events gives what the batch operator gives."""
    events = _stream(read, "events").select("event_id", "user_id", "ts", "event_type")
    spark, path = events.sparkSession, scratch(events.sparkSession)
    out = streams.changes(events, "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")
    streams.drained(out, f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{path}/out")


@QUERIES("""
WITH g AS (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type FROM g WHERE n = 1 OR b IS DISTINCT FROM event_type""")
def stream_shuffled_changes(read):
    """Events that come in four micro-batches whatever their times, and a last one that lets the watermark pass them all."""
    events = read("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("t"), "event_type")
    spark, path = events.sparkSession, scratch(events.sparkSession)
    for part in range(4):
        events.where(F.col("event_id") % 4 == (part * 3 + 1) % 4).repartition(FILES, "event_id").write.mode("append").parquet(f"{path}/in/part={part}")
    end = events.agg(F.max("t") + F.expr("interval 200 days")).first()[0]
    spark.createDataFrame([(None, None, end, None)], events.schema).coalesce(1).write.parquet(f"{path}/in/part=4")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(f"{path}/in/*")
    out = streams.ordered_changes(stream, "user_id", "t", ["event_id"], "event_type", "100 days")
    streams.drained(out.where("user_id is not null").select("event_id", "user_id", "event_type"), f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{path}/out")


@QUERIES("""SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def tumbling_counts(read):
    return streams.tumbling(read("events").withColumn("t", F.col("ts").cast("timestamp")), "t", "6 hours", "1 hour", ["event_type"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@QUERIES("""WITH g AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 4 HOURS, true) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 4 HOURS AS "end", count(*) AS n FROM s GROUP BY user_id, run""")
def session_windows(read):
    out = streams.sessionized(read("events").withColumn("t", F.col("ts").cast("timestamp")), "t", "4 hours", "1 hour", ["user_id"])
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


_STORE = """
WITH c AS (SELECT *, nullif(o_custkey % 70, 0) AS key, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS submission FROM orders WHERE o_orderkey % 5 <> 3),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY submission DESC) AS copy FROM c) WHERE key IS NULL OR copy = 1),
o AS (SELECT w.submission, coalesce(CAST(key AS VARCHAR), w.submission || '#0') AS session, l_suppkey AS entity, l_returnflag AS value, l_quantity AS t, l_linenumber AS seq, CASE WHEN key % 2 = 0 THEN o_totalprice END AS at_time FROM w JOIN lineitem ON l_orderkey = o_orderkey)
SELECT entity, value, 3 AS confidence, count(*) AS n, max(t) AS latest_t, count(DISTINCT session) FILTER (WHERE at_time IS NOT NULL) AS timed_sessions, max(at_time) AS newest_session FROM o GROUP BY entity, value"""


def _submission(c: str):
    return F.lpad(F.col(c).cast("string"), 12, "0").alias("submission")


def _observe(read, orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sessions, observations and submissions of orders: what a batch of the store is made of."""
    key, none = F.expr("nullif(o_custkey % 70, 0)"), F.lit(None).cast("string")
    sessions = orders.select(_submission("o_orderkey"), F.lit(0).alias("idx"), key.cast("string").alias("session_key"), F.lit(False).alias("duplicate"), none.alias("contributor"), F.when(key % 2 == 0, F.col("o_totalprice")).alias("session_time"), none.alias("error"))
    items = read("lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    observations = items.select(_submission("l_orderkey"), F.lit(0).alias("idx"), F.lit("scalar").alias("kind"), F.lit(0).alias("pos"), F.lit("flag").alias("field"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("entity"), none.alias("locale"), F.lit("high").alias("confidence"), F.col("l_quantity").alias("t"), F.col("l_returnflag").alias("value"), none.alias("token"), none.alias("extra"))
    return sessions, observations, orders.select(_submission("o_orderkey"), none.alias("error"))


def _stored(read) -> Store:
    """Orders in two batches, a fifth of them removed again."""
    orders, spark = read("orders"), read("orders").sparkSession
    store = Store(spark, scratch(spark), "v1")
    for part in (0, 1):
        store.append(*_observe(read, orders.where(F.col("o_orderkey") % 2 == part)))
    store.forget(orders.where("o_orderkey % 5 = 3").select(_submission("o_orderkey")))
    return store


_SUMMED = ("entity", "value", "confidence", "n", "latest_t", "timed_sessions", "newest_session")


@QUERIES(_STORE)
def store_summary(read):
    """Summarised from the newest copies."""
    return _stored(read).scalar_summary().select(*_SUMMED)


@QUERIES(_STORE)
def store_updates(read):
    """The same state reached by three incremental runs: a third of the orders, all of them, all but the removed ones."""
    orders, spark = read("orders").withColumn("submission", _submission("o_orderkey")), read("orders").sparkSession
    store = Store(spark, scratch(spark), "v1")
    for listed in (orders.where("o_orderkey % 3 = 0"), orders, orders.where("o_orderkey % 5 <> 3")):
        update(store, listed, lambda todo: _observe(read, todo))
    return store.scalar_summary().select(*_SUMMED)


@QUERIES(f"""WITH {_STORE.split('o AS (')[0].strip().removeprefix('WITH ').rstrip(',')} SELECT w.submission, l_linenumber AS seq, l_suppkey AS entity, l_returnflag AS value FROM w JOIN lineitem ON l_orderkey = o_orderkey WHERE w.submission BETWEEN '000000000100' AND '000000000399'""")
def store_key_range(read):
    """Observations of a range of submissions, from the batches and files that can hold them."""
    return _stored(read).observations(between=("000000000100", "000000000399")).select("submission", "seq", "entity", "value")


@QUERIES(f"""WITH {_STORE.split('o AS (')[0].strip().removeprefix('WITH ').rstrip(',')} SELECT w.submission, l_linenumber AS seq, l_suppkey AS entity, l_returnflag AS value FROM w JOIN lineitem ON l_orderkey = o_orderkey""")
def store_replay(read):
    """All observations of the newest copies, put together from the slices of a replay."""
    slices = list(_stored(read).replay(rows=read("lineitem").count() // 6))
    return reduce(DataFrame.unionByName, slices).select("submission", "seq", "entity", "value")
