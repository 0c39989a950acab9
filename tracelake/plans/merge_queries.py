"""Merges over ``lineitem``: a supplier is an entity, an order a session, its date the session's time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merges, sets
from .query import Family

QUERIES = Family()
#: Rows that one task joins and groups.
_TASK = 400_000


def _rows(read):
    """A third of the orders have no time.

    Dealt by session into parts of about ``_TASK`` rows: Spark merges shuffled parts up to a
    size in compressed bytes, and their sorts and groups take twenty times that memory.
    """
    time = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate"))
    orders = read("orders").select(F.col("o_orderkey").alias("session"), time.alias("at"), "o_orderstatus", "o_custkey")
    items = read("lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_orderkey").alias("session"), F.concat("l_returnflag", "l_linestatus").alias("value"), F.col("l_linenumber").alias("seq"), "l_partkey", "l_quantity", "l_shipdate", "l_discount", "l_extendedprice")
    parts = max(items.count() // _TASK, items.sparkSession.sparkContext.defaultParallelism)
    return items.repartition(parts, "session").join(orders.repartition(parts, "session"), "session")


_ROWS = """rows AS (SELECT l_suppkey AS entity, l_orderkey AS session, l_returnflag || l_linestatus AS value, l_linenumber AS seq, l_partkey, l_quantity, l_shipdate, l_discount, l_extendedprice,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS at_time, o_orderstatus, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_SUMMARY = f"""{_ROWS}, summary AS (SELECT entity, value, CAST(max(CASE WHEN l_quantity > 49 THEN 3 ELSE 2 END) AS INT) AS confidence, count(*) AS n, max(l_shipdate) AS latest_t,
  count(DISTINCT session) FILTER (WHERE at_time IS NOT NULL) AS timed_sessions, max(at_time) AS newest_session, min(row(session, seq, l_partkey)) AS seen FROM rows GROUP BY entity, value)"""


def _summary(read):
    confidence = F.when(F.col("l_quantity") > 49, 3).otherwise(2)
    return merges.scalar_summary(_rows(read), ["entity"], "value", t="l_shipdate", session="session", session_time="at", seen=["session", "seq", "l_partkey"], confidence=confidence)


@QUERIES(f"WITH {_SUMMARY} SELECT entity, value, confidence, n, latest_t, timed_sessions, newest_session, struct_extract_at(seen, 1) AS first_session, struct_extract_at(seen, 2) AS first_seq FROM summary")
def scalar_summary(read):
    return _summary(read).select("entity", "value", "confidence", "n", "latest_t", "timed_sessions", "newest_session", F.col("seen.session").alias("first_session"), F.col("seen.seq").alias("first_seq"))


_FACT = "SELECT entity, value, confidence, CAST(observations AS BIGINT) AS observations, alternatives FROM f WHERE place = 1"


@QUERIES(f"""WITH {_SUMMARY}, f AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY confidence DESC, n DESC, latest_t DESC, seen) AS place,
  sum(n) OVER (PARTITION BY entity) AS observations, count(*) OVER (PARTITION BY entity) - 1 AS alternatives FROM summary) {_FACT}""")
def default_merge(read):
    return merges.default_merge(_summary(read), ["entity"], "value")


@QUERIES(f"""WITH {_SUMMARY}, f AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY (timed_sessions >= 2) DESC, CASE WHEN timed_sessions >= 2 THEN newest_session END DESC NULLS LAST, confidence DESC, n DESC, latest_t DESC, seen) AS place,
  sum(n) OVER (PARTITION BY entity) AS observations, count(*) OVER (PARTITION BY entity) - 1 AS alternatives FROM summary) {_FACT}""")
def newest_wins_merge(read):
    return merges.newest_merge(_summary(read), ["entity"], "value")


@QUERIES(f"""WITH {_ROWS}, s AS (SELECT entity, l_partkey % 40 AS id, value AS kind, count(DISTINCT session) AS n FROM rows GROUP BY ALL),
m AS (SELECT *, max(n) OVER (PARTITION BY entity) AS top FROM s)
SELECT entity, kind, list_sort(list(id)) AS ids FROM m WHERE n >= 5 AND n >= top * 0.5 GROUP BY entity, kind""")
def supported_ids(read):
    rows = _rows(read).select("entity", "session", F.col("value").alias("kind"), (F.col("l_partkey") % 40).alias("id"))
    return merges.supported_ids(rows, ["entity"], "kind", "id", "session", 5, 0.5)


@QUERIES(f"""WITH {_ROWS}, s AS (SELECT entity, CAST(l_quantity AS BIGINT) AS level, count(DISTINCT session) AS n FROM rows GROUP BY ALL), m AS (SELECT *, max(n) OVER (PARTITION BY entity) AS top FROM s)
SELECT entity, min(level) AS low, max(level) AS high FROM m WHERE n >= 2 AND n >= top * 0.6 GROUP BY entity""")
def supported_range(read):
    rows = _rows(read).select("entity", "session", F.col("l_quantity").cast("long").alias("level"))
    return merges.supported_range(rows, ["entity"], "level", "session", 2, 0.6)


@QUERIES(f"""WITH {_ROWS}, s AS (SELECT l_partkey AS entity, CAST(l_quantity AS BIGINT) % 5 AS rank, count(DISTINCT session) AS n FROM rows GROUP BY ALL), m AS (SELECT *, max(n) OVER (PARTITION BY entity) AS top FROM s)
SELECT entity, any_value(rank) AS rank, any_value(n) AS sessions FROM m WHERE n = top AND n >= 2 GROUP BY entity HAVING count(*) = 1 AND any_value(rank) <> 0""")
def strict_mode(read):
    rows = _rows(read).select(F.col("l_partkey").alias("entity"), "session", (F.col("l_quantity").cast("long") % 5).alias("rank"))
    return merges.strict_mode(rows, ["entity"], "rank", "session")


@QUERIES(f"""WITH {_ROWS}, s AS (SELECT l_partkey AS entity, CAST(l_quantity AS BIGINT) % 7 AS xp, count(*) AS n FROM rows GROUP BY ALL), m AS (SELECT *, max(n) OVER (PARTITION BY entity) AS top FROM s)
SELECT entity, any_value(xp) AS xp, any_value(n) AS n FROM m WHERE n = top GROUP BY entity HAVING count(*) = 1""")
def untied_mode(read):
    rows = _rows(read).select(F.col("l_partkey").alias("entity"), (F.col("l_quantity").cast("long") % 7).alias("xp"))
    return merges.untied_mode(rows, ["entity"], "xp")


@QUERIES(f"""WITH {_ROWS}, s AS (SELECT entity, seq, l_partkey % 10 AS id, count(DISTINCT session) AS n FROM rows GROUP BY ALL),
b AS (SELECT entity, seq, arg_max(id, row(n, -id)) AS id FROM s GROUP BY entity, seq), o AS (SELECT entity, id, min(seq) AS seq FROM b GROUP BY entity, id)
SELECT entity, list(id ORDER BY seq) AS ids FROM o GROUP BY entity""")
def slot_mode(read):
    rows = _rows(read).select("entity", "session", "seq", (F.col("l_partkey") % 10).alias("id"))
    return merges.slot_mode(rows, ["entity"], "seq", "id", "session")


@QUERIES(f"""WITH {_ROWS}, w AS (SELECT *, value = 'RF' AS own, max(CAST(value = 'RF' AND l_quantity > 48 AS INT)) OVER (PARTITION BY l_partkey) AS has FROM rows),
n AS (SELECT l_partkey AS entity, l_suppkey_ AS zone, sum(CASE value WHEN 'RF' THEN 4 WHEN 'NO' THEN 2 ELSE 1 END) AS weight, min(row(session, seq)) AS seen
      FROM (SELECT *, entity AS l_suppkey_ FROM w WHERE has = 0 OR (own AND l_quantity > 48)) GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY weight DESC, seen) AS place FROM n)
SELECT entity, zone, CAST(weight AS BIGINT) AS weight FROM p WHERE place = 1""")
def weighted_mode(read):
    rows = _rows(read).select(F.col("l_partkey").alias("entity"), F.col("entity").alias("zone"), "value", "session", "seq", "l_quantity")
    weight = F.when(F.col("value") == "RF", 4).when(F.col("value") == "NO", 2).otherwise(1)
    return merges.weighted_mode(rows, ["entity"], "zone", weight, ["session", "seq"], (F.col("value") == "RF") & (F.col("l_quantity") > 48))


@QUERIES(f"""WITH {_ROWS}, r AS (SELECT l_partkey AS entity, value, l_quantity, CASE WHEN value = 'RF' THEN 0 WHEN value = 'AF' THEN 1 ELSE 2 END AS rank FROM rows),
b AS (SELECT *, min(rank) OVER (PARTITION BY entity) AS best FROM r)
SELECT entity, value, count(*) AS n FROM b WHERE rank = best GROUP BY ALL""")
def exclusive_tokens(read):
    rows = _rows(read).select(F.col("l_partkey").alias("entity"), "value", "l_quantity")
    return merges.exclusive_tokens(rows, ["entity"], "value", ["RF", "AF"]).groupBy("entity", "value").agg(F.count(F.lit(1)).alias("n"))


_SWITCH = """
WITH e AS (SELECT o_custkey AS entity, o_orderkey % 200 AS session, {side} AS side, o_orderdate AS at_time FROM orders),
s AS (SELECT entity, session, bool_and(side) AS side, bool_or(side) AS other, max(at_time) AS at_time FROM e GROUP BY ALL),
w AS (SELECT *, lag(side) OVER o AS before, lag(at_time) OVER o AS before_at FROM s WINDOW o AS (PARTITION BY entity ORDER BY at_time NULLS FIRST, session)),
n AS (SELECT entity, count(*) AS n, count(*) FILTER (WHERE side) AS t, count(*) FILTER (WHERE before <> side) AS switches, count(*) FILTER (WHERE before <> side AND before_at = at_time) AS ties,
      count(*) FILTER (WHERE at_time IS NULL) AS untimed, arg_max(side, row(coalesce(at_time, TIMESTAMP '1900-01-01'), session)) AS newest FROM w GROUP BY entity)
SELECT entity, newest AS side, n AS sessions FROM n
WHERE entity NOT IN (SELECT entity FROM s WHERE side <> other) AND CASE WHEN t = 0 OR t = n THEN n >= 2 ELSE untimed = 0 AND switches = 1 AND ties = 0 AND CASE WHEN newest THEN t ELSE n - t END >= 2 END"""


@QUERIES(_SWITCH.format(side="o_orderdate >= TIMESTAMP '1997-06-01' + INTERVAL 1 DAY * CAST(o_custkey % 900 AS INT) AND o_totalprice < 460000"))
def unanimous_switch(read):
    side = (F.col("o_orderdate") >= F.expr("timestamp_ntz'1997-06-01' + make_dt_interval(cast(o_custkey % 900 as int))")) & (F.col("o_totalprice") < 460000)
    rows = read("orders").select(F.col("o_custkey").alias("entity"), (F.col("o_orderkey") % 200).alias("session"), side.alias("side"), F.col("o_orderdate").alias("at"))
    return merges.undecided_switch(rows, ["entity"], "side", "session", "at")


@QUERIES(f"""WITH {_ROWS}, a AS (SELECT entity, count(DISTINCT session) AS n_all FROM rows GROUP BY entity),
p AS (SELECT entity, value AS faction, count(DISTINCT session) AS n_part FROM rows GROUP BY ALL),
m AS (SELECT entity, value AS faction, CAST(l_quantity > 10 AS INT) AS amount, count(DISTINCT session) AS sessions FROM rows GROUP BY ALL)
SELECT entity, faction, amount, sessions FROM m JOIN p USING (entity, faction) JOIN a USING (entity) WHERE n_part >= 2 AND n_part >= n_all * 0.2 AND sessions >= n_part * 0.8""")
def reputation_consensus(read):
    rows = _rows(read).select("entity", F.col("value").alias("faction"), (F.col("l_quantity") > 10).cast("int").alias("amount"), "session")
    return merges.consensus(rows, ["entity"], "faction", "amount", "session", presence=0.2)


@QUERIES(f"""WITH {_ROWS}, c AS (SELECT l_partkey AS entity, entity AS zone, CAST(l_quantity AS INT) // 10 AS x, seq AS y, count(*) AS n, max(l_shipdate) AS t, min(row(session, seq)) AS seen, max(CAST(value = 'RF' AS INT)) AS p FROM rows GROUP BY ALL),
z AS (SELECT entity, zone, row_number() OVER (PARTITION BY entity ORDER BY max(p) DESC, sum(n) DESC, max(t) DESC, zone) AS place FROM c GROUP BY entity, zone),
q AS (SELECT c.*, row_number() OVER (PARTITION BY c.entity ORDER BY n DESC, t DESC, seen) AS spot FROM c JOIN z ON z.entity = c.entity AND z.zone = c.zone AND z.place = 1)
SELECT entity, zone, x, y, n FROM q WHERE spot = 1""")
def trigger_location(read):
    rows = _rows(read).select(F.col("l_partkey").alias("entity"), F.col("entity").alias("zone"), F.floor(F.col("l_quantity").cast("int") / 10).cast("int").alias("x"), F.col("seq").alias("y"), "l_shipdate", "value", "session", "seq")
    return merges.located(rows, ["entity"], "zone", "x", "y", "l_shipdate", F.col("value") == "RF", ["session", "seq"])


@QUERIES(f"""WITH {_ROWS}, r AS (SELECT l_partkey % 500 AS entity, entity % 2 AS starter, o_orderstatus AS team, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE l_quantity > 25 END AS friendly, session FROM rows),
e AS (SELECT entity, starter, team, count(DISTINCT session) FILTER (WHERE NOT friendly) AS h, count(DISTINCT session) FILTER (WHERE friendly) AS k FROM r GROUP BY ALL),
t AS (SELECT entity, team, bool_and(h >= 3 AND k = 0) AS against, bool_and(k > 0 AND h = 0) AS pro, count(*) AS n FROM e GROUP BY ALL),
f AS (SELECT t.* FROM t JOIN (SELECT entity, count(DISTINCT starter) AS s FROM r GROUP BY entity) USING (entity) WHERE n = s)
SELECT DISTINCT a.entity, a.team FROM f a JOIN f b ON a.entity = b.entity AND a.pro AND b.against AND a.team <> b.team""")
def race_restriction(read):
    friendly = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).otherwise(F.col("l_quantity") > 25)
    rows = _rows(read).select((F.col("l_partkey") % 500).alias("id"), (F.col("entity") % 2).alias("starter"), F.col("o_orderstatus").alias("team"), friendly.alias("friendly"), "session").withColumnRenamed("id", "entity")
    return merges.restricted_to(rows, ["entity"], "starter", "team", "friendly", "session")


@QUERIES("SELECT l_suppkey AS entity, list_sort(list(DISTINCT l_partkey % 25)) AS ids FROM lineitem GROUP BY ALL")
def set_union(read):
    return sets.union_of(read("lineitem").select(F.col("l_suppkey").alias("entity"), (F.col("l_partkey") % 25).alias("id")), ["entity"], "id")


@QUERIES("SELECT l_suppkey AS entity, bool_or(l_discount = 0.1 AND l_quantity = 50) AS flag, min(l_quantity) AS low, median(l_extendedprice) AS middle FROM lineitem GROUP BY ALL")
def any_flag(read):
    items = read("lineitem").groupBy(F.col("l_suppkey").alias("entity"))
    return items.agg(F.bool_or((F.col("l_discount") == 0.1) & (F.col("l_quantity") == 50)).alias("flag"), F.min("l_quantity").alias("low"), F.median("l_extendedprice").alias("middle"))


@QUERIES("""WITH d AS (SELECT user_id, event_type, list_sort(list(DISTINCT CAST(props->>'k' AS BIGINT)) FILTER (WHERE value > 40)) AS ids FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL)
SELECT user_id, arg_min(event_type, row(ids IS NULL, event_type <> 'view')) AS stream, coalesce(arg_min(coalesce(ids, []), row(ids IS NULL, event_type <> 'view')), []) AS ids FROM d GROUP BY user_id""")
def preferred_stream(read):
    k = F.when(F.col("value") > 40, F.get_json_object("props", "$.k").cast("long"))
    d = read("events").where("event_type in ('view', 'click')").groupBy("user_id", F.col("event_type").alias("stream")).agg(F.array_sort(F.collect_set(k)).alias("ids"))
    return sets.preferred(d, ["user_id"], "stream", "ids", ["view", "click"])


_GAINS = """g AS (SELECT o % 11 AS quest, CASE WHEN o % 22 < 11 THEN 'A' ELSE 'H' END AS side, o AS turn, o % 40 AS session, n % 3 AS faction,
  CAST(CASE n % 3 WHEN 0 THEN CASE WHEN q < 48 THEN 40 + o % 11 * (CASE WHEN o % 11 = 4 AND o % 22 < 11 THEN 2 ELSE 1 END) ELSE 7 END WHEN 1 THEN 10 ELSE q END AS DOUBLE) AS amount, CASE WHEN n % 3 = 1 AND q < 46 THEN 0 END AS source
  FROM (SELECT l_orderkey AS o, l_linenumber AS n, l_quantity AS q FROM lineitem WHERE l_linenumber < 4))"""


@QUERIES(f"""WITH {_GAINS}, t AS (SELECT quest, side, count(DISTINCT turn) AS turns FROM g GROUP BY ALL),
p AS (SELECT quest, side, faction, count(DISTINCT turn) AS w, count(DISTINCT session) AS s FROM g WHERE source IS NULL GROUP BY ALL),
a AS (SELECT quest, side, faction, amount, count(DISTINCT session) AS n FROM g WHERE source IS NULL GROUP BY ALL),
d AS (SELECT quest, side, faction, min(amount) AS amount FROM a JOIN p USING (quest, side, faction) JOIN t USING (quest, side) WHERE w >= turns * 0.5 AND s >= 2 AND n >= 2 AND n >= s * 0.8 GROUP BY ALL HAVING count(*) = 1),
sp AS (SELECT quest, side, faction, count(DISTINCT turn) AS w, count(DISTINCT session) AS s FROM g WHERE source IS NOT NULL GROUP BY ALL),
sc AS (SELECT quest, side, faction, source, count(DISTINCT turn) AS n FROM g WHERE source IS NOT NULL GROUP BY ALL), sx AS (SELECT *, row_number() OVER (PARTITION BY quest, side, faction ORDER BY n DESC, source) AS r FROM sc),
x AS (SELECT sp.quest, sp.side, sp.faction, d.amount / 4 AS amount FROM sp JOIN sx USING (quest, side, faction) JOIN t USING (quest, side) JOIN d ON d.quest = sp.quest AND d.side = sp.side AND d.faction = sx.source
  WHERE r = 1 AND sp.w >= turns * 0.5 AND sp.s >= 2 AND sx.n >= sp.w * 0.8 AND (sp.quest, sp.side, sp.faction) NOT IN (SELECT (quest, side, faction) FROM d)),
r AS (SELECT quest, side, string_agg(faction || '=' || CAST(amount AS VARCHAR), ',' ORDER BY faction) AS rewards FROM (SELECT * FROM d UNION ALL SELECT * FROM x) GROUP BY ALL),
y AS (SELECT t.quest, count(*) AS sides, count(rewards) AS lists, count(DISTINCT rewards) AS kinds, min(rewards) AS rewards FROM t LEFT JOIN r USING (quest, side) GROUP BY ALL)
SELECT quest, rewards FROM y WHERE kinds = 1 AND (sides = 1 OR lists = sides)""")
def reputation_by_side(read):
    """Amounts by majority, spillover as a quarter of its source, and both sides of one mind."""
    o, n, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")
    first = 40 + o % 11 * F.when((o % 11 == 4) & (o % 22 < 11), 2).otherwise(1)
    amount = F.when(n % 3 == 0, F.when(q < 48, first).otherwise(7)).when(n % 3 == 1, 10).otherwise(q).cast("double")
    rows = read("lineitem").where("l_linenumber < 4").select((o % 11).alias("quest"), F.when(o % 22 < 11, "A").otherwise("H").alias("side"), o.alias("turn"), (o % 40).alias("session"), (n % 3).alias("faction"), amount.alias("amount"), F.when((n % 3 == 1) & (q < 46), 0).alias("source"))
    out = merges.decided_rewards(rows, "quest", "side", "turn", "session", "faction", "amount", "source")
    return out.select("quest", F.array_join(F.transform("rewards", lambda r: F.concat(r["faction"].cast("string"), F.lit("="), r["amount"].cast("string"))), ",").alias("rewards"))


_RACES = """st AS (SELECT DISTINCT l_orderkey % 60 AS quest, l_suppkey AS npc FROM lineitem WHERE l_orderkey % 60 = l_suppkey % 60 OR l_orderkey % 1501 = 0), re AS (SELECT l_suppkey AS npc, side, (side = 'A') = (l_suppkey % 3 > 0) AND NOT (l_suppkey % 7 = 0 AND l_linenumber = 1) AS friendly, l_orderkey % 50 AS session FROM lineitem, (SELECT unnest(['A', 'H']) AS side) WHERE l_quantity > 25),
se AS (SELECT DISTINCT l_orderkey % 60 AS quest, CASE WHEN l_orderkey % 60 % 3 > 0 OR l_orderkey % 60 % 5 = 0 THEN 'A' ELSE 'H' END AS side FROM lineitem WHERE l_orderkey % 4 < 2)"""


@QUERIES(f"""WITH {_RACES}, e AS (SELECT npc, side, count(DISTINCT session) FILTER (WHERE NOT friendly) AS h, count(DISTINCT session) FILTER (WHERE friendly) AS k FROM re GROUP BY ALL), c AS (SELECT DISTINCT quest, side, CASE side WHEN 'A' THEN 'H' ELSE 'A' END AS other FROM se)
SELECT quest, side FROM c WHERE quest IN (SELECT quest FROM st)
AND NOT EXISTS (SELECT 1 FROM st WHERE st.quest = c.quest AND NOT EXISTS (SELECT 1 FROM e WHERE e.npc = st.npc AND e.side = c.side AND k > 0 AND h = 0))
AND NOT EXISTS (SELECT 1 FROM st WHERE st.quest = c.quest AND NOT EXISTS (SELECT 1 FROM e WHERE e.npc = st.npc AND e.side = c.other AND k = 0 AND h >= 3))
AND NOT EXISTS (SELECT 1 FROM st JOIN st s2 ON s2.npc = st.npc JOIN se ON se.quest = s2.quest WHERE st.quest = c.quest AND se.side = c.other)""")
def race_restriction_siblings(read):
    """The side that alone can take a quest, unless the other saw it or another quest of its starters."""
    o, s = F.col("l_orderkey"), F.col("l_suppkey")
    items = read("lineitem")
    starters = items.where((o % 60 == s % 60) | (o % 1501 == 0)).select((o % 60).alias("quest"), s.alias("npc")).distinct()
    two = items.where("l_quantity > 25").select(s.alias("npc"), F.explode(F.array(F.lit("A"), F.lit("H"))).alias("side"), "l_linenumber", (o % 50).alias("session"))
    friendly = ((F.col("side") == "A") == (F.col("npc") % 3 > 0)) & ~((F.col("npc") % 7 == 0) & (F.col("l_linenumber") == 1))
    seen = items.where(o % 4 < 2).select((o % 60).alias("quest")).distinct().withColumn("side", F.when((F.col("quest") % 3 > 0) | (F.col("quest") % 5 == 0), "A").otherwise("H"))
    return merges.race_restrictions(starters, two.select("npc", "side", friendly.alias("friendly"), "session"), seen)


@QUERIES("""WITH r AS (SELECT user_id, event_id, ts, CASE WHEN value < 10 THEN ' ' ELSE event_type END AS text, value FROM events), l AS (SELECT user_id, arg_max(text, row(ts, -event_id)) AS text FROM r WHERE trim(text) <> '' GROUP BY 1) SELECT r.* FROM r JOIN l USING (user_id, text)""")
def latest_text(read):
    rows = read("events").select("user_id", "event_id", "ts", F.when(F.col("value") < 10, " ").otherwise(F.col("event_type")).alias("text"), "value")
    return merges.of_latest_text(rows, ["user_id"], "text", "ts", ["event_id"])
