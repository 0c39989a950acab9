"""Copies, keys, names and relations over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import relations
from .query import Family

QUERIES = Family()


@QUERIES("""WITH c AS (SELECT *, nullif(o_custkey % 70, 0) AS session_key FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY o_orderdate DESC, o_orderkey DESC) AS copy FROM c)
SELECT session_key, o_orderkey, o_orderdate FROM r WHERE session_key IS NULL OR copy = 1""")
def newest_copy(read):
    rows = read("orders").select(F.expr("nullif(o_custkey % 70, 0)").alias("session_key"), "o_orderkey", "o_orderdate")
    return relations.newest_copies(rows, "session_key", [F.desc("o_orderdate"), F.desc("o_orderkey")])


@QUERIES("""WITH c AS (SELECT nullif(o_custkey % 70, 0) AS k FROM orders)
SELECT count(*) AS copies, count(DISTINCT k) + count(*) FILTER (WHERE k IS NULL) AS winners, count(k) - count(DISTINCT k) AS duplicates FROM c""")
def copy_counts(read):
    rows = read("orders").select(F.expr("nullif(o_custkey % 70, 0)").alias("k"))
    n = rows.agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("k").alias("_d"), F.count("k").alias("_k"))
    return n.select("copies", (F.col("_d") + F.col("copies") - F.col("_k")).alias("winners"), (F.col("_k") - F.col("_d")).alias("duplicates"))


@QUERIES("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n <= 10")
def retention_topn(read):
    return relations.retained(read("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 10)


@QUERIES("SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0.1 AND l_quantity >= 49)")
def semi_copies(read):
    keys = read("lineitem").where("l_discount = 0.1 and l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return relations.holders(read("orders"), keys, "o_orderkey", "o_custkey")


@QUERIES("""WITH a AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'), b AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderdate < TIMESTAMP '1994-01-01')
SELECT key, 'new' AS change FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, 'gone' FROM b WHERE key NOT IN (SELECT key FROM a)""")
def anti_new_keys(read):
    orders = read("orders").withColumnRenamed("o_custkey", "key")
    return relations.key_diff(orders.where("o_orderdate >= timestamp_ntz'1998-01-01'"), orders.where("o_orderdate < timestamp_ntz'1994-01-01'"), "key")


@QUERIES("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)")
def excluded_ids_anti(read):
    excluded = read("lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return relations.without(read("part").select("p_partkey", "p_name"), excluded, ["p_partkey"])


@QUERIES("""WITH f AS (SELECT l_suppkey AS entity, 'level' AS field, max(l_quantity) AS v FROM lineitem WHERE l_discount > 0.09 GROUP BY ALL
UNION ALL SELECT l_suppkey, 'tax', max(l_tax) FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY ALL UNION ALL SELECT s_suppkey, 'balance', s_acctbal FROM supplier WHERE s_acctbal > 0)
SELECT entity, max(v) FILTER (WHERE field = 'level') AS level, max(v) FILTER (WHERE field = 'tax') AS tax, max(v) FILTER (WHERE field = 'balance') AS balance FROM f GROUP BY entity""")
def sparse_records(read):
    items, fact = read("lineitem"), lambda df, field, v: df.select("entity", F.lit(field).alias("field"), v.alias("v"))
    level = fact(items.where("l_discount > 0.09").groupBy(F.col("l_suppkey").alias("entity")).agg(F.max("l_quantity").alias("m")), "level", F.col("m"))
    tax = fact(items.where("l_suppkey % 3 = 0").groupBy(F.col("l_suppkey").alias("entity")).agg(F.max("l_tax").alias("m")), "tax", F.col("m"))
    balance = fact(read("supplier").where("s_acctbal > 0").withColumnRenamed("s_suppkey", "entity"), "balance", F.col("s_acctbal"))
    return relations.records(level.unionByName(tax).unionByName(balance), "entity", "field", "v", ["level", "tax", "balance"])


@QUERIES("""WITH q AS (SELECT l_orderkey AS quest, list(DISTINCT l_suppkey) AS givers FROM lineitem GROUP BY ALL)
SELECT giver, list_sort(list(DISTINCT quest)) AS owners FROM (SELECT quest, unnest(givers) AS giver FROM q) GROUP BY giver""")
def relation_inversion(read):
    quests = read("lineitem").groupBy(F.col("l_orderkey").alias("quest")).agg(F.collect_set("l_suppkey").alias("givers"))
    return relations.inverted(quests, "quest", "givers", "giver")


@QUERIES("SELECT c_custkey, least(c_acctbal, coalesce(m, c_acctbal)) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) / 100 AS m FROM orders GROUP BY ALL) ON c_custkey = o_custkey")
def clamp_join(read):
    limit = read("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_totalprice") / 100).alias("limit"))
    return relations.clamped(read("customer").select("c_custkey", "c_acctbal"), limit, "c_custkey", "c_acctbal", "limit")


@QUERIES("""WITH w AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '  ' || upper(p_name) || ' slain' ELSE p_name END AS wanted FROM part),
e AS (SELECT lower(trim(p_name)) AS name, arg_max(p_partkey, row(p_size, -p_partkey)) AS id FROM part WHERE p_brand <> 'Brand#1' GROUP BY 1)
SELECT p_partkey, wanted, coalesce(a.id, b.id) AS resolved FROM w LEFT JOIN e a ON a.name = lower(trim(wanted)) LEFT JOIN e b ON b.name = lower(trim(regexp_replace(trim(wanted), ' \\w+$', '')))""")
def name_resolution(read):
    """The whole name, else without its last word; evidence ranks by size."""
    wanted = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" slain"))).otherwise(F.col("p_name"))
    names = [text.normalized(F.col("wanted")), text.without_last_word(text.normalized(F.col("wanted")))]
    evidence = read("part").where("p_brand <> 'Brand#1'").withColumnRenamed("p_partkey", "id")
    return relations.resolve_in_order(read("part").select("p_partkey", wanted.alias("wanted")), evidence, names, text.normalized(F.col("p_name")), F.col("p_size"), "id")


@QUERIES("SELECT n_nationkey, n_name, (SELECT min(r_regionkey) FROM region WHERE lower(trim(r_name)) = lower(trim(n_name)) OR (lower(trim(r_name)) = 'asia' AND n_name = 'CHINA' AND false)) AS matched_id FROM nation UNION ALL SELECT r_regionkey + 100, r_name, r_regionkey FROM region")
def dim_join_by_name(read):
    left = read("nation").select("n_nationkey", "n_name").unionByName(read("region").select((F.col("r_regionkey") + 100).alias("n_nationkey"), F.col("r_name").alias("n_name")))
    return relations.by_display_name(left, read("region"), text.normalized(F.col("n_name")), text.normalized(F.col("r_name")), "r_regionkey")


@QUERIES("""WITH g AS (SELECT l_orderkey AS session, l_linenumber AS faction, round(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity / 4 ELSE l_quantity END) AS gain FROM lineitem),
s AS (SELECT a.session, a.faction, arg_max(b.faction, row(abs(b.gain), b.faction)) AS source FROM g a JOIN g b ON a.session = b.session AND a.faction <> b.faction
  AND abs(a.gain - b.gain / 4) <= 1 AND sign(a.gain) = sign(b.gain) AND abs(b.gain) > abs(a.gain) GROUP BY ALL)
SELECT g.session, g.faction, g.gain, source FROM g LEFT JOIN s USING (session, faction)""")
def spillover_split(read):
    gain = F.floor(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") / 4).otherwise(F.col("l_quantity")) + 0.5).cast("double")
    gains = read("lineitem").select(F.col("l_orderkey").alias("session"), F.col("l_linenumber").alias("faction"), gain.alias("gain"))
    return relations.split_spillover(gains, ["session"], "faction", "gain")


@QUERIES("""WITH t AS (SELECT n_nationkey AS k, n_regionkey * 100 AS a, n_nationkey * 60 + 90 AS b, n_nationkey * 60 + 94 AS c, n_nationkey * 75 AS d FROM nation),
r AS (SELECT k, s, CASE WHEN x <= 100 THEN 5 * floor((x + 2) / 5) WHEN x <= 500 THEN 10 * floor((x + 5) / 10) WHEN x <= 1000 THEN 25 * floor((x + 12) / 25) ELSE 50 * floor((x + 25) / 50) END AS x
      FROM (SELECT k, 0 AS s, a AS x FROM t UNION ALL SELECT k, 1, b FROM t UNION ALL SELECT k, 2, c FROM t UNION ALL SELECT k, 3, d FROM t)),
u AS (SELECT k, x, min(s) AS step FROM r GROUP BY k, x HAVING count(*) = 1)
SELECT c_custkey, c.k, xp, step FROM (SELECT c_custkey, c_nationkey AS k, CAST(c_custkey % 40 * 25 AS DOUBLE) AS xp FROM customer) c LEFT JOIN u ON u.k = c.k AND u.x = c.xp""")
def unique_inverse_lookup(read):
    steps = read("nation").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 100).alias("a"), (F.col("n_nationkey") * 60 + 90).alias("b"), (F.col("n_nationkey") * 60 + 94).alias("c"), (F.col("n_nationkey") * 75).alias("d"))
    rows = read("customer").select("c_custkey", F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 40 * 25).cast("double").alias("xp"))
    return relations.unique_inverse(rows, steps, "k", "xp", ["a", "b", "c", "d"], lambda x: text.tiered(x).cast("double"))


@QUERIES("""WITH RECURSIVE f AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 50 <> 0 THEN p_partkey - 1 END AS parent FROM part),
up AS (SELECT node, node AS root, 0 AS depth FROM f WHERE parent IS NULL UNION ALL SELECT f.node, up.root, up.depth + 1 FROM f JOIN up ON f.parent = up.node)
SELECT node, root, depth FROM up""")
def recursive_roots(read):
    forest = read("part").select(F.col("p_partkey").alias("node"), F.expr("case when p_partkey % 50 <> 0 then p_partkey - 1 end").alias("parent"))
    return relations.roots(forest, "node", "parent")


@QUERIES("""SELECT count(*) AS events, count(DISTINCT user_id) AS sessions, count(*) FILTER (WHERE event_type = 'signup') AS accepted, count(*) FILTER (WHERE event_type = 'purchase') AS turned_in, CAST(sum(seconds) AS BIGINT) AS seconds
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 THEN (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) // 1000000 END AS seconds FROM events)""")
def export_stats(read):
    each = read("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "signup").alias("a"), F.count_if(F.col("event_type") == "purchase").alias("p"), ((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1_000_000).cast("long").alias("s"))
    return each.agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("sessions"), F.sum("a").alias("accepted"), F.sum("p").alias("turned_in"), F.sum("s").alias("seconds"))


@QUERIES("SELECT user_id, count(*) AS events, count(DISTINCT event_type) AS streams, min(ts) AS started, max(ts) AS ended FROM events GROUP BY user_id")
def session_stats(read):
    return read("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_type").alias("streams"), F.min("ts").alias("started"), F.max("ts").alias("ended"))


@QUERIES("""
WITH RECURSIVE e AS (SELECT p_partkey AS node, 1 + (p_partkey * 7 + p_size * 31) % (SELECT max(p_partkey) FROM part) AS target FROM part),
r AS (SELECT node, target FROM e UNION SELECT r.node, e.target FROM r JOIN e ON r.target = e.node)
SELECT node, target FROM r""")
def reachable(read):
    """All parts behind a part, each pointing at one other: ways that end in cycles."""
    part = read("part")
    n = part.agg(F.max("p_partkey")).first()[0]
    edges = part.select(F.col("p_partkey").alias("node"), (1 + (F.col("p_partkey") * 7 + F.col("p_size") * 31) % n).alias("target"))
    return relations.reachable(edges, "node", "target")
