"""Scalar functions applied to whole tables; ids, links and objectives are composed from columns first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from .query import Family

QUERIES = Family()


@QUERIES("""WITH g AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Creature' WHEN 1 THEN 'GameObject' WHEN 2 THEN 'Player' WHEN 3 THEN 'Pet' ELSE 'Corpse' END || CASE WHEN event_id % 11 = 0 THEN '-x' ELSE '-0-5208-0-7-' || user_id || '-' || lpad(hex(event_id), 6, '0') END AS guid FROM events),
p AS (SELECT *, string_split(guid, '-') AS parts, CASE split_part(guid, '-', 1) WHEN 'Creature' THEN 'npc' WHEN 'Pet' THEN 'npc' WHEN 'GameObject' THEN 'object' WHEN 'Player' THEN 'player' ELSE 'unknown' END AS kind FROM g)
SELECT event_id, kind, CASE WHEN kind IN ('npc', 'object') AND len(parts) >= 3 THEN CAST(parts[-2] AS BIGINT) END AS id, CASE WHEN kind IN ('npc', 'object') AND len(parts) >= 3 THEN parts[-1] END AS spawn FROM p""")
def guid_parse(read):
    prefix = F.element_at(F.array(*[F.lit(x) for x in ("Creature", "GameObject", "Player", "Pet", "Corpse")]), (F.col("event_id") % 5 + 1).cast("int"))
    rest = F.when(F.col("event_id") % 11 == 0, F.lit("-x")).otherwise(F.concat(F.lit("-0-5208-0-7-"), F.col("user_id").cast("string"), F.lit("-"), F.lpad(F.hex("event_id"), 6, "0")))
    return read("events").select("event_id", text.parse_guid(F.concat(prefix, rest)).alias("g")).select("event_id", "g.*")


@QUERIES(r"""WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE 'You get |Hitem:' || p_partkey || '::::1|h[' || p_name || ']|h.' END AS link FROM part)
SELECT p_partkey, CAST(nullif(regexp_extract(link, '\|Hitem:(\d+):[^|]*\|h\[([^\]]*)\]\|h', 1), '') AS BIGINT) AS id, CASE WHEN p_partkey % 7 <> 0 THEN regexp_extract(link, '\|Hitem:(\d+):[^|]*\|h\[([^\]]*)\]\|h', 2) END AS name FROM l""")
def link_parse(read):
    link = F.when(F.col("p_partkey") % 7 == 0, F.col("p_name")).otherwise(F.concat(F.lit("You get |Hitem:"), F.col("p_partkey").cast("string"), F.lit("::::1|h["), F.col("p_name"), F.lit("]|h.")))
    return read("part").select("p_partkey", text.parse_link(link).alias("l")).select("p_partkey", "l.id", "l.name")


@QUERIES("""SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 1 THEN ' slain' ELSE '' END AS name FROM part""")
def counter_strip(read):
    n = F.concat((F.col("p_partkey") % 9).cast("string"), F.lit("/"), (F.col("p_partkey") % 9 + 1).cast("string"))
    shown = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), n, F.lit(" "), F.col("p_name"), F.lit(" Slain"))).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" slain: "), n)).otherwise(F.concat("p_name", F.lit(" : "), n, F.lit(" ")))
    return read("part").select("p_partkey", text.objective_name(shown, F.col("p_partkey") % 3 == 0).alias("name"))


@QUERIES(r"""WITH l AS (SELECT conv_id, turn, list_transform(string_split_regex(text, '\r?\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS lines FROM conversations),
i AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda k: lines[k] <> '') AS f FROM l)
SELECT conv_id, turn, CASE WHEN len(f) > 0 THEN lines[list_min(f):list_max(f)] ELSE [] END AS lines FROM i""")
def line_split(read):
    return read("conversations").select("conv_id", "turn", text.lines_of(F.col("text")).alias("lines"))


@QUERIES("""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN q <= 100 THEN 5 * floor((q + 2) / 5) WHEN q <= 500 THEN 10 * floor((q + 5) / 10) WHEN q <= 1000 THEN 25 * floor((q + 12) / 25) ELSE 50 * floor((q + 25) / 50) END AS BIGINT) AS xp
FROM (SELECT *, CAST(l_quantity * 37 AS BIGINT) AS q FROM lineitem)""")
def tiered_rounding(read):
    return read("lineitem").select("l_orderkey", "l_linenumber", text.tiered((F.col("l_quantity") * 37).cast("long")).cast("long").alias("xp"))


@QUERIES("SELECT event_id, floor((value - 25) * 10 + 0.5) / 10 AS one, floor((value - 25) / 50 * 10000 + 0.5) / 100 AS pct FROM events")
def half_up_rounding(read):
    x = F.col("value") - 25
    return read("events").select("event_id", text.half_up(x, 1).alias("one"), text.percent(x / 50).alias("pct"))


@QUERIES("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN substr(sha256(CAST(o_orderkey * 100 AS VARCHAR) || '|' || CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) || '.5' END), 1, 16) END AS session_key FROM orders""")
def session_key(read):
    key = F.col("o_orderkey")
    started = F.when(key % 10 != 0, (key * 100).cast("double"))
    return read("orders").select("o_orderkey", text.session_key(started, F.when(key % 2 == 0, key.cast("double")).otherwise(key + F.lit(0.5))).alias("session_key"))


@QUERIES("SELECT c_custkey, c_name FROM customer WHERE CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) / 4294967296.0 < 0.05")
def hash_sample(read):
    return read("customer").where(text.sampled(F.col("c_name"), 5)).select("c_custkey", "c_name")


@QUERIES("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, props->>'missing' AS missing FROM events WHERE CAST(props->>'k' AS BIGINT) >= 90")
def json_extract(read):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return read("events").select("event_id", k.alias("k"), F.get_json_object("props", "$.missing").alias("missing")).where("k >= 90")


_NAMES = ("QUEST_TURNED_IN", "CHAT_MSG_LOOT", "CHAT_MSG_COMBAT_XP", "CHAT_MSG_SAY", "NAME_PLATE_UNIT_ADDED", "ZONE_CHANGED", "BAG_UPDATE", "GOSSIP_SHOW", "PLAYER_REGEN_ENABLED", "MERCHANT_SHOW")


@QUERIES(f"""WITH n AS (SELECT event_id, {list(_NAMES)}[CAST(event_id % 10 AS INT) + 1] AS name FROM events),
c AS (SELECT *, CASE WHEN starts_with(name, 'QUEST_') OR name = 'GOSSIP_SHOW' THEN 'quest' WHEN name = 'CHAT_MSG_LOOT' THEN 'loot' WHEN starts_with(name, 'CHAT_MSG_COMBAT') OR name = 'PLAYER_REGEN_ENABLED' THEN 'combat' WHEN starts_with(name, 'CHAT_MSG_') THEN 'chat'
  WHEN starts_with(name, 'NAME_PLATE_') THEN 'target' WHEN starts_with(name, 'ZONE_') THEN 'zone' WHEN starts_with(name, 'BAG_') THEN 'inventory' WHEN name = 'MERCHANT_SHOW' THEN 'npc' ELSE 'other' END AS category FROM n)
SELECT event_id, name, category FROM c WHERE category IN ('quest', 'chat', 'combat', 'other') AND contains(lower(name), 'e')""")
def event_category_filter(read):
    name = F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (F.col("event_id") % 10 + 1).cast("int"))
    rows = read("events").select("event_id", name.alias("name")).withColumn("category", text.category_of(F.col("name")))
    return rows.where(F.col("category").isin("quest", "chat", "combat", "other") & text.has_all_terms(F.col("name"), "E"))


@QUERIES("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS faction, CASE WHEN event_id % 4 = 0 THEN NULL WHEN value >= 10 THEN floor(value) ELSE 0 - floor(value) END AS amount FROM events""")
def standing_parse(read):
    amount = F.floor("value").cast("string")
    message = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("You gain "), amount)).otherwise(F.concat(F.lit("Reputation with "), F.col("event_type"), F.when(F.col("value") >= 10, F.lit(" increased by ")).otherwise(F.lit(" decreased by ")), amount, F.lit(".")))
    return read("events").select("event_id", text.parse_standing(message).alias("s")).select("event_id", "s.faction", F.col("s.amount").cast("double").alias("amount"))


@QUERIES(r"""SELECT conv_id, turn, regexp_replace(regexp_replace(text, '(^|[^A-Za-z])(they)s?([^A-Za-z]|$)', '\1<name>\3', 'g'), '$^', '') AS text FROM (SELECT conv_id, turn, 'they ' || turn || ' theys|r say they.' AS text FROM conversations)""")
def redact_names(read):
    rows = read("conversations").select("conv_id", "turn", F.concat(F.lit("they "), F.col("turn").cast("string"), F.lit(" theys|r say they.")).alias("text"))
    return rows.withColumn("text", text.redacted(F.col("text"), ["the", "they"]))


@QUERIES("SELECT label, median(x) AS x, median(y) AS y, count(*) AS n FROM (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings) GROUP BY label")
def median_xy(read):
    rows = read("embeddings").select("label", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return rows.groupBy("label").agg(F.median("x").alias("x"), F.median("y").alias("y"), F.count(F.lit(1)).alias("n"))


@QUERIES("""SELECT page_id, url FROM pages WHERE contains(lower(url), 'example') AND contains(lower(url), 'ref') ORDER BY page_id DESC LIMIT 50""")
def multi_term_search(read):
    return read("pages").where(text.has_all_terms(F.col("url"), "Example  ref")).select("page_id", "url").orderBy(F.desc("page_id")).limit(50)


@QUERIES("""SELECT s_suppkey, printf('%02d:%02d.%03d', m // 60000, m // 1000 % 60, m % 1000) AS shown FROM (SELECT s_suppkey, CAST(floor(abs(s_acctbal) * 1000 + 0.5) AS BIGINT) AS m FROM supplier)""")
def clock_format(read):
    return read("supplier").select("s_suppkey", text.clock_text(F.abs("s_acctbal")).alias("shown"))
