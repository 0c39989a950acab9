"""Sinks, filters, privacy and display over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shown, text
from ..operators import emit, privacy, relations
from .query import Family

QUERIES = Family()


@QUERIES(r"""WITH r AS (SELECT part.*, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name || chr(9) || '"\' || chr(10) || chr(3) || 'x' ELSE p_name END AS s, CASE WHEN p_partkey % 5 = 0 THEN [] ELSE [p_size, 3] END AS a, CASE WHEN p_partkey % 11 = 0 THEN CAST('nan' AS DOUBLE) WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) ELSE p_size + 0.5 END AS x FROM part)
SELECT p_partkey, coalesce('"' || replace(replace(replace(replace(replace(s, '\', '\\'), '"', '\"'), chr(9), '\t'), chr(10), '\n'), chr(3), '\003') || '"', 'nil') AS s, CASE WHEN len(a) > 0 THEN '{' || a[1] || ',3}' ELSE 'nil' END AS a, CASE WHEN isnan(x) THEN 'nil' WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE CAST(x AS VARCHAR) END AS x FROM r""")
def script_literals(read):
    s = F.when(F.col("p_partkey") % 7 == 0, None).when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit('\t"\\\n\x03x'))).otherwise(F.col("p_name"))
    a = F.when(F.col("p_partkey") % 5 == 0, F.expr("filter(array(1), x -> false)")).otherwise(F.array(F.col("p_size"), F.lit(3)))
    x = F.when(F.col("p_partkey") % 11 == 0, F.lit(float("nan"))).when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("double")).otherwise(F.col("p_size") + F.lit(0.5))
    return read("part").select("p_partkey", emit.literal(s, "string").alias("s"), emit.literal(a, "array<int>").alias("a"), emit.literal(x, "double").alias("x"))


@QUERIES("""WITH r AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN '{' || p_size || ',7}' END AS a, CASE WHEN p_partkey % 3 = 0 THEN '{' || (p_size + 1) || '}' END AS b, CASE WHEN p_partkey % 5 = 0 THEN '{9}' END AS c FROM part)
SELECT k, CASE WHEN c IS NOT NULL THEN '{' || coalesce(a, 'nil') || ',' || coalesce(b, 'nil') || ',' || c || '}' WHEN b IS NOT NULL THEN '{' || coalesce(a, 'nil') || ',' || b || '}' WHEN a IS NOT NULL THEN '{' || a || '}' ELSE 'nil' END AS shown,
 CASE WHEN b IS NOT NULL THEN '{' || coalesce(replace(replace(replace(a, '{', '{{'), '}', '}}'), ',', '},{'), 'nil') || ',{' || b || '}}' WHEN a IS NOT NULL THEN '{' || replace(replace(replace(a, '{', '{{'), '}', '}}'), ',', '},{') || '}' ELSE 'nil' END AS wrapped FROM r""")
def positional_tables(read):
    """Lists by place; empty ones at the end are left out, others are nil."""
    none = F.expr("filter(array(1), x -> false)")
    k = F.col("p_partkey")
    a, b, c = F.when(k % 2 == 0, F.array("p_size", F.lit(7))).otherwise(none), F.when(k % 3 == 0, F.array(F.col("p_size") + 1)), F.when(k % 5 == 0, F.array(F.lit(9))).otherwise(none)
    return read("part").select(k.alias("k"), emit.positional([a, b, c]).alias("shown"), emit.positional([a, b], wrapped=True).alias("wrapped"))


@QUERIES("""WITH s AS (SELECT l_orderkey AS quest, list_sort(list(DISTINCT l_suppkey)) AS ids, max(l_quantity) AS level FROM lineitem WHERE l_linenumber > 4 GROUP BY ALL)
SELECT o_orderkey AS quest, '[' || o_orderkey || '] = {' || concat_ws(',', 'startedBy_add={' || array_to_string(ids, ',') || '}', 'questLevel=' || CAST(CAST(level AS BIGINT) AS VARCHAR), 'name="' || o_orderpriority || '"') || '}' AS line FROM orders LEFT JOIN s ON quest = o_orderkey""")
def corrections_lines(read):
    """Sparse records: fields in their order, those that add under their other name, excluded ones left out."""
    facts = read("lineitem").where("l_linenumber > 4").groupBy(F.col("l_orderkey").alias("quest")).agg(F.array_sort(F.collect_set("l_suppkey")).alias("startedBy"), F.max("l_quantity").alias("questLevel"))
    records = read("orders").select(F.col("o_orderkey").alias("quest"), F.col("o_orderpriority").alias("name"), F.lit(5).alias("requiredLevel")).join(facts, "quest", "left")
    return emit.lines(records, "quest", ["startedBy", "questLevel", "requiredLevel", "name"], excluded=["requiredLevel"])


@QUERIES("""SELECT c_custkey AS id, '[' || c_custkey || '] = {"' || c_name || '", ' || CASE WHEN c_custkey % 3 = 0 THEN 'nil' ELSE '{"' || c_mktsegment || '","x"}' END || '},' AS line FROM customer""")
def lookup_lines(read):
    none = F.expr("filter(array(''), x -> false)")
    rows = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, none).otherwise(F.array("c_mktsegment", F.lit("x"))).alias("lines"))
    return emit.lookup_lines(rows, "id", ["name", "lines"])


@QUERIES("SELECT p_partkey AS quest, 'db[' || p_partkey || '] = {' || p_size || ', ' || (p_size * 25) || '}' AS line FROM part")
def xp_lines(read):
    return emit.pair_lines(read("part").select(F.col("p_partkey").alias("quest"), "p_size", (F.col("p_size") * 25).alias("xp")), "quest", "p_size", "xp", "db")


@QUERIES("""SELECT (SELECT count(*) FROM orders) AS submissions, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS skipped, count(*) AS sessions, count(*) FILTER (WHERE l_linenumber > 1) AS duplicates, count(*) FILTER (WHERE l_returnflag = 'R') AS partial FROM lineitem""")
def run_metadata(read):
    submissions = read("orders").select(F.when(F.col("o_orderstatus") == "F", "bad").alias("error"))
    sessions = read("lineitem").select((F.col("l_linenumber") > 1).alias("duplicate"), F.when(F.col("l_returnflag") == "R", "cut").alias("error"))
    return emit.run_figures(submissions, sessions)


@QUERIES("""WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 16000 + o_orderkey % 7 WHEN o_orderkey % 3 = 1 THEN 11500 END AS stream, CASE WHEN o_orderkey % 2 = 0 THEN '16001' WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '10002' END AS envelope FROM orders)
SELECT k, coalesce(stream, TRY_CAST(envelope AS INT)) AS version FROM s WHERE coalesce(stream, TRY_CAST(envelope AS INT)) IS NULL OR CAST(coalesce(stream, TRY_CAST(envelope AS INT)) AS VARCHAR) LIKE '16%'""")
def client_filter(read):
    """The stream's version, else the envelope's; sessions without a known one count in."""
    k = F.col("o_orderkey")
    stream = F.when(k % 3 == 0, 16000 + k % 7).when(k % 3 == 1, 11500)
    envelope = F.when(k % 2 == 0, "16001").when(k % 5 == 0, "x").otherwise("10002")
    rows = read("orders").select(k.alias("k"), text.client_version(stream, envelope).alias("version"))
    return rows.where(text.version_is(F.col("version"), "16"))


@QUERIES("""WITH s AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '-5' WHEN c_custkey % 3 = 0 THEN '1.5' ELSE CAST(60000 + c_custkey AS VARCHAR) END AS build, CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'enUS' ELSE 'deDE' END AS locale FROM customer)
SELECT k, CASE WHEN TRY_CAST(build AS DOUBLE) > 0 AND TRY_CAST(build AS DOUBLE) = floor(TRY_CAST(build AS DOUBLE)) THEN CAST(CAST(build AS DOUBLE) AS BIGINT) END AS build, nullif(locale, '') AS locale FROM s""")
def session_client(read):
    k = F.col("c_custkey")
    build = F.when(k % 4 == 0, "-5").when(k % 3 == 0, "1.5").otherwise((60000 + k).cast("string"))
    locale = F.when(k % 5 == 0, "").when(k % 2 == 0, "enUS").otherwise("deDE")
    return read("customer").select(k.alias("k"), text.positive_whole(build).alias("build"), F.nullif(locale, F.lit("")).alias("locale"))


@QUERIES("""WITH t AS (SELECT l_returnflag AS kind, max(l_partkey) - 50 AS m FROM lineitem WHERE l_returnflag <> 'N' AND l_quantity < 40 GROUP BY 1) SELECT l_orderkey, l_linenumber, l_returnflag AS kind, l_partkey AS entity FROM lineitem LEFT JOIN t ON kind = l_returnflag WHERE m IS NULL OR l_partkey > m""")
def id_threshold(read):
    items = read("lineitem")
    limits = items.where("l_returnflag <> 'N' and l_quantity < 40").groupBy(F.col("l_returnflag").alias("kind")).agg((F.max("l_partkey") - 50).alias("max_id"))
    return emit.above(items.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("kind"), F.col("l_partkey").alias("entity")), "entity", "kind", limits)


@QUERIES("SELECT o_orderkey, o_custkey FROM orders WHERE lpad(CAST(o_orderkey AS VARCHAR), 12, '0') BETWEEN '000000000100' AND '000000000399'")
def key_range(read):
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return read("orders").where(key.between("000000000100", "000000000399")).select("o_orderkey", "o_custkey")


@QUERIES("""SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY TRY_CAST(x AS DOUBLE) NULLS LAST, x, p_partkey) AS place, p_partkey FROM (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS x FROM part) WHERE contains(lower(p_type), 'st')""")
def stream_order(read):
    """Streams whose name holds a text, in the order of their parameters: numbers by value, then texts."""
    x = F.when(F.col("p_partkey") % 4 == 0, F.col("p_type")).otherwise(F.col("p_size").cast("string"))
    rows = read("part").where(text.has_all_terms(F.col("p_type"), "ST")).withColumn("x", x)
    return relations.placed(rows, ["p_brand"], [*text.by_number(F.col("x")), F.asc("p_partkey")]).select("p_brand", "p_type", "place", "p_partkey")


@QUERIES("""SELECT o_custkey, o_orderkey, l_linenumber, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey, l_linenumber) AS place FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 40) ON l_orderkey = o_orderkey""")
def fold_order(read):
    """Winners left-joined with their observations, numbered in the order in which a fold takes them: newest session first."""
    rows = read("orders").select("o_custkey", "o_orderkey", "o_orderdate").join(read("lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), "o_orderkey", "left")
    return relations.placed(rows, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey"), F.asc_nulls_last("l_linenumber")]).select("o_custkey", "o_orderkey", "l_linenumber", "place")


@QUERIES("""WITH m AS (SELECT l_orderkey AS quest, count(DISTINCT l_suppkey) AS matched FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey AS quest, count(*) AS reported FROM lineitem GROUP BY 1) SELECT quest, matched FROM m JOIN c USING (quest) WHERE matched = reported""")
def complete_only(read):
    by = read("lineitem").groupBy(F.col("l_orderkey").alias("quest"))
    return emit.complete(by.agg(F.count_distinct("l_suppkey").alias("matched")), by.agg(F.count(F.lit(1)).alias("reported")), "quest", "matched", "reported")


@QUERIES("SELECT l_orderkey AS quest, list_sort(list(DISTINCT l_partkey)) AS givers FROM lineitem WHERE l_partkey > 100 GROUP BY 1")
def new_relations(read):
    relation = read("lineitem").groupBy(F.col("l_orderkey").alias("quest")).agg(F.collect_set("l_partkey").alias("givers"))
    return emit.new_relations(relation, "quest", "givers", F.col("member") <= 100)


@QUERIES("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS map, CASE WHEN c_custkey % 2 = 0 THEN ' china' ELSE 'none' END AS name FROM customer)
SELECT c_custkey, map, name, coalesce(a.n_regionkey, b.n_regionkey) AS n_regionkey FROM r LEFT JOIN nation a ON a.n_nationkey = map LEFT JOIN nation b ON lower(b.n_name) = trim(name)""")
def map_lookup(read):
    k = F.col("c_custkey")
    rows = read("customer").select(k, F.when(k % 3 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")).alias("map"), F.when(k % 2 == 0, " china").otherwise("none").alias("name"))
    return relations.by_id_or_name(rows, read("nation"), "map", text.normalized(F.col("name")), "n_nationkey", text.normalized(F.col("n_name")), "n_regionkey")


@QUERIES("""WITH e AS (SELECT user_id, ts, event_id, value, CAST(props->>'k' AS BIGINT) AS k, event_type FROM events), l AS (SELECT user_id, ts, event_id, [k % 3, k % 5, k % 7] AS keys FROM e WHERE event_type = 'view'), v AS (SELECT user_id, ts, event_id, k % 4 AS key, value FROM e WHERE event_type = 'click'),
p AS (SELECT user_id, ts, event_id, k % 4 + 1 AS place FROM e WHERE event_type = 'purchase'), q AS (SELECT p.*, list_extract(l.keys, place) AS key FROM p ASOF LEFT JOIN l ON p.user_id = l.user_id AND p.ts >= l.ts)
SELECT q.user_id, q.ts, q.event_id, q.place, q.key, v.value AS v FROM q ASOF LEFT JOIN v ON q.user_id = v.user_id AND q.key = v.key AND q.ts >= v.ts""")
def index_to_key(read):
    """The list that held at a time, its entry at a place, and what that entry's own stream held then."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = read("events").select("user_id", "ts", "event_id", "value", k.alias("k"), "event_type")
    lists = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("pos"), F.array(F.col("k") % 3, F.col("k") % 5, F.col("k") % 7).alias("keys"))
    values = e.where("event_type = 'click'").select("user_id", (F.col("k") % 4).alias("key"), "ts", F.col("event_id").alias("pos"), F.col("value").alias("v"))
    return relations.indexed(e.where("event_type = 'purchase'").select("user_id", "ts", "event_id", (F.col("k") % 4 + 1).alias("place")), lists, values, ["user_id"], "ts", "place")


@QUERIES("""WITH f AS (SELECT l_orderkey AS quest, list(DISTINCT l_suppkey) AS enders FROM lineitem GROUP BY 1) SELECT o_orderkey AS quest, o_totalprice AS x, enders[1] AS member FROM orders JOIN f ON quest = o_orderkey WHERE len(enders) = 1""")
def single_finisher(read):
    """Places of quests that exactly one unit ends, joined to that unit."""
    enders = read("lineitem").groupBy(F.col("l_orderkey").alias("quest")).agg(F.collect_set("l_suppkey").alias("enders"))
    return relations.single_of(read("orders").select(F.col("o_orderkey").alias("quest"), F.col("o_totalprice").alias("x")), enders, "quest", "enders")


@QUERIES("SELECT l_suppkey, min(l_shipdate) AS first, max(l_shipdate) AS last, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1")
def bounds(read):
    return read("lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@QUERIES("""WITH r AS (SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events)
SELECT event_id, k % 3 <> 0 AS same, CASE k % 8 WHEN 0 THEN 'nil' WHEN 1 THEN '("a", nil, ' || k || ')' WHEN 2 THEN '"word ' || repeat('x', 31) || '...' WHEN 3 THEN CAST(k AS VARCHAR) WHEN 4 THEN '{ id: ' || k || ' }'
  WHEN 5 THEN '({ id: ' || k || ', name: "N" }, (), {})' WHEN 6 THEN '{ 2: true, 10: 0.5, b: "5" }' ELSE '(1, ("x", ' || k || '), nil)' END AS shown,
  CASE k % 8 WHEN 1 THEN '"a", nil, ' || k WHEN 4 THEN '{"id":' || k || '}' WHEN 5 THEN '[{"id":' || k || ',"name":"N"},[],{}]' WHEN 6 THEN '{"b":"5","10":0.5,"2":true}' WHEN 7 THEN '1, [object Object], nil' ELSE '' END AS args FROM r""")
def value_preview(read):
    k = F.get_json_object("props", "$.k").cast("long")
    n = k.cast("string")
    a = F.concat(F.lit('{"x": 1, "y": ['), n, F.lit("]}"))
    b = F.concat(F.lit('{"y":['), F.when(k % 3 == 0, k + 1).otherwise(k).cast("string"), F.lit('],"x":1}'))
    kind = k % 8
    v = (
        F.when(kind == 0, None).when(kind == 1, F.concat(F.lit('{"1":"a","3":'), n, F.lit(',"n":3}'))).when(kind == 2, F.concat(F.lit("word "), F.repeat(F.lit("x"), 40))).when(kind == 3, n)
        .when(kind == 4, F.concat(F.lit('{"id":'), n, F.lit("}"))).when(kind == 5, F.concat(F.lit('[{"id":'), n, F.lit(',"name":"N"},[],{}]'))).when(kind == 6, '{"b":"5","10":0.5,"2":true}')
        .otherwise(F.concat(F.lit('{"1":1.0,"2":{"1":"x","2":'), n, F.lit(',"n":2},"n":3}')))
    )
    return read("events").select("event_id", shown.same_value(a, b).alias("same"), shown.preview(v).alias("shown"), shown.arguments(v).alias("args"))


@QUERIES("""WITH r AS (SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events) SELECT event_id, 'icon ' || k AS icon, CASE WHEN k % 2 = 0 THEN 'Item' END AS name, CAST(k AS VARCHAR) AS quantity FROM r""")
def arg_labels(read):
    """Places of a tuple under their names."""
    k = F.get_json_object("props", "$.k").cast("long")
    v = F.concat(F.lit('{"1":"icon '), k.cast("string"), F.lit('",'), F.when(k % 2 == 0, '"2":"Item",').otherwise(""), F.lit('"3":'), k.cast("string"), F.lit(',"4":true,"n":4}'))
    named = shown.labelled(v, ["icon", "name", "quantity"])
    return read("events").select("event_id", named.alias("m")).select("event_id", *[F.col("m")[n].alias(n) for n in ("icon", "name", "quantity")])


_FIXED = "(CAST({x} * 4503599627370496 AS HUGEINT) * 20 + 4503599627370496) // 9007199254740992"


@QUERIES(f"""WITH r AS (SELECT o_orderkey, CAST(floor(o_totalprice * (1 + o_orderkey % 4 * 300)) AS BIGINT) AS n FROM orders), s AS (SELECT *, floor(n / 1000.0 + 0.5) AS sec, floor(floor(n / 1000.0 + 0.5) / 60 + 0.5) AS mins,
  {_FIXED.format(x="(CASE WHEN n < 60000 THEN CAST(n AS DOUBLE) / 1000 ELSE 0 END)")} AS tenths, {_FIXED.format(x="(CASE WHEN n < 1000000000 THEN CAST(n AS DOUBLE) / 1000000 ELSE 0 END)")} AS mega FROM r)
SELECT o_orderkey, CASE WHEN n < 1000 THEN n || 'ms' WHEN n < 60000 THEN tenths // 10 || '.' || tenths % 10 || 's' WHEN sec < 3600 THEN printf('%dm %02ds', CAST(floor(sec / 60) AS BIGINT), CAST(sec AS BIGINT) % 60) ELSE printf('%dh %02dm', CAST(floor(mins / 60) AS BIGINT), CAST(mins AS BIGINT) % 60) END AS took,
 CASE WHEN n < 1000000 THEN n || ' B' ELSE mega // 10 || '.' || mega % 10 || ' MB' END AS size FROM s""")
def duration_and_size(read):
    n = F.floor(F.col("o_totalprice") * (1 + F.col("o_orderkey") % 4 * 300)).cast("long")
    return read("orders").select("o_orderkey", n.alias("n")).select("o_orderkey", shown.duration(F.col("n")).alias("took"), shown.size(F.col("n")).alias("size"))


_CRAFT = ("You create %s.", "%s creates %s.", "%2$s was made by %1$s!")


@QUERIES("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'You create ' || c_mktsegment || '.' WHEN 1 THEN '<name> creates ' || c_mktsegment || '.' WHEN 2 THEN c_mktsegment || ' was made by <name>!' WHEN 3 THEN '' END AS message FROM customer""")
def tradeskill_redaction(read):
    k, name, item = F.col("c_custkey") % 5, F.col("c_name"), F.col("c_mktsegment")
    message = F.when(k == 0, F.concat(F.lit("You create "), item, F.lit("."))).when(k == 1, F.concat(name, F.lit(" creates "), item, F.lit("."))).when(k == 2, F.concat(item, F.lit(" was made by "), name, F.lit("!"))).when(k == 3, "").otherwise(F.concat(name, F.lit(" dances")))
    return read("customer").select("c_custkey", privacy.tradeskill(message, _CRAFT[:1], _CRAFT[1:]).alias("message"))


@QUERIES("""SELECT event_id, user_id, CASE WHEN event_type IN ('view', 'click') THEN CASE WHEN event_type = 'view' THEN 'Creature-0-1-0-7-5-0A' ELSE 'GameObject-0-1-0-7-5-0A' END END AS guid, regexp_matches('You gain ' || CASE WHEN value >= 50 THEN CAST(floor(value) AS BIGINT) || '' ELSE event_type END || ' of x.', '^You gain \\d+ of .+\\.$') AS allowed, event_type IN ('view', 'click') AS sources FROM events""")
def chat_and_sources(read):
    """Ids that may stay, messages that fit a template, loots all of whose sources may stay."""
    e = F.col("event_type")
    guid = F.when(e == "view", "Creature-0-1-0-7-5-0A").when(e == "click", "GameObject-0-1-0-7-5-0A").when(e == "error", "Player-1-2").otherwise("?")
    message = F.concat(F.lit("You gain "), F.when(F.col("value") >= 50, F.floor("value").cast("string")).otherwise(e), F.lit(" of x."))
    rows = read("events").select("event_id", "user_id", guid.alias("guid"), message.alias("m"), F.lit("a").alias("a"), F.lit("b").alias("b"), F.array(F.lit("Creature-0-1-0-7-5-0A"), guid).alias("s"))
    kept = privacy.with_allowed_sources(rows, "s").select("event_id", F.lit(True).alias("sources"))
    rows = privacy.chat(rows.withColumn("allowed", privacy.message_allowed(F.col("m"), ["You gain %d of %s."])), "m", "a", "b", "guid", ["x"])
    return rows.join(kept, "event_id", "left").select("event_id", "user_id", "guid", "allowed", F.coalesce("sources", F.lit(False)).alias("sources"))


@QUERIES("""WITH s AS (SELECT 'u' || user_id AS sid, event_id, date_trunc('hour', ts) AS t, CASE WHEN event_type = 'view' THEN 'guid' ELSE 'name' END AS fn, CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'me' || user_id ELSE 'x' END ELSE 'n' END AS v FROM events)
SELECT sid, event_id, v FROM s WHERE (fn = 'name' AND NOT EXISTS (SELECT 1 FROM s m WHERE m.sid = s.sid AND m.t = s.t AND m.fn = 'guid' AND m.v = 'me' || substr(m.sid, 2))) OR (fn = 'guid' AND (sid, t) NOT IN (SELECT (sid, t) FROM s WHERE fn = 'guid' AND v = 'me' || substr(sid, 2)))""")
def self_scrub(read):
    """Samples without those that show the player, nor the names taken at the same time."""
    view = F.col("event_type") == "view"
    s = read("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sid"), "event_id", F.date_trunc("hour", "ts").alias("t"), F.when(view, "UnitGUID").otherwise("UnitName").alias("fn"), F.array(F.lit("target")).alias("params"),
                              F.when(view, F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("me"), F.col("user_id").cast("string"))).otherwise("x")).otherwise("n").alias("v"))
    own = read("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sid"), F.concat(F.lit("me"), F.col("user_id").cast("string")).alias("guid")).distinct()
    return privacy.without_self(s, own).select("sid", "event_id", "v")


@QUERIES("""SELECT user_id, max(ts) AS last FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)) >= 86400000000""")
def reminder_due(read):
    last = read("events").where("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.where(F.unix_micros(F.lit("2024-01-31").cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp")) >= 86_400_000_000)


@QUERIES(r"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Level ' || event_id || ' (Elite)' WHEN event_id % 3 = 1 THEN 'Hoch ??' ELSE 'SI:7 Agent' END AS line, event_id % 3 < 2 AS is_level, nullif(trim(replace(CASE WHEN event_id % 4 = 0 THEN ' ' || chr(10) ELSE ' a' || chr(10) || 'b ' END, chr(10), '')), '') AS name,
 CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'H' END AS side, CASE WHEN event_id % 5 = 0 THEN 2 WHEN event_id % 5 = 1 THEN 4 END AS rank, CASE event_id % 3 WHEN 1 THEN 7 WHEN 2 THEN 8 END AS quest FROM events""")
def small_decoders(read):
    """Level lines, cleaned names, sides, ranks and the quest among an event's arguments."""
    i = F.col("event_id")
    line = F.when(i % 3 == 0, F.concat(F.lit("Level "), i.cast("string"), F.lit(" (Elite)"))).when(i % 3 == 1, "Hoch ??").otherwise("SI:7 Agent")
    name = F.when(i % 4 == 0, " \n").otherwise(" a\nb ")
    side = F.when(F.col("event_type") == "view", "Alliance").when(F.col("event_type") == "click", "Horde").otherwise("Neutral")
    rank = F.when(i % 5 == 0, "rareelite").when(i % 5 == 1, "rare").otherwise("odd")
    return read("events").select("event_id", line.alias("line"), text.is_level_line(line).alias("is_level"), text.cleaned(name).alias("name"), text.side_of(side).alias("side"), text.lookup(text.RANKS, rank).alias("rank"), text.quest_id(i % 3, F.lit(7), F.lit(8)).alias("quest"))


_NAMES = ("MERCHANT_SHOW", "ADDON_LOADED", "TAXIMAP_CLOSED", "SPELLS_CHANGED", "ITEM_LOCKED", "NEW_WMO_CHUNK", "CHAT_MSG_MONEY", "GOSSIP_CLOSED", "PLAYER_TARGET_CHANGED", "UNIT_AURA")


@QUERIES(f"""SELECT event_id, {list(_NAMES)}[CAST(event_id % 10 AS INT) + 1] AS name, ['npc', 'init', 'npc', 'init', 'inventory', 'zone', 'loot', 'quest', 'target', 'other'][CAST(event_id % 10 AS INT) + 1] AS category FROM events""")
def event_categories(read):
    """Names of every category; what each must be is written out in the SQL."""
    name = F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (F.col("event_id") % 10 + 1).cast("int"))
    return read("events").select("event_id", name.alias("name")).withColumn("category", text.category_of(F.col("name")))
