"""All fields at once: every observation from one timeline, and the records that merging them gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bundle, fields
from . import observer_queries as one
from .query import Family
from .trace_sessions import SQL, moments, stored

QUERIES = Family()

#: Sessions are dealt further by half days, so that a very long one is many tasks' work.
PART_SECONDS = 43_200


def _lookups(read):
    areas = read("region").select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("long").alias("id"))
    return {"areas": areas, "sorts": read("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("id"))}


def _observed(read):
    events, samples = stored(read)
    return fields.observed(events, samples, _lookups(read), bucket=lambda t: F.floor(t / PART_SECONDS))


def _sessions(read):
    """Sessions with the time of their first row; of every other user none is known."""
    first = moments(read).groupBy("sid", "u").agg(F.min("second").alias("_first"))
    return first.select("sid", F.when(F.col("u") % 2 == 0, F.col("_first")).alias("session_time"))


def _inner(name: str, *swaps: tuple[str, str]) -> str:
    """The SQL of one observer's query, as a subquery over the shared tables."""
    sql = one.QUERIES.sql[name]
    for a, b in swaps:
        assert a in sql
        sql = sql.replace(a, b)
    return "WITH " + sql.removeprefix(f"WITH {SQL},") if sql.startswith(f"WITH {SQL},") else sql.removeprefix(f"WITH {SQL}")


_OBJECT_NAMES = _inner("obs_object_names", ("SELECT DISTINCT sid, id AS entity, name AS value, t FROM r WHERE name IS NOT NULL AND " + one._LOCALE + " = 'enUS'", f"SELECT DISTINCT sid, id AS entity, name AS value, t, {one._LOCALE} AS locale FROM r WHERE name IS NOT NULL AND {one._LOCALE} IS NOT NULL"))
_LEVELS = _inner("obs_required_levels", ("CAST(min(greatest(held, told)) AS INT) AS value FROM", "CAST(min(greatest(held, told)) AS INT) AS value, arg_min(t, row(greatest(held, told), t)) AS t FROM"))
_XP = _inner("obs_quest_xp", ("SELECT r.sid, r.t,", "SELECT r.sid, r.tp AS t,"), ("SELECT sid, entity, xp, level FROM x", "SELECT sid, entity, xp, level, t FROM x"))

#: (entity, field, SQL of its rows, columns that differ from: value, t, high)
_PARTS = (
    ("npc", "npcName", _inner("obs_npc_names"), {"locale": "locale"}),
    ("npc", "npcSubName", _inner("obs_npc_subnames"), {"locale": "locale"}),
    ("npc", "npcLevel", _inner("obs_npc_levels"), {}),
    ("npc", "npcRank", _inner("obs_npc_ranks"), {}),
    ("npc", "npcFriendlyToFaction", _inner("obs_npc_friendliness"), {"token": "side"}),
    ("npc", "npcSpawns", _inner("obs_npc_places"), {"value": "zone", "x": "x", "y": "y", "token": "token"}),
    ("object", "objectName", _OBJECT_NAMES, {"locale": "locale"}),
    ("object", "objectSpawns", _inner("obs_object_places"), {"value": "zone", "x": "x", "y": "y", "token": "token"}),
    ("item", "itemName", _inner("obs_item_names"), {}),
    ("item", "npcDrops", f"SELECT * FROM ({_inner('obs_drops')}) WHERE kind = 'npc'", {}),
    ("item", "objectDrops", f"SELECT * FROM ({_inner('obs_drops')}) WHERE kind = 'object'", {}),
    ("quest", "questName", _inner("obs_quest_names"), {"locale": "locale"}),
    ("quest", "questLevel", _inner("obs_quest_levels"), {}),
    ("quest", "requiredLevel", _LEVELS, {"confidence": "'medium'"}),
    ("quest", "zoneOrSort", _inner("obs_zone_or_sort"), {"confidence": "'medium'"}),
    ("quest", "objectives", _inner("obs_objectives"), {"value": "id", "token": "kind", "x": "index", "extra": "text", "confidence": "'low'"}),
    ("quest", "objectiveCount", _inner("obs_objective_counts"), {}),
    ("quest", "objectivesText", _inner("obs_objective_texts"), {"value": "array_to_string(value, chr(10))", "locale": "locale"}),
    ("quest", "triggerEnd", _inner("obs_trigger_places"), {"value": "zone", "x": "x", "y": "y", "extra": "text"}),
    ("quest", "startedBy", _inner("obs_started_by"), {"token": "kind", "extra": "token", "confidence": "confidence"}),
    ("quest", "finishedBy", _inner("obs_finished_by"), {"token": "kind", "extra": "token", "confidence": "confidence"}),
    ("quest", "reputationReward", _inner("obs_reputation_rewards"), {"value": "faction", "x": "amount", "token": "side", "extra": "source"}),
    ("quest", "questXp", _XP, {"value": "xp", "x": "level"}),
    ("quest", "questFactions", _inner("obs_quest_factions"), {}),
    ("quest", "turnInPoi", _inner("obs_turn_in_places"), {"value": "zone", "x": "x", "y": "y"}),
)


def _part(entity: str, field: str, sql: str, own: dict[str, str]) -> str:
    text = lambda c: f"CAST({own[c]} AS VARCHAR) AS {c}" if c in own else f"CAST(NULL AS VARCHAR) AS {c}"
    number = lambda c: f"CAST({own.get(c, 'NULL')} AS DOUBLE) AS {c}"
    return f"SELECT sid, '{entity}' AS entity, '{field}' AS field, entity AS id, {text('locale')}, CAST({own.get('value', 'value')} AS VARCHAR) AS value, {number('x')}, {number('y')}, {text('token')}, {text('extra')}, t, {own.get('confidence', repr('high'))} AS confidence FROM ({sql})"


_ALL = f"{SQL.replace('sm AS (', 'sm AS MATERIALIZED (').replace('ev AS (', 'ev AS MATERIALIZED (')}, ob AS MATERIALIZED ({' UNION ALL '.join(_part(*p) for p in _PARTS)})"


@QUERIES(f"WITH {_ALL} SELECT * FROM ob")
def all_observations(read):
    """Every observation of every registered field."""
    return _observed(read)


#: Each field's rule again, over ``ob``; ends with relation fx(entity, id, place, name, text).
_FACTS = """
z AS (SELECT sid, CASE WHEN u % 2 = 0 THEN min(second) END AS tm FROM m GROUP BY sid, u),
o AS (SELECT ob.*, z.tm FROM ob LEFT JOIN z USING (sid) WHERE locale IS NULL OR locale = 'enUS'),
su AS (SELECT entity, field, id, value, max(CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS c, count(*) AS n, max(t) AS lt, count(DISTINCT sid) FILTER (WHERE tm IS NOT NULL) AS ts, max(tm) AS ns, min(row(sid, t, value)) AS seen FROM o GROUP BY ALL),
nw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field, id ORDER BY (ts >= 2) DESC, CASE WHEN ts >= 2 THEN ns END DESC NULLS LAST, c DESC, n DESC, lt DESC, seen) AS k FROM su WHERE field IN ('npcName', 'npcSubName', 'objectName', 'itemName', 'questName')) WHERE k = 1 AND value <> ''),
df AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field, id ORDER BY c DESC, n DESC, lt DESC, seen) AS k FROM su WHERE field IN ('questLevel', 'zoneOrSort', 'objectiveCount', 'objectivesText')) WHERE k = 1),
ss AS (SELECT field, id, token, value, count(DISTINCT sid) AS n FROM o GROUP BY ALL),
st AS (SELECT *, max(n) OVER (PARTITION BY field, id) AS top FROM ss),
sp AS (SELECT id, min(TRY_CAST(value AS BIGINT)) AS low, max(TRY_CAST(value AS BIGINT)) AS high FROM st WHERE field = 'npcLevel' AND n >= 2 AND n >= top * 0.1 GROUP BY id),
md AS (SELECT id, any_value(value) AS value FROM st WHERE field = 'npcRank' AND n = top AND n >= 2 GROUP BY id HAVING count(*) = 1 AND any_value(value) <> '0'),
v AS (SELECT id, token, sid, any_value(tm) AS tm, bool_or(value = 'true') AS f, count(DISTINCT value) AS kinds FROM o WHERE field = 'npcFriendlyToFaction' GROUP BY ALL),
vs AS (SELECT *, lag(f) OVER w AS before, lag(tm) OVER w AS before_tm FROM v WINDOW w AS (PARTITION BY id, token ORDER BY tm NULLS FIRST, sid)),
vd AS (SELECT id, token, count(*) AS n, count(*) FILTER (WHERE f) AS yes, count(*) FILTER (WHERE before <> f) AS sw, count(*) FILTER (WHERE before <> f AND before_tm = tm) AS ties, count(*) FILTER (WHERE tm IS NULL) AS untimed, arg_max(f, row(coalesce(tm, -1), sid)) AS newest FROM vs GROUP BY ALL HAVING max(kinds) = 1),
vk AS (SELECT id, token, newest FROM vd WHERE CASE WHEN yes = 0 OR yes = n THEN n >= 2 ELSE untimed = 0 AND sw = 1 AND ties = 0 AND CASE WHEN newest THEN yes ELSE n - yes END >= 2 END),
fr AS (SELECT id, coalesce(string_agg(token, '' ORDER BY token) FILTER (WHERE newest), '') AS value FROM vk GROUP BY id HAVING count(*) = 2),
lv AS (SELECT r.id, least(r.value, TRY_CAST(df.value AS BIGINT)) AS value FROM (SELECT id, min(TRY_CAST(value AS BIGINT)) AS value FROM o WHERE field = 'requiredLevel' GROUP BY id) r LEFT JOIN df ON df.field = 'questLevel' AND df.id = r.id),
dr AS (SELECT field, id, list(DISTINCT TRY_CAST(value AS BIGINT)) AS ids FROM o WHERE field IN ('npcDrops', 'objectDrops') GROUP BY ALL),
gi AS (SELECT field, id, token, list_sort(list(TRY_CAST(value AS BIGINT))) AS ids FROM st WHERE field IN ('startedBy', 'finishedBy') AND n >= 5 AND n >= top * 0.005 GROUP BY ALL),
gp AS (SELECT field, id, any_value(ids) FILTER (WHERE token = 'creature') AS a, any_value(ids) FILTER (WHERE token = 'object') AS b, any_value(ids) FILTER (WHERE token = 'item') AS c FROM gi GROUP BY ALL),
ob2 AS (SELECT id, token, TRY_CAST(x AS INT) AS slot, TRY_CAST(value AS BIGINT) AS v, count(DISTINCT sid) AS n FROM o WHERE field = 'objectives' GROUP BY ALL),
ob3 AS (SELECT id, token, slot, arg_max(v, row(n, -v)) AS v FROM ob2 GROUP BY ALL),
ob4 AS (SELECT id, token, v, min(slot) AS slot FROM ob3 GROUP BY ALL),
ob5 AS (SELECT id, count(*) AS n, list(v ORDER BY slot) FILTER (WHERE token = 'monster') AS a, list(v ORDER BY slot) FILTER (WHERE token = 'object') AS b, list(v ORDER BY slot) FILTER (WHERE token = 'item') AS c FROM ob4 GROUP BY id),
ob6 AS (SELECT ob5.* FROM ob5 JOIN df ON df.field = 'objectiveCount' AND df.id = ob5.id AND TRY_CAST(df.value AS BIGINT) = ob5.n),
tr AS (SELECT o.*, TRY_CAST(o.value AS BIGINT) AS zone, coalesce(TRY_CAST(o.value AS BIGINT) = TRY_CAST(df.value AS BIGINT), false) AS own FROM o LEFT JOIN df ON df.field = 'zoneOrSort' AND df.id = o.id WHERE o.field = 'triggerEnd' AND trim(o.extra) <> ''),
tt AS (SELECT id, arg_min(extra, row(-t, sid, extra)) AS extra FROM tr GROUP BY id),
tz AS (SELECT id, zone, x, y, count(*) AS n, max(t) AS lt, min(row(sid, x, y)) AS seen, bool_or(own) AS own, any_value(extra) AS text FROM tr JOIN tt USING (id, extra) GROUP BY ALL),
ty AS (SELECT id, zone, row_number() OVER (PARTITION BY id ORDER BY bool_or(own) DESC, sum(n) DESC, max(lt) DESC, zone) AS k FROM tz GROUP BY id, zone),
tx AS (SELECT tz.*, row_number() OVER (PARTITION BY tz.id ORDER BY n DESC, lt DESC, seen) AS k FROM tz JOIN ty ON ty.id = tz.id AND ty.zone = tz.zone AND ty.k = 1),
rr AS (SELECT id, token AS side, sid, sid || '@' || t AS turn, TRY_CAST(value AS BIGINT) AS part, x AS amount, TRY_CAST(extra AS BIGINT) AS source FROM o WHERE field = 'reputationReward'),
ra AS (SELECT id, side, count(DISTINCT turn) AS turns FROM rr GROUP BY ALL),
rp AS (SELECT id, side, part, count(DISTINCT turn) AS n_with, count(DISTINCT sid) AS n_all FROM rr WHERE source IS NULL GROUP BY ALL),
rm AS (SELECT id, side, part, amount, count(DISTINCT sid) AS s FROM rr WHERE source IS NULL GROUP BY ALL),
rd AS (SELECT id, side, part, min(amount) AS amount FROM rm JOIN rp USING (id, side, part) JOIN ra USING (id, side) WHERE n_with >= turns * 0.5 AND n_all >= 2 AND s >= 2 AND s >= n_all * 0.8 GROUP BY ALL HAVING count(*) = 1),
rs AS (SELECT id, side, part, count(DISTINCT turn) AS n_with, count(DISTINCT sid) AS n_all FROM rr WHERE source IS NOT NULL GROUP BY ALL),
rt AS (SELECT id, side, part, arg_max(source, row(n, -source)) AS source, max(n) AS n FROM (SELECT id, side, part, source, count(DISTINCT turn) AS n FROM rr WHERE source IS NOT NULL GROUP BY ALL) GROUP BY ALL),
rx AS (SELECT rs.id, rs.side, rs.part, rd.amount / 4 AS amount FROM rs JOIN rt USING (id, side, part) JOIN ra ON ra.id = rs.id AND ra.side = rs.side JOIN rd ON rd.id = rs.id AND rd.side = rs.side AND rd.part = rt.source
  WHERE rs.n_with >= turns * 0.5 AND rs.n_all >= 2 AND rt.n >= rs.n_with * 0.8 AND NOT EXISTS (SELECT 1 FROM rd d WHERE d.id = rs.id AND d.side = rs.side AND d.part = rs.part)),
rl AS (SELECT id, side, list({'p': part, 'a': amount} ORDER BY part) AS l FROM (SELECT * FROM rd UNION ALL SELECT * FROM rx) GROUP BY ALL),
rw AS (SELECT id, any_value(l) AS l FROM ra LEFT JOIN rl USING (id, side) GROUP BY id HAVING count(DISTINCT l) = 1 AND count(l) = count(*)),
qs AS (SELECT DISTINCT id AS quest, value AS side FROM o WHERE field = 'questFactions'),
qn AS (SELECT id AS quest, unnest(ids) AS npc FROM gi WHERE field = 'startedBy' AND token = 'creature' AND id NOT IN (SELECT id FROM o WHERE field = 'startedBy' AND token <> 'creature')),
qr AS (SELECT id AS npc, token AS side, count(DISTINCT sid) FILTER (WHERE value = 'false') AS bad, count(DISTINCT sid) FILTER (WHERE value = 'true') AS good FROM o WHERE field = 'npcFriendlyToFaction' GROUP BY ALL),
qf AS (SELECT quest, s.side, bool_and(coalesce(bad >= 3 AND good = 0, false) AND NOT EXISTS (SELECT 1 FROM qn y JOIN qs ON qs.quest = y.quest WHERE y.npc = qn.npc AND qs.side = s.side)) AS against, bool_and(coalesce(good > 0 AND bad = 0, false)) AS for_
  FROM qn, (VALUES ('A'), ('H')) s(side) LEFT JOIN qr ON qr.npc = qn.npc AND qr.side = s.side GROUP BY ALL),
rq AS (SELECT a.quest AS id, a.side AS value FROM qf a JOIN qf b ON a.quest = b.quest AND a.side <> b.side AND b.against JOIN qs ON qs.quest = a.quest AND qs.side = a.side WHERE a.for_),
fn AS (SELECT id AS quest, coalesce(a, []) AS a, coalesce(b, []) AS b FROM gp WHERE field = 'finishedBy' AND len(coalesce(a, [])) + len(coalesce(b, [])) + len(coalesce(c, [])) = 1),
zo AS (SELECT field, id, TRY_CAST(value AS BIGINT) AS zone, token, sid, t FROM o WHERE field IN ('npcSpawns', 'objectSpawns')
  UNION ALL SELECT 'npcSpawns', a[1], TRY_CAST(value AS BIGINT), 'questpoi', sid, t FROM o JOIN fn ON o.field = 'turnInPoi' AND fn.quest = o.id AND len(a) = 1 UNION ALL SELECT 'objectSpawns', b[1], TRY_CAST(value AS BIGINT), 'questpoi', sid, t FROM o JOIN fn ON o.field = 'turnInPoi' AND fn.quest = o.id AND len(b) = 1),
zw AS (SELECT field, id, zone, sum(CASE token WHEN 'questpoi' THEN 4 WHEN 'questnpc' THEN 3 WHEN 'loot' THEN 3 WHEN 'npc' THEN 2 WHEN 'target' THEN 1 ELSE 0 END) AS w, min(row(sid, t, zone)) AS seen FROM zo WHERE token = 'questpoi' OR (field, id) NOT IN (SELECT (field, id) FROM zo WHERE token = 'questpoi') GROUP BY ALL),
zb AS (SELECT *, row_number() OVER (PARTITION BY field, id ORDER BY w DESC, seen) AS k FROM zw),
fx AS (
  SELECT 'npc' AS entity, id, 0 AS place, 'name' AS name, {q} AS text FROM nw WHERE field = 'npcName' UNION ALL SELECT 'npc', id, 1, 'subName', {q} FROM nw WHERE field = 'npcSubName'
  UNION ALL SELECT 'npc', id, 2, 'minLevel', '' || low FROM sp UNION ALL SELECT 'npc', id, 3, 'maxLevel', '' || high FROM sp UNION ALL SELECT 'npc', id, 4, 'rank', value FROM md UNION ALL SELECT 'npc', id, 5, 'friendlyToFaction', {q} FROM fr WHERE value <> ''
  UNION ALL SELECT 'npc', id, 6, 'zoneID', '' || zone FROM zb WHERE k = 1 AND field = 'npcSpawns' UNION ALL SELECT 'object', id, 7, 'name', {q} FROM nw WHERE field = 'objectName' UNION ALL SELECT 'object', id, 8, 'zoneID', '' || zone FROM zb WHERE k = 1 AND field = 'objectSpawns'
  UNION ALL SELECT 'item', id, 9, 'name', {q} FROM nw WHERE field = 'itemName' UNION ALL SELECT 'item', id, 10, 'npcDrops_add', '{{' || array_to_string(list_sort(ids), ',') || '}}' FROM dr WHERE field = 'npcDrops' UNION ALL SELECT 'item', id, 11, 'objectDrops_add', '{{' || array_to_string(list_sort(ids), ',') || '}}' FROM dr WHERE field = 'objectDrops'
  UNION ALL SELECT 'quest', id, 12, 'name', {q} FROM nw WHERE field = 'questName' UNION ALL SELECT 'quest', id, 13, 'questLevel', value FROM df WHERE field = 'questLevel' UNION ALL SELECT 'quest', id, 14, 'requiredLevel', '' || value FROM lv
  UNION ALL SELECT 'quest', id, 15, 'zoneOrSort', value FROM df WHERE field = 'zoneOrSort' UNION ALL SELECT 'quest', id, 16, 'objectives', {wrapped} FROM ob6
  UNION ALL SELECT 'quest', id, 17, 'objectivesText', '{{"' || replace(value, chr(10), '","') || '"}}' FROM df WHERE field = 'objectivesText'
  UNION ALL SELECT 'quest', id, 18, 'triggerEnd', '{{"' || text || '",{{[' || zone || ']={{{{' || {x} || ',' || {y} || '}}}}}}}}' FROM tx WHERE k = 1
  UNION ALL SELECT 'quest', id, 19, 'startedBy_add', {lists} FROM gp WHERE field = 'startedBy' UNION ALL SELECT 'quest', id, 20, 'finishedBy_add', {lists} FROM gp WHERE field = 'finishedBy'
  UNION ALL SELECT 'quest', id, 21, 'reputationReward', '{{' || array_to_string(list_transform(l, lambda r: '{{' || r.p || ',' || {amount} || '}}'), ',') || '}}' FROM rw UNION ALL SELECT 'quest', id, 22, 'requiredRaces', {q} FROM rq)"""


def _facts() -> str:
    number = lambda c: f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"
    one_ = lambda c, item: f"CASE WHEN len({c}) > 0 THEN '{{' || array_to_string({item}, ',') || '}}' END"

    def lists(wrapped: bool) -> str:
        a, b, c = (one_(n, f"list_transform({n}, lambda i: '{{' || i || '}}')" if wrapped else n) for n in "abc")
        # the empty lists at the end are left out
        return f"CASE WHEN {c} IS NOT NULL THEN '{{' || coalesce({a}, 'nil') || ',' || coalesce({b}, 'nil') || ',' || {c} || '}}' WHEN {b} IS NOT NULL THEN '{{' || coalesce({a}, 'nil') || ',' || {b} || '}}' ELSE '{{' || {a} || '}}' END"

    return _FACTS.split("fx AS (")[0] + "fx AS (" + _FACTS.split("fx AS (")[1].format(q="'\"' || value || '\"'", x=number("x"), y=number("y"), amount=number("r.a"), wrapped=lists(True), lists=lists(False))


@QUERIES(f"""WITH {_ALL}, {_facts()} SELECT entity, id, '[' || id || '] = {{' || string_agg(name || '=' || text, ',' ORDER BY place) || '}}' AS line FROM fx WHERE text IS NOT NULL GROUP BY entity, id""")
def record_lines(read):
    """From recorded sessions to a script line for every npc, object, item and quest."""
    return bundle.lines(bundle.facts(bundle.Evidence(fields.written(_observed(read)), _sessions(read))))


_LOOKUPS = f"""WITH {_ALL}, z AS (SELECT sid, CASE WHEN u % 2 = 0 THEN min(second) END AS tm FROM m GROUP BY sid, u),
o AS (SELECT ob.*, z.tm FROM ob LEFT JOIN z USING (sid) WHERE locale <> 'enUS'),
su AS (SELECT entity, field, locale, id, value, max(CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) AS c, count(*) AS n, max(t) AS lt, count(DISTINCT sid) FILTER (WHERE tm IS NOT NULL) AS ts, max(tm) AS ns, min(row(sid, t, value)) AS seen FROM o GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY field, locale, id ORDER BY CASE WHEN field <> 'objectivesText' THEN ts >= 2 END DESC, CASE WHEN field <> 'objectivesText' AND ts >= 2 THEN ns END DESC NULLS LAST, c DESC, n DESC, lt DESC, seen) AS k FROM su),
w AS (SELECT entity, locale, id, max(value) FILTER (WHERE field IN ('npcName', 'questName', 'objectName', 'itemName')) AS name, max(nullif(value, '')) FILTER (WHERE field = 'npcSubName') AS sub, max(value) FILTER (WHERE field = 'objectivesText') AS texts FROM k WHERE k = 1 GROUP BY ALL)
SELECT entity, locale, id, '[' || id || '] = ' || CASE entity WHEN 'npc' THEN '{{"' || name || '", ' || coalesce('"' || sub || '"', 'nil') || '}}' WHEN 'quest' THEN '{{"' || name || '", ' || coalesce('{{"' || replace(texts, chr(10), '","') || '"}}', 'nil') || '}}' ELSE '"' || name || '"' END || ',' AS line FROM w WHERE name IS NOT NULL"""


@QUERIES(_LOOKUPS)
def localized_lines(read):
    """A line for every translated name of every locale but the one that records hold."""
    return bundle.lookups(fields.written(_observed(read)), _sessions(read))
