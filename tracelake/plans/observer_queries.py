"""Observers over the sessions of ``trace_sessions``; the checking SQL looks every value up by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import dialogs, observers, rewards
from ..operators import objectives as goals
from .query import Family
from .trace_sessions import SQL, stored

QUERIES = Family()

_TOKENS = "('target', 'npc', 'questnpc')"


def _kind(g: str) -> str:
    return f"CASE split_part({g}, '-', 1) WHEN 'Creature' THEN 'npc' WHEN 'GameObject' THEN 'object' WHEN 'Player' THEN 'player' ELSE 'unknown' END"


def _id(g: str) -> str:
    return f"CASE WHEN len(string_split({g}, '-')) >= 3 AND split_part({g}, '-', 1) <> 'Player' THEN TRY_CAST(list_extract(string_split({g}, '-'), -2) AS BIGINT) END"


def _last(fn: str, row: str = "r", where: str = "true", t: str | None = None, op: str = "<=") -> str:
    """The value that a stream held at a row's time."""
    return f"struct_extract((SELECT arg_max({{'v': s.v}}, row(s.t, s.pos)) FROM sm s WHERE s.sid = {row}.sid AND s.fn = '{fn}' AND {where} AND s.t {op} {t or row + '.t'}), 'v')"


def _clean(v: str) -> str:
    return f"nullif(regexp_replace(regexp_replace({v}, '[\\r\\n]+', '', 'g'), '^\\s+|\\s+$', '', 'g'), '')"


def _name(v: str) -> str:
    """A recorded name: the first of a tuple, or the value."""
    return _clean(f"CASE WHEN {v} LIKE '{{%' THEN {v}->>'$.\"1\"' ELSE {v} END")


_LOCALE = _last("GetLocale")
_SIDE = lambda v: f"CASE {v} WHEN 'Alliance' THEN 'A' WHEN 'Horde' THEN 'H' END"
_UNITS = f"u AS (SELECT sid, p1 AS token, t, tp, pos, {_kind('v')} AS kind, {_id('v')} AS id FROM sm WHERE fn = 'UnitGUID' AND p1 IN {_TOKENS} AND v IS NOT NULL)"
_LOOTS = f"""o AS (SELECT DISTINCT sid, t, {_id('guid')} AS id FROM (SELECT sid, t, unnest([CASE WHEN v LIKE '[%' THEN v->>'$[0]' ELSE v->>'$."1"' END, v->>'$."3"']) AS guid FROM sm WHERE fn = 'GetLootSourceInfo' AND v IS NOT NULL)
  WHERE {_kind('guid')} = 'object' AND (sid, t) IN (SELECT (sid, t) FROM ev WHERE e = 'LOOT_READY'))"""


@QUERIES(f"WITH {SQL}, {_UNITS} SELECT sid, token, t, kind, id FROM u WHERE kind IN ('npc', 'object') AND id IS NOT NULL")
def obs_encounters(read):
    return _both(read, lambda s, kind: observers.encounters(s, kind).select("sid", "token", "t", F.lit(kind).alias("kind"), "id"))


def _both(read, f):
    s = stored(read)[1]
    return f(s, "npc").unionByName(f(s, "object"))


@QUERIES(f"WITH {SQL} SELECT sid, t, CAST(v AS BIGINT) AS id FROM sm WHERE fn = 'GetQuestID' AND v <> '0'")
def obs_quest_encounters(read):
    _, samples = stored(read)
    return observers.quest_encounters(samples).select("sid", "t", "id")


@QUERIES(f"WITH {SQL}, {_LOOTS} SELECT sid, t, id FROM o")
def obs_object_loots(read):
    events, samples = stored(read)
    return observers.object_loots(events, samples).select("sid", "t", "id").distinct()


@QUERIES(f"""WITH {SQL}, {_UNITS}, r AS (SELECT sid, t, id, {_last('UnitName', 'u', 's.p1 = u.token')} AS raw FROM u WHERE kind = 'npc' AND id IS NOT NULL)
SELECT * FROM (SELECT sid, id AS entity, {_name('raw')} AS value, t, {_LOCALE} AS locale FROM r) WHERE value IS NOT NULL AND locale IS NOT NULL""")
def obs_npc_names(read):
    _, samples = stored(read)
    return observers.names(samples).select("sid", "entity", "value", "t", "locale")


@QUERIES(f"""WITH {SQL}, {_UNITS}, {_LOOTS}, r AS (SELECT sid, t, id, {_name(_last('UnitName', 'u', 's.p1 = u.token'))} AS name FROM u WHERE kind = 'object'
  UNION ALL SELECT sid, t, id, {_last('GameObjectName', 'l')} FROM (SELECT DISTINCT sid, t, id FROM o) l)
SELECT DISTINCT sid, id AS entity, name AS value, t FROM r WHERE name IS NOT NULL AND {_LOCALE} = 'enUS'""")
def obs_object_names(read):
    """Names in one locale, of objects met and looted."""
    events, samples = stored(read)
    return observers.in_locale(observers.names(samples, "object", events)).select("sid", "entity", "value", "t").distinct()


_GUIDS = f"g AS (SELECT sid, p1 AS token, t, tp, {_kind('v')} AS kind, {_id('v')} AS id, coalesce(lead(tp) OVER (PARTITION BY sid, p1, t ORDER BY tp), CAST('infinity' AS DOUBLE)) AS nxt FROM sm WHERE fn = 'UnitGUID')"


@QUERIES(f"""WITH {SQL}, {_GUIDS}, r AS (SELECT g.*, (SELECT arg_min({{'v': s.v}}, row(s.tp, s.pos)) FROM sm s WHERE s.sid = g.sid AND s.fn = 'UnitSubName' AND s.p1 = g.token AND s.t = g.t AND s.tp >= g.tp AND s.tp < g.nxt) AS x FROM g WHERE token = 'mouseover' AND kind = 'npc')
SELECT sid, id AS entity, CASE WHEN regexp_matches(x['v'], '^\\S+ (\\d+|\\?\\?)( ?\\([^)]*\\))?$') THEN '' ELSE x['v'] END AS value, t, locale FROM (SELECT r.*, {_LOCALE} AS locale FROM r) WHERE x['v'] IS NOT NULL AND locale IS NOT NULL""")
def obs_npc_subnames(read):
    _, samples = stored(read)
    return observers.subnames(samples).select("sid", "entity", "value", "t", "locale")


def _held(fn: str, place: str) -> str:
    """Units with what a state stream held up to the token's next unit."""
    return f"""{_GUIDS}, h AS (SELECT g.sid, g.token, g.t, g.id, (SELECT arg_max({{'v': s.v}}, row(s.t, s.tp, s.pos)) FROM sm s WHERE s.sid = g.sid AND s.fn = '{fn}' AND {place} = g.token AND (s.t < g.t OR (s.t = g.t AND s.tp < g.nxt))) AS x
  FROM g WHERE token IN ('target', 'mouseover') AND kind = 'npc' AND (EXISTS (SELECT 1 FROM sm s WHERE s.sid = g.sid AND s.fn = '{fn}' AND {place} = g.token AND s.t = g.t)
    OR EXISTS (SELECT 1 FROM ev WHERE ev.sid = g.sid AND ev.t = g.t AND e IN ('PLAYER_TARGET_CHANGED', 'UPDATE_MOUSEOVER_UNIT'))))"""


@QUERIES(f"WITH {SQL}, {_held('UnitLevel', 's.p1')} SELECT sid, id AS entity, CAST(x['v'] AS INT) AS value, min(t) AS t FROM h WHERE CAST(x['v'] AS INT) >= 1 GROUP BY ALL")
def obs_npc_levels(read):
    events, samples = stored(read)
    return observers.levels(samples, events).select("sid", "entity", "value", "t")


@QUERIES(f"WITH {SQL}, {_held('UnitClassification', 's.p1')}, k AS (SELECT sid, id AS entity, CASE x['v'] WHEN 'normal' THEN 0 WHEN 'elite' THEN 1 WHEN 'rare' THEN 4 END AS value, t FROM h) SELECT sid, entity, value, min(t) AS t FROM k WHERE value IS NOT NULL GROUP BY ALL")
def obs_npc_ranks(read):
    events, samples = stored(read)
    return observers.ranks(samples, events).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, {_held('UnitReaction', 's.p2')}, r AS (SELECT sid, id AS entity, CAST(x['v'] AS INT) >= 4 AS value, t FROM h), k AS (SELECT r.*, {_SIDE(_last('UnitFactionGroup'))} AS side FROM r)
SELECT sid, entity, value, side, min(t) AS t FROM k WHERE value IS NOT NULL AND side IS NOT NULL GROUP BY ALL""")
def obs_npc_friendliness(read):
    events, samples = stored(read)
    return observers.friendliness(samples, events).select("sid", "entity", "value", "side", "t")


def _places(rows: str) -> str:
    return f"""p AS (SELECT r.*, {_last('C_Map.GetBestMapForUnit')} AS z, {_last('C_Map.GetPlayerMapPosition')} AS xy FROM ({rows}) r)"""


_SPOT = "CAST(z AS BIGINT) AS zone, floor(CAST(xy->>'$.x' AS DOUBLE) * 10000 + 0.5) / 100 AS x, floor(CAST(xy->>'$.y' AS DOUBLE) * 10000 + 0.5) / 100 AS y"


@QUERIES(f"""WITH {SQL}, {_UNITS}, {_places("SELECT * FROM u WHERE kind = 'npc' AND id IS NOT NULL")}
SELECT sid, id AS entity, {_SPOT}, t, token FROM p WHERE z IS NOT NULL AND xy IS NOT NULL AND (token <> 'target' OR sid NOT IN (SELECT sid FROM sm WHERE fn = 'CheckInteractDistance') OR {_last('CheckInteractDistance', 'p')} = 'true')""")
def obs_npc_places(read):
    _, samples = stored(read)
    return observers.places(samples).select("sid", "entity", "value.zone", "value.x", "value.y", "t", "token")


@QUERIES(f"""WITH {SQL}, {_UNITS}, {_LOOTS}, {_places("SELECT sid, t, id, token FROM u WHERE kind = 'object' UNION ALL SELECT sid, t, id, 'loot' FROM o")}
SELECT DISTINCT sid, id AS entity, {_SPOT}, t, token FROM p WHERE z IS NOT NULL AND xy IS NOT NULL""")
def obs_object_places(read):
    events, samples = stored(read)
    return observers.places(samples, "object", events=events).select("sid", "entity", "value.zone", "value.x", "value.y", "t", "token").distinct()


_ITEM = r"'\|Hitem:(\d+):[^|]*\|h\[([^\]]*)\]\|h'"


@QUERIES(f"WITH {SQL} SELECT sid, CAST(regexp_extract(v, {_ITEM}, 1) AS BIGINT) AS entity, regexp_extract(v, {_ITEM}, 2) AS value, t FROM sm WHERE fn = 'GetLootSlotLink' AND regexp_matches(v, {_ITEM})")
def obs_item_names(read):
    _, samples = stored(read)
    return observers.item_names(samples).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, l AS (SELECT sid, p1, t, CAST(regexp_extract(v, {_ITEM}, 1) AS BIGINT) AS item FROM sm WHERE fn = 'GetLootSlotLink' AND regexp_matches(v, {_ITEM})),
f AS (SELECT sid, p1, t, arg_min({{'v': v}}, pos)['v'] AS v FROM sm WHERE fn = 'GetLootSourceInfo' GROUP BY ALL),
g AS (SELECT sid, t, item, unnest([CASE WHEN v LIKE '[%' THEN v->>'$[0]' ELSE v->>'$."1"' END, v->>'$."3"']) AS guid FROM l JOIN f USING (sid, p1, t) WHERE v IS NOT NULL)
SELECT sid, item AS entity, {_kind('guid')} AS kind, {_id('guid')} AS value, t FROM g WHERE {_kind('guid')} IN ('npc', 'object')""")
def obs_drops(read):
    return _both(read, lambda s, kind: observers.drops(s, kind).select("sid", "entity", F.lit(kind).alias("kind"), "value", "t"))


@QUERIES(f"""WITH {SQL}, q AS (SELECT sid, t, CAST(v AS BIGINT) AS entity FROM sm WHERE fn = 'GetQuestID' AND v <> '0'),
d AS (SELECT r.sid, r.entity, {_clean(_last('GetTitleText'))} AS value, r.t, {_LOCALE} AS locale FROM q r), s1 AS (SELECT * FROM d WHERE value IS NOT NULL AND locale IS NOT NULL),
w AS (SELECT r.sid, CAST(r.p1 AS BIGINT) AS entity, {_clean('r.v')} AS value, r.t, {_LOCALE} AS locale FROM sm r WHERE fn = 'C_QuestLog.GetTitleForQuestID')
SELECT * FROM s1 UNION ALL SELECT * FROM w WHERE locale IS NOT NULL AND value IS NOT NULL AND (sid, entity) NOT IN (SELECT (sid, entity) FROM s1)""")
def obs_quest_names(read):
    _, samples = stored(read)
    return observers.quest_names(samples).select("sid", "entity", "value", "t", "locale")


@QUERIES(f"""WITH {SQL}, n AS (SELECT sid, CAST(p1 AS BIGINT) AS entity, CAST(v AS INT) AS value, t FROM sm WHERE fn = 'C_QuestLog.GetQuestDifficultyLevel')
SELECT * FROM n UNION ALL SELECT sid, CAST(p1 AS BIGINT), CAST(v->>'$[1]' AS INT), t FROM sm WHERE fn = 'GetQuestLogTitle' AND (sid, CAST(p1 AS BIGINT)) NOT IN (SELECT (sid, entity) FROM n)""")
def obs_quest_levels(read):
    _, samples = stored(read)
    return observers.quest_levels(samples).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, l AS (SELECT r.sid, CAST(r.p1 AS BIGINT) AS entity, list_transform(string_split(r.v->>'$[1]', chr(10)), lambda x: trim(x)) AS lines, r.t, coalesce({_LOCALE}, 'enUS') AS locale FROM sm r WHERE fn = 'GetQuestLogQuestText'),
f AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda k: lines[k] <> '') AS full_ FROM l) SELECT sid, entity, lines[list_min(full_):list_max(full_)] AS value, t, locale FROM f WHERE len(full_) > 0""")
def obs_objective_texts(read):
    _, samples = stored(read)
    return observers.objective_texts(samples).select("sid", "entity", "value", "t", "locale")


@QUERIES(f"""WITH {SQL} SELECT sid, CAST(p1 AS BIGINT) AS entity, CAST(json_array_length(v) - len(list_filter(v->>'$[*].type', lambda x: x IN ('event', 'log'))) AS INT) AS value, t FROM sm WHERE fn = 'C_QuestLog.GetQuestObjectives' AND v <> '[]'""")
def obs_objective_counts(read):
    _, samples = stored(read)
    return observers.objective_counts(samples).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, a AS (SELECT lower(r_name) AS name, min(r_regionkey) AS id FROM region GROUP BY 1), b AS (SELECT lower(n_name) AS name, min(n_nationkey) AS id FROM nation GROUP BY 1)
SELECT sid, CAST(p1 AS BIGINT) AS entity, CAST(coalesce(a.id, -b.id) AS BIGINT) AS value, t FROM sm LEFT JOIN a ON a.name = lower(trim(v)) LEFT JOIN b ON b.name = lower(trim(v)) WHERE fn = 'QuestHeader' AND (a.id IS NOT NULL OR b.id IS NOT NULL)""")
def obs_zone_or_sort(read):
    _, samples = stored(read)
    areas = read("region").select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("long").alias("id"))
    sorts = read("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("id"))
    return observers.zone_or_sort(samples, areas, sorts).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, a AS (SELECT sid, pos, t, CAST(CASE WHEN args->>'$.n' = '1' THEN args->>'$."1"' ELSE args->>'$."2"' END AS BIGINT) AS entity FROM ev WHERE e = 'QUEST_ACCEPTED'),
r AS (SELECT a.*, CAST({_last('UnitLevel', 'a', "s.p1 = 'player'")} AS DOUBLE) AS held, (SELECT arg_max(CAST(args->>'$."1"' AS DOUBLE), row(l.t, l.pos)) FROM ev l WHERE l.sid = a.sid AND l.e = 'PLAYER_LEVEL_UP' AND (l.t < a.t OR (l.t = a.t AND l.pos < a.pos))) AS told FROM a)
SELECT sid, entity, CAST(min(greatest(held, told)) AS INT) AS value FROM r WHERE coalesce(held, told) IS NOT NULL GROUP BY ALL""")
def obs_required_levels(read):
    events, samples = stored(read)
    return observers.required_levels(events, samples).select("sid", "entity", "value")


@QUERIES(f"""WITH {SQL}, x AS (SELECT r.sid, r.t, CAST(struct_extract((SELECT arg_max({{'v': s.v}}, row(s.tp, s.pos)) FROM sm s WHERE s.sid = r.sid AND s.fn = 'GetQuestID' AND s.tp <= r.tp), 'v') AS BIGINT) AS entity, CAST(r.v AS BIGINT) AS xp,
  CAST(struct_extract((SELECT arg_max({{'v': s.v}}, row(s.tp, s.pos)) FROM sm s WHERE s.sid = r.sid AND s.fn = 'UnitLevel' AND s.p1 = 'player' AND s.tp <= r.tp), 'v') AS INT) AS level FROM sm r WHERE r.fn = 'GetRewardXP')
SELECT sid, entity, xp, level FROM x WHERE entity <> 0 AND xp > 0""")
def obs_quest_xp(read):
    _, samples = stored(read)
    return observers.quest_xp(samples).select("sid", "entity", "value.xp", "value.level")


@QUERIES(f"""WITH {SQL}, l AS (SELECT r.sid, r.p1 AS quest, r.t, r.pos, r.v, {_last('C_Map.GetPlayerMapPosition')} AS xy, {_last('C_Map.GetBestMapForUnit')} AS z FROM sm r WHERE r.fn = 'C_QuestLog.GetQuestObjectives' AND coalesce({_LOCALE}, 'enUS') = 'enUS'),
o AS (SELECT sid, quest, t, pos, xy, z, trim(j->>'$.text') AS text, (j->>'$.finished') = 'true' AS done FROM (SELECT l.*, unnest(CAST(v AS JSON[])) AS j FROM l) WHERE j->>'$.type' = 'event' AND xy IS NOT NULL AND z IS NOT NULL),
w AS (SELECT *, lag(done) OVER (PARTITION BY sid, quest, text ORDER BY t, pos) AS was FROM o)
SELECT sid, CAST(quest AS BIGINT) AS entity, text, {_SPOT}, t FROM w WHERE done AND NOT coalesce(was, false)""")
def obs_trigger_places(read):
    _, samples = stored(read)
    return observers.trigger_places(samples).select("sid", "entity", "value.text", "value.zone", "value.x", "value.y", "t")


@QUERIES(f"""WITH {SQL}, p AS (SELECT sid, p1 AS map, t, pos, k, j->>'$.questID' AS quest, CAST(j->>'$.x' AS DOUBLE) AS x, CAST(j->>'$.y' AS DOUBLE) AS y FROM (SELECT *, generate_subscripts(CAST(v AS JSON[]), 1) AS k, unnest(CAST(v AS JSON[])) AS j FROM sm WHERE fn = 'C_QuestLog.GetQuestsOnMap') WHERE j->>'$.mapID' = p1),
r AS (SELECT p.*, coalesce({_last('C_QuestLog.IsComplete', 'p', 's.p1 = p.quest')}, 'false') = 'true' AS done FROM p),
c AS (SELECT r.*, (SELECT arg_max({{'x': q.x, 'y': q.y}}, row(q.t, q.pos, q.k)) FROM r q WHERE q.sid = r.sid AND q.quest = r.quest AND q.map = r.map AND NOT q.done AND row(q.t, q.pos, q.k) < row(r.t, r.pos, r.k)) AS open_ FROM r WHERE done)
SELECT sid, CAST(quest AS BIGINT) AS entity, CAST(map AS BIGINT) AS zone, floor(x * 10000 + 0.5) / 100 AS x, floor(y * 10000 + 0.5) / 100 AS y, min(t) AS t FROM c WHERE open_ IS NULL OR open_['x'] <> x OR open_['y'] <> y GROUP BY ALL""")
def obs_turn_in_places(read):
    _, samples = stored(read)
    return observers.turn_in_places(samples).select("sid", "entity", "value.zone", "value.x", "value.y", "t")


def _dialog(shown: str, confirmed: str, quest: str, gossip: str) -> str:
    """Every event looks up its streams to the next event of its frame."""
    look = lambda name, fn, more="true": f"(SELECT arg_max({{'v': s.v, 'on': s.t = b.t AND s.tp = b.upto}}, row(s.t, s.tp, s.pos)) FROM sm s WHERE s.sid = b.sid AND s.fn = '{fn}' AND {more} AND (s.t < b.t OR (s.t = b.t AND s.tp <= b.upto))) AS {name}"
    sure = lambda x: f"CASE WHEN NOT {x}['on'] THEN {x}['v'] END"
    return f"""n AS (SELECT *, lag(t) OVER w AS t0, lag(tp) OVER w AS tp0, lead(t) OVER w AS t1, lead(tp) OVER w AS tp1 FROM ev WINDOW w AS (PARTITION BY sid ORDER BY pos)),
b AS (SELECT *, CASE WHEN t1 = t THEN tp1 ELSE CAST('infinity' AS DOUBLE) END AS upto FROM n WHERE NOT coalesce(t0 = t AND tp0 = tp, false) AND NOT coalesce(t1 = t AND tp1 = tp, false)),
a AS (SELECT b.*, {look('dialog', 'GetQuestID')}, {look('listed', gossip)}, {look('qn', 'UnitGUID', "s.p1 = 'questnpc'")}, {look('np', 'UnitGUID', "s.p1 = 'npc'")} FROM b WHERE e IN ('{shown}', '{confirmed}', 'GOSSIP_SHOW')),
k AS (SELECT sid, pos, t, e, args, qn, np, CAST(CASE WHEN e = '{shown}' THEN nullif({sure('dialog')}, '0') ELSE {quest} END AS BIGINT) AS quest FROM a WHERE e <> 'GOSSIP_SHOW'
  UNION ALL SELECT sid, pos, t, e, args, qn, np, CAST(j->>'$.questID' AS BIGINT) FROM (SELECT *, unnest(CAST({sure('listed')} AS JSON[])) AS j FROM a WHERE e = 'GOSSIP_SHOW')),
c AS (SELECT * FROM k WHERE quest > 0 AND NOT (e = '{confirmed}' AND EXISTS (SELECT 1 FROM k z WHERE z.sid = k.sid AND z.quest = k.quest AND z.e = '{shown}' AND z.pos < k.pos))),
g AS (SELECT *, {sure('qn')} AS q, {sure('np')} AS p, coalesce(qn['on'], false) AS clash FROM c),
y AS (SELECT sid, quest, t, e, args, CASE WHEN clash THEN NULL WHEN {_kind('q')} IN ('npc', 'object') AND {_id('q')} > 0 THEN {{'g': q, 'token': 'questnpc'}} WHEN e = 'GOSSIP_SHOW' AND {_kind('p')} = 'npc' AND {_id('p')} > 0 THEN {{'g': p, 'token': 'npc'}} END AS unit FROM g)
SELECT sid, quest AS entity, CASE {_kind("unit['g']")} WHEN 'npc' THEN 'creature' ELSE 'object' END AS kind, {_id("unit['g']")} AS value, t, CASE {_kind("unit['g']")} WHEN 'npc' THEN 'medium' ELSE 'low' END AS confidence, unit['token'] AS token FROM y WHERE unit IS NOT NULL"""


_TWO = """CASE WHEN args->>'$.n' = '1' THEN args->>'$."1"' ELSE args->>'$."2"' END"""


@QUERIES(f"""WITH {SQL}, {_dialog('QUEST_DETAIL', 'QUEST_ACCEPTED', _TWO, 'C_GossipInfo.GetAvailableQuests')}
UNION ALL SELECT sid, quest, 'item', CAST(args->>'$."1"' AS BIGINT), t, 'high', NULL FROM y WHERE e = 'QUEST_DETAIL' AND CAST(args->>'$."1"' AS BIGINT) > 0""")
def obs_started_by(read):
    events, samples = stored(read)
    return dialogs.started_by(events, samples)


@QUERIES(f"""WITH {SQL}, {_dialog('QUEST_COMPLETE', 'QUEST_TURNED_IN', """args->>'$."1"'""", 'C_GossipInfo.GetActiveQuests')}""")
def obs_finished_by(read):
    events, samples = stored(read)
    return dialogs.finished_by(events, samples)


_LISTED = " UNION ALL ".join(f"SELECT sid, CAST(unnest(v->>'$[*].questID') AS BIGINT), t FROM sm WHERE fn = 'C_GossipInfo.{fn}'" for fn in ("GetAvailableQuests", "GetActiveQuests"))


@QUERIES(f"""WITH {SQL}, z AS (SELECT sid, CAST(v AS BIGINT) AS quest, t FROM sm WHERE fn = 'GetQuestID' UNION ALL SELECT sid, CAST({_TWO} AS BIGINT), t FROM ev WHERE e = 'QUEST_ACCEPTED'
  UNION ALL SELECT sid, unnest(CAST(v AS BIGINT[])), t FROM sm WHERE fn = 'QuestLog' UNION ALL {_LISTED}),
r AS (SELECT * FROM z WHERE quest > 0), y AS (SELECT r.sid, r.quest, r.t, coalesce({_SIDE(_last('UnitFactionGroup'))}, (SELECT arg_min({_SIDE('s.v')}, row(s.t, s.pos)) FROM sm s WHERE s.sid = r.sid AND s.fn = 'UnitFactionGroup' AND s.v IS NOT NULL)) AS side FROM r)
SELECT sid, quest AS entity, side AS value, min(t) AS t FROM y WHERE side IS NOT NULL GROUP BY ALL""")
def obs_quest_factions(read):
    events, samples = stored(read)
    return dialogs.quest_factions(events, samples).select("sid", "entity", "value", "t")


@QUERIES(f"""WITH {SQL}, a AS (SELECT sid, pos, t, CAST(args->>'$."1"' AS BIGINT) AS quest FROM ev WHERE e = 'QUEST_TURNED_IN'),
r AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.sid = a.sid AND b.pos <> a.pos AND abs(b.t - a.t) < 1)),
k AS (SELECT r.*, {_last('UnitRace')}->>'$."2"' AS race, {_SIDE(_last('UnitFactionGroup'))} AS side FROM r), turned AS (SELECT * FROM k WHERE race <> 'Human' AND side IS NOT NULL),
st AS (SELECT sid, CAST(p1 AS BIGINT) AS faction, fn = 'GetFactionInfoByID' AS old, t, pos, CAST(CASE WHEN fn = 'GetFactionInfoByID' THEN v->>'$."6"' ELSE v->>'$.currentStanding' END AS DOUBLE) AS standing, CASE WHEN fn = 'GetFactionInfoByID' THEN v->>'$."1"' ELSE v->>'$.name' END AS name FROM sm WHERE fn IN ('GetFactionInfoByID', 'C_Reputation.GetFactionDataByID')),
b AS (SELECT c.sid, c.pos, s.faction, s.old, arg_max(s.standing, row(s.t, s.pos)) FILTER (WHERE s.t < c.t - 0.5) AS low, arg_max(s.standing, row(s.t, s.pos)) FILTER (WHERE s.t <= c.t + 0.5) AS high FROM turned c JOIN st s USING (sid) GROUP BY ALL),
f AS (SELECT sid, pos, faction, arg_min({{'low': low, 'high': high}}, row(low IS NULL OR high IS NULL, old)) AS x FROM b GROUP BY ALL),
d AS (SELECT sid, pos, faction, x['high'] - x['low'] AS gain, x['high'] IS NOT NULL AND x['low'] IS NULL AS fresh FROM f),
said AS (SELECT c.sid, c.pos, v.args->>'$."1"' AS message FROM turned c JOIN ev v ON v.sid = c.sid AND v.e = 'CHAT_MSG_COMBAT_FACTION_CHANGE' AND abs(v.t - c.t) <= 0.5),
q AS (SELECT c.*, {_last('GetLocale', 'c')} AS locale, coalesce((SELECT bool_or(fresh) FROM d WHERE d.sid = c.sid AND d.pos = c.pos), false) OR (SELECT count(*) FROM said WHERE said.sid = c.sid AND said.pos = c.pos AND regexp_matches(message, '[0-9]')) > (SELECT count(*) FROM d WHERE d.sid = c.sid AND d.pos = c.pos AND gain <> 0) AS chat FROM turned c),
names AS (SELECT sid, name, arg_max(faction, row(old, faction)) AS faction FROM st GROUP BY ALL),
h AS (SELECT said.sid, said.pos, names.faction, CAST(CASE WHEN message LIKE '% increased by %' THEN 1 ELSE -1 END * CAST(regexp_extract(message, '([0-9]+)\\.$', 1) AS BIGINT) AS DOUBLE) AS gain FROM said LEFT JOIN names ON names.sid = said.sid AND names.name = regexp_extract(message, '^Reputation with (.+) (?:in|de)creased by', 1)),
g AS (SELECT d.sid, d.pos, d.faction, d.gain FROM d JOIN q USING (sid, pos) WHERE NOT chat AND gain <> 0
  UNION ALL SELECT h.sid, h.pos, h.faction, h.gain FROM h JOIN q USING (sid, pos) WHERE chat AND locale = 'enUS' AND (h.sid, h.pos) NOT IN (SELECT (sid, pos) FROM h WHERE faction IS NULL) AND (h.sid, h.pos) NOT IN (SELECT (sid, pos) FROM h GROUP BY sid, pos HAVING count(*) > count(DISTINCT faction)))
SELECT g.sid, q.quest AS entity, q.t, q.side, g.faction, g.gain AS amount, (SELECT arg_max(o.faction, row(abs(o.gain), -o.faction)) FROM g o WHERE o.sid = g.sid AND o.pos = g.pos AND sign(o.gain) = sign(g.gain) AND abs(o.gain) > abs(g.gain) AND abs(g.gain - o.gain / 4) <= 1) AS source FROM g JOIN q USING (sid, pos)""")
def obs_reputation_rewards(read):
    events, samples = stored(read)
    return rewards.reputation_rewards(events, samples)


@QUERIES(f"""WITH {SQL}, {_UNITS},
ie AS (SELECT r.sid, 'item' AS kind, lower(regexp_extract(r.v, {_ITEM}, 2)) AS name, CAST(regexp_extract(r.v, {_ITEM}, 1) AS BIGINT) AS id, coalesce({_last('GetLootSlotInfo', 'r', 's.p1 = r.p1')}->>'$."7"' = 'true', false) AS pref, CAST(nullif({_last('GetLootSlotInfo', 'r', 's.p1 = r.p1')}->>'$."8"', '0') AS BIGINT) AS starts, NULL AS dialog FROM sm r WHERE r.fn = 'GetLootSlotLink' AND regexp_matches(r.v, {_ITEM})
  UNION ALL SELECT sid, 'item', lower(regexp_extract(v, {_ITEM}, 2)), CAST(regexp_extract(v, {_ITEM}, 1) AS BIGINT), false, NULL, NULL FROM sm WHERE fn = 'GetMerchantItemLink'
  UNION ALL SELECT sid, CASE kind WHEN 'npc' THEN 'monster' ELSE kind END, lower({_name(_last('UnitName', 'u', 's.p1 = u.token'))}), id, false, NULL, CAST(nullif({_last('GetQuestID', 'u')}, '0') AS BIGINT) FROM u WHERE kind IN ('npc', 'object')),
l AS (SELECT r.sid, CAST(r.p1 AS BIGINT) AS entity, r.t, generate_subscripts(CAST(r.v AS JSON[]), 1) - 1 AS index, unnest(CAST(r.v AS JSON[])) AS j FROM sm r WHERE r.fn = 'C_QuestLog.GetQuestObjectives' AND coalesce({_LOCALE}, 'enUS') = 'enUS'),
o AS (SELECT sid, entity, t, index, j->>'$.type' AS kind, j->>'$.text' AS text, trim(regexp_replace(regexp_replace(CASE WHEN j->>'$.type' = 'monster' THEN regexp_replace(j->>'$.text', ' slain$', '') ELSE j->>'$.text' END, '^0/[18] ', ''), ': 0/1$', '')) AS whole FROM l WHERE j->>'$.type' IN ('monster', 'item', 'object')),
w AS (SELECT *, whole AS name, 0 AS place FROM o UNION ALL SELECT *, regexp_replace(whole, ' \\S+ed$', ''), 1 FROM o WHERE kind <> 'item' AND regexp_matches(whole, ' \\S+ed$')),
mm AS (SELECT w.sid, w.entity, w.t, w.index, w.kind, w.text, arg_min({{'id': x.id, 'name': w.name}}, row(place, CASE WHEN pref OR coalesce(dialog = w.entity, false) THEN 1 WHEN coalesce(starts = w.entity, false) THEN 3 ELSE 2 END, x.id)) AS best FROM w JOIN ie x ON x.sid = w.sid AND x.kind = w.kind AND x.name = lower(w.name) GROUP BY ALL)
SELECT sid, entity, t, CAST(index AS INT) AS index, kind, best['name'] AS name, text, best['id'] AS id FROM mm""")
def obs_objectives(read):
    _, samples = stored(read)
    return goals.objectives(samples).drop("confidence")


@QUERIES(f"""WITH {SQL} SELECT sid, fn, p1, t, CASE WHEN v LIKE '{{%' AND v->>'$.n' IS NOT NULL THEN list_transform(range(1, CAST(v->>'$.n' AS BIGINT) + 1), lambda k: json_extract_string(v, '$."' || k || '"')) WHEN v LIKE '[%' THEN CAST(v AS JSON[])->>'$' END AS parts
FROM sm WHERE fn IN ('GetLootSourceInfo', 'UnitRace', 'GetFactionInfoByID')""".replace("CAST(v AS JSON[])->>'$'", "list_transform(CAST(v AS JSON[]), lambda x: x->>'$')"))
def packed_tuples(read):
    """Recorded tuples as arrays of their length."""
    _, samples = stored(read)
    rows = samples.where("fn in ('GetLootSourceInfo', 'UnitRace', 'GetFactionInfoByID')")
    return rows.select("sid", "fn", F.try_element_at("params", F.lit(1)).alias("p1"), "t", text.unpacked(F.col("v")).alias("parts"))
