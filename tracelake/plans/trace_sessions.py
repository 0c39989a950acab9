"""Sessions of a trace made from the table ``events``: a user is a session, each row a moment in it.

Every entry says for which rows there is a sample or event, its stream, how long after
the row's second it was taken (frame, precise clock) and its value, in expressions that
Spark and the checking SQL both read. ``i`` is the row's id, ``k`` its property, ``u`` the user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch

_UNIT = "CASE WHEN i % 17 = 0 THEN NULL WHEN i % 5 = 0 THEN 'GameObject-0-1-0-7-' || (200 + k % 11) || '-0A' WHEN i % 7 = 0 THEN 'Player-1-0A' ELSE 'Creature-0-1-0-7-' || (100 + k % 13) || '-0B' END"
_TOKEN = "CASE i % 3 WHEN 0 THEN 'target' WHEN 1 THEN 'npc' ELSE 'questnpc' END"
_HOVER = "CASE WHEN i % 2 = 0 THEN 'target' ELSE 'mouseover' END"
_LINK = "'|cff|Hitem:' || (500 + k % 17) || ':0|h[Item ' || (k % 17) || ']|h|r'"
_PAIRS = """'{"1":"Creature-0-1-0-7-' || (100 + k % 13) || '-0B","2":1,"3":"GameObject-0-1-0-7-' || (200 + k % 11) || '-0A","4":2,"n":4}'"""
_QUEST = "CAST(300 + k % 9 AS STRING)"
_LIST = """'[{"questID":' || (300 + k % 9) || '},{"questID":' || (300 + i % 5) || '},{"title":"x"}]'"""
_GOALS = """'[{"type":"monster","text":"0/8 Unit ' || (k % 13) || ' slain","finished":false},{"type":"event","text":" Scout ' || (k % 2) || '","finished":' || CASE WHEN i % 3 = 0 THEN 'true' ELSE 'false' END || '},{"type":"item","text":"Item ' || (k % 17) || ': 0/1","finished":false},{"type":"object","text":"0/1 Chest ' || (k % 4) || ' opened","finished":false}]'"""
_STANDING = """'{"currentStanding":' || (100 * (i % 4) + k) || ',"name":"Faction ' || (70 + k % 3) || '"}'"""

#: (rows, stream path, seconds to the frame, seconds to the precise clock, value)
SAMPLES = (
    ("kind = 'view'", f"'UnitGUID/' || {_TOKEN}", 0, 0.002, _UNIT),
    ("kind = 'view'", f"'UnitName/' || {_TOKEN}", 0, 0.003, """CASE WHEN i % 13 = 0 THEN NULL WHEN i % 4 = 0 THEN '{"1":" Unit ' || (k % 13) || '","n":2}' WHEN i % 5 = 0 THEN 'Chest ' || (k % 4) ELSE ' Unit ' || chr(10) || (k % 13) || ' ' END"""),
    ("kind = 'view' AND i % 4 < 2", f"'UnitGUID/' || {_HOVER}", 1, 1.002, _UNIT),
    ("kind = 'view' AND i % 4 < 2", f"'UnitLevel/' || {_HOVER}", 1, 1.004, "CAST(k % 60 AS STRING)"),
    ("kind = 'view' AND i % 8 < 2", f"'UnitGUID/' || {_HOVER}", 1, 1.010, "'Creature-0-1-0-7-' || (100 + i % 13) || '-0C'"),
    ("kind = 'view' AND i % 16 < 2", f"'UnitLevel/' || {_HOVER}", 1, 1.012, "CAST(i % 60 AS STRING)"),
    ("kind = 'view' AND i % 3 = 0", f"'UnitClassification/' || {_HOVER}", 1, 1.004, "CASE k % 4 WHEN 0 THEN 'elite' WHEN 1 THEN 'rare' WHEN 2 THEN 'normal' ELSE 'odd' END"),
    ("kind = 'view' AND i % 3 > 0", f"'UnitReaction/player/' || {_HOVER}", 1, 1.005, "CAST(1 + k % 8 AS STRING)"),
    ("kind = 'view' AND i % 4 = 1", "'UnitSubName/mouseover'", 1, 1.003, "CASE WHEN k % 3 = 0 THEN 'Level ' || k || ' (Elite)' WHEN k % 3 = 1 THEN 'Baker' ELSE NULL END"),
    ("kind = 'click'", "'C_Map.GetBestMapForUnit/player'", 0, 0.001, "CASE WHEN i % 19 = 0 THEN NULL ELSE CAST(1400 + k % 5 AS STRING) END"),
    ("kind = 'click'", "'C_Map.GetPlayerMapPosition/player'", 0, 0.001, """CASE WHEN i % 11 = 0 THEN NULL ELSE '{"x":0.' || lpad(CAST(k AS STRING), 2, '0') || '37,"y":0.' || lpad(CAST(99 - k AS STRING), 2, '0') || '52}' END"""),
    ("kind = 'click' AND u % 2 = 0", "'CheckInteractDistance/target/4'", 0, 0.001, "CASE WHEN i % 3 = 0 THEN 'false' ELSE 'true' END"),
    ("kind = 'click'", f"'C_QuestLog.GetQuestObjectives/' || {_QUEST}", 0, 0.002, f"CASE WHEN i % 23 = 0 THEN '[]' ELSE {_GOALS} END"),
    ("kind = 'click'", "'C_QuestLog.GetQuestsOnMap/' || CAST(1400 + k % 2 AS STRING)", 0, 0.003, """'[{"questID":' || (300 + k % 9) || ',"mapID":' || (1400 + k % 2) || ',"x":0.' || (10 + k % 3) || ',"y":0.25},{"questID":' || (300 + i % 9) || ',"mapID":' || (1400 + i % 2) || ',"x":0.5,"y":0.75}]'"""),
    ("kind = 'click'", f"'C_QuestLog.IsComplete/' || {_QUEST}", 0, 0.002, "CASE WHEN i % 2 = 0 THEN 'true' ELSE 'false' END"),
    ("kind = 'purchase'", "'GetLootSlotLink/1'", 0, 0.002, f"CASE WHEN i % 9 = 0 THEN 'gold' ELSE {_LINK} END"),
    ("kind = 'purchase' AND i % 2 = 0", "'GetLootSlotInfo/1'", 0, 0.001, """'{"3":1,"7":' || CASE WHEN i % 4 = 0 THEN 'true' ELSE 'false' END || ',"8":' || (CASE WHEN i % 6 = 0 THEN 300 + k % 9 ELSE 0 END) || ',"n":9}'"""),
    ("kind = 'purchase'", "'GetLootSourceInfo/1'", 0, 0.002, f"CASE WHEN i % 10 = 0 THEN NULL ELSE {_PAIRS} END"),
    ("kind = 'purchase' AND i % 3 = 0", "'GetLootSourceInfo/1'", 0, 0.004, """'["Creature-0-1-0-7-190-0B",1]'"""),
    ("kind = 'purchase' AND i % 5 = 0", "'GetLootSourceInfo/2'", 0, 0.002, _PAIRS),
    ("kind = 'purchase' AND i % 7 = 0", "'GetMerchantItemLink/' || CAST(k % 4 AS STRING)", 0, 0.002, "'|Hitem:' || (600 + k % 17) || '::|h[Item ' || (k % 17) || ']|h'"),
    ("kind = 'purchase'", "'GameObjectName'", 0, 0.001, "CASE WHEN i % 8 = 0 THEN NULL ELSE 'Chest ' || (k % 4) END"),
    ("kind = 'signup'", "'GetQuestID'", 0, 0.001, "CASE WHEN i % 7 = 0 THEN '0' ELSE CAST(300 + k % 9 AS STRING) END"),
    ("kind = 'signup'", "'GetTitleText'", 0, 0.001, "CASE WHEN i % 5 = 0 THEN NULL ELSE 'Quest ' || (k % 9) || ' ' END"),
    ("kind = 'signup' AND i % 3 < 2", "'UnitGUID/questnpc'", 0, 0.002, _UNIT),
    ("kind = 'signup' AND i % 6 = 5", "'UnitGUID/questnpc'", 0, 0.006, "'Creature-0-1-0-7-150-0D'"),
    ("kind = 'signup'", "'C_GossipInfo.GetAvailableQuests'", 0, 0.001, f"CASE WHEN i % 13 = 0 THEN '[]' ELSE {_LIST} END"),
    ("kind = 'signup' AND i % 2 = 0", "'C_GossipInfo.GetActiveQuests'", 0, 0.001, _LIST),
    ("kind = 'signup' AND i % 4 = 0", "'QuestLog'", 0, 0.001, "'[' || (300 + k % 9) || ',0,' || (310 + k % 3) || ']'"),
    ("kind = 'signup'", "'GetRewardXP'", 0, 0.002, "CAST((k % 20) * 10 AS STRING)"),
    ("kind = 'signup' AND i % 2 = 1", f"'C_QuestLog.GetTitleForQuestID/' || {_QUEST}", 0, 0.002, "'Quest ' || (k % 9)"),
    ("kind = 'signup' AND i % 3 = 0", f"'C_QuestLog.GetQuestDifficultyLevel/' || {_QUEST}", 0, 0.002, "CAST(k % 40 AS STRING)"),
    ("kind = 'signup'", f"'GetQuestLogTitle/' || {_QUEST}", 0, 0.002, """'["Quest",' || (k % 30) || ']'"""),
    ("kind = 'signup' AND i % 3 = 1", f"'QuestHeader/' || {_QUEST}", 0, 0.002, "CASE k % 3 WHEN 0 THEN ' AFRICA' WHEN 1 THEN 'china ' ELSE 'nowhere' END"),
    ("kind = 'signup' AND i % 3 = 2", f"'GetQuestLogQuestText/' || {_QUEST}", 0, 0.002, """'["d","' || CASE WHEN k % 5 = 0 THEN ' ' ELSE '\\\\n Go ' || (k % 4) || '\\\\n\\\\nnow ' END || '"]'"""),
    ("kind = 'error'", "'UnitFactionGroup/player'", 0, 0.001, "CASE WHEN i % 9 = 0 THEN NULL WHEN u % 3 = 0 THEN 'Horde' ELSE 'Alliance' END"),
    ("kind = 'error'", "'UnitRace/player'", 0, 0.001, """'{"1":"R","2":"' || CASE WHEN u % 4 = 0 THEN 'Human' ELSE 'Orc' END || '","n":2}'"""),
    ("kind = 'error'", "'GetLocale/player'", 0, 0.001, "CASE WHEN u % 5 = 0 THEN 'deDE' WHEN i % 29 = 0 THEN NULL ELSE 'enUS' END"),
    ("kind = 'error'", "'UnitLevel/player'", 0, 0.001, "CAST(1 + k % 60 AS STRING)"),
    ("kind = 'error'", "'C_Reputation.GetFactionDataByID/' || CAST(70 + k % 3 AS STRING)", 0, 0.001, _STANDING),
    ("kind = 'error' AND i % 2 = 0", "'GetFactionInfoByID/' || CAST(70 + k % 4 AS STRING)", 0, 0.001, """'{"1":"Faction ' || (70 + k % 4) || '","6":' || (k * 2) || ',"n":6}'"""),
    ("kind = 'signup' AND i % 6 = 3", "'C_Reputation.GetFactionDataByID/' || CAST(70 + k % 3 AS STRING)", 0, 0.3, """'{"currentStanding":' || (500 + 4 * k) || ',"name":"Faction ' || (70 + k % 3) || '"}'"""),
    ("kind = 'signup' AND i % 12 = 3", "'C_Reputation.GetFactionDataByID/' || CAST(70 + (k + 1) % 3 AS STRING)", 0, 0.3, """'{"currentStanding":' || (100 + k) || ',"name":"Faction ' || (70 + (k + 1) % 3) || '"}'"""),
)

#: (rows, seconds to the frame, seconds to the precise clock, name, arguments)
EVENTS = (
    ("kind = 'view' AND i % 5 < 3", 1, 1.001, "CASE WHEN i % 2 = 0 THEN 'PLAYER_TARGET_CHANGED' ELSE 'UPDATE_MOUSEOVER_UNIT' END", "NULL"),
    ("kind = 'purchase'", 0, 0.0005, "CASE WHEN i % 4 = 0 THEN 'LOOT_CLOSED' ELSE 'LOOT_READY' END", "NULL"),
    ("kind = 'error'", 0, 0.002, "'PLAYER_LEVEL_UP'", """'{"1":' || (k % 70) || ',"n":1}'"""),
    ("kind = 'signup'", 0, 0.0005, "CASE i % 6 WHEN 0 THEN 'QUEST_DETAIL' WHEN 1 THEN 'QUEST_ACCEPTED' WHEN 2 THEN 'QUEST_COMPLETE' WHEN 3 THEN 'QUEST_TURNED_IN' WHEN 4 THEN 'GOSSIP_SHOW' ELSE 'QUEST_ACCEPTED' END",
     """CASE i % 6 WHEN 0 THEN '{"1":' || (CASE WHEN i % 4 = 0 THEN 500 + k % 17 ELSE 0 END) || ',"n":1}' WHEN 5 THEN '{"1":3,"2":' || (300 + k % 9) || ',"n":2}' ELSE '{"1":' || (300 + k % 9) || ',"n":1}' END"""),
    ("kind = 'signup' AND i % 6 = 3 AND k % 2 = 0", 0, 0.1, "'CHAT_MSG_COMBAT_FACTION_CHANGE'", """'{"1":"Reputation with Faction ' || (70 + k % 4) || CASE WHEN k % 3 = 0 THEN ' decreased by ' ELSE ' increased by ' END || (5 * k) || '.","n":1}'"""),
    ("kind = 'signup' AND i % 5 = 0", 0, 0.0045, "'QUEST_PROGRESS'", "NULL"),
    ("kind = 'signup' AND i % 15 = 1", 0, 0.002, "'QUEST_GREETING'", "NULL"),
    ("kind = 'signup' AND i % 35 = 2", 0, 0.0005, "'QUEST_FINISHED'", "NULL"),
    ("kind = 'signup' AND i % 18 = 3", 0.5, 0.5, "'QUEST_TURNED_IN'", """'{"1":309,"n":1}'"""),
)


def moments(read) -> DataFrame:
    """sid, u, i, k, kind, second of every row."""
    return read("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sid"), F.col("user_id").alias("u"), F.col("event_id").alias("i"), F.get_json_object("props", "$.k").cast("long").alias("k"), F.col("event_type").alias("kind"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double").alias("second"))


def _each(rows: DataFrame, entries: tuple, fields) -> DataFrame:
    """One struct for each entry whose condition a row meets, all from one scan."""
    made = [F.when(F.expr(e[0]), F.struct(F.lit(n).alias("n"), *fields(e))) for n, e in enumerate(entries)]
    return rows.select("sid", "i", F.explode(F.array(*made)).alias("_e")).where("_e is not null")


def _at(seconds: float) -> Column:
    return F.col("second") + F.lit(float(seconds))


def samples(read) -> DataFrame:
    """sid, fn, params, pos, t, tp, v."""
    rows = _each(moments(read), SAMPLES, lambda e: (F.expr(e[1]).alias("path"), _at(e[2]).alias("t"), _at(e[3]).alias("tp"), F.expr(e[4]).cast("string").alias("v")))
    parts = F.split("_e.path", "/")
    return rows.select("sid", parts[0].alias("fn"), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias("params"), (F.col("i") * 64 + F.col("_e.n")).alias("pos"), "_e.t", "_e.tp", "_e.v")


def events(read) -> DataFrame:
    """sid, pos, t, tp, e, args."""
    rows = _each(moments(read), EVENTS, lambda e: (_at(e[1]).alias("t"), _at(e[2]).alias("tp"), F.expr(e[3]).alias("e"), F.expr(e[4]).cast("string").alias("args")))
    return rows.select("sid", (F.col("i") * 64 + F.col("_e.n")).alias("pos"), "_e.t", "_e.tp", "_e.e", "_e.args")


def stored(read) -> tuple[DataFrame, DataFrame]:
    """Events and samples written to a new folder and read again, as a store holds them: lookups read the streams they name, not the rows these were made from."""
    out = []
    for made in (events(read), samples(read)):
        path = scratch(made.sparkSession)
        made.write.parquet(path)
        out.append(made.sparkSession.read.schema(made.schema).parquet(path))
    return out[0], out[1]


def _sql() -> str:
    base = "m AS (SELECT 'u' || user_id AS sid, user_id AS u, event_id AS i, CAST(props->>'k' AS BIGINT) AS k, event_type AS kind, CAST(floor(epoch_us(ts) / 1000000) AS DOUBLE) AS second FROM events)"
    # a backslash in front of n is written twice for Spark, whose strings have escapes
    value = lambda v: v.replace("\\\\", "\\")
    s = " UNION ALL ".join(f"SELECT sid, i * 64 + {n} AS pos, second + CAST({t} AS DOUBLE) AS t, second + CAST({tp} AS DOUBLE) AS tp, {path} AS path, CAST({value(v)} AS VARCHAR) AS v FROM m WHERE {cond}" for n, (cond, path, t, tp, v) in enumerate(SAMPLES))
    e = " UNION ALL ".join(f"SELECT sid, i * 64 + {n} AS pos, second + CAST({t} AS DOUBLE) AS t, second + CAST({tp} AS DOUBLE) AS tp, {name} AS e, CAST({args} AS VARCHAR) AS args FROM m WHERE {cond}" for n, (cond, t, tp, name, args) in enumerate(EVENTS))
    return f"{base}, sm AS (SELECT sid, pos, t, tp, v, split_part(path, '/', 1) AS fn, split_part(path, '/', 2) AS p1, split_part(path, '/', 3) AS p2 FROM ({s})), ev AS ({e})"


#: CTEs ``sm`` (samples; parameters as p1, p2) and ``ev`` (events) for the checking SQL.
SQL = _sql()
