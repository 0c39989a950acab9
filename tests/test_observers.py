"""Observers on one hand-written session."""

import json

import pytest

from tracelake.operators import observers as o

UNIT = "Creature-0-5208-0-7-{}-000032"
THING = "GameObject-0-5208-0-7-{}-000032"


def stream(fn, *samples, params=()):
    return [("s", fn, list(params), k, float(t), float(tp), v) for k, (t, tp, v) in enumerate(samples)]


@pytest.fixture(scope="module")
def session(spark):
    rows = [
        *stream("GetLocale", (0, 0, "enUS")),
        *stream("UnitGUID", (1, 1.001, UNIT.format(823)), (5, 5.001, UNIT.format(197)), (9, 9, None), params=["target"]),
        *stream("UnitName", (1, 1.002, " Deputy \r\n"), (5, 5.002, "Marshal"), params=["target"]),
        *stream("UnitLevel", (1, 1.003, "5"), (5, 5.003, "0"), params=["target"]),
        *stream("UnitLevel", (0, 0, "7"), params=["player"]),
        *stream("UnitClassification", (1, 1.003, "rareelite"), (5, 5.0, "elite"), params=["target"]),
        *stream("UnitReaction", (1, 1.004, "5"), (5, 5.004, "2"), params=["target"]),
        *stream("UnitFactionGroup", (0, 0, "Alliance"), params=["player"]),
        *stream("UnitGUID", (3, 3.002, UNIT.format(823)), params=["questnpc"]),
        *stream("UnitGUID", (2, 2, UNIT.format(55)), (2.5, 2.5, UNIT.format(56)), params=["mouseover"]),
        *stream("UnitSubName", (2, 2.001, "Level 28 (Elite)"), (2.5, 2.501, "Innkeeper"), params=["mouseover"]),
        *stream("C_Map.GetBestMapForUnit", (0, 0, "1429"), params=["player"]),
        *stream("C_Map.GetPlayerMapPosition", (0, 0, '{"x": 0.4219, "y": 0.6587}'), (6, 6, None), params=["player"]),
        *stream("TargetDistance", (1, 1, "10"), (5, 5, "80")),
        *stream("GetLootSlotLink", (4, 4, "|Hitem:750:::|h[Tough Meat]|h"), params=["1"]),
        *stream("GetLootSourceInfo", (4, 4.0, json.dumps([UNIT.format(69), 1, THING.format(7), 2])), (4, 4.1, json.dumps([UNIT.format(70), 1])), params=["1"]),
        *stream("GetQuestID", (3, 3.001, "33"), (8, 8, "0")),
        *stream("GetTitleText", (3, 3.001, "Wolves")),
        *stream("C_QuestLog.GetTitleForQuestID", (3, 3, "Wolves again"), params=["33"]),
        *stream("C_QuestLog.GetTitleForQuestID", (3, 3, "Kobolds"), params=["15"]),
        *stream("C_QuestLog.GetQuestDifficultyLevel", (3, 3, "2"), params=["33"]),
        *stream("GetQuestLogTitle", (3, 3, '["Wolves", 9]'), params=["33"]),
        *stream("GetQuestLogTitle", (3, 3, '["Kobolds", 3]'), params=["15"]),
        *stream("C_QuestLog.GetQuestObjectives", (3, 3, '[{"type":"monster"},{"type":"event","text":"Scout","finished":false}]'), (4, 4, "[]"), (5, 5, '[{"type":"monster"},{"type":"event","text":"Scout","finished":true}]'), params=["33"]),
        *stream("GetRewardXP", (3, 3.003, "250"), (8, 8.5, "90")),
    ]
    samples = spark.createDataFrame(rows, "sid string, fn string, params array<string>, pos int, t double, tp double, v string")
    events = [("QUEST_DETAIL", 3, 3.0005, {"n": 1, "1": 0}), ("QUEST_ACCEPTED", 3.5, 3.5, {"n": 2, "1": 1, "2": 33}), ("PLAYER_LEVEL_UP", 6, 6, {"n": 1, "1": 9}), ("QUEST_ACCEPTED", 7, 7, {"n": 1, "1": 15})]
    return spark.createDataFrame([("s", k, float(t), float(tp), e, json.dumps(a)) for k, (e, t, tp, a) in enumerate(events)], "sid string, pos int, t double, tp double, e string, args string"), samples


def pairs(df):
    return sorted((r.entity, tuple(r.value) if isinstance(r.value, tuple) else r.value) for r in df.collect())


def test_units(session):
    _, s = session
    assert pairs(o.names(s)) == [(197, "Marshal"), (823, "Deputy")] + [(823, "Deputy")] * 0
    assert {r.locale for r in o.names(s).collect()} == {"enUS"}
    assert pairs(o.levels(s)) == [(823, 5)]
    assert pairs(o.ranks(s)) == [(823, 2)]  # the elite rank was sampled before its unit
    assert [(r.entity, r.value, r.side) for r in o.friendliness(s).orderBy("entity").collect()] == [(197, False, "A"), (823, True, "A")]
    assert pairs(o.subnames(s)) == [(55, ""), (56, "Innkeeper")]


def test_places(session):
    _, s = session
    # the second target is too far away
    assert [(r.entity, tuple(r.value), r.token) for r in o.places(s).orderBy("t").collect()] == [(823, (1429, 42.19, 65.87), "target"), (823, (1429, 42.19, 65.87), "questnpc")]


def test_items(session):
    _, s = session
    assert pairs(o.item_names(s)) == [(750, "Tough Meat")] and pairs(o.drops(s)) == [(750, 69)] and pairs(o.drops(s, "object")) == [(750, 7)]


def test_quests(session):
    events, s = session
    assert pairs(o.quest_names(s)) == [(15, "Kobolds"), (33, "Wolves")]
    assert pairs(o.quest_levels(s)) == [(15, 3), (33, 2)]
    assert pairs(o.objective_counts(s)) == [(33, 1), (33, 1)]
    assert pairs(o.required_levels(events, s)) == [(15, 9), (33, 7)]
    assert pairs(o.quest_xp(s)) == [(33, (7, 250))]
    assert pairs(o.trigger_places(s)) == [(33, ("Scout", 1429, 42.19, 65.87))]


def test_givers(session):
    events, s = session
    assert pairs(o.givers(events, s, ("QUEST_ACCEPTED",))) == [(15, 823), (33, 823)]
    assert pairs(o.givers(events, s, ("QUEST_ACCEPTED",), unless=("QUEST_DETAIL",))) == [(15, 823), (33, 823)]


def test_every_registered_field_runs(session):
    _, s = session
    for (entity, _), observe in o.FIELDS.items():
        assert {"sid", "entity", "value", "t", "confidence"} <= set(observe(s).columns), entity


def test_texts_headers_and_map_places(spark):
    rows = [
        *stream("GetQuestLogQuestText", (1, 1, '["x", "\\n Kill \\n\\n wolves \\n"]'), params=["33"]),
        *stream("QuestHeader", (1, 1, " elwynn forest"), params=["33"]),
        *stream("QuestHeader", (1, 1, "Mage"), params=["34"]),
        *stream("GetQuestsOnMap", (1, 1, '[{"questID": 33, "x": 0.1, "y": 0.2}]'), (5, 5, '[{"questID": 33, "x": 0.1, "y": 0.2}]'), (6, 6, '[{"questID": 33, "x": 0.5, "y": 0.2}]'), (7, 7, '[{"questID": 33, "x": 0.5, "y": 0.2}]'), params=["12"]),
        *stream("IsQuestComplete", (0, 0, "false"), (4, 4, "true"), params=["33"]),
        *stream("UnitFactionGroup", (4, 4, "Horde"), params=["player"]),
        *stream("GetFactionDataByID", (0, 0, '{"currentStanding": 100}'), (10.2, 10.2, '{"currentStanding": 350}'), params=["72"]),
        *stream("GetLootSourceInfo", (2, 2, json.dumps([THING.format(7), 2, UNIT.format(1), 1])), (3, 3, json.dumps([THING.format(8), 2])), params=["1"]),
    ]
    s = spark.createDataFrame(rows, "sid string, fn string, params array<string>, pos int, t double, tp double, v string")
    e = spark.createDataFrame([("s", 0, 2.0, 2.0, "LOOT_READY", None), ("s", 1, 10.0, 10.0, "QUEST_TURNED_IN", '{"n": 1, "1": 33}'), ("s", 2, 20.0, 20.0, "QUEST_TURNED_IN", '{"n": 1, "1": 34}'), ("s", 3, 20.5, 20.5, "QUEST_TURNED_IN", '{"n": 1, "1": 35}')], "sid string, pos int, t double, tp double, e string, args string")
    assert [(r.entity, r.value, r.locale) for r in o.objective_texts(s).collect()] == [(33, ["Kill", "", "wolves"], "enUS")]
    dim = lambda *rows_: spark.createDataFrame(rows_, "name string, id long")
    assert pairs(o.zone_or_sort(s, dim(("Elwynn Forest", 12), ("Elwynn Forest", 14)), dim(("Mage", 161), ("Elwynn Forest", 1)))) == [(33, 12), (34, -161)]
    assert pairs(o.turn_in_places(s)) == [(33, (12, 50.0, 20.0))]
    assert [r.id for r in o.object_loots(e, s).collect()] == [7]
    seen = spark.createDataFrame([("s", 33, 1.0), ("s", 33, 9.0)], "sid string, quest long, t double")
    assert pairs(o.quest_sides(seen, s)) == [(33, "H")]
    assert [(r.quest, r.faction, r.gain) for r in o.standing_gains(e, s).collect()] == [(33, 72, 250.0)]


def test_privacy_and_emission(spark):
    from pyspark.sql import functions as F

    from tracelake.operators import emit, privacy

    rows = spark.createDataFrame([(1, [UNIT.format(1), THING.format(2)]), (2, [UNIT.format(1), "Player-5208-01"]), (3, ["?"])], "k int, guids array<string>")
    assert [r.k for r in privacy.with_allowed_sources(rows, "guids").collect()] == [1]
    texts = spark.createDataFrame([("You gain 5 of Ann.",), ("You gain x of Ann.",), ("hello You gain 5 of Ann.",)], "m string")
    assert [r.ok for r in texts.select(privacy.message_allowed(F.col("m"), ["You gain %d of %s.", "Bye"]).alias("ok")).collect()] == [True, False, False]
    chat = spark.createDataFrame([("Ann said hi", "Ann", "Ann", "Player-1-2"), ("x", "y", "z", UNIT.format(3))], "m string, a string, b string, g string")
    assert [tuple(r) for r in privacy.chat(chat, "m", "a", "b", "g", ["Ann"]).orderBy("m").collect()] == [("<name> said hi", None, None, None), ("x", None, None, UNIT.format(3))]
    s = spark.createDataFrame([*stream("UnitGUID", (1, 1, "Player-1-2"), (2, 2, UNIT.format(5)), params=["target"]), *stream("UnitName", (1, 1, "Ann"), (2, 2, "Wolf"), params=["target"])], "sid string, fn string, params array<string>, pos int, t double, tp double, v string")
    own = spark.createDataFrame([("s", "Player-1-2")], "sid string, guid string")
    assert sorted(r.v for r in privacy.without_self(s, own).collect()) == [UNIT.format(5), "Wolf"]
    records = spark.createDataFrame([(2, 'a "b"\n', [1, 2], 1.0), (1, None, [], float("nan"))], "id int, name string, ids array<int>, x double")
    assert [r.line for r in emit.lines(records, "id", ["name", "ids", "x"]).orderBy("id").collect()] == ["[1] = {ids=nil,x=nil}", '[2] = {name="a \\"b\\"\\n",ids={1,2},x=1}']
    limits = spark.createDataFrame([("npc", 100)], "kind string, max_id long")
    facts = spark.createDataFrame([("npc", 99), ("npc", 101), ("quest", 1)], "kind string, entity long")
    assert sorted((r.kind, r.entity) for r in emit.above(facts, "entity", "kind", limits).collect()) == [("npc", 101), ("quest", 1)]
    rel = spark.createDataFrame([(1, [5, 200]), (2, [6])], "quest long, givers array<long>")
    assert [(r.quest, r.givers) for r in emit.new_relations(rel, "quest", "givers", F.col("member") <= 100).collect()] == [(1, [200])]
