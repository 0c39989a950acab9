"""Observations from sessions: each observer is a query over events and samples.

Input: ``events(sid, pos, t, tp, e, args)`` and ``samples(sid, fn, params, pos, t, tp, v)``
(``sid`` names a session, ``args`` and ``v`` are JSON, a null ``v`` is a stored nil), as
``sources.submissions`` gives them with ``sid`` for submission and idx. Output:
``sid, entity, value, t, confidence`` and, where it counts, ``token``. Streams are looked
up per session and function, so work is dealt by both. Observers that also need events
take them as ``events``; without them they do what samples alone allow (stated there).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import temporal

TOKENS = ("target", "npc", "questnpc")


def stream(samples: DataFrame, fn: str, *params: str) -> DataFrame:
    """sid, t, tp, pos, v of one stream."""
    own = (F.col("fn") == fn) & (F.size("params") == len(params))
    for k, p in enumerate(params):
        own = own & (F.col("params")[k] == p)
    return samples.where(own).select("sid", "t", "tp", "pos", "v")


def by_param(samples: DataFrame, fn: str, name: str, fixed: Sequence[str] = ()) -> DataFrame:
    """The same for all streams of a function with one more parameter, which becomes a column."""
    own = (F.col("fn") == fn) & (F.size("params") == len(fixed) + 1)
    for k, p in enumerate(fixed):
        own = own & (F.col("params")[k] == p)
    return samples.where(own).select("sid", F.col("params")[len(fixed)].alias(name), "t", "tp", "pos", "v")


def at(rows: DataFrame, samples: DataFrame, name: str, by: Sequence[str] = ("sid",), strict: bool = False) -> DataFrame:
    """``rows`` with the active value of a stream as ``name``; null where it holds nil or nothing."""
    return temporal.asof(rows, samples, list(by), "t", ["v"], ["pos"], strict, names=[name]).drop("matched")


def at_many(rows: DataFrame, streams: Mapping[str, DataFrame], by: Sequence[str] = ("sid",), strict: bool = False) -> DataFrame:
    """The same for several streams in one pass, each under its name."""
    found = temporal.asof_many(rows, {n: s.select(*by, "t", "pos", "v") for n, s in streams.items()}, list(by), "t", ["pos"], strict)
    return found.select(*rows.columns, *[F.col(f"{n}.v").alias(n) for n in streams])


def number(v: Column) -> Column:
    return v.try_cast("double")


def locales(samples: DataFrame) -> DataFrame:
    """The stream of locales, with or without a parameter."""
    return samples.where("fn = 'GetLocale'").select("sid", "t", "tp", "pos", F.nullif("v", F.lit("")).alias("v"))


def unit_name(v: Column) -> Column:
    """A recorded name, alone or the first of a tuple, cleaned."""
    return text.cleaned(F.coalesce(F.try_element_at(text.unpacked(v), F.lit(1)), v))


def in_locale(observations: DataFrame, locale: str = "enUS") -> DataFrame:
    """The observations of one locale."""
    return observations.where(F.col("locale") == locale).drop("locale")


def _observation(rows: DataFrame, entity: Column, value: Column, confidence: str = "high", *more: Column) -> DataFrame:
    out = rows.select("sid", entity.cast("long").alias("entity"), value.alias("value"), "t", F.lit(confidence).alias("confidence"), *more)
    return out.where(F.col("entity").isNotNull() & F.col("value").isNotNull())


def first_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of each key in a session."""
    w = Window.partitionBy("sid", *keys).orderBy("t")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def encounters(samples: DataFrame, kind: str, tokens: Sequence[str] = TOKENS) -> DataFrame:
    """sid, token, t, tp, pos, id, guid of every sampled unit of a kind (npc, object)."""
    units = by_param(samples, "UnitGUID", "token").where(F.col("token").isin(*tokens) & F.col("v").isNotNull())
    parsed = units.withColumn("_g", text.parse_guid(F.col("v")))
    return parsed.where((F.col("_g.kind") == kind) & F.col("_g.id").isNotNull()).select("sid", "token", "t", "tp", "pos", F.col("_g.id").alias("id"), F.col("v").alias("guid"))


def quest_encounters(samples: DataFrame) -> DataFrame:
    quests = stream(samples, "GetQuestID").withColumn("id", number(F.col("v")).cast("long"))
    return quests.where("id <> 0").select("sid", "t", "tp", "pos", "id")


def names(samples: DataFrame, kind: str = "npc", events: DataFrame | None = None) -> DataFrame:
    """Names of units, with the locale that held (``locale``); with ``events`` also those of looted objects, from the last tooltip before the loot."""
    named = at(encounters(samples, kind), by_param(samples, "UnitName", "token"), "name", ("sid", "token")).select("sid", "t", "id", unit_name(F.col("name")).alias("name"))
    if events is not None and kind == "object":
        looted = at(object_loots(events, samples), stream(samples, "GameObjectName"), "name")
        named = named.unionByName(looted.select("sid", "t", "id", F.nullif("name", F.lit("")).alias("name")))
    seen = at(named, locales(samples), "locale").where("locale is not null")
    return _observation(seen, F.col("id"), F.col("name"), "high", F.col("locale"))


def unit_state(samples: DataFrame, fn: str, tokens: Sequence[str] = TOKENS) -> DataFrame:
    """Units with the value of a state stream that was sampled in the same frame and before the next unit of the token."""
    heads = by_param(samples, "UnitGUID", "token").where(F.col("token").isin(*tokens)).select("sid", "token", "t", "tp", text.parse_guid(F.col("v")).alias("_g"))
    paired = temporal.same_frame_first(heads, by_param(samples, fn, "token"), ["sid", "token"], "t", "tp", ["v"], ["pos"])
    return paired.where("_g.kind = 'npc' and _g.id is not null").select("sid", "token", "t", "tp", F.col("_g.id").alias("id"), "v")


#: Events at which the state of every unit token is sampled.
STATE_EVENTS = ("PLAYER_TARGET_CHANGED", "UPDATE_MOUSEOVER_UNIT")


def unit_state_held(events: DataFrame, samples: DataFrame, fn: str, fixed: Sequence[str] = (), tokens: Sequence[str] = ("target", "mouseover")) -> DataFrame:
    """Units of a token with the value that a state stream held: sid, token, t, id, v.

    Streams are written on change only, so a value counts where the stream has a sample in
    the unit's frame or one of ``STATE_EVENTS`` fell into it. Samples from the token's next
    unit in the frame on belong to that one.
    """
    units = by_param(samples, "UnitGUID", "token").where(F.col("token").isin(*tokens))
    w = Window.partitionBy("sid", "token", "t").orderBy("tp")
    units = units.withColumn("_next", F.coalesce(F.lead("tp").over(w), F.lit(float("inf")))).withColumn("_g", text.parse_guid(F.col("v")))
    heads = units.where("_g.kind = 'npc' and _g.id is not null").select("sid", "token", "t", F.col("_g.id").alias("id"), F.struct(F.col("t").alias("t"), F.col("_next").alias("tp")).alias("_clock"))
    values = by_param(samples, fn, "token", fixed)
    own = values.select("sid", "token", "t").distinct().withColumn("_own", F.lit(True))
    fired = events.where(F.col("e").isin(*STATE_EVENTS)).select("sid", "t").distinct().withColumn("_fired", F.lit(True))
    heads = heads.join(own, ["sid", "token", "t"], "left").join(fired, ["sid", "t"], "left").where("_own or _fired").select("sid", "token", "t", "id", "_clock")
    held = temporal.asof(heads, values.select("sid", "token", "pos", "v", F.struct("t", "tp").alias("_clock")), ["sid", "token"], "_clock", ["v"], ["pos"], strict=True)
    return held.where("matched").drop("matched", "_clock")


def levels(samples: DataFrame, events: DataFrame | None = None) -> DataFrame:
    state = unit_state(samples, "UnitLevel") if events is None else unit_state_held(events, samples, "UnitLevel")
    rows = state.withColumn("level", number(F.col("v")).cast("int")).where("level >= 1")
    return _observation(first_of(rows, ["id", "level"]), F.col("id"), F.col("level"))


def ranks(samples: DataFrame, events: DataFrame | None = None) -> DataFrame:
    state = unit_state(samples, "UnitClassification") if events is None else unit_state_held(events, samples, "UnitClassification")
    rows = state.withColumn("rank", text.lookup(text.RANKS, F.col("v"))).where("rank is not null")
    return _observation(first_of(rows, ["id", "rank"]), F.col("id"), F.col("rank"))


def friendliness(samples: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Whether a unit is friendly (a reaction of 4 or more), with the player's side: each answer once a session and side.

    With ``events`` also the session's server time (``session_time``), by which merges order sessions.
    """
    state = unit_state(samples, "UnitReaction") if events is None else unit_state_held(events, samples, "UnitReaction", ("player",))
    rows = at(state, stream(samples, "UnitFactionGroup", "player"), "faction").withColumn("side", text.side_of(F.col("faction"))).withColumn("friendly", number(F.col("v")) >= 4)
    rows = first_of(rows.where("side is not null and friendly is not null"), ["id", "side", "friendly"])
    if events is None:
        return _observation(rows, F.col("id"), F.col("friendly"), "high", F.col("side"))
    first = samples.where("fn = 'GetServerTime'").groupBy("sid").agg(F.min_by(number(F.col("v")), F.struct("t", "pos")).alias("session_time"))
    return _observation(rows.join(first, "sid", "left"), F.col("id"), F.col("friendly"), "high", F.col("side"), F.col("session_time"))


def subnames(samples: DataFrame) -> DataFrame:
    """Titles under names; a level line means none (empty). The locale that held comes with them."""
    rows = at(unit_state(samples, "UnitSubName", ("mouseover",)).where("v is not null"), locales(samples), "locale")
    return _observation(rows.where("locale is not null"), F.col("id"), F.when(text.is_level_line(F.col("v")), "").otherwise(F.col("v")), "high", F.col("locale"))


def places(samples: DataFrame, kind: str = "npc", most_distance: float = 30.0, events: DataFrame | None = None) -> DataFrame:
    """Zone and position (per cent) where units were met.

    Of targets only near ones count where nearness is recorded: a distance up to
    ``most_distance``, or a check of the interaction distance that is true. With ``events``
    also where objects were looted (token ``loot``).
    """
    met = encounters(samples, kind).select("sid", "t", "id", "token")
    if events is not None and kind == "object":
        met = met.unionByName(object_loots(events, samples).select("sid", "t", "id", F.lit("loot").alias("token")))
    looked = {"zone": stream(samples, "C_Map.GetBestMapForUnit", "player"), "position": stream(samples, "C_Map.GetPlayerMapPosition", "player")}
    near, ranged = F.lit(True), None
    if kind == "npc":
        checks = by_param(samples, "CheckInteractDistance", "_index", ("target",)).drop("_index")
        ranged = stream(samples, "TargetDistance").withColumn("v", (number(F.col("v")) <= most_distance).cast("string")).unionByName(checks)
        looked["near"] = ranged
    rows = at_many(met, looked)
    if ranged is not None:
        rows = rows.join(ranged.select("sid", F.lit(True).alias("_ranged")).distinct(), "sid", "left")
        near = (F.col("token") != "target") | F.col("_ranged").isNull() | (F.col("near") == "true")
    coordinate = lambda c: text.percent(F.get_json_object("position", f"$.{c}").try_cast("double"))
    spot = F.struct(number(F.col("zone")).cast("long").alias("zone"), coordinate("x").alias("x"), coordinate("y").alias("y"))
    rows = rows.where(near).withColumn("_spot", spot).where("_spot.zone is not null and _spot.x is not null and _spot.y is not null")
    return _observation(rows, F.col("id"), F.col("_spot"), "high", F.col("token"))


def item_names(samples: DataFrame) -> DataFrame:
    links = by_param(samples, "GetLootSlotLink", "slot").withColumn("_l", text.parse_link(F.col("v"))).where("_l is not null")
    return _observation(links, F.col("_l.id"), F.col("_l.name"))


def drops(samples: DataFrame, kind: str = "npc") -> DataFrame:
    """Items and the units that dropped them: link and source of a slot at the same time, the first source sample alone.

    A source is an array of unit ids and counts by turns.
    """
    links = by_param(samples, "GetLootSlotLink", "slot").withColumn("item", text.parse_link(F.col("v"))["id"]).where("item is not null").select("sid", "slot", "t", "item")
    sources = by_param(samples, "GetLootSourceInfo", "slot").select("sid", "slot", "t", "pos", F.col("v").alias("source"))
    pairs = temporal.first_match(links, sources, ["sid", "slot", "t"], ["pos"], ["source"])
    units = pairs.select("sid", "t", "item", F.posexplode(text.unpacked(F.col("source"))).alias("k", "guid")).where("k % 2 = 0").withColumn("_g", text.parse_guid(F.col("guid")))
    return _observation(units.where(F.col("_g.kind") == kind), F.col("item"), F.col("_g.id"))


def objective_counts(samples: DataFrame) -> DataFrame:
    """Objectives of a quest that are neither events nor log entries; empty lists tell nothing."""
    lists = by_param(samples, "C_QuestLog.GetQuestObjectives", "quest").withColumn("_o", F.from_json("v", "array<struct<type: string>>")).where("size(_o) > 0")
    return _observation(lists, number(F.col("quest")), F.size(F.filter("_o", lambda o: ~F.coalesce(o["type"], F.lit("")).isin("event", "log"))))


def quest_names(samples: DataFrame) -> DataFrame:
    """Titles of the dialog; titles of the quest log only for quests that have no dialog title in the session."""
    locale = locales(samples)
    dialog = at_many(quest_encounters(samples), {"title": stream(samples, "GetTitleText"), "locale": locale}).where("locale is not null")
    spoken = _observation(dialog, F.col("id"), text.cleaned(F.col("title")), "high", F.col("locale"))
    log = by_param(samples, "C_QuestLog.GetTitleForQuestID", "quest").unionByName(by_param(samples, "C_QuestLog.GetInfo", "quest").withColumn("v", F.get_json_object("v", "$.title")))
    written = _observation(at(log, locale, "locale").where("locale is not null"), number(F.col("quest")), text.cleaned(F.col("v")), "high", F.col("locale"))
    return spoken.unionByName(written.join(spoken.select("sid", "entity").distinct(), ["sid", "entity"], "left_anti"))


def quest_levels(samples: DataFrame) -> DataFrame:
    """The newer function's level of a quest where it has samples, else the older one's (second entry of its tuple)."""
    new = by_param(samples, "C_QuestLog.GetQuestDifficultyLevel", "quest").withColumn("level", number(F.col("v")))
    new = new.unionByName(by_param(samples, "C_QuestLog.GetInfo", "quest").withColumn("level", F.get_json_object("v", "$.level").try_cast("double"))).where("level is not null")
    old = by_param(samples, "GetQuestLogTitle", "quest").withColumn("level", F.try_element_at(text.unpacked(F.col("v")), F.lit(2)).try_cast("double"))
    old = old.join(new.select("sid", "quest").distinct(), ["sid", "quest"], "left_anti")
    return _observation(new.unionByName(old), number(F.col("quest")), F.col("level").cast("int"))


def required_levels(events: DataFrame, samples: DataFrame) -> DataFrame:
    """At each accept the player's level, or the last announced one if it is greater; the least of a quest in a session."""
    arg = lambda k: F.get_json_object("args", f"$['{k}']").try_cast("double")
    marked = temporal.carried(events, ["sid"], "t", F.when(F.col("e") == "PLAYER_LEVEL_UP", arg(1)), "announced", ["pos"], inclusive=False)
    accepts = marked.where("e = 'QUEST_ACCEPTED'").withColumn("quest", text.quest_id(arg("n"), arg(1), arg(2)).cast("long")).where("quest is not null")
    rows = at(accepts, stream(samples, "UnitLevel", "player"), "level").withColumn("_level", F.greatest(number(F.col("level")), F.col("announced"))).where("_level is not null")
    least = rows.groupBy("sid", "quest").agg(F.min(F.struct("_level", "t")).alias("_m")).select("sid", "quest", "_m._level", "_m.t")
    return _observation(least, F.col("quest"), F.col("_level").cast("int"), "medium")


def quest_xp(samples: DataFrame) -> DataFrame:
    """Shown rewards with the quest and the player's level that held on the precise clock."""
    clock = lambda df: df.drop("t").withColumnRenamed("tp", "t")
    rewards = clock(stream(samples, "GetRewardXP")).withColumnRenamed("v", "xp")
    rows = at_many(rewards, {"quest": clock(stream(samples, "GetQuestID")), "level": clock(stream(samples, "UnitLevel", "player"))})
    found = rows.where((number(F.col("quest")) != 0) & (number(F.col("xp")) > 0))
    return _observation(found, number(F.col("quest")), F.struct(number(F.col("level")).cast("int").alias("level"), number(F.col("xp")).cast("long").alias("xp")))


def givers(events: DataFrame, samples: DataFrame, names_: Sequence[str] = ("QUEST_DETAIL",), unless: Sequence[str] = (), kind: str = "npc") -> DataFrame:
    """Units that quests were taken from or handed to: the dialog's unit when the event was handled.

    An event whose unit could belong to the next event tells nothing. ``unless``: an event
    counts only if its quest had none of these before.
    """
    arg = lambda k: F.get_json_object("args", f"$['{k}']").try_cast("double")
    e = events.withColumn("quest", text.quest_id(arg("n"), arg(1), arg(2)).cast("long"))
    wanted = F.col("e").isin(*names_)
    e = temporal.unless_seen_before(e, ["sid", "quest"], "t", wanted, F.col("e").isin(*unless), ["pos"]) if unless else e.where(wanted)
    found = temporal.bounded_asof(e.select("sid", "pos", "t", "tp", "quest"), by_param(samples, "UnitGUID", "token").where("token = 'questnpc'"), ["sid"], "t", "tp", ["v"], ["pos"])
    met = temporal.bounded_asof(e.select("sid", "pos", "t", "tp", "quest"), stream(samples, "GetQuestID"), ["sid"], "t", "tp", ["v"], ["pos"]).select("sid", "pos", F.when(number(F.col("v")) != 0, number(F.col("v"))).alias("_shown"))
    rows = found.join(met, ["sid", "pos"], "left").withColumn("_g", text.parse_guid(F.col("v"))).where((F.col("_g.kind") == kind) & ~F.col("ambiguous"))
    return _observation(rows, F.coalesce("quest", "_shown"), F.col("_g.id"), "medium")


def trigger_places(samples: DataFrame) -> DataFrame:
    """Where an event objective became complete: its text and the position then; samples without a place, or in another locale than enUS, don't count."""
    lists = at(by_param(samples, "C_QuestLog.GetQuestObjectives", "quest"), locales(samples), "locale").where("coalesce(locale, 'enUS') = 'enUS'")
    each = lists.select("sid", "quest", "t", "pos", F.explode(F.from_json("v", "array<struct<type: string, text: string, finished: boolean>>")).alias("_o"))
    each = each.where("_o.type = 'event' and _o.finished is not null").withColumn("text", F.nullif(text.trimmed(F.col("_o.text")), F.lit(""))).where("text is not null")
    rows = at_many(each, {"position": stream(samples, "C_Map.GetPlayerMapPosition", "player"), "zone": stream(samples, "C_Map.GetBestMapForUnit", "player")}).where("position is not null and zone is not null")
    done = temporal.became_true(rows, ["sid", "quest", "text"], "t", F.col("_o.finished"), ["pos"])
    coordinate = lambda c: text.percent(F.get_json_object("position", f"$.{c}").try_cast("double"))
    return _observation(done, number(F.col("quest")), F.struct("text", number(F.col("zone")).cast("long").alias("zone"), coordinate("x").alias("x"), coordinate("y").alias("y")))


#: Registered fields: the observers over samples alone, by entity and field.
FIELDS = {
    ("npc", "name"): names, ("npc", "subName"): subnames, ("npc", "level"): levels, ("npc", "rank"): ranks, ("npc", "friendly"): friendliness, ("npc", "spawns"): places,
    ("object", "name"): lambda s: names(s, "object"), ("object", "spawns"): lambda s: places(s, "object"), ("item", "name"): item_names, ("item", "npcDrops"): drops, ("item", "objectDrops"): lambda s: drops(s, "object"),
    ("quest", "name"): quest_names, ("quest", "level"): quest_levels, ("quest", "objectiveCount"): objective_counts, ("quest", "xp"): quest_xp, ("quest", "triggerEnd"): trigger_places,
}


def objective_texts(samples: DataFrame) -> DataFrame:
    """Lines of a quest's objective text (second entry of its tuple), with the locale; no locale means enUS."""
    rows = at(by_param(samples, "GetQuestLogQuestText", "quest"), locales(samples), "locale")
    lines = text.lines_of(F.try_element_at(text.unpacked(F.col("v")), F.lit(2)))
    return _observation(rows.withColumn("_lines", lines).where("size(_lines) > 0"), number(F.col("quest")), F.col("_lines"), "high", F.coalesce("locale", F.lit("enUS")).alias("locale"))


def zone_or_sort(samples: DataFrame, areas: DataFrame, sorts: DataFrame) -> DataFrame:
    """A quest's header as an area id, or as a negative sort id if no area has that name (``areas``, ``sorts``: name, id)."""
    own = areas.select(text.normalized(F.col("name")).alias("_name"), F.lit(0).alias("_p"), F.col("id")).unionByName(sorts.select(text.normalized(F.col("name")).alias("_name"), F.lit(1).alias("_p"), (-F.col("id")).alias("id")))
    signed = own.groupBy("_name").agg(F.min_by("id", F.struct(F.col("_p"), F.abs("id"))).alias("signed"))
    rows = by_param(samples, "QuestHeader", "quest").unionByName(by_param(samples, "QuestLogZone", "quest")).withColumn("_name", text.normalized(F.col("v")))
    return _observation(rows.join(signed, "_name"), number(F.col("quest")), F.col("signed"), "medium")


def turn_in_places(samples: DataFrame) -> DataFrame:
    """Where the map shows a complete quest, if that differs from where it was last shown incomplete; each place once."""
    maps = by_param(samples, "GetQuestsOnMap", "map").unionByName(by_param(samples, "C_QuestLog.GetQuestsOnMap", "map"))
    pois = maps.select("sid", F.col("map"), "t", "pos", F.posexplode(F.from_json("v", "array<struct<questID: long, mapID: string, x: double, y: double, isQuestStart: boolean>>")).alias("k", "_p"))
    shown = (F.coalesce("_p.mapID", "map") == F.col("map")) & ~F.coalesce("_p.isQuestStart", F.lit(False)) & (F.col("_p.x") > 0) & (F.col("_p.y") > 0)
    rows = pois.where(shown).select("sid", F.col("_p.questID").cast("string").alias("quest"), F.col("map"), "t", "pos", "k", "_p.x", "_p.y").where("quest is not null")
    rows = at(rows, by_param(samples, "IsQuestComplete", "quest").unionByName(by_param(samples, "C_QuestLog.IsComplete", "quest")), "complete", ("sid", "quest"))
    done = F.coalesce(F.col("complete") == "true", F.lit(False))
    spot = F.struct("x", "y")
    rows = temporal.carried(rows, ["sid", "quest", "map"], "t", F.when(~done, spot), "_open", ["pos", "k"], inclusive=False).where(done & ~F.col("_open").eqNullSafe(spot))
    rows = rows.withColumn("x", text.percent(F.col("x"))).withColumn("y", text.percent(F.col("y")))
    rows = first_of(rows.withColumn("zone", number(F.col("map")).cast("long")), ["quest", "zone", "x", "y"])
    return _observation(rows, number(F.col("quest")), F.struct("zone", "x", "y"))


def object_loots(events: DataFrame, samples: DataFrame) -> DataFrame:
    """sid, t, id, guid of every object that was looted: sources sampled when a loot opened, each object once a time."""
    sources = by_param(samples, "GetLootSourceInfo", "slot").join(events.where("e = 'LOOT_READY'").select("sid", "t").distinct(), ["sid", "t"], "left_semi")
    units = sources.select("sid", "t", F.posexplode(text.unpacked(F.col("v"))).alias("k", "guid")).where("k % 2 = 0").withColumn("_g", text.parse_guid(F.col("guid")))
    return units.where("_g.kind = 'object' and _g.id is not null").select("sid", "t", F.col("_g.id").alias("id"), "guid").distinct()


def quest_sides(sightings: DataFrame, samples: DataFrame) -> DataFrame:
    """Sides that saw a quest (``sightings(sid, quest, t)``): the faction then, or the first known one before it was known; each once."""
    factions = stream(samples, "UnitFactionGroup", "player").withColumn("v", text.side_of(F.col("v")))
    first = factions.where("v is not null").groupBy("sid").agg(F.min_by("v", F.struct("t", "pos")).alias("_first"))
    rows = at(sightings, factions, "side").join(first, "sid", "left").withColumn("side", F.coalesce("side", "_first")).where("side is not null")
    return _observation(first_of(rows, ["quest", "side"]), F.col("quest"), F.col("side"))


def standing_gains(events: DataFrame, samples: DataFrame, seconds: float = 0.5, apart: float = 1.0) -> DataFrame:
    """Gains of each faction at a turn-in that stands alone: standing at ``seconds`` after it less the one before ``seconds`` ahead of it."""
    arg = lambda k: F.get_json_object("args", f"$['{k}']").try_cast("double")
    turned = events.where("e = 'QUEST_TURNED_IN'").select("sid", "pos", "t", arg(1).cast("long").alias("quest"))
    w = Window.partitionBy("sid").orderBy("t", "pos")
    alone = F.coalesce(F.least(F.col("t") - F.lag("t").over(w), F.lead("t").over(w) - F.col("t")), F.lit(apart)) >= apart
    turned = turned.withColumn("_alone", alone).where("_alone").drop("_alone")
    standing = by_param(samples, "GetFactionDataByID", "faction").withColumn("v", F.get_json_object("v", "$.currentStanding"))
    asked = turned.join(standing.select("sid", "faction").distinct(), "sid")
    before = at(asked.withColumn("t", F.col("t") - seconds), standing, "low", ("sid", "faction"), strict=True).withColumn("t", F.col("t") + seconds)
    after = at(before.withColumn("t", F.col("t") + seconds), standing, "high", ("sid", "faction")).withColumn("t", F.col("t") - seconds)
    gain = number(F.col("high")) - number(F.col("low"))
    return after.withColumn("gain", gain).where("gain <> 0").select("sid", "t", "quest", number(F.col("faction")).cast("long").alias("faction"), "gain")
