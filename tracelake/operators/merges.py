"""Evidence of many sessions merged into one fact for each entity and field.

All are two-level aggregations: rows are combined map-side by (entity, value) first, so
an entity with very many rows shuffles one row for each distinct value, and windows
run over those. Ties are resolved by stated orders alone, never by arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar_summary(rows: DataFrame, by: Sequence[str], value: str, *, t: str, session: str, session_time: str, seen: Sequence[str], confidence: Column | None = None) -> DataFrame:
    """One row for each (``by``, value): confidence, n, latest_t, timed_sessions, newest_session, seen (struct of the first row's place)."""
    timed = F.when(F.col(session_time).isNotNull(), F.col(session))
    return rows.groupBy(*by, value).agg(
        F.max(confidence if confidence is not None else F.lit(3)).alias("confidence"), F.count(F.lit(1)).alias("n"), F.max(t).alias("latest_t"),
        F.count_distinct(timed).alias("timed_sessions"), F.max(session_time).alias("newest_session"), F.min(F.struct(*seen)).alias("seen"),
    )


def _facts(summary: DataFrame, by: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    everything = Window.partitionBy(*by)
    ranked = summary.withColumn("_place", F.row_number().over(everything.orderBy(*order))).withColumn("observations", F.sum("n").over(everything)).withColumn("alternatives", F.count(F.lit(1)).over(everything) - 1)
    return ranked.where("_place = 1").select(*by, value, "confidence", "observations", "alternatives")


_DEFAULT = ("confidence", "n", "latest_t")


def default_merge(summary: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The value with the highest confidence, then most rows, then latest, then first seen."""
    return _facts(summary, by, value, [*(F.desc(c) for c in _DEFAULT), F.asc("seen")])


def newest_merge(summary: DataFrame, by: Sequence[str], value: str, sessions: int = 2) -> DataFrame:
    """The value that at least ``sessions`` timed sessions support and the newest of them; else as ``default_merge``."""
    supported = F.col("timed_sessions") >= sessions
    return _facts(summary, by, value, [F.desc(supported.cast("int")), F.desc(F.when(supported, F.col("newest_session"))), *(F.desc(c) for c in _DEFAULT), F.asc("seen")])


def sessions_of(rows: DataFrame, by: Sequence[str], session: str, name: str = "sessions") -> DataFrame:
    """Distinct sessions of each group: duplicates go first, which rows dealt by session need no further shuffle for, and their counts are combined before the next."""
    return rows.select(*by, session).distinct().groupBy(*by).agg(F.count(session).alias(name))


def support(rows: DataFrame, by: Sequence[str], value: Sequence[str], session: str) -> DataFrame:
    """Distinct sessions of each value of an entity, and of its strongest value."""
    n = sessions_of(rows, [*by, *value], session)
    return n.withColumn("strongest", F.max("sessions").over(Window.partitionBy(*by)))


def supported_ids(rows: DataFrame, by: Sequence[str], kind: str, id_: str, session: str, least: int = 5, share: float = 0.005) -> DataFrame:
    """For each entity and kind the sorted ids that ``least`` sessions and ``share`` of the strongest id (of any kind) support."""
    ok = (F.col("sessions") >= least) & (F.col("sessions") >= F.col("strongest") * share)
    return support(rows, by, [kind, id_], session).where(ok).groupBy(*by, kind).agg(F.array_sort(F.collect_list(id_)).alias("ids"))


def supported_range(rows: DataFrame, by: Sequence[str], value: str, session: str, least: int = 2, share: float = 0.1) -> DataFrame:
    """Least and greatest value with enough support."""
    ok = (F.col("sessions") >= least) & (F.col("sessions") >= F.col("strongest") * share)
    return support(rows, by, [value], session).where(ok).groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def strict_mode(rows: DataFrame, by: Sequence[str], value: str, session: str, least: int = 2, none: object = 0) -> DataFrame:
    """The value of most sessions, at least ``least``; entities with a tie, or whose value is ``none``, have no row."""
    ranked = support(rows, by, [value], session).withColumn("_ties", F.count(F.when(F.col("sessions") == F.col("strongest"), 1)).over(Window.partitionBy(*by)))
    return ranked.where((F.col("sessions") == F.col("strongest")) & (F.col("_ties") == 1) & (F.col("sessions") >= least) & (F.col(value) != F.lit(none))).select(*by, value, "sessions")


def untied_mode(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The value of most rows; entities with a tie have no row."""
    n = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    return n.withColumn("_top", F.max("n").over(w)).withColumn("_ties", F.count(F.when(F.col("n") == F.col("_top"), 1)).over(w)).where("n = _top and _ties = 1").select(*by, value, "n")


def slot_mode(rows: DataFrame, by: Sequence[str], slot: str, id_: str, session: str) -> DataFrame:
    """In each slot the id of most sessions (lowest of equals); the ids of an entity in slot order, each once."""
    n = sessions_of(rows, [*by, slot, id_], session)
    best = n.groupBy(*by, slot).agg(F.max_by(F.col(id_), F.struct(F.col("sessions"), -F.col(id_))).alias("id"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(slot).alias("slot"), F.col("id")))), lambda s: s["id"])
    return best.groupBy(*by).agg(F.array_distinct(ordered).alias("ids"))


def weighted_mode(rows: DataFrame, by: Sequence[str], value: str, weight: Column, seen: Sequence[str], exclusive: Column | None = None) -> DataFrame:
    """The value with the greatest sum of weights, first seen of equals; where an entity has ``exclusive`` rows only those count."""
    own = F.lit(True) if exclusive is None else F.coalesce(exclusive, F.lit(False))
    place = F.struct(*seen)
    # both sums of each value first: the window that knows of exclusive rows runs over values, not rows
    n = rows.groupBy(*by, value).agg(F.sum(weight).alias("_all"), F.min(place).alias("_all_seen"), F.sum(F.when(own, weight)).alias("_own"), F.min(F.when(own, place)).alias("_own_seen"), F.max(own.cast("int")).alias("_is"))
    n = n.withColumn("_any", F.max("_is").over(Window.partitionBy(*by))).where("_is = 1 or _any = 0")
    chosen = F.col("_any") == 1
    n = n.select(*by, value, F.when(chosen, F.col("_own")).otherwise(F.col("_all")).alias("weight"), F.when(chosen, F.col("_own_seen")).otherwise(F.col("_all_seen")).alias("_seen"))
    return n.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("weight"), F.asc("_seen")))).where("_place = 1").select(*by, value, "weight")


def exclusive_tokens(rows: DataFrame, by: Sequence[str], token: str, priority: Sequence[str]) -> DataFrame:
    """Rows of the highest token of ``priority`` that their entity has; all its rows if it has none of them."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for i, p in enumerate(priority) for x in (p, i)])[F.col(token)], F.lit(len(priority)))
    best = rows.withColumn("_rank", rank).groupBy(*by).agg(F.min("_rank").alias("_best"))
    return rows.withColumn("_rank", rank).join(best, list(by)).where("_rank = _best").drop("_rank", "_best")


def undecided_switch(rows: DataFrame, by: Sequence[str], side: str, session: str, session_time: str, least: int = 2) -> DataFrame:
    """The boolean ``side`` an entity has now.

    An entity of which any session saw both sides has none. All sessions of one side: at
    least ``least`` of them. Both sides: every session needs a time, there must be exactly one
    switch in the order of time, not between equal times, and the newer side needs
    ``least`` sessions.
    """
    each = rows.groupBy(*by, session).agg(F.min(side).alias("side"), F.max(side).alias("_other"), F.max(session_time).alias("at"))
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_first("at"), F.col(session))
    step = each.withColumn("_before", F.lag("side").over(w)).withColumn("_before_at", F.lag("at").over(w))
    switched = F.col("_before").isNotNull() & (F.col("_before") != F.col("side"))
    n = step.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("side").alias("n_true"), F.count_if(switched).alias("switches"), F.count_if(switched & (F.col("_before_at") == F.col("at"))).alias("ties"),
        F.count_if(F.col("side") != F.col("_other")).alias("mixed"), F.count_if(F.col("at").isNull()).alias("untimed"), F.max_by("side", F.struct(F.col("at").isNotNull(), F.col("at"), F.col(session))).alias("newest"),
    )
    newer = F.when(F.col("newest"), F.col("n_true")).otherwise(F.col("n") - F.col("n_true"))
    unanimous = (F.col("n_true") == 0) | (F.col("n_true") == F.col("n"))
    ok = F.when(unanimous, F.col("n") >= least).otherwise((F.col("untimed") == 0) & (F.col("switches") == 1) & (F.col("ties") == 0) & (newer >= least))
    return n.where(ok & (F.col("mixed") == 0)).select(*by, F.col("newest").alias("side"), F.col("n").alias("sessions"))


def consensus(rows: DataFrame, by: Sequence[str], part: str, amount: str, session: str, presence: float = 0.5, share: float = 0.8, least: int = 2) -> DataFrame:
    """Parts (with their amount) present in ``presence`` of an entity's sessions and ``least``, one amount in ``share`` of those."""
    total = sessions_of(rows, by, session, "_all")
    # the presence of a part and of an amount, each a distinct count of sessions
    parts = sessions_of(rows, [*by, part], session, "_part")
    amounts = sessions_of(rows, [*by, part, amount], session)
    joined = amounts.join(parts, [*by, part]).join(total, list(by))
    return joined.where((F.col("_part") >= least) & (F.col("_part") >= F.col("_all") * presence) & (F.col("sessions") >= F.col("_part") * share)).select(*by, part, amount, "sessions")


def located(rows: DataFrame, by: Sequence[str], zone: str, x: str, y: str, t: str, preferred: Column, seen: Sequence[str]) -> DataFrame:
    """The zone (preferred, then most rows, latest, lowest) and in it the coordinate (most rows, latest, first met) of an entity."""
    points = rows.groupBy(*by, zone, x, y).agg(F.count(F.lit(1)).alias("n"), F.max(t).alias("_t"), F.min(F.struct(*seen)).alias("_seen"), F.max(preferred.cast("int")).alias("_p"))
    zones = points.groupBy(*by, zone).agg(F.max("_p").alias("_zp"), F.sum("n").alias("_zn"), F.max("_t").alias("_zt"))
    best = zones.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_zp"), F.desc("_zn"), F.desc("_zt"), zone))).where("_place = 1").select(*by, zone)
    place = Window.partitionBy(*by).orderBy(F.desc("n"), F.desc("_t"), F.asc("_seen"))
    return points.join(best, [*by, zone]).withColumn("_place", F.row_number().over(place)).where("_place = 1").select(*by, zone, x, y, "n")


def restricted_to(rows: DataFrame, by: Sequence[str], starter: str, team: str, friendly: str, session: str, least: int = 3) -> DataFrame:
    """The team an entity is restricted to: all its starters are hostile in ``least`` sessions and never friendly to another team, friendly and never hostile to it."""
    hostile, kind = F.count_distinct(F.when(~F.col(friendly), F.col(session))), F.count_distinct(F.when(F.col(friendly), F.col(session)))
    each = rows.groupBy(*by, starter, team).agg(hostile.alias("hostile"), kind.alias("kind"))
    teams = each.groupBy(*by, team).agg(F.bool_and((F.col("hostile") >= least) & (F.col("kind") == 0)).alias("against"), F.bool_and((F.col("kind") > 0) & (F.col("hostile") == 0)).alias("for"), F.count(F.lit(1)).alias("n"))
    starters = rows.groupBy(*by).agg(F.count_distinct(starter).alias("_starters"))
    full = teams.join(starters, list(by)).where("n = _starters")
    other = full.where("against").select(*by, F.col(team).alias("_against"))
    return full.where("for").join(other, list(by)).where(F.col(team) != F.col("_against")).select(*by, team).distinct()


def decided_rewards(rows: DataFrame, quest: str, side: str, turn: str, session: str, part: str, amount: str, source: str, presence: float = 0.5, share: float = 0.8, least: int = 2) -> DataFrame:
    """The rewards (array of part, amount) of each quest, on which its sides agree.

    ``rows`` are gains of turn-ins; ``source`` names the part that a gain spilled over
    from, if any. A part needs ``presence`` of a side's turn-ins and ``least`` sessions, and
    exactly one amount with ``least`` sessions and ``share`` of the part's. A part that only
    spills over gets a quarter of its decided source, if ``share`` of its turn-ins name that
    one. A quest that both sides handed in has rewards only where theirs are equal.
    """
    by = [quest, side]
    total = rows.groupBy(*by).agg(F.count_distinct(turn).alias("_turns"))
    own = rows.where(F.col(source).isNull())
    parts = own.groupBy(*by, part).agg(F.count_distinct(turn).alias("_with"), F.count_distinct(session).alias("_all"))
    amounts = own.groupBy(*by, part, amount).agg(F.count_distinct(session).alias("_sessions")).join(parts, [*by, part]).join(total, by)
    fits = (F.col("_with") >= F.col("_turns") * presence) & (F.col("_all") >= least) & (F.col("_sessions") >= least) & (F.col("_sessions") >= F.col("_all") * share)
    decided = amounts.where(fits).groupBy(*by, part).agg(F.min(amount).alias(amount), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    spilt = rows.where(F.col(source).isNotNull())
    each = spilt.groupBy(*by, part).agg(F.count_distinct(turn).alias("_with"), F.count_distinct(session).alias("_all"))
    top = spilt.groupBy(*by, part, source).agg(F.count_distinct(turn).alias("_times")).groupBy(*by, part).agg(F.max(F.struct(F.col("_times"), (-F.col(source)).alias("_less"))).alias("_top"))
    from_source = decided.select(*by, F.col(part).alias("_source"), F.col(amount).alias("_amount"))
    spill = each.join(top, [*by, part]).join(total, by).withColumn("_source", -F.col("_top._less")).join(from_source, [*by, "_source"])
    spill = spill.where((F.col("_with") >= F.col("_turns") * presence) & (F.col("_all") >= least) & (F.col("_top._times") >= F.col("_with") * share))
    spill = spill.select(*by, part, (F.col("_amount") / 4).alias(amount)).join(decided.select(*by, part), [*by, part], "left_anti")
    lists = decided.unionByName(spill).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(part, amount))).alias("rewards"))
    sides = total.join(lists, by, "left").groupBy(quest).agg(F.count(F.lit(1)).alias("_sides"), F.count("rewards").alias("_lists"), F.count_distinct("rewards").alias("_kinds"), F.first("rewards", ignorenulls=True).alias("rewards"))
    return sides.where("_kinds = 1 and (_sides = 1 or _lists = _sides)").select(quest, "rewards")


def race_restrictions(starters: DataFrame, reactions: DataFrame, seen: DataFrame, least: int = 3) -> DataFrame:
    """(quest, side) of quests that one side alone can take: ``starters(quest, npc)``, ``reactions(npc, side, friendly, session)``, ``seen(quest, side)``.

    Every starter was hostile to the other side in ``least`` sessions and friendly to it in
    none, friendly to this side and never hostile; this side saw the quest; the other saw
    neither it nor another quest of its starters.
    """
    n = lambda c: F.count_distinct(F.when(c, F.col("session")))
    each = reactions.groupBy("npc", "side").agg(n(~F.col("friendly")).alias("_hostile"), n(F.col("friendly")).alias("_kind"))
    # a side that saw any quest of a starter saw this one or a sibling
    met = starters.join(seen, "quest").select("npc", "side").distinct().withColumn("_met", F.lit(True))
    sides = starters.select("quest", "npc", F.explode(F.array(F.lit("A"), F.lit("H"))).alias("side")).distinct()
    facts = sides.join(each, ["npc", "side"], "left").join(met, ["npc", "side"], "left")
    against = F.coalesce((F.col("_hostile") >= least) & (F.col("_kind") == 0), F.lit(False)) & F.col("_met").isNull()
    kind = F.coalesce((F.col("_kind") > 0) & (F.col("_hostile") == 0), F.lit(False))
    quests = facts.groupBy("quest", "side").agg(F.bool_and(against).alias("_against"), F.bool_and(kind).alias("_for"))
    other = quests.where("_against").select("quest", F.when(F.col("side") == "A", "H").otherwise("A").alias("side"))
    return quests.where("_for").join(other, ["quest", "side"]).join(seen.select("quest", "side").distinct(), ["quest", "side"], "left_semi").select("quest", "side")


def of_latest_text(rows: DataFrame, by: Sequence[str], text: str, t: str, seen: Sequence[str]) -> DataFrame:
    """Rows of an entity that have its latest text that is not blank (the first seen of equal times)."""
    spoken = F.trim(F.col(text)) != ""
    last = rows.where(spoken).groupBy(*by).agg(F.max(t).alias("_t"))
    chosen = rows.where(spoken).join(last, [*by]).where(F.col(t) == F.col("_t")).groupBy(*by).agg(F.min_by(text, F.struct(*seen)).alias("_text"))
    return rows.join(chosen, [*by]).where(F.col(text) == F.col("_text")).drop("_text")
