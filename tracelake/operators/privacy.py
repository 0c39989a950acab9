"""What must not leave a session: names, own ids, ids of players, free system messages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def kind_allowed(guid: Column) -> Column:
    """Whether an id is of an npc, object or item; players and unknown ones are not."""
    return text.parse_guid(guid)["kind"].isin("npc", "object", "item")


def with_allowed_sources(rows: DataFrame, sources: str) -> DataFrame:
    """Rows whose array of ids holds allowed ones alone: one other id discards the whole row."""
    return rows.where(F.forall(F.col(sources), lambda g: F.coalesce(kind_allowed(g), F.lit(False))))


def pattern_of(template: str) -> str:
    """An anchored pattern for a message template with %s and %d (or %1$s) places."""
    out = "".join(r"\d+" if re.fullmatch(r"%(\d\$)?d", p) else ".+" if re.fullmatch(r"%(\d\$)?s", p) else re.escape(p) for p in re.split(r"(%(?:\d\$)?[sd])", template) if p and not re.fullmatch(r"\d\$", p))
    return f"^{out}$"


def message_allowed(message: Column, templates: Sequence[str]) -> Column:
    """Whether a message fits one of the templates; none fit if there are none."""
    return message.rlike("|".join(map(pattern_of, templates))) if templates else F.lit(False)


def chat(args: DataFrame, message: str, sender: str, other: str, guid: str, names: Sequence[str]) -> DataFrame:
    """Chat arguments with names redacted, both sender names nulled and an id kept only if allowed."""
    return args.withColumn(message, text.redacted(F.col(message), names)).withColumn(sender, F.lit(None).cast("string")).withColumn(other, F.lit(None).cast("string")).withColumn(guid, F.when(kind_allowed(F.col(guid)), F.col(guid)))


def without_self(samples: DataFrame, own: DataFrame, guid_fn: str = "UnitGUID", name_fns: Sequence[str] = ("UnitName",)) -> DataFrame:
    """``samples`` without those that show the player: ids equal to ``own(sid, guid)`` and names of the same unit at the same time.

    Two anti-joins; streams that lose all samples are gone with them.
    """
    mine = samples.where(F.col("fn") == guid_fn).join(own, (samples["sid"] == own["sid"]) & (samples["v"] == own["guid"]), "left_semi").select("sid", "params", "t").distinct()
    shown = F.col("fn").isin(guid_fn, *name_fns)
    same = [F.col(f"a.{c}") == F.col(f"m.{c}") for c in ("sid", "params", "t")]
    return samples.where(~shown).unionByName(samples.where(shown).alias("a").join(mine.alias("m"), same, "left_anti"))


def crafter_pattern(template: str) -> str:
    """An anchored pattern whose second group is the first argument of a template with %s and %d (or %1$s) places."""
    out, n, found = "", 0, False
    for part in re.split(r"(%(?:\d\$)?[sd])", template):
        if not re.fullmatch(r"%(?:\d\$)?[sd]", part):
            out += re.escape(part)
            continue
        n += 1
        if int(part[1] if "$" in part else n) == 1 and not found:
            found, out = True, f"({out})(.*?)("
        else:
            out += ".*?"
    return f"^{out})$" if found else ""


def tradeskill(message: Column, own: Sequence[str], others: Sequence[str]) -> Column:
    """A tradeskill message without the crafter's name: ``others`` begin with one, ``own`` have none; other texts are dropped (null)."""
    out = F.when(message == "", message)
    for template in others:
        if pattern := crafter_pattern(template):
            out = out.when(message.rlike(pattern), F.regexp_replace(message, pattern, "$1<name>$3"))
    return out.when(message_allowed(message, own), message)
