"""Scalar functions over columns: names, links, ids, rounding, categories. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at the ends of a text, line breaks included (``trim`` takes blanks alone).
_ENDS = r"^\s+|\s+$"

#: What the first part of a unit id means.
GUID_KINDS = {"Creature": "npc", "Pet": "npc", "Vehicle": "npc", "GameObject": "object", "Player": "player", "Item": "item"}
#: Ranks by classification.
RANKS = {"normal": 0, "trivial": 0, "minus": 0, "elite": 1, "rareelite": 2, "worldboss": 3, "rare": 4}


#: Patterns of recorded texts.
PROGRESS_HEAD, PROGRESS_TAIL, SLAIN = r"^\s*\d+\s*/\s*\d+\s*", r"\s*:\s*\d+\s*/\s*\d+\s*$", r"(?i)\s+slain$"
LEVEL_LINE = r"^\S+ (\d+|\?\?)( ?[(（][^)）]*[)）])?$"
ITEM_LINK = r"\|Hitem:(\d+):[^|]*\|h\[([^\]]*)\]\|h"
STANDING = r"^Reputation with (.+) (increased|decreased) by (\d+)\.$"


def lookup(values: Mapping[str, object], column: Column) -> Column:
    """The entry of a small fixed map, null where there is none."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[column]


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, _ENDS, "")


def cleaned(text: Column) -> Column:
    """Line breaks dropped, ends trimmed, null if nothing is left."""
    return F.nullif(trimmed(F.regexp_replace(text, r"[\r\n]+", "")), F.lit(""))


def normalized(text: Column) -> Column:
    return F.lower(trimmed(text))


def without_last_word(text: Column, ending: str = r"\w+") -> Column:
    return trimmed(F.regexp_replace(text, rf"\s+{ending}$", ""))


def objective_name(text: Column, monster: Column) -> Column:
    """Without its progress (``0/8`` in front, ``: 0/1`` behind) and, for a monster, a last ``slain``; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(text, PROGRESS_HEAD, ""), PROGRESS_TAIL, "")
    return F.nullif(trimmed(F.when(monster, F.regexp_replace(bare, SLAIN, "")).otherwise(bare)), F.lit(""))


def is_level_line(text: Column) -> Column:
    """One word, a level or ``??``, and perhaps a rank in brackets (ASCII or full-width)."""
    return text.rlike(LEVEL_LINE)


def parse_guid(guid: Column) -> Column:
    """struct(kind, id, spawn): ids of npcs and objects are the last part but one."""
    parts = F.split(guid, "-")
    kind = F.coalesce(lookup(GUID_KINDS, F.element_at(parts, 1)), F.lit("unknown"))
    whole = kind.isin("npc", "object") & (F.size(parts) >= 3)
    return F.struct(kind.alias("kind"), F.when(whole, F.try_element_at(parts, F.lit(-2)).try_cast("double").cast("long")).alias("id"), F.when(whole, F.try_element_at(parts, F.lit(-1))).alias("spawn"))


def parse_link(link: Column) -> Column:
    """struct(id, name) of the first item link in a text, null if there is none."""
    return F.when(link.rlike(ITEM_LINK), F.struct(F.regexp_extract(link, ITEM_LINK, 1).try_cast("long").alias("id"), F.regexp_extract(link, ITEM_LINK, 2).alias("name")))


def parse_standing(message: Column) -> Column:
    """struct(faction, amount) of a chat message about a standing, null for others."""
    amount = F.regexp_extract(message, STANDING, 3).try_cast("long")
    signed = F.when(F.regexp_extract(message, STANDING, 2) == "increased", amount).otherwise(-amount)
    return F.when(message.rlike(STANDING), F.struct(F.regexp_extract(message, STANDING, 1).alias("faction"), signed.alias("amount")))


def lines_of(text: Column) -> Column:
    """Trimmed lines without the blank ones at either end; inner blank lines stay."""
    lines = F.transform(F.split(text, r"\r?\n"), trimmed)
    filled = F.filter(F.transform(lines, lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull())
    first, last = F.array_min(filled), F.array_max(filled)
    return F.when(F.size(filled) > 0, F.slice(lines, first + 1, last - first + 1)).otherwise(F.slice(lines, 1, 0))


def half_up(x: Column, digits: int = 0) -> Column:
    """Rounded half up, also below zero (``round`` goes away from zero there)."""
    scale = F.lit(float(10**digits))
    return F.floor(x * scale + 0.5) / scale


def percent(x: Column) -> Column:
    """A part of a map as per cent with two places."""
    return F.floor(x * 10000 + 0.5) / 100


def tiered(xp: Column) -> Column:
    """To 5 up to 100, to 10 up to 500, to 25 up to 1000, to 50 above."""
    step = lambda size, shift: F.lit(size) * F.floor((xp + shift) / size)
    return F.when(xp <= 100, step(5, 2)).when(xp <= 500, step(10, 5)).when(xp <= 1000, step(25, 12)).otherwise(step(50, 25))


def script_number(x: Column) -> Column:
    """A number as a script writes it: whole ones below 10**15 without a fraction."""
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), F.floor(x).cast("string")).otherwise(x.cast("string"))


def session_key(started: Column, precise: Column) -> Column:
    """First 16 hex digits of the SHA-256 of both clocks; null if one isn't finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    both = F.concat(script_number(started), F.lit("|"), script_number(precise))
    return F.when(finite(started) & finite(precise), F.substring(F.sha2(both, 256), 1, 16))


def unpacked(v: Column) -> Column:
    """The entries of a recorded tuple as texts: a JSON list, or an object of places 1 to ``n`` (missing places are null); null for other values."""
    # a text that is no object is not parsed: each that fails costs an exception
    n = F.when(F.ltrim(v, F.lit(" \t\r\n")).startswith("{"), F.get_json_object(v, "$.n")).try_cast("int")
    places = F.transform(F.sequence(F.lit(1), n), lambda k: F.call_function("get_json_object", v, F.concat(F.lit("$."), k.cast("string"))))
    return F.when(v.startswith("["), F.from_json(v, "array<string>")).when(n >= 1, places).when(n == 0, F.array().cast("array<string>"))


def sampled(key: Column, percent_: float) -> Column:
    """Whether a key is in a sample of so many per cent; every larger sample holds the smaller ones."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") / F.lit(2.0**32) < percent_ / 100


def quest_id(n: Column, first: Column, second: Column) -> Column:
    """The quest among an event's arguments: the only one, or the second of two."""
    return F.when(n == 1, first).when(n == 2, second)


def side_of(faction: Column) -> Column:
    return lookup({"Alliance": "A", "Horde": "H"}, faction)


#: Categories of event names, (category, prefixes, whole names), the first that fits counts.
CATEGORIES = (
    ("quest", ("QUEST_",), ("UNIT_QUEST_LOG_CHANGED", "QUESTLINE_UPDATE", "GOSSIP_SHOW", "GOSSIP_CLOSED")),
    ("loot", ("LOOT_",), ("CHAT_MSG_LOOT", "CHAT_MSG_MONEY")),
    ("combat", ("CHAT_MSG_COMBAT",), ("PLAYER_REGEN_DISABLED", "PLAYER_REGEN_ENABLED")),
    ("chat", ("CHAT_MSG_",), ()),
    ("target", ("NAME_PLATE_",), ("PLAYER_TARGET_CHANGED",)),
    ("zone", ("ZONE_",), ("PLAYER_ENTERING_WORLD", "NEW_WMO_CHUNK")),
    ("inventory", ("BAG_", "ITEM_"), ()),
    ("npc", (), (
        "MERCHANT_SHOW", "MERCHANT_CLOSED", "TRAINER_SHOW", "TRAINER_CLOSED", "MAIL_SHOW", "MAIL_CLOSED", "AUCTION_HOUSE_SHOW", "AUCTION_HOUSE_CLOSED",
        "BANKFRAME_OPENED", "BANKFRAME_CLOSED", "TAXIMAP_OPENED", "TAXIMAP_CLOSED", "GUILD_REGISTRAR_SHOW", "GUILD_REGISTRAR_CLOSED", "PET_STABLE_SHOW", "PET_STABLE_CLOSED",
        "BATTLEFIELDS_SHOW", "BATTLEFIELDS_CLOSED", "PETITION_SHOW", "PETITION_CLOSED", "GUILDBANKFRAME_OPENED", "GUILDBANKFRAME_CLOSED",
    )),
    ("init", (), ("ADDON_LOADED", "PLAYER_LOGIN", "PLAYER_LOGOUT", "PLAYER_LEAVING_WORLD", "SPELLS_CHANGED", "LOADING_SCREEN_DISABLED")),
)


def category_of(name: Column, rules: Sequence[tuple] = CATEGORIES, other: str = "other") -> Column:
    """The first category whose prefix or name fits."""
    out = None
    for category, prefixes, names in rules:
        fits = F.lit(False)
        for p in prefixes:
            fits = fits | name.startswith(p)
        if names:
            fits = fits | name.isin(*names)
        out = F.when(fits, category) if out is None else out.when(fits, category)
    return out.otherwise(other)


def has_all_terms(text: Column, query: str) -> Column:
    """Whether a text holds every white-space separated term, in any case."""
    out = F.lit(True)
    for term in query.split():
        out = out & F.contains(F.lower(text), F.lit(term.lower()))
    return out


def redacted(text: Column, names: Sequence[str], instead: str = "<name>") -> Column:
    """Names replaced as whole words, the longest first, a possessive ``s`` with them.

    Letters are A-Z and a-z; beside another letter a name counts wherever it stands.
    Escape sequences (``|c`` with eight hex digits, ``|r`` and the like) end a word.
    """
    escape = r"(\|c[0-9A-Fa-f]{8}|\|[rthna])"
    out = F.regexp_replace(text, escape, "$1\u0001")
    for name in sorted(names, key=lambda n: -len(n.encode())):
        pattern = "\\Q" + name + "\\E"
        if name[:1].isascii() and name[:1].isalpha():
            pattern = "(?<![A-Za-z])" + pattern
        if name[-1:].isascii() and name[-1:].isalpha():
            pattern += "s?(?![A-Za-z])"
        out = F.regexp_replace(out, pattern, instead.replace("$", "\\$"))
    return F.regexp_replace(out, "\u0001", "")


def clock_text(seconds: Column) -> Column:
    """``MM:SS.mmm``."""
    millis = F.floor(seconds * 1000 + 0.5).cast("long")
    return F.format_string("%02d:%02d.%03d", F.floor(millis / 60000), F.floor(millis / 1000) % 60, millis % 1000)


def positive_whole(v: Column) -> Column:
    """A recorded number (or its text) if it is whole and positive."""
    x = v.try_cast("double")
    return F.when((x > 0) & (x == F.floor(x)), x.cast("long"))


def client_version(stream: Column, envelope: Column) -> Column:
    """The version that a session's own stream tells, else that of its envelope."""
    return F.coalesce(stream, positive_whole(envelope))


def by_number(key: Column) -> list[Column]:
    """The order of texts of which numbers stand first, by value."""
    return [key.try_cast("double").asc_nulls_last(), key.asc()]


def version_is(version: Column, major: str) -> Column:
    """Whether a version starts with ``major``; unknown versions count in."""
    return version.isNull() | version.cast("string").startswith(major)
