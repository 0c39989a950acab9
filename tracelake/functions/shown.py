"""Values as people read them: previews, labels, durations, sizes. All but previews are built-in expressions."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import unpacked


def fixed(x: Column, places: int) -> Column:
    """A number that is not negative with ``places`` decimals, rounded by its exact binary value; a tie goes up."""
    # a double as a whole number of 2**-bits: the smaller it is, the more of its bits stand behind the point
    bits = F.when(x < 1, 62).when(x < 1024, 52).otherwise(42)
    scaled = (x.cast("double") * F.pow(F.lit(2.0), bits)).cast("long").cast("decimal(20,0)")
    half = F.pow(F.lit(2.0), bits).cast("long").cast("decimal(20,0)")
    n = F.call_function("div", scaled * 2 * 10**places + half, half * 2).cast("long")
    whole = F.call_function("div", n, F.lit(10**places))
    return F.concat(whole.cast("string"), F.lit("."), F.lpad((n % 10**places).cast("string"), places, "0"))


def duration(ms: Column) -> Column:
    """Milliseconds as ``5ms``, ``1.5s``, ``2m 03s`` or ``1h 02m``."""
    seconds = F.floor(ms / 1000 + 0.5)
    minutes = F.floor(seconds / 60 + 0.5)
    return (
        F.when(ms < 1000, F.concat(F.floor(ms + 0.5).cast("string"), F.lit("ms")))
        .when(ms < 60_000, F.concat(fixed(ms / 1000, 1), F.lit("s")))
        .when(seconds < 3600, F.format_string("%dm %02ds", F.floor(seconds / 60), seconds % 60))
        .otherwise(F.format_string("%dh %02dm", F.floor(minutes / 60), minutes % 60))
    )


def size(n_bytes: Column) -> Column:
    """Bytes as ``12 B``, ``1.5 MB`` or ``2.34 GB``."""
    return F.when(n_bytes < 1_000_000, F.concat(n_bytes.cast("string"), F.lit(" B"))).when(n_bytes < 1_000_000_000, F.concat(fixed(n_bytes / 1e6, 1), F.lit(" MB"))).otherwise(F.concat(fixed(n_bytes / 1e9, 2), F.lit(" GB")))


def _number(x: int | float) -> str:
    """The shortest text of a number: no point behind whole ones, powers of ten beyond 21 and below -6 places."""
    if isinstance(x, float) and (math.isnan(x) or math.isinf(x)):
        return "NaN" if math.isnan(x) else "Infinity" if x > 0 else "-Infinity"
    if x == 0:
        return "0"
    sign, digits, exponent = Decimal(repr(float(x))).normalize().as_tuple()
    place = len(digits) + exponent
    if -6 < place <= 21:
        return format(Decimal((sign, digits, exponent)), "f")
    text = "".join(map(str, digits))
    return f"{'-' * sign}{text[0]}{'.' + text[1:] if len(text) > 1 else ''}e{place - 1:+d}"


def _packed(v: object) -> list | None:
    """The places of a recorded tuple (an object with its length ``n``), None for anything else."""
    if not isinstance(v, dict) or isinstance(v.get("n"), bool) or not isinstance(v.get("n"), (int, float)):
        return None
    return [v.get(str(k)) for k in range(1, int(v["n"]) + 1)]


def _recorded(v: str | None) -> object:
    """A recorded value: JSON, or a text that stands for itself."""
    if v is None:
        return None
    try:
        return json.loads(v)
    except ValueError:
        return v


def _plain(v: object) -> str:
    if v is None or isinstance(v, bool):
        return {None: "nil", True: "true", False: "false"}[v]
    return f'"{v}"' if isinstance(v, str) else _number(v)


def _shown(v: object) -> str:
    places = v if isinstance(v, list) else _packed(v)
    if places is not None:
        return f"({', '.join(map(_shown, places))})"
    if not isinstance(v, dict):
        return _plain(v)
    # whole-number keys come first, in their order
    keys = sorted((k for k in v if k.isdigit() and str(int(k)) == k), key=int)
    entries = [f"{k}: {_shown(v[k])}" for k in [*keys, *(k for k in v if k not in keys)]]
    return f"{{ {', '.join(entries)} }}" if entries else "{}"


def _argument(v: object) -> str:
    if isinstance(v, str):
        return f'"{v[:57]}..."' if len(v) > 60 else f'"{v}"'
    if isinstance(v, list):
        return ",".join("" if x is None else x if isinstance(x, str) else _argument(x) for x in v)
    return "[object Object]" if isinstance(v, dict) else _plain(v)


def _by_value(f: Callable[[str | None], str]) -> Callable[[Column], Column]:
    # nested texts of unknown depth: no built-in expression recurses; batches of values go to Python
    return F.pandas_udf(lambda values: values.map(f, na_action=None), "string")


def preview(v: Column, most: int = 40) -> Column:
    """A recorded value on one line of at most ``most`` characters: ``nil``, quoted texts at any depth, tuples and lists ``(1, "a")``, objects ``{ id: 5 }``."""
    whole = _by_value(lambda x: _shown(_recorded(x)))(v)
    return F.when(F.length(whole) > most, F.concat(F.substring(whole, 1, most - 3), F.lit("..."))).otherwise(whole)


def arguments(args: Column) -> Column:
    """An event's recorded arguments in one line of at most 80 characters; texts of over 60 are cut."""

    def one(x: str | None) -> str:
        v = _recorded(x)
        places = _packed(v)
        whole = ", ".join(map(_argument, places)) if places is not None else json.dumps(v, separators=(",", ":"), ensure_ascii=False) if isinstance(v, (dict, list)) else ""
        return whole[:77] + "..." if len(whole) > 80 else whole

    return _by_value(one)(args)


def labelled(v: Column, names: Sequence[str]) -> Column:
    """A recorded tuple as a map from the names of its places; places without a name, or without a value, are left out."""
    parts = unpacked(v)
    entries = F.transform(F.arrays_zip(F.lit(list(names)).alias("k"), F.slice(parts, 1, len(names)).alias("v")), lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def same_value(a: Column, b: Column) -> Column:
    """Whether two recorded JSON values are equal, whatever the order of keys and spacing."""
    return F.parse_json(a).cast("string").eqNullSafe(F.parse_json(b).cast("string"))
