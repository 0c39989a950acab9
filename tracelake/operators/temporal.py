"""State at a time, from samples that are recorded on change only.

Every operator takes ``by`` (the key columns of a stream) and ``t`` (its clock);
``order`` breaks ties on the clock, the last one standing for the value. A sample
whose value is null is a value, not a missing sample: values travel in a struct. Keys
never mix, so work is dealt by key. ``bucket``, a function of the clock that never falls
(its day, say), deals a hot key further by parts of its time and carries what one part
leaves over to the next: one row for each part, not for each sample.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def clock(t: Column) -> Column:
    """Microseconds of a timestamp, with or without a time zone."""
    return F.unix_micros(t.cast("timestamp"))


Bucket = Callable[[Column], Column] | None


def _parts(rows: DataFrame, t: str, bucket: Bucket) -> DataFrame:
    return rows if bucket is None else rows.withColumn("_bucket", bucket(F.col(t)))


def _reached(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, bucket: Bucket, inclusive: bool = True, forward: bool = False) -> DataFrame:
    """``rows`` with the last non-null ``value`` up to each (``forward``: the first one from it on) as ``name``; its own counts if ``inclusive``.

    With a bucket rows have the column ``_bucket``, and both keep it.
    """
    pick = F.first if forward else F.last
    span = (0 if inclusive else 1, _LAST) if forward else (_FIRST, 0 if inclusive else -1)
    if bucket is None:
        return rows.withColumn(name, pick(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*span)))
    inside = rows.withColumn(name, pick(value, ignorenulls=True).over(Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(*span)))
    # one row for each part of a key's time: the value it leaves, and from those before (behind) it the value that enters
    end = (F.min_by if forward else F.max_by)(value, F.when(value.isNotNull(), F.struct(*order)))
    ends = rows.groupBy(*by, "_bucket").agg(end.alias("_end"))
    carry = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(*((1, _LAST) if forward else (_FIRST, -1)))
    ends = ends.withColumn("_enters", pick("_end", ignorenulls=True).over(carry)).drop("_end")
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (*by, "_bucket")]
    joined = inside.alias("i").join(ends.alias("e"), same, "left")
    return joined.select(*[F.col(f"i.{c}") for c in inside.columns if c != name], F.coalesce(f"i.{name}", "e._enters").alias(name))


def _placed(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str, bucket: Bucket) -> DataFrame:
    """``rows`` numbered from 1 within their key."""
    if bucket is None:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    inside = rows.withColumn("_in", F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)))
    counts = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*by).orderBy("_bucket").rowsBetween(_FIRST, -1)))
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "_bucket")]
    place = (F.col("i._in") + F.coalesce("c._before", F.lit(0))).cast("int")
    return inside.alias("i").join(counts.alias("c"), same, "left").select(*[F.col(f"i.{c}") for c in rows.columns], place.alias(name))


def _both(probes: DataFrame, samples: DataFrame, by: Sequence[str], t: str, value: Sequence[str], order: Sequence[str], strict: bool) -> DataFrame:
    """Samples and probes as rows of one shape; at equal times samples stand first, or last if ``strict``."""
    row = probes.schema
    own = samples.select(*by, F.col(t).alias("_t"), F.lit(int(strict)).alias("_side"), F.struct(*order).alias("_order"), F.struct(*value).alias("_v"))
    asked = probes.select(*by, F.col(t).alias("_t"), F.lit(int(not strict)).alias("_side"), F.struct(*probes.columns).cast(row).alias("_p"))
    return own.unionByName(asked, allowMissingColumns=True)


_CLOCK = ("_t", "_side", "_order")


def _answered(rows: DataFrame, value: Sequence[str], names: Sequence[str] | None) -> DataFrame:
    names = names or value
    return rows.select("_p.*", F.col("_hit").isNotNull().alias("matched"), *[F.col(f"_hit.{v}").alias(n) for v, n in zip(value, names, strict=True)])


def asof(probes: DataFrame, samples: DataFrame, by: Sequence[str], t: str, value: Sequence[str], order: Sequence[str] = (), strict: bool = False, names: Sequence[str] | None = None, bucket: Bucket = None) -> DataFrame:
    """``probes`` with ``matched`` and the values of the last sample at or before (``strict``: before) each probe's time."""
    rows = _parts(_both(probes, samples, by, t, value, order or [t], strict), "_t", bucket)
    return _answered(_reached(rows, by, _CLOCK, F.col("_v"), "_hit", bucket).where("_p is not null"), value, names)


def asof_many(probes: DataFrame, streams: Mapping[str, DataFrame], by: Sequence[str], t: str, order: Sequence[str] = (), strict: bool = False, bucket: Bucket = None) -> DataFrame:
    """``probes`` with a column for each of ``streams``: its columns besides ``by``, ``t`` and ``order``, as a struct, of the last sample at or before (``strict``: before) each probe's time; null where there is none.

    All streams are looked up in one union and one window: a row of a stream fills the column of
    its own stream alone. Each stream is read once, however many of them there are.
    """
    order = order or [t]
    values = {n: [c for c in df.columns if c not in (*by, t, *order)] or [t] for n, df in streams.items()}
    kinds = {n: df.select(F.struct(*values[n]).alias("v")).schema["v"].dataType for n, df in streams.items()}

    def row(df: DataFrame, side: int, key: Column, filled: str | None) -> DataFrame:
        held = [(F.struct(*values[n]) if n == filled else F.lit(None)).cast(kinds[n]).alias(f"_v_{n}") for n in streams]
        probe = (F.struct(*probes.columns) if filled is None else F.lit(None)).cast(probes.schema).alias("_p")
        return df.select(*by, F.col(t).alias("_t"), F.lit(side).alias("_side"), key.alias("_order"), *held, probe)

    none = F.lit(None).cast(next(iter(streams.values())).select(F.struct(*order).alias("o")).schema["o"].dataType)
    rows = row(probes, int(not strict), none, None)
    for n, df in streams.items():
        rows = rows.unionByName(row(df, int(strict), F.struct(*order), n))
    rows = _parts(rows, "_t", bucket)
    if bucket is None:
        span = Window.partitionBy(*by).orderBy(*_CLOCK).rowsBetween(_FIRST, 0)
        rows = rows.select("_p", *[F.last(f"_v_{n}", ignorenulls=True).over(span).alias(n) for n in streams])
    else:
        for n in streams:
            rows = _reached(rows, by, _CLOCK, F.col(f"_v_{n}"), n, bucket)
    return rows.where("_p is not null").select("_p.*", *streams)


def asof_index(probes: DataFrame, samples: DataFrame, by: Sequence[str], t: str, order: Sequence[str] = (), name: str = "active", bucket: Bucket = None) -> DataFrame:
    """``probes`` with the 0-based place, within its key's samples, of the active one; -1 before the first."""
    placed = _placed(_parts(samples, t, bucket), by, [t, *(order or [t])], "_place", bucket).withColumn("_place", F.col("_place") - 1)
    return asof(probes, placed, by, t, ["_place"], ["_place"], names=[name], bucket=bucket).withColumn(name, F.coalesce(name, F.lit(-1))).drop("matched")


def nearest(probes: DataFrame, samples: DataFrame, by: Sequence[str], t: str, value: Sequence[str], within: float | Column, order: Sequence[str] = (), names: Sequence[str] | None = None, distance: Callable[[Column, Column], Column] | None = None, bucket: Bucket = None) -> DataFrame:
    """``probes`` with the values of the nearest sample not further than ``within``; the earlier one of two as near.

    Of the samples before a probe the last one counts, of those at or after it the first.
    """
    distance = distance or (lambda a, b: F.abs(a - b))
    order = order or [t]
    rows = _parts(_both(probes, samples.withColumn("_at", F.col(t)), by, t, [*value, "_at"], order, True), "_t", bucket)
    rows = _reached(rows, by, _CLOCK, F.col("_v"), "_b", bucket)
    rows = _reached(rows, by, _CLOCK, F.col("_v"), "_f", bucket, forward=True).where("_p is not null")
    back, forth = distance(F.col("_b._at"), F.col("_t")), distance(F.col("_f._at"), F.col("_t"))
    limit = within if isinstance(within, Column) else F.lit(within)
    hit = F.when((back <= limit) & (forth.isNull() | (back <= forth)), F.col("_b")).when(forth <= limit, F.col("_f"))
    return _answered(rows.withColumn("_hit", hit), value, names)


def bounded_asof(events: DataFrame, samples: DataFrame, by: Sequence[str], t: str, tp: str, value: Sequence[str], order: Sequence[str] = (), bucket: Bucket = None) -> DataFrame:
    """``events`` with the values that held when each was handled, and ``ambiguous``.

    The sampler may run a little after the event in the same frame (equal ``t``), so a
    sample counts up to the next event's precise time in that frame. A sample at exactly
    that time could belong to either event: ambiguous, no value. Events that share both
    clocks have no lookup.
    """
    order = order or [tp]
    frame = Window.partitionBy(*by, t)
    e = events.withColumn("_next", F.lead(tp).over(frame.orderBy(tp))).withColumn("_twins", F.count(F.lit(1)).over(Window.partitionBy(*by, t, tp)))
    e = e.withColumn("_upto", F.when(F.col("_next").isNotNull(), F.col("_next")).otherwise(F.lit(float("inf"))))
    # as-of on (t, tp): the bound itself is excluded, a sample that stands on it is looked for apart
    bound = F.struct(F.col(t).alias("t"), F.col("_upto").alias("tp"))
    s = samples.withColumn("_clock", F.struct(F.col(t).alias("t"), F.col(tp).cast("double").alias("tp")))
    found = asof(e.withColumn("_clock", bound), s, by, "_clock", value, order, strict=True, bucket=bucket and (lambda c: bucket(c["t"])))
    on = samples.select(*by, F.col(t).alias("_t2"), F.col(tp).cast("double").alias("_tp2")).distinct()
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    tied = found.alias("f").join(on.alias("o"), [*same, F.col(f"f.{t}") == F.col("o._t2"), F.col("f._next") == F.col("o._tp2")], "left")
    alone, clash = F.col("_twins") == 1, F.col("o._tp2").isNotNull()
    kept = [F.col(f"f.{c}") for c in events.columns]
    return tied.select(*kept, (alone & clash).alias("ambiguous"), (alone & ~clash & F.col("f.matched")).alias("matched"), *[F.when(alone & ~clash, F.col(f"f.{v}")).alias(v) for v in value])


def windowed_join(left: DataFrame, right: DataFrame, by: Sequence[str], t: str, seconds: float) -> DataFrame:
    """Pairs of rows of a key whose clocks (timestamps) differ by at most ``seconds``; right columns get the prefix ``r_``.

    An equi-join on the key and a time bin of the window's width: each right row goes to
    its own bin and both neighbours, so no key's rows are all paired.
    """
    micros = int(seconds * 1_000_000)
    bin_of = lambda c: F.floor(clock(c) / F.lit(max(micros, 1)))
    a = left.withColumn("_bin", bin_of(F.col(t)))
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: bin_of(F.col(f"r_{t}")) + d)))
    near = F.abs(clock(F.col(t)) - clock(F.col(f"r_{t}"))) <= micros
    return a.join(b, [a["_bin"] == b["_bin"], *[F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in by], near]).drop("_bin")


def isolated(events: DataFrame, by: Sequence[str], t: str, seconds: float, order: Sequence[str] = (), bucket: Bucket = None) -> DataFrame:
    """Events of which no other of the same key lies strictly within ``seconds``."""
    micros, by_time = clock(F.col(t)), [t, *order]
    rows = _reached(_parts(events, t, bucket), by, by_time, micros, "_b", bucket, inclusive=False)
    rows = _reached(rows, by, by_time, micros, "_f", bucket, inclusive=False, forward=True)
    gap = F.least(micros - F.col("_b"), F.col("_f") - micros)
    return rows.withColumn("_gap", gap).where(F.col("_gap").isNull() | (F.col("_gap") >= int(seconds * 1_000_000))).select(*events.columns)


def unless_seen_before(events: DataFrame, by: Sequence[str], t: str, wanted: Column, suppressor: Column, order: Sequence[str] = (), bucket: Bucket = None) -> DataFrame:
    """Events that are ``wanted`` and whose key had no ``suppressor`` event before."""
    seen = _reached(_parts(events, t, bucket), by, [t, *order], F.when(suppressor, 1), "_seen", bucket, inclusive=False)
    return seen.where(wanted & F.col("_seen").isNull()).select(*events.columns)


def changes(samples: DataFrame, by: Sequence[str], t: str, value: Sequence[str], order: Sequence[str] = (), bucket: Bucket = None) -> DataFrame:
    """The samples whose value differs (null-safe) from the one before; the first of a key always."""
    now = F.struct(*value)
    rows = _reached(_parts(samples, t, bucket), by, [t, *order], now, "_before", bucket, inclusive=False)
    return rows.where(~F.col("_before").eqNullSafe(now)).select(*samples.columns)


def became_true(samples: DataFrame, by: Sequence[str], t: str, flag: Column, order: Sequence[str] = (), counts: Column | None = None, bucket: Bucket = None) -> DataFrame:
    """Samples at which ``flag`` is true and was not true at the last one before; ``counts``: which samples count at all."""
    rows = samples if counts is None else samples.where(counts)
    marked = _parts(rows.withColumn("_now", F.coalesce(flag, F.lit(False))), t, bucket)
    seen = _reached(marked, by, [t, *order], F.col("_now"), "_was", bucket, inclusive=False)
    return seen.where("_now and not coalesce(_was, false)").select(*rows.columns)


def carried(rows: DataFrame, by: Sequence[str], t: str, value: Column, name: str, order: Sequence[str] = (), inclusive: bool = True, bucket: Bucket = None) -> DataFrame:
    """``rows`` with the last non-null ``value`` up to each row (or, not ``inclusive``, before it)."""
    return _reached(_parts(rows, t, bucket), by, [t, *order], value, name, bucket, inclusive).select(*[c for c in rows.columns if c != name], name)


def gaps(beats: DataFrame, by: Sequence[str], t: str, seconds: float, first: int = 10, order: Sequence[str] = (), bucket: Bucket = None) -> DataFrame:
    """Heartbeats that are among the ``first`` of their key or come more than ``seconds`` after the one before (``gap``)."""
    micros = clock(F.col(t))
    rows = _reached(_parts(beats, t, bucket), by, [t, *order], micros, "_before", bucket, inclusive=False)
    rows = _placed(rows, by, [t, *order], "beat", bucket).withColumn("gap", F.coalesce((micros - F.col("_before")) / 1e6, F.lit(0.0)))
    return rows.where((F.col("beat") <= first) | (F.col("gap") > seconds)).select(*beats.columns, "gap", "beat")


def state_at(samples: DataFrame, by: Sequence[str], t: str, at: Column, value: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The active values of every key at one time: an aggregation, combined map-side."""
    last = F.max_by(F.struct(*value), F.struct(t, *order))
    return samples.where(F.col(t) <= at).groupBy(*by).agg(last.alias("_v")).select(*by, "_v.*")


def events_between(events: DataFrame, t: str, begin: Column, end: Column) -> DataFrame:
    """Events in [begin, end]."""
    return events.where(F.col(t).between(begin, end))


def same_frame_first(heads: DataFrame, samples: DataFrame, by: Sequence[str], t: str, tp: str, value: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``heads`` with the first sample of the same frame whose precise time lies from the head's up to the next head's."""
    # within a frame, a sample belongs to the last head at or before it
    tagged = heads.withColumn("_head", F.struct(*heads.columns))
    owned = asof(samples, tagged, [*by, t], tp, ["_head"], [tp]).where("matched")
    first = owned.groupBy("_head").agg(F.min_by(F.struct(*value), F.struct(tp, *order)).alias("_v"))
    return tagged.join(first, "_head", "left").select(*heads.columns, *[F.col(f"_v.{v}").alias(v) for v in value])


def first_match(left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[str], value: Sequence[str]) -> DataFrame:
    """Rows of ``left`` joined with the first row of ``right`` that has the same ``on`` columns (exact time, slot, ...)."""
    first = right.groupBy(*on).agg(F.min_by(F.struct(*value), F.struct(*order)).alias("_v"))
    return left.join(first, list(on)).select(*left.columns, "_v.*")


def resampled(samples: DataFrame, by: Sequence[str], t: str, value: Sequence[str], step: str, order: Sequence[str] = ()) -> DataFrame:
    """The active values on a grid of times ``step`` apart, from each key's first sample to its last."""
    ends = samples.groupBy(*by).agg(F.date_trunc("hour", F.min(t)).alias("_a"), F.max(t).alias("_z"))
    grid = ends.select(*by, F.explode(F.sequence("_a", "_z", F.expr(f"interval {step}"))).alias(t))
    return asof(grid, samples, by, t, value, order)


def cooled(rows: DataFrame, by: Sequence[str], t: str, gap: float | Column, order: Sequence[str], bucket: Bucket = None) -> DataFrame:
    """Rows that a throttle lets through: the first of each key, then always the first one at least ``gap`` after the last taken.

    Which rows are taken depends on the one taken before, so no window frame tells it.
    Every row has one successor, the first row ``gap`` after it (an as-of lookup with time
    reversed); the taken rows are the way from a key's first row along successors. Jumps
    double each round, so a key with n taken rows needs log2(n) rounds of joins by row,
    dealt evenly whatever the key. ``order`` makes rows of a key unique, with ``t``.
    """
    place = F.struct(F.col(t).alias("t"), *order)
    marked = rows.withColumn("_at", place)
    later = marked.select(*by, (-F.col(t).cast("double")).alias("_back"), F.col("_at").alias("_next"), F.struct(*[(-F.col(c)).alias(c) for c in order]).alias("_turn"))
    asked = marked.select(*by, "_at", (-(F.col(t).cast("double") + gap)).alias("_back"))
    jumps = asof(asked, later, by, "_back", ["_next"], ["_turn"], bucket=bucket).select(*by, "_at", "_next")
    jumps = written(jumps.where("_next is not null"))
    taken = written(marked.groupBy(*by).agg(F.min("_at").alias("_at")))
    parts, hop = [taken], lambda j, name: j.select(*by, F.col("_at").alias("_next"), F.col("_next").alias(name))
    same = lambda a, b: reduce(lambda x, c: x & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), by, F.lit(True))
    while True:
        every = reduce(DataFrame.unionByName, parts)
        found = every.alias("k").join(jumps.alias("j"), same("k", "j") & (F.col("k._at") == F.col("j._at"))).select(*[F.col(f"k.{c}") for c in by], F.col("j._next").alias("_at"))
        found = written(found)
        if not found.take(1):
            break
        parts.append(found)
        jumps = written(jumps.alias("a").join(hop(jumps, "_far").alias("b"), same("a", "b") & (F.col("a._next") == F.col("b._next"))).select(*[F.col(f"a.{c}") for c in by], F.col("a._at"), F.col("b._far").alias("_next")))
    every = reduce(DataFrame.unionByName, parts)
    return marked.alias("r").join(every.alias("k"), same("r", "k") & (F.col("r._at") == F.col("k._at")), "left_semi").drop("_at")
