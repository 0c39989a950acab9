"""Temporal lookups over ``events``: a user is a session, an event type a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets, temporal
from .query import Family

QUERIES = Family()
#: A small value stands for a stored nil.
_SQL_NIL = "CASE WHEN value >= 5 THEN value END"


def _day(t):
    """Parts of a hot user's time."""
    return F.date_trunc("day", t)


def _views(read):
    return read("events").where("event_type = 'view'").select("user_id", "ts", "event_id", F.expr("case when value >= 5 then value end").alias("v"))


def _purchases(read):
    return read("events").where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("probe_id"))


_ASOF = f"""
WITH s AS (SELECT user_id, ts, event_id, {_SQL_NIL} AS v FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, ts, event_id AS probe_id FROM events WHERE event_type = 'purchase')
SELECT p.user_id, p.ts, probe_id, s.event_id IS NOT NULL AS matched, s.v AS v, s.event_id AS sample_id
FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts {{op}} s.ts"""


@QUERIES(_ASOF.format(op=">="))
def asof_backward(read):
    """Dealt by user and day: a user with a third of all events is no hot group."""
    return temporal.asof(_purchases(read), _views(read), ["user_id"], "ts", ["v", "event_id"], ["event_id"], names=["v", "sample_id"], bucket=_day)


_TIED = """
WITH s AS (SELECT user_id, date_trunc('hour', ts) AS ts, event_id, value FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, date_trunc('hour', ts) AS ts, event_id AS probe_id FROM events WHERE event_type = 'purchase'),
m AS (SELECT probe_id, p.user_id, p.ts, arg_max(s.event_id, row(s.ts, s.event_id)) AS sample_id, arg_max(s.value, row(s.ts, s.event_id)) AS v
      FROM p LEFT JOIN s ON p.user_id = s.user_id AND s.ts < p.ts GROUP BY ALL)
SELECT user_id, ts, probe_id, sample_id IS NOT NULL AS matched, v, sample_id FROM m"""


@QUERIES(_TIED)
def asof_strict(read):
    """The last view of an earlier hour: times tie, and equal ones don't count."""
    hour = F.date_trunc("hour", "ts")
    samples = read("events").where("event_type = 'view'").select("user_id", hour.alias("ts"), "event_id", F.col("value").alias("v"))
    return temporal.asof(_purchases(read).withColumn("ts", hour), samples, ["user_id"], "ts", ["v", "event_id"], ["event_id"], strict=True, names=["v", "sample_id"], bucket=_day)


@QUERIES("""
WITH p AS (SELECT user_id, ts, event_id AS probe_id FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place FROM events WHERE event_type = 'view')
SELECT p.user_id, p.ts, probe_id, CAST(coalesce(s.place, -1) AS INT) AS active FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts >= s.ts""")
def asof_index(read):
    return temporal.asof_index(_purchases(read), _views(read), ["user_id"], "ts", ["event_id"], bucket=_day)


@QUERIES(f"""
WITH s AS (SELECT user_id, ts, event_id, {_SQL_NIL} AS v FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, ts, event_id AS probe_id FROM events WHERE event_type = 'purchase'),
b AS (SELECT p.*, s.event_id AS b_id, s.v AS b_v, epoch_us(p.ts) - epoch_us(s.ts) AS b_d FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts > s.ts),
f AS (SELECT p.probe_id, s.event_id AS f_id, s.v AS f_v, epoch_us(s.ts) - epoch_us(p.ts) AS f_d FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts <= s.ts),
j AS (SELECT b.*, f_id, f_v, f_d, b_d <= 7200000000 AND (f_d IS NULL OR b_d <= f_d) AS back, f_d <= 7200000000 AS forth FROM b JOIN f USING (probe_id))
SELECT user_id, ts, probe_id, coalesce(back, false) OR coalesce(forth, false) AS matched,
       CASE WHEN back THEN b_v WHEN forth THEN f_v END AS v, CASE WHEN back THEN b_id WHEN forth THEN f_id END AS sample_id FROM j""")
def nearest_in_window(read):
    apart = lambda a, b: F.abs(temporal.clock(a) - temporal.clock(b))
    return temporal.nearest(_purchases(read), _views(read), ["user_id"], "ts", ["v", "event_id"], 7_200_000_000, ["event_id"], ["v", "sample_id"], apart, _day)


@QUERIES("""
WITH e AS (SELECT user_id, event_id, epoch(date_trunc('hour', ts)) AS t, epoch(ts) AS tp, event_type, value FROM events),
p AS (SELECT *, lead(tp) OVER (PARTITION BY user_id, t ORDER BY tp) AS nxt, count(*) OVER (PARTITION BY user_id, t, tp) AS twins FROM e WHERE event_type = 'click'),
s AS (SELECT user_id, t, tp + 900 AS tp, event_id, value FROM e WHERE event_type = 'view' UNION ALL SELECT user_id, t, tp, event_id, value FROM e WHERE event_type = 'click' AND value > 20),
m AS (SELECT p.user_id, p.event_id, p.t, p.tp, p.twins, bool_or(s.t = p.t AND s.tp = p.nxt) AS clash,
             arg_max(s.value, row(s.t, s.tp, s.event_id)) FILTER (WHERE s.t < p.t OR (s.t = p.t AND s.tp < coalesce(p.nxt, 1e300))) AS v
      FROM p LEFT JOIN s ON s.user_id = p.user_id AND s.t <= p.t GROUP BY ALL)
SELECT user_id, event_id, t, tp, twins = 1 AND coalesce(clash, false) AS ambiguous,
       twins = 1 AND NOT coalesce(clash, false) AND v IS NOT NULL AS matched,
       CASE WHEN twins = 1 AND NOT coalesce(clash, false) THEN v END AS v FROM m""")
def bounded_asof(read):
    """Clicks are events; views are sampled a quarter of an hour late, large clicks at the click itself (ambiguous for the click before)."""
    e = read("events").select("user_id", "event_id", (temporal.clock(F.date_trunc("hour", "ts")) / 1e6).alias("t"), (temporal.clock(F.col("ts")) / 1e6).alias("tp"), "event_type", "value")
    own = e.where("event_type = 'view'").withColumn("tp", F.col("tp") + 900).unionByName(e.where("event_type = 'click' and value > 20"))
    samples = own.select("user_id", "t", "tp", "event_id", F.col("value").alias("v"))
    return temporal.bounded_asof(e.where("event_type = 'click'").select("user_id", "event_id", "t", "tp"), samples, ["user_id"], "t", "tp", ["v"], ["event_id"], lambda t: F.floor(t / 86400))


@QUERIES("""
SELECT p.event_id, p.user_id, p.ts, c.event_id AS r_event_id, c.ts AS r_ts FROM events p JOIN events c
ON c.user_id = p.user_id AND abs(epoch_us(c.ts) - epoch_us(p.ts)) <= 1800000000 WHERE p.event_type = 'purchase' AND c.event_type = 'click'""")
def windowed_event_join(read):
    cut = lambda kind: read("events").where(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    return temporal.windowed_join(cut("purchase"), cut("click"), ["user_id"], "ts", 1800).drop("r_user_id")


@QUERIES("""
WITH g AS (SELECT event_id, user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS a, lead(epoch_us(ts)) OVER w - epoch_us(ts) AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts FROM g WHERE coalesce(least(a, b), 3600000000) >= 3600000000""")
def isolated_events(read):
    return temporal.isolated(read("events").select("event_id", "user_id", "ts"), ["user_id"], "ts", 3600, ["event_id"], _day)


@QUERIES("""
SELECT event_id, user_id, ts FROM events e WHERE event_type = 'purchase'
AND NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'error' AND (s.ts < e.ts OR (s.ts = e.ts AND s.event_id < e.event_id)))""")
def prior_event_suppression(read):
    out = temporal.unless_seen_before(read("events"), ["user_id"], "ts", F.col("event_type") == "purchase", F.col("event_type") == "error", ["event_id"], _day)
    return out.select("event_id", "user_id", "ts")


@QUERIES("""
WITH g AS (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts, event_type FROM g WHERE n = 1 OR b IS DISTINCT FROM event_type""")
def change_only(read):
    return temporal.changes(read("events").select("event_id", "user_id", "ts", "event_type"), ["user_id"], "ts", ["event_type"], ["event_id"], _day)


@QUERIES("""
WITH g AS (SELECT *, value > 30 AS now, lag(value > 30) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events WHERE event_type <> 'view')
SELECT event_id, user_id, ts, value FROM g WHERE now AND NOT coalesce(was, false)""")
def false_true_transition(read):
    out = temporal.became_true(read("events"), ["user_id"], "ts", F.col("value") > 30, ["event_id"], F.col("event_type") != "view", _day)
    return out.select("event_id", "user_id", "ts", "value")


@QUERIES("""
SELECT event_id, user_id, ts, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS header,
       last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_error
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def carry_forward(read):
    e = read("events").select("event_id", "user_id", "ts", "event_type", "value")
    out = temporal.carried(e, ["user_id"], "ts", F.when(F.col("event_type") == "signup", F.col("event_id")), "header", ["event_id"], bucket=_day)
    out = temporal.carried(out, ["user_id"], "ts", F.when(F.col("event_type") == "error", F.col("value")), "last_error", ["event_id"], inclusive=False, bucket=_day)
    return out.select("event_id", "user_id", "ts", "header", "last_error")


@QUERIES("""
WITH g AS (SELECT event_id, user_id, ts, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6, 0.0) AS gap, row_number() OVER w AS beat FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts, CAST(gap AS DOUBLE) AS gap, CAST(beat AS INT) AS beat FROM g WHERE beat <= 10 OR gap > 21600""")
def gap_detect(read):
    return temporal.gaps(read("events").select("event_id", "user_id", "ts"), ["user_id"], "ts", 21600, 10, ["event_id"], _day)


@QUERIES("""
SELECT user_id, event_type, arg_max(event_id, row(ts, event_id)) AS event_id, arg_max(value, row(ts, event_id)) AS value
FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id, event_type""")
def state_at_time(read):
    return temporal.state_at(read("events"), ["user_id", "event_type"], "ts", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"), ["event_id", "value"], ["event_id"])


@QUERIES("""
SELECT user_id, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'view') AS view, max(value) FILTER (WHERE event_type = 'purchase') AS purchase
FROM (SELECT user_id, event_type, arg_max(value, row(ts, event_id)) AS value FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id, event_type) GROUP BY user_id""")
def state_at_pivot(read):
    """The identity panel: the active values of several streams as one row."""
    return state_at_time(read).groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.max("value"))


@QUERIES("SELECT event_id, user_id, ts, event_type FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 06:30:00'")
def event_range(read):
    e = read("events").select("event_id", "user_id", "ts", "event_type")
    return temporal.events_between(e, "ts", F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12 06:30:00").cast("timestamp_ntz"))


@QUERIES("""
WITH e AS (SELECT user_id, date_trunc('day', ts) AS frame, ts, event_id, event_type, value FROM events),
h AS (SELECT *, lead(ts) OVER (PARTITION BY user_id, frame ORDER BY ts) AS nxt FROM e WHERE event_type = 'purchase')
SELECT h.user_id, h.frame, h.ts, h.event_id, arg_min(s.event_id, row(s.ts, s.event_id)) AS sample_id, arg_min(s.value, row(s.ts, s.event_id)) AS v
FROM h LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') s ON s.user_id = h.user_id AND s.frame = h.frame AND s.ts >= h.ts AND (h.nxt IS NULL OR s.ts < h.nxt) GROUP BY ALL""")
def same_frame_join(read):
    e = read("events").withColumn("frame", F.date_trunc("day", "ts"))
    heads = e.where("event_type = 'purchase'").select("user_id", "frame", "ts", "event_id")
    views = e.where("event_type = 'view'").select("user_id", "frame", "ts", F.col("event_id").alias("sample_id"), F.col("value").alias("v"))
    return temporal.same_frame_first(heads, views, ["user_id"], "frame", "ts", ["sample_id", "v"], ["sample_id"])


@QUERIES("""
WITH e AS (SELECT user_id, date_trunc('hour', ts) AS t, event_id, event_type, value FROM events)
SELECT l.user_id, l.t, l.event_id, arg_min(r.event_id, r.event_id) AS r_id, arg_min(r.value, r.event_id) AS v FROM e l JOIN e r ON l.user_id = r.user_id AND l.t = r.t
WHERE l.event_type = 'click' AND r.event_type = 'view' GROUP BY ALL""")
def exact_time_join(read):
    e = read("events").withColumn("t", F.date_trunc("hour", "ts"))
    left = e.where("event_type = 'click'").select("user_id", "t", "event_id")
    right = e.where("event_type = 'view'").select("user_id", "t", F.col("event_id").alias("r_id"), F.col("value").alias("v"))
    return temporal.first_match(left, right, ["user_id", "t"], ["r_id"], ["r_id", "v"])


def _deltas(read):
    """Clicks put their ``k`` into the user's set, errors take it out."""
    k = F.get_json_object("props", "$.k").cast("long")
    return read("events").where("event_type in ('click', 'error')").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "click", "add").otherwise("remove").alias("op"), k.alias("id"))


_DELTAS = "d AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'click' THEN 'add' ELSE 'remove' END AS op, CAST(props->>'k' AS BIGINT) AS id FROM events WHERE event_type IN ('click', 'error'))"


@QUERIES(f"""
WITH {_DELTAS}, l AS (SELECT user_id, id, arg_max(op, row(ts, event_id)) AS op FROM d WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY user_id, id)
SELECT user_id, list_sort(coalesce(list(id) FILTER (WHERE op = 'add'), [])) AS ids FROM l GROUP BY user_id""")
def delta_set_at(read):
    return sets.sets_at(_deltas(read), ["user_id"], "ts", "op", "id", F.lit("2024-01-20").cast("timestamp_ntz"), ["event_id"])


@QUERIES("""
WITH s AS (SELECT user_id, date_trunc('day', ts) AS day, list_sort(list(DISTINCT CAST(props->>'k' AS BIGINT) % 20)) AS ids FROM events GROUP BY ALL),
b AS (SELECT *, coalesce(lag(ids) OVER (PARTITION BY user_id ORDER BY day), []) AS was FROM s),
c AS (SELECT user_id, day, list_sort(list_filter(ids, lambda x: NOT list_contains(was, x))) AS added, list_sort(list_filter(was, lambda x: NOT list_contains(ids, x))) AS removed FROM b)
SELECT * FROM c WHERE len(added) > 0 OR len(removed) > 0""")
def set_diff_delta(read):
    k = F.get_json_object("props", "$.k").cast("long") % 20
    daily = read("events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.array_sort(F.collect_set(k)).alias("ids"))
    return sets.set_changes(daily, ["user_id"], "day", "ids")


@QUERIES(f"""
WITH {_DELTAS}, x AS (SELECT user_id, id, CASE WHEN ts > TIMESTAMP '2024-01-05' THEN ts END AS ts, event_id, op FROM d),
i AS (SELECT user_id, count(*) FILTER (WHERE ts IS NULL) AS initial, count(DISTINCT ts) AS changes FROM x GROUP BY user_id),
c AS (SELECT user_id, count(*) FILTER (WHERE op = 'add') AS current FROM (SELECT user_id, id, arg_max(op, row(ts IS NOT NULL, coalesce(ts, TIMESTAMP '1970-01-01'), event_id)) AS op FROM x GROUP BY user_id, id) GROUP BY user_id)
SELECT user_id, initial, changes, current FROM i JOIN c USING (user_id)""")
def set_cardinality(read):
    d = _deltas(read).withColumn("ts", F.when(F.col("ts") > F.lit("2024-01-05").cast("timestamp_ntz"), F.col("ts")))
    return sets.cardinality(d, ["user_id"], "ts", "op", "id", ["event_id"])


@QUERIES("""
WITH g AS (SELECT user_id, unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 12 HOURS)) AS ts FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT g.user_id, g.ts, s.event_id IS NOT NULL AS matched, s.value FROM g ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') s ON g.user_id = s.user_id AND g.ts >= s.ts""")
def grid_replay(read):
    return temporal.resampled(read("events").where("event_type = 'view'"), ["user_id"], "ts", ["value"], "12 hours", ["event_id"])


@QUERIES("""
WITH p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'click' AND value >= 5), m AS (SELECT user_id, ts, props->>'k' AS zone FROM events WHERE event_type = 'signup')
SELECT p.user_id, p.ts, p.event_id, p.value, m.zone IS NOT NULL AS matched, m.zone FROM p ASOF LEFT JOIN m ON p.user_id = m.user_id AND p.ts >= m.ts""")
def trajectory_tagging(read):
    e = read("events")
    points = e.where("event_type = 'click' and value >= 5").select("user_id", "ts", "event_id", "value")
    maps = e.where("event_type = 'signup'").select("user_id", "ts", F.get_json_object("props", "$.k").alias("zone"))
    return temporal.asof(points, maps, ["user_id"], "ts", ["zone"])


@QUERIES("""
WITH e AS (SELECT user_id, ts, event_id, value, CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END AS level FROM events)
SELECT user_id, min(greatest(value, coalesce(last_level, value))) AS required FROM (
  SELECT user_id, value, level, last_value(CASE WHEN level = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_level FROM e)
WHERE level = 1 GROUP BY user_id""")
def min_required(read):
    """At each other event the greater of its value and the last announced one; the least of a user."""
    out = temporal.carried(read("events"), ["user_id"], "ts", F.when(F.col("event_type") == "signup", F.col("value")), "_last", ["event_id"], inclusive=False, bucket=_day)
    return out.where("event_type <> 'signup'").groupBy("user_id").agg(F.min(F.greatest("value", F.coalesce("_last", "value"))).alias("required"))


@QUERIES("""
SELECT arg_min(event_id, row(abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 00:00:00')), event_id)) AS event_id, user_id FROM events GROUP BY user_id""")
def nearest_event_row(read):
    away = F.abs(temporal.clock(F.col("ts")) - temporal.clock(F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
    return read("events").groupBy("user_id").agg(F.min_by("event_id", F.struct(away, F.col("event_id"))).alias("event_id"))


@QUERIES("""
WITH RECURSIVE e AS (SELECT user_id, event_id, CAST(epoch_us(ts) AS BIGINT) AS t FROM events),
c AS (SELECT user_id, min(row(t, event_id)) AS k FROM e GROUP BY user_id
  UNION ALL SELECT c.user_id, min(row(e.t, e.event_id)) FROM c JOIN e ON e.user_id = c.user_id AND e.t >= struct_extract_at(c.k, 1) + 21600000000 GROUP BY c.user_id)
SELECT user_id, struct_extract_at(k, 2) AS event_id FROM c""")
def cooldown(read):
    """Events of a user that a throttle of six hours lets through."""
    rows = read("events").select("user_id", "event_id", temporal.clock(F.col("ts")).alias("t"))
    return temporal.cooled(rows, ["user_id"], "t", 21_600_000_000.0, ["event_id"]).select("user_id", "event_id")
