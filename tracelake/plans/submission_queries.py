"""Submissions made from the sessions of ``trace_sessions``, decoded again.

A user's submission holds one export of the session; of some users it is cut off, has no
export in it, or is no JSON at all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import submissions
from ..sources.codec import to_export
from ..sources.scratch import written
from .query import Family
from .trace_sessions import SQL, stored

QUERIES = Family()
_MARKER = "Trace"


def _assembled(read) -> DataFrame:
    """submission, raw (the file's text)."""
    events, samples = stored(read)
    e = events.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("pos", "t", "tp", "e", "args"))).alias("events"))
    s = samples.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("pos", F.array_join(F.concat(F.array("fn"), "params"), "/").alias("path"), "t", "tp", "v"))).alias("samples"))

    def values(column: pa.Array, k: int) -> Iterator[tuple]:
        return zip(*(f.to_pylist() for f in column[k].values.flatten()), strict=True)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k, sid in enumerate(batch.column("sid").to_pylist()):
                functions: dict = {}
                for _, path, t, tp, v in values(batch.column("samples"), k):
                    *names, last = path.split("/")
                    at = functions
                    for p in names:
                        at = at.setdefault(p, {})
                    at.setdefault(last, []).append({"t": t, "tp": tp, "v": v})
                own = [{"t": t, "tp": tp, "e": e, "a": json.loads(args or "{}")} for _, t, tp, e, args in values(batch.column("events"), k)]
                session = {"startedAt": 1.5, "startedAtPrecise": float(int(sid[1:])), "serverTime": 7, "events": own, "functions": functions}
                text = "pasted " + to_export({"sessions": [session, {"events": 3}]}, _MARKER) + " twice?"
                user = int(sid[1:]) % 7
                text = text[: len(text) // 2] if user == 3 else "nothing here" if user == 4 else text
                yield sid, "{" if user == 5 else json.dumps({"id": sid, "contributor_id": "c", "received_at": "2024-01-01", "export_string": text})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return submissions.pieces(rows(batches), pa.schema([("submission", pa.string()), ("raw", pa.string())]))

    return e.join(s, "sid").select("sid", "events", "samples").mapInArrow(run, "submission string, raw string")


def _decoded(read) -> DataFrame:
    return submissions.decoded(submissions.fields(_assembled(read)), _MARKER)


@QUERIES(f"""WITH {SQL} SELECT sid AS submission, row_number() OVER (PARTITION BY sid ORDER BY pos) - 1 AS pos, t, tp, e, args->>'$."1"' AS first FROM ev WHERE CAST(substr(sid, 2) AS BIGINT) % 7 NOT IN (3, 4, 5)""")
def submission_events(read):
    out = submissions.events(_decoded(read))
    return out.select("submission", F.col("pos").cast("long").alias("pos"), "t", "tp", "e", F.get_json_object("args", "$.1").alias("first"))


@QUERIES(f"""WITH {SQL}, p AS (SELECT *, concat_ws('/', fn, nullif(p1, ''), nullif(p2, '')) AS path FROM sm WHERE CAST(substr(sid, 2) AS BIGINT) % 7 NOT IN (3, 4, 5))
SELECT sid AS submission, path, row_number() OVER (PARTITION BY sid, path ORDER BY pos) - 1 AS pos, t, tp, v FROM p""")
def submission_samples(read):
    out = submissions.samples(_decoded(read))
    return out.select("submission", F.array_join(F.concat(F.array("fn"), "params"), "/").alias("path"), F.col("pos").cast("long").alias("pos"), "t", "tp", "v")


@QUERIES(f"""WITH {SQL}, u AS (SELECT DISTINCT sid, CAST(substr(sid, 2) AS BIGINT) AS u FROM ev WHERE sid IN (SELECT sid FROM sm))
SELECT sid AS submission, CASE WHEN u % 7 NOT IN (3, 4, 5) THEN substr(sha256('1.5|' || u), 1, 16) END AS session_key, CASE u % 7 WHEN 3 THEN 'an export is cut off' WHEN 4 THEN 'no export in the text' WHEN 5 THEN 'no JSON' END AS error FROM u""")
def submission_sessions(read):
    """Sessions by key, and why other submissions have none."""
    # both are read by several branches
    fields = written(submissions.fields(_assembled(read)))
    decoded = written(submissions.decoded(fields, _MARKER))
    none = F.lit(None).cast("string")
    out = submissions.sessions(decoded).select("submission", "session_key", none.alias("error"))
    return out.unionByName(decoded.where("error is not null").select("submission", none.alias("session_key"), "error")).unionByName(fields.where("error is not null").select("submission", none.alias("session_key"), "error"))
