"""Submission files to sessions, events, samples and set deltas."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sampled, session_key
from .codec import exports


#: Characters of text that a task makes before it hands them on.
PIECE = 4 << 20


def pieces(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``PIECE`` characters (one row may be larger): what a task holds doesn't grow with its rows."""
    made, size = [], 0
    for row in rows:
        made.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if size >= PIECE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)
            made, size = [], 0
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The values of one row at a time; those of a batch are never all Python objects at once."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def listed(spark: SparkSession, path: str, percent: float | None = None) -> DataFrame:
    """(submission, raw) of the JSON files under a folder; ``percent``: of a key-stable sample. An empty folder raises."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("wholetext", "true").text(path)
    rows = rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("submission"), F.col("value").alias("raw"))
    if not rows.take(1):
        raise FileNotFoundError(f"no submissions in {path}")
    return rows if percent is None else rows.where(sampled(F.col("submission"), percent))


def fields(rows: DataFrame) -> DataFrame:
    """submission, contributor, received_at, export, error of each file; the error never quotes the file."""
    parsed = F.from_json("raw", "id STRING, contributor_id STRING, received_at STRING, export_string STRING, _broken STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = rows.withColumn("_p", parsed)
    error = F.when(F.col("_p").isNull() | F.col("_p._broken").isNotNull(), "no JSON").when(F.col("_p.export_string").isNull(), "no export")
    return rows.select("submission", F.col("_p.contributor_id").alias("contributor"), F.col("_p.received_at").alias("received_at"), F.col("_p.export_string").alias("export"), error.alias("error"))


def decoded(submissions: DataFrame, marker: str) -> DataFrame:
    """(submission, idx, session JSON, error) of every valid session, and a row with an error for every export that was dropped."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for submission, text in each(batches):
            found, dropped = exports(text or "", marker)
            valid = (s for t in found if isinstance(t, dict) for s in t.get("sessions") or () if isinstance(s, dict) and isinstance(s.get("events"), list) and isinstance(s.get("functions"), (dict, list)))
            for i, s in enumerate(valid):
                yield submission, i, json.dumps(s), None
            for why in dropped:
                yield submission, None, None, why

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pieces(rows(batches), pa.schema([("submission", pa.string()), ("idx", pa.int32()), ("session", pa.string()), ("error", pa.string())]))

    return submissions.where("export is not null").select("submission", "export").mapInArrow(run, "submission string, idx int, session string, error string")


def _key(session: Column) -> list[Column]:
    field = lambda n: F.get_json_object(session, f"$.{n}").try_cast("double")
    return [session_key(field("startedAt"), field("startedAtPrecise")).alias("session_key"), field("serverTime").alias("session_time")]


def sessions(decoded_rows: DataFrame) -> DataFrame:
    """submission, idx, session_key, session_time of each session."""
    return decoded_rows.where("session is not null").select("submission", "idx", *_key(F.col("session")))


def events(decoded_rows: DataFrame) -> DataFrame:
    """submission, idx, pos, t, tp, e, args (JSON) of every event."""
    parsed = F.from_json(F.get_json_object("session", "$.events"), "array<struct<t: double, tp: double, e: string, a: string>>")
    return decoded_rows.where("session is not null").select("submission", "idx", F.posexplode(parsed).alias("pos", "_e")).select("submission", "idx", "pos", "_e.t", "_e.tp", "_e.e", F.col("_e.a").alias("args"))


def _leaves(functions: object) -> Iterator[tuple[str, list[str], list]]:
    """(function, parameters, samples) of every stream, whatever the number of its parameters."""
    todo = [([name], rest) for name, rest in functions.items()] if isinstance(functions, dict) else []
    while todo:
        path, rest = todo.pop()
        if isinstance(rest, list):
            yield path[0], path[1:], rest
        elif isinstance(rest, dict):
            todo += [([*path, name], deeper) for name, deeper in rest.items()]


def samples(decoded_rows: DataFrame) -> DataFrame:
    """submission, idx, fn, params, pos, t, tp, v (JSON; null is a stored nil) of every sample.

    Parameters nest to any depth: each session is walked once. Streams of a session are rows
    before its samples are, so a long session is split there.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            for submission, idx, session in zip(frame["submission"], frame["idx"], frame["session"], strict=True):
                for fn, params, found in _leaves(json.loads(session).get("functions")):
                    yield submission, idx, fn, params, json.dumps(found)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape = pa.schema([("submission", pa.string()), ("idx", pa.int32()), ("fn", pa.string()), ("params", pa.list_(pa.string())), ("_rest", pa.string())])
        return (piece.to_pandas() for piece in pieces(rows(frames), shape))

    streams = decoded_rows.where("session is not null").select("submission", "idx", "session").mapInPandas(walk, "submission string, idx int, fn string, params array<string>, _rest string")
    parsed = F.from_json("_rest", "array<struct<t: double, tp: double, v: string>>")
    return streams.select("submission", "idx", "fn", "params", F.posexplode(parsed).alias("pos", "_s")).select("submission", "idx", "fn", "params", "pos", "_s.t", "_s.tp", "_s.v")


def deltas(decoded_rows: DataFrame) -> DataFrame:
    """submission, idx, stream, pos, t, op, id of every set change; the first set stands at position -1 without a time."""
    kind = "map<string, struct<initial: array<long>, delta: array<struct<t: double, add: array<long>, remove: array<long>>>>>"
    streams = decoded_rows.where("session is not null").select("submission", "idx", F.explode(F.from_json(F.get_json_object("session", "$.functionsDelta"), kind)).alias("stream", "_d"))
    first = streams.select("submission", "idx", "stream", F.lit(-1).alias("pos"), F.lit(None).cast("double").alias("t"), F.lit("add").alias("op"), F.explode("_d.initial").alias("id"))
    steps = streams.select("submission", "idx", "stream", F.posexplode("_d.delta").alias("pos", "_s"))
    change = lambda op: steps.select("submission", "idx", "stream", "pos", "_s.t", F.lit(op).alias("op"), F.explode(f"_s.{op}").alias("id"))
    return first.unionByName(change("add")).unionByName(change("remove"))


def dimension(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Named columns of a CSV table with quoted values and a header, cast to the given types."""
    rows = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true").csv(path)
    return rows.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in columns.items()])
