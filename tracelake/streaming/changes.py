"""Stateful streams: change-only samples, windows with a watermark, incremental ingestion."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def changes(stream: DataFrame, by: str, order: Sequence[str], value: str) -> DataFrame:
    """Rows whose ``value`` differs from the one before of the same key, over all micro-batches.

    The state of a key is its last value, stored nil included. Rows of a key are put in
    ``order`` within a micro-batch; a micro-batch must not hold rows that precede those of
    an earlier one.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    whole = kinds[value] in ("tinyint", "smallint", "int", "bigint")

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(list(order), kind="stable")
        known, before = state.get if state.exists else (False, None)
        now = rows[value].astype(object).where(rows[value].notna(), None)
        last = now.shift(1)
        last.iloc[0] = before
        differs = ~((now == last) | (now.isna() & last.isna()))
        if not known:
            differs.iloc[0] = True
        end = now.iloc[-1]
        # pandas holds a nullable whole number as a float, which the state's type does not take
        state.update((True, end if end is None else int(end) if whole else getattr(end, "item", lambda: end)()))
        yield rows[differs.to_numpy()]

    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    return stream.groupBy(by).applyInPandasWithState(run, schema, f"known boolean, last {kinds[value]}", "append", GroupStateTimeout.NoTimeout)


def ordered_changes(stream: DataFrame, by: str, t: str, order: Sequence[str], value: str, late: str, keep: str | None = None) -> DataFrame:
    """The same for rows that come in any order: up to ``late`` behind the latest time seen.

    Rows wait in the state of their key until the watermark has passed their time ``t``, and
    are then compared in the order of (``t``, ``order``); rows that come behind the watermark
    are left out. With ``keep`` a row so long after the one before of its key counts as a
    change, so the state of a key goes once the watermark is so far beyond its last row.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    run = _in_order(list(kinds), [t, *order], value, None if keep is None else int(pd.Timedelta(keep).total_seconds() * 1000))
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    # times reach Python in the session's zone; the watermark is counted in UTC
    timed = stream.withWatermark(t, late).withColumn("_ms", F.unix_millis(t)).groupBy(by)
    return timed.applyInPandasWithState(run, schema, "known boolean, last binary, held binary, seen bigint", "append", GroupStateTimeout.EventTimeTimeout)


def _in_order(names: list[str], own_order: list[str], value: str, patience: int | None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What ``ordered_changes`` does with a key of a micro-batch. Rows wait as tuples: most keys have few, and a frame of few rows costs far more than they do."""
    at, places = names.index(value), [names.index(c) for c in own_order]
    missing = lambda x: x is None or x != x
    rank = lambda r: [(missing(r[p]), 0 if missing(r[p]) else r[p]) for p in places]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, last, raw, seen = state.get if state.exists else (False, None, None, 0)
        before = pickle.loads(last) if last else None
        passed = state.getCurrentWatermarkMs()
        waiting = pickle.loads(raw) if raw else []
        if not state.hasTimedOut:
            waiting += [r for f in frames for r in zip(*(f[c].tolist() for c in (*names, "_ms")), strict=True) if r[-1] >= passed]
        ready, waiting = sorted((r for r in waiting if r[-1] < passed), key=rank), [r for r in waiting if r[-1] >= passed]
        if ready:
            out = []
            for r in ready:
                now, ms = None if missing(r[at]) else r[at], int(r[-1])
                if not known or now != before or (patience is not None and ms - seen >= patience):
                    out.append(r[:-1])
                known, before, seen = True, now, ms
            yield pd.DataFrame(out, columns=names)
        if waiting:
            state.update((known, pickle.dumps(before), pickle.dumps(waiting), seen))
            state.setTimeoutTimestamp(max(min(int(r[-1]) for r in waiting), passed) + 1)
        elif not known or (patience is not None and passed >= seen + patience):
            if state.exists:
                state.remove()
        else:
            state.update((known, pickle.dumps(before), None, seen))
            if patience is not None:
                state.setTimeoutTimestamp(max(seen + patience, passed + 1))

    return run


def tumbling(stream: DataFrame, t: str, width: str, late: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts in windows of event time; rows later than ``late`` are left out."""
    return stream.withWatermark(t, late).groupBy(F.window(t, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def sessionized(stream: DataFrame, t: str, gap: str, late: str, by: Sequence[str]) -> DataFrame:
    """Runs of events of a key with no gap as long as ``gap``."""
    return stream.withWatermark(t, late).groupBy(F.session_window(t, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def ingest(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand all that is there now to ``each`` by micro-batches, once."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write all that is there now to a Parquet folder."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
