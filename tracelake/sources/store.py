"""Observations in an incremental Parquet store.

A batch is a Parquet folder of observations and one of sessions, ranged by submission, and
a zone map: the least and greatest submission of each of its files. The state of the
store is a numbered commit: a small file that names a manifest (submission, batch, error)
and the range of every batch that the manifest points at. A commit is made by renaming a
finished file to the next number, which fails if another writer was there first; that
writer's state is then read and the change made anew. So a run that breaks off leaves
nothing visible, of two writers none is lost, and a reader sees one state without putting
it together. Manifests of another observer version don't count. All paths are Spark
paths; the file system's rename must not overwrite.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merges, relations

_MANIFEST = "submission string, batch long, error string"
_SESSIONS = "submission string, idx int, session_key string, duplicate boolean, contributor string, session_time double, error string"
_OBSERVATIONS = "submission string, idx int, kind string, pos int, field string, seq int, entity long, locale string, confidence string, t double, value string, token string, extra string"
_ZONES = "file string, low string, high string, n long"

Range = tuple[str, str] | None


class Commits:
    """Numbered files in a folder, each made once."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._jvm, self._dir = jvm, jvm.org.apache.hadoop.fs.Path(path)
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._dir.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._none = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        self._none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._dir, name)

    def last(self) -> tuple[int, dict | None]:
        """The greatest number and what its file says; (0, None) before the first."""
        if not self._fs.exists(self._dir):
            return 0, None
        n = max((int(f.getPath().getName()) for f in self._fs.listStatus(self._dir) if f.getPath().getName().isdigit()), default=0)
        if not n:
            return 0, None
        # lines of it come through Spark's own file systems
        stream = self._fs.open(self._path(str(n)))
        try:
            return n, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def make(self, n: int, content: dict) -> bool:
        """Make number ``n``; False if another writer did."""
        self._fs.mkdirs(self._dir)
        made = self._path(f".{uuid.uuid4().hex}")
        out = self._fs.create(made, False)
        out.write(json.dumps(content).encode())
        out.close()
        try:
            self._context.rename(made, self._path(str(n)), self._none)
            return True
        except Py4JJavaError as e:
            self._fs.delete(made, False)
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False

    def remove(self, path: str) -> None:
        """Delete a folder that no commit names."""
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)


class Store:
    def __init__(self, spark: SparkSession, path: str, version: str):
        self.spark, self.path, self.version = spark, path.rstrip("/"), version
        self.commits = Commits(spark, f"{self.path}/commits")

    def state(self) -> tuple[int, dict]:
        """The last commit: its number, manifest folder and the range of each batch."""
        n, said = self.commits.last()
        if said is None or said["version"] != self.version:
            said = {"version": self.version, "manifest": None, "batches": {}}
        return n, said

    def manifest(self, state: dict | None = None) -> DataFrame:
        """submission, batch, error of every stored submission."""
        state = state or self.state()[1]
        if state["manifest"] is None:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(state["manifest"])

    def _commit(self, change: DataFrame, batch: int | None, span: Range = None) -> None:
        """Make ``change`` (submission, error) the newest word on its submissions: in ``batch``, or gone."""
        while True:
            n, state = self.state()
            kept = self.manifest(state).join(change.select("submission").distinct(), "submission", "left_anti")
            if batch is not None:
                kept = kept.unionByName(change.select("submission", F.lit(batch).alias("batch"), F.col("error").cast("string").alias("error")))
            path = f"{self.path}/manifests/{n + 1}-{uuid.uuid4().hex}"
            kept.write.parquet(path)
            written = self.spark.read.schema(_MANIFEST).parquet(path)
            batches = state["batches"] | ({} if batch is None else {str(batch): list(span or ("", ""))})
            # batches that no submission points at are no longer read
            live = {str(r.batch) for r in written.select("batch").distinct().collect()}
            if self.commits.make(n + 1, {"version": self.version, "manifest": path, "batches": {b: s for b, s in batches.items() if b in live}}):
                return

    def pending(self, listed: DataFrame) -> DataFrame:
        """(submission, change): what is listed and not stored without error, and what is stored and no longer listed. An empty listing raises."""
        if not listed.take(1):
            raise ValueError("the source lists nothing; the store stays as it is")
        manifest = self.manifest()
        return relations.key_diff(listed, manifest.where("error is null"), "submission").unionByName(
            manifest.where("error is not null").join(listed, "submission", "left_anti").select("submission", F.lit("gone").alias("change")))

    def append(self, sessions: DataFrame, observations: DataFrame, submissions: DataFrame) -> int:
        """Store a batch: its observations, sessions and zone map first, then ``submissions(submission, error)`` in a commit."""
        batch = time.time_ns()
        write = lambda df, name, keys: df.repartitionByRange("submission").sortWithinPartitions(*keys).write.option("compression", "zstd").parquet(self._folder(name, batch))
        write(observations, "observations", ["submission", "idx", "kind", "pos", "seq"])
        write(sessions, "sessions", ["submission", "idx"])
        span = ("", "")
        for name, schema in (("observations", _OBSERVATIONS), ("sessions", _SESSIONS)):
            files = self.spark.read.schema(schema).parquet(self._folder(name, batch)).groupBy(F.input_file_name().alias("file"))
            files.agg(F.min("submission").alias("low"), F.max("submission").alias("high"), F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(self._folder(f"zones-{name}", batch))
            low, high = self.spark.read.schema(_ZONES).parquet(self._folder(f"zones-{name}", batch)).agg(F.min("low"), F.max("high")).first()
            if low is not None:
                span = (min(span[0] or low, low), max(span[1], high))
        self._commit(submissions, batch, span)
        return batch

    def _folder(self, name: str, batch: int | str) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def forget(self, keys: DataFrame) -> DataFrame:
        """Remove submissions; returns those that hold another copy of one of their sessions and must be observed again."""
        keys = keys.select("submission").distinct()
        gone = self.live("sessions").join(keys, "submission", "left_semi")
        again = relations.holders(self.live("sessions").join(keys, "submission", "left_anti").where("duplicate"), gone.where("session_key is not null"), "session_key", "submission")
        # written before the removal takes effect
        path = f"{self.path}/again/{uuid.uuid4().hex}"
        again.write.parquet(path)
        self._commit(keys.withColumn("error", F.lit(None)), None)
        return self.spark.read.schema("submission string").parquet(path)

    def files(self, name: str, between: Range = None) -> list[str]:
        """Files of a table that can hold submissions of a range: batches by their range in the commit, files by the zone map."""
        _, state = self.state()
        return self._files(state, name, between)

    def _files(self, state: dict, name: str, between: Range) -> list[str]:
        batches = [b for b, (low, high) in state["batches"].items() if between is None or (low <= between[1] and high >= between[0])]
        if between is None or not batches:
            return [self._folder(name, b) for b in batches]
        zones = self.spark.read.schema(_ZONES).parquet(*[self._folder(f"zones-{name}", b) for b in batches])
        return [r.file for r in zones.where((F.col("low") <= between[1]) & (F.col("high") >= between[0])).select("file").collect()]

    def live(self, name: str, between: Range = None) -> DataFrame:
        """Rows of a table that belong to the newest batch of their submission; of a range of submissions only its files are read."""
        _, state = self.state()
        schema, paths = _SESSIONS if name == "sessions" else _OBSERVATIONS, self._files(state, name, between)
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, batch long")
        rows = self.spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.path}/{name}").parquet(*paths)
        manifest = self.manifest(state).select("submission", "batch")
        if between is not None:
            rows, manifest = (df.where(F.col("submission").between(*between)) for df in (rows, manifest))
        return rows.join(manifest, ["submission", "batch"], "left_semi")

    def slices(self, rows: int) -> list[tuple[str, str]]:
        """Ranges of submissions that follow one another, each of whole files with about ``rows`` observations: what a replay takes at a time."""
        _, state = self.state()
        batches = list(state["batches"])
        if not batches:
            return []
        zones = self.spark.read.schema(_ZONES).parquet(*[self._folder("zones-sessions", b) for b in batches]).unionByName(self.spark.read.schema(_ZONES).parquet(*[self._folder("zones-observations", b) for b in batches]))
        out: list[list] = []
        # one row a file; files of several batches overlap, and those that share a submission stay together
        for low, high, n in zones.select("low", "high", "n").orderBy("low", "high").collect():
            if out and (low <= out[-1][1] or out[-1][2] < rows):
                out[-1] = [out[-1][0], max(high, out[-1][1]), out[-1][2] + n]
            else:
                out.append([low, high, n])
        return [(low, high) for low, high, _ in out]

    def replay(self, rows: int = 5_000_000) -> Iterator[DataFrame]:
        """Observations of the newest copies of sessions, newest submissions first, a slice at a time: no slice reads another's files."""
        for between in reversed(self.slices(rows)):
            yield self.observations(between=between)

    def winners(self) -> DataFrame:
        """The newest copy of each session; sessions without a key all count."""
        return relations.newest_copies(self.live("sessions").where("not duplicate"), "session_key", [F.desc("submission"), F.asc("idx")])

    def observations(self, kinds: tuple[str, ...] = ("scalar", "custom", "lookup"), between: Range = None) -> DataFrame:
        own = self.winners().select("submission", "idx", "batch", F.coalesce("session_key", F.concat_ws("#", "submission", F.col("idx").cast("string"))).alias("session"), "session_time", "contributor")
        return self.live("observations", between).where(F.col("kind").isin(*kinds)).join(own, ["submission", "idx", "batch"])

    def scalar_summary(self) -> DataFrame:
        rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
        # the newest submission comes first: its bytes turned round order it so in any row by itself
        place = F.concat(F.translate(F.hex("submission"), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
        rows = self.observations(("scalar", "lookup")).withColumn("place", place)
        return merges.scalar_summary(rows, ["kind", "field", "locale", "entity"], "value", t="t", session="session", session_time="session_time", seen=["place", "idx", "seq"], confidence=rank)

    def register_views(self) -> None:
        self.winners().createOrReplaceTempView("sessions")
        self.observations().createOrReplaceTempView("observations")


def update(store: Store, listed: DataFrame, observe: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]) -> tuple[int, int]:
    """One incremental run: forget what vanished, observe what is new or lost its other copy; (new, gone)."""
    change = store.pending(listed.select("submission")).cache()
    gone, new = change.where("change = 'gone'").select("submission"), change.where("change = 'new'").select("submission")
    n_gone = gone.count()
    again = store.forget(gone) if n_gone else new.limit(0)
    todo = new.unionByName(again).distinct()
    n_new = todo.count()
    if n_new:
        # written once: sessions, observations, the samples of their ranges and the commit each read it
        path = f"{store.path}/listed/{uuid.uuid4().hex}"
        rows = listed.join(todo, "submission", "left_semi")
        rows.write.parquet(path)
        store.append(*observe(store.spark.read.schema(rows.schema).parquet(path)))
        store.commits.remove(path)
    change.unpersist()
    return n_new, n_gone
