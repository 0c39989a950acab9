"""Change-only streams whose rows come in any order."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracelake.operators import temporal
from tracelake.streaming import changes

SCHEMA = "key string, t timestamp, n int, v int"


def feed(spark, path, batches):
    """Each batch a file; ``t`` in seconds."""
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "key string, s long, n int, v int").select("key", F.timestamp_seconds("s").alias("t"), "n", "v")
        df.coalesce(1).write.parquet(f"{path}/in/batch={k}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")


def drain(spark, stream, path, late, keep=None):
    out = changes.ordered_changes(stream, "key", "t", ["n"], "v", late, keep)
    query = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.schema(SCHEMA).parquet(f"{path}/out").select("key", F.unix_seconds("t").alias("s"), "n", "v").collect()
    return sorted((tuple(r) for r in got), key=str), query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_any_order_gives_the_batch_result(spark, tmp_path, zone):
    r = random.Random(3)
    rows = [(r.choice("abc"), r.randrange(2000), k, None if r.random() < 0.1 else r.randrange(3)) for k in range(300)]
    stream = feed(spark, tmp_path, [rows[:100], rows[100:130], rows[130:], [("end", 100_000, 0, 0)]])
    got, _ = drain(spark, stream, tmp_path, "1 hour")
    batch = spark.createDataFrame(rows, "key string, s long, n int, v int")
    want = [tuple(x) for x in temporal.changes(batch, ["key"], "s", ["v"], ["n"]).select("key", "s", "n", "v").collect()]
    assert got == sorted(want, key=str)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    stream = feed(spark, tmp_path, [[("a", 100, 0, 1), ("a", 1000, 1, 2)], [("a", 2000, 2, 2)], [("a", 150, 3, 9), ("a", 1990, 4, 7)], [("end", 100_000, 0, 0)]])
    got, _ = drain(spark, stream, tmp_path, "30 seconds")
    assert got == [("a", 100, 0, 1), ("a", 1000, 1, 2), ("a", 1990, 4, 7), ("a", 2000, 2, 2)]


def test_keys_are_forgotten(spark, tmp_path):
    batches = [[(f"k{k}", 100, k, 1) for k in range(50)], [("k1", 500, 100, 1)], [("x", 5000, 101, 1)], [("k1", 9000, 102, 1), ("k2", 9000, 103, 1)], [("end", 9200, 0, 0)]]
    for name, keep in (("kept", None), ("gone", "1000 seconds")):
        (tmp_path / name).mkdir()
        got, held = drain(spark, feed(spark, tmp_path / name, batches), tmp_path / name, "10 seconds", keep)
        again = {("k1", 9000, 102, 1), ("k2", 9000, 103, 1)} & set(got)
        assert (len(again), held >= 50) == ((0, True) if keep is None else (2, False))


def test_rows_wait_in_few_bytes():
    class State:
        exists, hasTimedOut, get = False, False, None

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, value):
            self.exists, self.get = True, value

        def setTimeoutTimestamp(self, ms):
            self.due = ms

    def frame(ms):
        return pd.DataFrame({"key": "a", "n": [1], "v": [7], "t": pd.to_datetime([ms], unit="ms"), "_ms": [ms]})

    state, run = State(), changes._in_order(["key", "n", "v", "t"], ["t", "n"], "v", None)
    for ms in (50, 10, 30):
        assert list(run(("a",), iter([frame(ms)]), state)) == []
    # a frame of these rows takes some 900 bytes
    assert state.due == 11 and len(state.get[2]) < 600
