"""The store's commits, zone maps and slices."""

import pytest
from pyspark.sql import functions as F

from tracelake.sources import store as module
from tracelake.sources.store import Store, update


def batch(spark, names, value):
    rows = spark.createDataFrame([(n,) for n in names], "submission string")
    none = F.lit(None).cast("string")
    sessions = rows.select("submission", F.lit(0).alias("idx"), F.col("submission").alias("session_key"), F.lit(False).alias("duplicate"), none.alias("contributor"), F.lit(1.0).alias("session_time"), none.alias("error"))
    seen = rows.select("submission", F.lit(0).alias("idx"), F.lit("scalar").alias("kind"), F.lit(0).alias("pos"), F.lit("name").alias("field"), F.lit(0).alias("seq"), F.lit(1).cast("long").alias("entity"), none.alias("locale"), F.lit("high").alias("confidence"), F.lit(0.0).alias("t"), F.lit(value).alias("value"), none.alias("token"), none.alias("extra"))
    return sessions, seen, rows.select("submission", none.alias("error"))


def held(store):
    return sorted((r.submission, r.value) for r in store.observations().collect())


def test_of_two_writers_none_is_lost(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/store"
    one, two = Store(spark, path, "v1"), Store(spark, path, "v1")
    one.append(*batch(spark, ["a"], "x"))
    make, met = module.Commits.make, []

    def late(self, n, content):
        # another writer commits after this one has read the state and before it commits
        if not met:
            met.append(n)
            monkeypatch.setattr(module.Commits, "make", make)
            two.append(*batch(spark, ["b"], "y"))
            assert make(self, n, content) is False
            return False
        return make(self, n, content)

    monkeypatch.setattr(module.Commits, "make", late)
    one.append(*batch(spark, ["c"], "z"))
    assert met == [2] and held(one) == held(two) == [("a", "x"), ("b", "y"), ("c", "z")]
    assert one.state()[0] == 3


def test_a_run_that_breaks_off_leaves_the_state(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/store", "v1")
    store.append(*batch(spark, ["a"], "x"))

    def fails(self, n, content):
        raise RuntimeError("lost")

    monkeypatch.setattr(module.Commits, "make", fails)
    for change in (lambda: store.append(*batch(spark, ["a", "b"], "new")), lambda: store.forget(spark.createDataFrame([("a",)], "submission string"))):
        with pytest.raises(RuntimeError):
            change()
    monkeypatch.undo()
    assert held(store) == [("a", "x")] and store.state()[0] == 1
    store.append(*batch(spark, ["a"], "again"))
    assert held(store) == [("a", "again")]
    # the first batch is no longer pointed at, so it is not read
    assert len(store.state()[1]["batches"]) == 1


@pytest.fixture
def many_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_range_reads_only_its_files(spark, tmp_path, many_files):
    store = Store(spark, f"file://{tmp_path}/store", "v1")
    for k, names in enumerate([[f"a{n:03}" for n in range(200)], [f"b{n:03}" for n in range(200)]]):
        store.append(*batch(spark, names, str(k)))
    every = store._files(store.state()[1], "observations", ("", "~"))
    few = store.files("observations", ("b010", "b012"))
    assert len(every) >= 4 and 1 <= len(few) < len(every) / 2 and all("batch=" in f for f in few)
    got = store.live("observations", ("b010", "b012"))
    assert sorted(r.submission for r in got.collect()) == ["b010", "b011", "b012"]
    assert store.live("observations", ("c", "d")).count() == 0 and store.files("observations", ("c", "d")) == []


def test_slices_cover_everything_once(spark, tmp_path, many_files):
    store = Store(spark, f"file://{tmp_path}/store", "v1")
    assert store.slices(10) == [] and list(store.replay(10)) == []
    for k in range(3):
        store.append(*batch(spark, [f"{n:03}" for n in range(k, 300, 3)], str(k)))
    update(store, spark.createDataFrame([(f"{n:03}",) for n in range(200)], "submission string"), lambda todo: batch(spark, [r.submission for r in todo.collect()], "new"))
    for rows in (1, 100, 10_000):
        slices = store.slices(rows)
        assert all(a[1] < b[0] for a, b in zip(slices, slices[1:], strict=False))
        assert sorted((r.submission, r.value) for part in store.replay(rows) for r in part.collect()) == held(store)
    assert len(held(store)) == 200


def test_what_a_run_observes_is_looked_up_once(spark, tmp_path):
    store, read = Store(spark, f"file://{tmp_path}/store", "v1"), []
    looked = spark.sparkContext.accumulator(0)

    def rows(batches):
        for frame in batches:
            looked.add(len(frame))
            yield frame

    def observe(todo):
        read.extend(todo.inputFiles())
        looked.value = 0
        return batch(spark, sorted(r.submission for r in todo.select("submission").collect()), "x")

    listed = spark.createDataFrame([(n,) for n in "abc"], "submission string").mapInPandas(rows, "submission string")
    assert update(store, listed, observe) == (3, 0)
    # neither the observing nor the commit went back to the source, and nothing of it is left
    assert looked.value == 0 and read and not any((tmp_path / "store/listed").iterdir())
    assert held(store) == [(n, "x") for n in "abc"]
