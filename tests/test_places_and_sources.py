"""Clusters against brute force; decoding, the store's life, streams over several micro-batches."""

import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.functions import text
from tracelake.operators import spatial, temporal
from tracelake.sources import codec, submissions
from tracelake.sources.store import Store, update
from tracelake.streaming import changes


def brute_clusters(points, threshold):
    clusters = []
    mean = lambda c: (sum(p[0] for p in c) / len(c), sum(p[1] for p in c) / len(c))
    far = lambda a, b: ((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5
    for p in sorted(points):
        best = min(clusters, key=lambda c: far(mean(c), p), default=None)
        if best is not None and far(mean(best), p) <= threshold + 1e-9:
            best.append(p)
        else:
            clusters.append([p])
    again = True
    while again:
        again = False
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                if not again and far(mean(clusters[i]), mean(clusters[j])) <= threshold + 1e-9:
                    clusters[i] += clusters.pop(j)
                    again = True
                    break
            if again:
                break
    return sorted(sorted(c) for c in clusters)


def test_clusters_equal_brute_force():
    draw = random.Random(4)
    for _ in range(40):
        points = sorted({(round(draw.uniform(0, 4), 2), round(draw.uniform(0, 4), 2)) for _ in range(draw.randrange(1, 40))})
        own = spatial.labels(np.array(points), 0.5)
        assert sorted(sorted(p for p, k in zip(points, own, strict=True) if k == c) for c in set(own.tolist())) == brute_clusters(points, 0.5)


def test_spawns(spark):
    place = lambda rows, **o: sorted((r.zone, r.x, r.y) for r in spatial.spawns(spark.createDataFrame([(1, z, float(x), float(y), s) for s, (z, x, y) in enumerate(rows)], "e int, zone int, x double, y double, s int"), "e", "zone", "x", "y", "s", **o).collect())
    assert place([(1, 30, 30), (1, 30.1, 30.1), (1, 30.2, 30.2), (1, 30.4, 30.4)]) == [(1, 30.15, 30.15)]
    assert place([(1, 62.52, 19.74), (1, 62.57, 19.9), (1, 62.59, 19.75)]) == [(1, 62.57, 19.75)]
    assert place([(40, 10, 50), (40, 30, 60), (40, 30.2, 60), (12, 47.46, 62.18)], single=True) == [(12, 47.46, 62.18), (40, 30.1, 60.0)]
    assert place([(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 9, 1)], reducer="mean", least=1, compact=2.0) == [(1, 1.5, 1.0), (2, 1.0, 1.0), (2, 9.0, 1.0)]


@pytest.mark.parametrize("data,want", [("3863", -100), ("f9c400", -4.0), ("8301f603", {"1": 1, "3": 3}), ("82810181 02".replace(" ", ""), {"1": [1], "2": [2]}), ("a0", []), ("a2013102", None), ("a26130016131 02".replace(" ", ""), {"0": 1, "1": 2})])
def test_cbor(data, want):
    if want is None:
        with pytest.raises(ValueError):
            codec.cbor(bytes.fromhex(data))
    else:
        assert codec.cbor(bytes.fromhex(data)) == want


@pytest.mark.parametrize("data", ["c001", "9f01ff", "0101", "8201", "a1f601", "81" * 101 + "01", "f800"])
def test_cbor_errors(data):
    with pytest.raises(ValueError):
        codec.cbor(bytes.fromhex(data))


def to_cbor(value):
    if value is None:
        return b"\xf6"
    if isinstance(value, bool):
        return b"\xf5" if value else b"\xf4"
    if isinstance(value, int):
        return b"\x1a" + value.to_bytes(4, "big")
    if isinstance(value, float):
        return b"\xfb" + np.float64(value).byteswap().tobytes()
    head = lambda major, n: bytes([major << 5 | 26]) + n.to_bytes(4, "big")
    if isinstance(value, str):
        return head(3, len(value.encode())) + value.encode()
    if isinstance(value, list):
        return head(4, len(value)) + b"".join(map(to_cbor, value))
    return head(5, len(value)) + b"".join(to_cbor(k) + to_cbor(v) for k, v in value.items())


def export(value, n=1):
    z = zlib.compressobj(9, zlib.DEFLATED, -15)
    return f"!Trace:{n}!" + codec.to_print(z.compress(to_cbor(value)) + z.flush()) + f"!End:Trace:{n}!"


SESSION = {
    "startedAt": 100000.0, "startedAtPrecise": 5.5, "serverTime": 1000.0,
    "events": [{"t": 1.0, "tp": 1.001, "e": "QUEST_ACCEPTED", "a": {"n": 1, "1": 7}}, {"t": 2.0, "tp": 2.0, "e": "LOOT_READY"}],
    "functions": {"GetLocale": [{"t": 0.5, "tp": 0.5, "v": "enUS"}], "UnitName": {"target": [{"t": 1.0, "tp": 1.0, "v": "Ann"}, {"t": 2.0, "tp": 2.0}]}, "Deep": {"a": {"b": [{"t": 3.0, "tp": 3.0, "v": 4}]}}},
    "functionsDelta": {"Done": {"t": 0.0, "initial": [1, 2], "delta": [{"t": 5.0, "add": [3], "remove": [1]}]}},
}


def test_submissions(spark, tmp_path):
    folder = tmp_path / "submissions" / "2026-01"
    folder.mkdir(parents=True)
    wrapped = export({"sessions": [SESSION]})
    texts = {"a": wrapped[:40] + "\n " + wrapped[40:] + export({"sessions": [{"events": [], "functions": {}}, {"broken": 1}]}, 2), "b": wrapped[:-3], "c": "!Trace:1!abc!End:Trace:1!"}
    for name, body in texts.items():
        (folder / f"{name}.json").write_text(json.dumps({"id": name, "contributor_id": "p", "received_at": "x", "export_string": body}))
    (folder / "d.json").write_text("{no json")
    listed = submissions.listed(spark, f"file://{tmp_path}/submissions")
    fields = submissions.fields(listed)
    assert {r.submission: r.error for r in fields.collect()} == {"a": None, "b": None, "c": None, "d": "no JSON"}
    rows = submissions.decoded(fields, "Trace")
    assert sorted((r.submission, r.idx is None) for r in rows.collect()) == [("a", False), ("a", False), ("b", True), ("c", True)]
    key = submissions.sessions(rows).where("idx = 0").first().session_key
    import hashlib

    assert key == hashlib.sha256(b"100000|5.5").hexdigest()[:16]
    assert [(r.e, r.pos) for r in submissions.events(rows).where("idx = 0").orderBy("pos").collect()] == [("QUEST_ACCEPTED", 0), ("LOOT_READY", 1)]
    got = sorted((r.fn, r.params, r.pos, r.v) for r in submissions.samples(rows).where("idx = 0").collect() if r.v)
    assert got == [("Deep", ["a", "b"], 0, "4"), ("GetLocale", [], 0, "enUS"), ("UnitName", ["target"], 0, "Ann")]
    assert submissions.samples(rows).where("v is null").count() == 1
    assert sorted((r.t is None, r.op, r.id) for r in submissions.deltas(rows).collect()) == [(False, "add", 3), (False, "remove", 1), (True, "add", 1), (True, "add", 2)]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        submissions.listed(spark, f"file://{tmp_path}/empty")


def observe(rows):
    none = F.lit(None).cast("string")
    sessions = rows.select("submission", F.lit(0).alias("idx"), F.col("key").alias("session_key"), F.lit(False).alias("duplicate"), none.alias("contributor"), F.col("at").alias("session_time"), none.alias("error"))
    seen = rows.select("submission", F.lit(0).alias("idx"), F.lit("scalar").alias("kind"), F.lit(0).alias("pos"), F.lit("name").alias("field"), F.lit(0).alias("seq"), F.lit(1).cast("long").alias("entity"), none.alias("locale"), F.lit("high").alias("confidence"), F.lit(0.0).alias("t"), F.col("v").alias("value"), none.alias("token"), none.alias("extra"))
    return sessions, seen, rows.select("submission", none.alias("error"))


def summary(store):
    return sorted((r.value, r.n, r.timed_sessions) for r in store.scalar_summary().collect())


def test_store_life(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "k", 1.0, "old"), ("s2", "k", 2.0, "new"), ("s3", None, None, "new"), ("s4", None, 4.0, "x\"\\ ")], "submission string, key string, at double, v string")
    whole = Store(spark, f"file://{tmp_path}/whole", "v1")
    assert update(whole, rows, observe) == (4, 0)
    steps = Store(spark, f"file://{tmp_path}/steps", "v1")
    for k in (1, 2, 4):
        update(steps, rows.where(F.col("submission") <= f"s{k}"), observe)
    assert summary(whole) == summary(steps) == [("new", 2, 1), ("x\"\\ ", 1, 1)]
    assert update(steps, rows, observe) == (0, 0)
    assert update(steps, rows.where("submission <> 's2'"), observe) == (0, 1)
    assert ("old", 1, 1) in summary(steps)
    with pytest.raises(ValueError):
        update(steps, rows.limit(0), observe)
    assert Store(spark, f"file://{tmp_path}/steps", "v2").live("sessions").count() == 0
    steps.register_views()
    assert spark.sql("SELECT count(*) AS n FROM observations JOIN sessions USING (submission, idx)").first().n == 3


def test_stream_over_several_micro_batches(spark, tmp_path):
    rows = spark.createDataFrame([(k % 3, k, None if k % 7 == 0 else k // 9 % 2) for k in range(90)], "key int, t int, v int")
    for part in range(3):
        rows.where(F.floor(F.col("t") / 30) == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    files = sorted((p for p in (tmp_path / "in").glob("*.parquet")), key=lambda p: p.stat().st_mtime_ns)
    assert len(files) == 3
    stream = spark.readStream.schema("key int, t int, v int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    changes.drained(changes.changes(stream, "key", ["t"], "v"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    want = temporal.changes(rows, ["key"], "t", ["v"])
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ingest_hands_all_rows_on(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/in")
    seen = []
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    for _ in range(2):
        changes.ingest(stream, f"{tmp_path}/checkpoint", lambda df, _: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 10


def test_text_rules(spark):
    one = lambda column: spark.range(1).select(column.alias("x")).first().x
    assert [one(text.tiered(F.lit(v))) for v in (530, 910, 2450, 93, 103)] == [525, 900, 2450, 95, 100]
    assert one(text.half_up(F.lit(-2.5))) == -2 and one(text.percent(F.lit(0.12345))) == 12.35
    assert one(text.redacted(F.lit("Ann met Announce, Anns |cff00ff00Ann|r and Ann-Lee"), ["Ann", "Ann-Lee"])) == "<name> met Announce, <name> |cff00ff00<name>|r and <name>"
    assert one(text.redacted(F.lit("Пётр и Петр"), ["Пётр"])) == "<name> и Петр"
    assert one(text.parse_guid(F.lit("Creature-0-5208-0-7-823-000031"))) == ("npc", 823, "000031") and one(text.parse_guid(F.lit(""))) == ("unknown", None, None)
    assert [one(text.is_level_line(F.lit(x))) for x in ("Level 28", "Stufe ?? (Boss)", "等级 10（精英）", "SI:7 Operative")] == [True, True, True, False]
    assert one(text.cleaned(F.lit(" \r\n a \n"))) == "a" and one(text.cleaned(F.lit("\n"))) is None
    assert one(text.clock_text(F.lit(61.5))) == "01:01.500"


def test_streams_of_any_depth_from_one_pass(spark):
    import json

    from tracelake.sources import submissions

    deep = {"a": {"b": {"c": {"d": {"e": {"f": [{"t": 1, "tp": 2, "v": {"x": [1, None]}}]}}}}}, "One": [{"t": 1}, {"t": 2, "v": 5}], "None": {}, "odd": 3}
    rows = spark.createDataFrame([("s", 0, json.dumps({"functions": deep}), None), ("t", 0, json.dumps({"functions": []}), None), ("u", None, None, "broken")], "submission string, idx int, session string, error string")
    out = submissions.samples(rows)
    assert sorted((r.fn, r.params, r.pos, r.v) for r in out.collect()) == [("One", [], 0, None), ("One", [], 1, "5"), ("a", ["b", "c", "d", "e", "f"], 0, '{"x":[1,null]}')]
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1


def test_tasks_hand_on_text_in_pieces(spark, monkeypatch):
    import json

    import pyarrow as pa

    from tracelake.sources import submissions

    rows = iter([("s", "x" * 400, None)] * 10)
    monkeypatch.setattr(submissions, "PIECE", 1000)
    out = submissions.pieces(rows, pa.schema([("a", pa.string()), ("b", pa.string()), ("c", pa.int32())]))
    assert next(out).num_rows == 3 and len(list(rows)) == 7
    assert sum(x.num_rows for x in out) == 0
    # a row is read when the one before it is made
    seen = submissions.each(iter([pa.RecordBatch.from_pylist([{"a": 1, "b": "x"}, {"a": None, "b": "y"}])]))
    assert list(seen) == [(1, "x"), (None, "y")]
    session = json.dumps({"functions": {"f": {str(k): [{"t": k, "tp": k, "v": "x" * 50}] for k in range(200)}}})
    got = submissions.samples(spark.createDataFrame([("s", 0, session, None)] * 5, "submission string, idx int, session string, error string"))
    assert got.count() == 1000 and got.where("length(v) = 50").count() == 1000


def test_print_alphabet_of_all_bytes():
    import pytest

    data = bytes(range(256)) * 3
    assert codec.from_print(codec.to_print(data) + " \n") == data
    for wrong in ("ab!c", "abé", "ab一", "ab?d", "a"):
        with pytest.raises(ValueError):
            codec.from_print(wrong)
