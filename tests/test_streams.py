"""A stream in many small, shuffled files gives what the batch job gives."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frameline import scratch_dir
from frameline.fixtures import DERIVED, Tables
from frameline.operators import metrics
from frameline.streaming import events as E
from frameline.streaming import state as S
from frameline.streaming import windows as W
from frameline.streaming.combine import combined, frame_bitmaps
from frameline.streaming.run import event_time, run_to_table

FOLDER = "/root/testdata/sf0.001"
STAGE = "CASE event_id % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'process' ELSE 'recompose' END"


@pytest.fixture(scope="module")
def pieces(spark):
    """The event table in 5 files of random rows, and in 5 files in time order."""
    events = Tables(spark, FOLDER).raw("events")
    mixed, ordered = scratch_dir(spark, "mixed"), scratch_dir(spark, "ordered")
    events.repartition(5, F.md5(F.col("event_id").cast("string"))).write.parquet(mixed)
    for i, day in enumerate((0, 6, 12, 18, 24)):
        part = events.filter((F.dayofmonth("ts") > day) & (F.dayofmonth("ts") <= (day + 6 if day < 24 else 31)))
        part.coalesce(1).write.mode("append").parquet(ordered)
    return {"mixed": mixed, "ordered": ordered, "schema": events.schema}


def stream(spark, pieces, kind, name):
    raw = spark.readStream.schema(pieces["schema"]).option("maxFilesPerTrigger", "1").parquet(pieces[kind])
    return DERIVED[name].apply(raw)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("kind", ["mixed", "ordered"])
def test_dead_letters(spark, pieces, kind):
    got = run_to_table(spark, S.dead_letters(stream(spark, pieces, kind, "messages"), retention_days=60, delay="60 days"), "dead")
    assert rows(got) == rows(E.dead_letters_batch(Tables(spark, FOLDER)("messages")))


def steps(spark, path, *batches, shape):
    """A stream that gets each batch in a file of its own."""
    for rows in batches:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(shape).option("maxFilesPerTrigger", "1").parquet(path)


def day(n, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=hour)


def test_dead_letters_are_forgotten(spark):
    """Three receives, a long silence, three more: dead only where the message is remembered. Another one is dead at once."""
    shape = "message_id string, receive_id long, ts timestamp"
    batches = [[("a", i, day(0, i)) for i in range(3)] + [("b", i, day(0, i)) for i in range(6)], [("c", 1, day(20))], [("c", 2, day(21))], [("a", 9 + i, day(22, i)) for i in range(3)]]
    found = {}
    for days in (4, 60):
        receives = steps(spark, scratch_dir(spark, "receives"), *batches, shape=shape)
        found[days] = sorted(r.message_id for r in run_to_table(spark, S.dead_letters(receives, retention_days=days), "dead").collect())
    assert found == {4: ["b"], 60: ["a", "b"]}


def test_ended_jobs_are_forgotten(spark):
    """A job that ended and then fails anew after its life starts at revision 1 again."""
    shape = "job_id string, stage string, status string, ts timestamp"
    batches = [[("j", s, "COMPLETED", day(0, i)) for i, s in enumerate(S.STAGES)], [("k", "extract", "COMPLETED", day(50))], [("k", "extract", "COMPLETED", day(51))], [("j", "extract", "FAILED", day(52))]]
    got = {}
    for days in (10, 365):
        changes = steps(spark, scratch_dir(spark, "changes"), *batches, shape=shape)
        got[days] = sorted((r.job_id, r.state, r.revision) for r in run_to_table(spark, S.job_state_machine(changes, keep_days=days), "ends").collect())
    assert got == {10: [("j", "COMPLETED", 1), ("j", "extract_failed", 1)], 365: [("j", "COMPLETED", 1)]}


def test_progress_counts_each_frame_once_and_forgets(spark):
    shape = "job_id string, n long, ts timestamp"
    batches = [[("a", n, day(0)) for n in (1, 2, 2, 1)] + [("b", n, day(0)) for n in range(1, 20001)], [("a", 2, day(1)), ("a", None, day(1)), ("c", 1, day(1))], [("b", 7, day(1)), ("a", 3, day(2))],
               [("x", 1, day(40))], [("x", 1, day(41))], [("c", 2, day(42))]]
    totals = spark.createDataFrame([("a", 3), ("b", 20000), ("c", 2), ("x", 9)], "job_id string, total long")
    got = {}
    for days in (10, 365):
        frames = steps(spark, scratch_dir(spark, "frames"), *batches, shape=shape)
        got[days] = sorted((r.job_id, r.total) for r in run_to_table(spark, S.progress_stream(frames, totals, keep_days=days), "done").collect())
    assert got == {10: [("a", 3), ("b", 20000)], 365: [("a", 3), ("b", 20000), ("c", 2)]}


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    """Nine rows of ten have one key: no more than a few rows of it leave a task."""
    rows = spark.range(200_000, numPartitions=4).selectExpr("CASE WHEN id % 10 = 0 THEN 'm-' || id ELSE 'hot' END AS k", "1L AS n", "id AS seen")
    reduced = combined(rows, ["k"], {"n": "sum", "seen": "max"})
    hot = reduced.filter("k = 'hot'").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.max("seen").alias("seen")).first()
    assert hot.n == 180_000 and hot.seen == 199_999 and hot.rows <= 8
    assert reduced.agg(F.sum("n")).first()[0] == 200_000
    frames = spark.range(300_000, numPartitions=4).selectExpr("'hot' AS job_id", "id + 1 AS n", "300000L AS total", "id AS at")
    maps = frame_bitmaps(frames)
    assert maps.count() < 300 and sum(int.from_bytes(bytes(r.bits), "big").bit_count() for r in maps.collect()) == 300_000


def test_keys_share_a_call(spark):
    """Many jobs in few groups: each gives its own signal once, and one is forgotten while others of its group stay."""
    shape = "job_id string, n long, ts timestamp"
    many = [(f"j{i}", n, day(0)) for i in range(3000) for n in (1, 2)]
    batches = [many, [("x", 1, day(40)), ("j1", 3, day(40))], [("x", 1, day(41))], [(f"j{i}", 3, day(42)) for i in (0, 1, 2)]]
    totals = spark.createDataFrame([(f"j{i}", 2 if i > 2 else 3) for i in range(3000)] + [("x", 9)], "job_id string, total long")
    calls = spark.sparkContext.accumulator(0)
    rows = steps(spark, scratch_dir(spark, "shared"), *batches, shape=shape).selectExpr("job_id", "n", "unix_millis(ts) AS seen")

    def count(key, new, value):
        calls.add(1)
        before = value[0] if value else 0
        return (before + len(new),), [(key[0], before + len(new))]

    out = S._keyed(rows, "job_id", ["n"], count, "n bigint", "job_id string, n bigint", 10, "1 hour", groups=4)
    assert "pmod" in out._jdf.queryExecution().analyzed().toString()
    got = run_to_table(spark, out, "shared")
    assert got.count() == calls.value == 3000 + 2 + 1 + 3 and got.filter("job_id = 'j1' AND n = 3").count() == 1
    assert sorted((r.job_id, r.n) for r in got.filter("job_id IN ('j0', 'j1', 'j2', 'x')").collect()) == [("j0", 1), ("j0", 2), ("j1", 2), ("j1", 3), ("j1", 4), ("j2", 1), ("j2", 2), ("x", 1), ("x", 2)]
    frames = steps(spark, scratch_dir(spark, "frames"), *batches, shape=shape)
    done = run_to_table(spark, S.progress_stream(frames, totals, keep_days=10), "done")
    assert sorted(r.job_id for r in done.collect()) == sorted(["j1", *[f"j{i}" for i in range(3, 3000)]])


def test_bitmaps_span_record_batches(spark):
    """A task gives one bitmap for a job and block, also where Arrow batches are small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    try:
        rows = spark.range(2000, numPartitions=1).selectExpr("'j' || id % 3 AS job_id", "id % 50 AS n", "9L AS total", "id AS at")
        got = {r.job_id: (int.from_bytes(bytes(r.bits), "little").bit_count(), r["at"]) for r in frame_bitmaps(rows).collect()}
        assert frame_bitmaps(rows).count() == 3 and got == {"j0": (49, 1998), "j1": (49, 1999), "j2": (49, 1997)}
    finally:
        spark.conf.set(name, before)


def test_orphans_wait_for_late_jobs(spark):
    """A job that comes after its object, within the horizon, keeps it; the stream gives what the batch gives."""
    shape = "key string, size long, ts timestamp"
    objects = [[("known/a", 1, day(0)), ("late/a", 1, day(0)), ("late/b", 2, day(0, 2)), ("lost/a", 1, day(0))], [("lost/b", 1, day(1)), ("toolate/a", 1, day(0, 3))], [("end/a", 1, day(30))], [("end/b", 1, day(31))]]
    jobs = [[("other", day(0))], [("late", day(0, 20)), ("toolate", day(6))], [("end", day(30))], [("end2", day(31))]]
    found = steps(spark, scratch_dir(spark, "objects"), *objects, shape=shape)
    arriving = steps(spark, scratch_dir(spark, "arriving"), *jobs, shape="job_id string, ts timestamp")
    known = spark.createDataFrame([("known",)], "job_id string")
    got = sorted(r.key for r in run_to_table(spark, E.incremental_orphans(found, known, arriving, "2 days"), "orphans").collect())
    assert got == ["lost/a", "lost/b", "toolate/a"]
    rows_, come = [r for b in objects for r in b], [r for b in jobs for r in b]
    want = [k for k, _, t in rows_ if k.split("/")[0] != "known" and t < day(29) and not any(j == k.split("/")[0] and abs(at - t) <= timedelta(days=2) for j, at in come)]
    assert got == sorted(want)


@pytest.mark.parametrize("kind", ["mixed", "ordered"])
def test_state_machine_in_one_batch_and_many(spark, pieces, kind):
    changes = stream(spark, pieces, kind, "status_changes").withColumn("stage", F.expr(STAGE))
    got = run_to_table(spark, S.job_state_machine(changes, keep_days=60, delay="60 days"), "machine")
    want = S.job_states_batch(Tables(spark, FOLDER)("status_changes").withColumn("stage", F.expr(STAGE))).filter("state NOT LIKE '%waiting'")
    assert want.count() > 0 and rows(S.latest_verdicts(got)) == rows(want)


def test_closed_periods_equal_batch(spark, pieces):
    stats = run_to_table(spark, W.stream_stats(event_time(stream(spark, pieces, "mixed", "metrics")), "1 day", "Sum", ["name"], delay="40 days"), "late")
    assert stats.count() == 0  # every period is still open within the delay
    closed = run_to_table(spark, W.stream_stats(event_time(stream(spark, pieces, "ordered", "metrics")).filter("ts < '2024-01-02'"), "6 hours", "Sum", ["name"], delay="6 hours"), "closed")
    batch = metrics.metric_stats(event_time(Tables(spark, FOLDER)("metrics")), "6 hours", "Sum", ["name"])
    assert set(rows(closed)) <= set(rows(batch)) and closed.count() > 0


def test_dedupe_ids(spark, pieces):
    twice = event_time(stream(spark, pieces, "mixed", "messages")).union(event_time(stream(spark, pieces, "ordered", "messages")))
    got = run_to_table(spark, E.dedupe_messages(twice, horizon="60 days").select("message_id"), "ids")
    assert rows(got) == rows(Tables(spark, FOLDER)("messages").select("message_id").distinct())


def test_run_goes_on_where_it_stopped(spark, pieces):
    path = scratch_dir(spark, "resume")
    routes = {"q": F.lit(True)}
    first = run_to_table(spark, E.fan_out(stream(spark, pieces, "mixed", "messages"), routes), "resume", ["queue"], path).count()
    again = run_to_table(spark, E.fan_out(stream(spark, pieces, "mixed", "messages"), routes), "resume", ["queue"], path).count()
    assert first == again == Tables(spark, FOLDER)("messages").count()
    assert os.path.isdir(f"{path}/rows/queue=q")


def test_idle_sliding_stream_equals_batch_on_closed_spans(spark, pieces):
    got = run_to_table(spark, W.idle_sliding(event_time(stream(spark, pieces, "ordered", "metrics")), delay="8 days", percent=50.0), "idle")
    batch = W.idle_sliding(event_time(Tables(spark, FOLDER)("metrics")), percent=50.0)
    assert set(rows(got)) <= set(rows(batch)) and got.count() > 0
