"""Edge cases of the control-data jobs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frameline.functions import names, sizing
from frameline.operators import audit, frames, infer, inventory, jobs, metrics, resources

NOW = datetime(2024, 1, 31)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def objects(spark, *keys):
    return spark.createDataFrame([(k, 10, NOW) for k in keys], "key string, size long, last_modified timestamp_ntz")


def job(spark, *rows):
    return spark.createDataFrame(rows, "job_id string, status string, updated_at timestamp_ntz, endpoints string")


def test_expired_job_loses_both_objects(spark):
    done = job(spark, ("j1", "COMPLETED", NOW - timedelta(days=10), ""), ("j2", "COMPLETED", NOW - timedelta(days=7), ""))
    got = inventory.expired_objects(objects(spark, "j1/a", "j1/b", "j2/a"), done, now(), 7)
    assert sorted(r.key for r in got.collect()) == ["j1/a", "j1/b"]


def test_only_unknown_job_is_orphan(spark):
    got = inventory.orphan_objects(objects(spark, "known/a", "lost/a"), job(spark, ("known", "COMPLETED", NOW, "")))
    assert [r.key for r in got.collect()] == ["lost/a"]


def test_cleanup_reports_zero(spark):
    done = job(spark, ("j1", "COMPLETED", NOW - timedelta(days=10), ""))
    assert [tuple(r) for r in inventory.cleanup_summary(done, objects(spark, "x/a"), now(), 7).collect()] == [("j1", "success", 0)]


def test_1500_objects_make_calls_of_1000_and_500(spark):
    found = inventory.with_job(objects(spark, *[f"j/{i}.png" for i in range(1500)]))
    got = inventory.delete_calls(found).groupBy("call").count().orderBy("call").collect()
    assert [tuple(r) for r in got] == [(0, 1000), (1, 500)]


def test_compressible(spark):
    both = objects(spark, "a.png", "b.png.gz")
    assert [r.key for r in inventory.compressible(both).collect()] == ["a.png"]
    assert inventory.compressible(both, enabled=False).count() == 0


@pytest.mark.parametrize("age,action", [(0, "NONE"), (3, "IA"), (14, "GLACIER"), (15, "EXPIRE")])
def test_lifecycle_of_frames(spark, age, action):
    one = objects(spark, "job-1/frames/f.png").withColumn("last_modified", now() - F.make_dt_interval(F.lit(age)))
    assert inventory.lifecycle_action(one, now()).first().action == action


STORES = [("source", "", "IA", 30), ("source", "", "DEEP_ARCHIVE", 180), ("source", "", "ABORT", 1), ("work", "", "EXPIRE", 30), ("work", "frames/", "IA", 3), ("work", "frames/old/", "EXPIRE", 10), ("work", "temp/", "EXPIRE", 1)]


@pytest.mark.parametrize("bucket,key,age,incomplete,action,expires", [
    ("source", "a.mp4", 29, False, "NONE", None), ("source", "a.mp4", 30, False, "IA", None), ("source", "a.mp4", 999, False, "DEEP_ARCHIVE", None),
    ("source", "a.mp4", 999, True, "ABORT", None), ("source", "a.mp4", 0, True, "NONE", None), ("work", "j/frames/f", 5, False, "IA", 30),
    ("work", "j/frames/old/f", 10, False, "EXPIRE", 10), ("work", "j/temp/f", 2, False, "EXPIRE", 1), ("work", "j/temporary", 2, False, "NONE", 30),
    ("work", "", 31, False, "EXPIRE", 30), ("work", None, 31, False, "NONE", None), ("elsewhere", "j/temp/f", 99, False, "NONE", None), (None, "x", 99, False, "NONE", None),
])
def test_rules_of_all_stores(spark, bucket, key, age, incomplete, action, expires):
    one = spark.createDataFrame([(bucket, key, NOW - timedelta(days=age), incomplete, "x")], "bucket string, key string, last_modified timestamp_ntz, incomplete boolean, action_taken string")
    got = inventory.store_lifecycle(one, spark.createDataFrame(STORES, inventory.STORE_RULE), now()).first()
    assert (got.action, got.expires_after, got.action_taken) == (action, expires, "x")


def test_every_action_of_the_stores_occurs(spark):
    from frameline.fixtures import Tables
    from frameline.registry import load

    rows = load()["store_lifecycle"].run(Tables(spark, "/root/testdata/sf0.001"))
    assert {r.action for r in rows.select("action").distinct().collect()} == {"NONE", "ABORT", *inventory.ACTION_RANK}


def test_prefix_only_at_the_start(spark):
    two = spark.createDataFrame([("work", k, NOW - timedelta(days=2)) for k in ("temp/f", "j/temp/f")], "bucket string, key string, last_modified timestamp_ntz")
    rules = spark.createDataFrame(STORES, inventory.STORE_RULE)
    assert {r.key: r.action for r in inventory.store_lifecycle(two, rules, now(), any_part=False).collect()} == {"temp/f": "EXPIRE", "j/temp/f": "NONE"}
    assert inventory.store_lifecycle(two, rules.limit(0), now()).filter("action = 'NONE'").count() == 2


def points(spark, *rows):
    shape = "resource_id string, endpoint_name string, name string, ts timestamp_ntz, value double"
    return spark.createDataFrame([(i, i, n, NOW - timedelta(minutes=m), v) for i, n, m, v in rows], shape)


def test_idle_instances(spark):
    tags = "array<struct<Key string, Value string>>"
    rows = [("busy", "running", None), ("idle", "running", None), ("silent", "running", None), ("kept", "running", [("AutoShutdownExclude", "true")]), ("off", "stopped", None)]
    inst = spark.createDataFrame(rows, f"resource_id string, state string, tags {tags}")
    cpu = points(spark, *[(i, "CPUUtilization", 10, 15.0 if i == "busy" else 5.0) for i in ("busy", "idle", "kept", "off")], ("idle", "CPUUtilization", 90, 99.0))
    assert [r.resource_id for r in resources.idle_instances(inst, cpu, now()).collect()] == ["idle"]


def test_idle_endpoints_and_active_jobs(spark):
    eps = spark.createDataFrame([("ep-1", "InService"), ("ep-2", "InService"), ("ep-3", "InService"), ("ep-4", "Creating")], "endpoint_name string, endpoint_status string")
    calls = points(spark, ("ep-1", "Invocations", 30, 2.0), ("ep-2", "Invocations", 30, 5.0))
    idle = resources.idle_endpoints(eps, calls, now())
    assert sorted(r.endpoint_name for r in idle.collect()) == ["ep-1", "ep-3"]
    live = job(spark, ("j", "PROCESSING", NOW, "x,ep-1"), ("k", "COMPLETED", NOW, "ep-3"))
    assert [r.endpoint_name for r in resources.without_active_jobs(idle, live).collect()] == ["ep-3"]
    assert [r.endpoint_name for r in resources.without_jobs_containing(idle, live).collect()] == ["ep-3"]


def test_orphan_volumes_and_snapshots(spark):
    tags, keep, old = "array<struct<Key string, Value string>>", [("KeepOrphaned", "true")], NOW - timedelta(hours=48)
    vols = spark.createDataFrame([("v1", "available", old, None), ("v2", "available", old, keep), ("v3", "in-use", old, None), ("v4", "available", NOW, None)],
                                 f"volume_id string, state string, create_time timestamp_ntz, tags {tags}")
    assert [r.volume_id for r in resources.orphan_volumes(vols, now()).collect()] == ["v1"]
    age = NOW - timedelta(days=10)
    snaps = spark.createDataFrame([("s1", "gone", age, None), ("s2", "gone", age, keep), ("s3", "v1", age, None), ("s4", None, age, None)],
                                  f"snapshot_id string, volume_id string, start_time timestamp_ntz, tags {tags}")
    assert sorted(r.snapshot_id for r in resources.orphan_snapshots(snaps, vols, now()).collect()) == ["s1", "s4"]


@pytest.mark.parametrize("fulfilled,expected", [(0.5, ("aggressive", 2)), (1.5, ("balanced", 1)), (2.0, ("minimal", 0)), (3.0, ("minimal", 0))])
def test_fallback_capacity(spark, fulfilled, expected):
    fleet = spark.createDataFrame([(fulfilled, 2)], "fulfilled double, target long")
    r = resources.fallback_capacity(fleet).first()
    assert (r.strategy, r.on_demand) == expected


def test_no_leak_no_notice(spark):
    none = spark.createDataFrame([], "error string")
    assert resources.leak_report(none, none).count() == 0


def test_untagged_instance_gives_no_update(spark):
    warn = spark.createDataFrame([("i-1",), ("i-2",)], "instance_id string")
    inst = spark.createDataFrame([("i-1", None), ("i-2", [("JobId", "j")])], "resource_id string, tags array<struct<Key string, Value string>>")
    assert [r.job_id for r in jobs.interrupted_jobs(warn, inst, now()).collect()] == ["j"]


def test_uploads(spark):
    good = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"uploads/%s"}}}]}'
    bodies = spark.createDataFrame([(good % "a+b%20c.MP4",), (good % "document.pdf",), ('{"Records":[{}]}',), ("junk",)], "body string")
    unpacked = jobs.unpack_upload_event(bodies)
    assert [(r.key, r.status_code) for r in unpacked.collect()] == [("uploads/a b c.MP4", 200), ("uploads/document.pdf", 200), (None, 400), (None, 400)]
    made = jobs.make_jobs(unpacked, None, now()).collect()
    assert [(r.video_name, r.content_length, r.content_type, r.frames.total) for r in made] == [("a b c.MP4", 0, "application/octet-stream", 0)]


@pytest.mark.parametrize("asked,used", [(299, 3600), (300, 300), (604800, 604800), (604801, 3600), (None, 3600)])
def test_expiry_limits(spark, asked, used):
    assert jobs.validate_upload_requests(spark.createDataFrame([("f", asked)], "file_name string, expiration int")).first().expires_in == used


def test_variants_and_gpu_batches(spark):
    asked = spark.createDataFrame([("jpeg_car",), ("unknown",), (None,), ("color_dn",)], "model_variant string")
    got = infer.resolve_variant(asked, ["real_sr", "jpeg_car"])
    assert [(r.variant, r.scale) for r in got.collect()] == [("jpeg_car", 1), ("real_sr", 4), ("real_sr", 4), ("real_sr", 4)]
    free = spark.createDataFrame([(None,), (100,), (5000,), (90000,)], "mb int").select(sizing.batch_size_by_gpu_memory(F.col("mb")).alias("n"))
    assert [r.n for r in free.collect()] == [4, 1, 8, 16]


def test_names(spark):
    one = spark.range(1)
    got = one.select(
        names.stem(F.lit("a/b.tar.gz")), names.extension(F.lit("a/b.tar.gz")), names.extension(F.lit("a/.hidden")), names.media_type(F.lit("x/y")),
        names.split_uri(F.lit("/local/x"))["key"], names.frame_key(F.lit("c"), F.lit(7), F.lit(1200), F.lit("png")), names.normalize_status(F.lit("encoding")),
    ).first()
    assert tuple(got) == ("b.tar", "gz", "", None, "/local/x", "c_0007.png", "RECOMPOSING")


def test_upsert_keeps_old_values_and_new_keys(spark):
    current = spark.createDataFrame([("a", "INITIATED", 5, 1)], "job_id string, status string, size int, updated_at int")
    change = spark.createDataFrame([("a", "FAILED", 3), ("b", "INITIATED", 2)], "job_id string, status string, updated_at int")
    got = {r.job_id: (r.status, r["size"], r.updated_at) for r in jobs.upsert_jobs(current, change).collect()}
    assert got == {"a": ("FAILED", 5, 3), "b": ("INITIATED", None, 2)}


@pytest.mark.parametrize("names", [1000, 3])
def test_endpoint_names_inside_free_text(spark, names):
    ends = spark.createDataFrame([(n,) for n in ("ep-1", "ep-12", "p-", "ep-9", "é", "ep-3", None)], "endpoint_name string")
    live = job(spark, ("a", "PROCESSING", NOW, "uses ep-12, twice ep-12"), ("b", "INITIATED", NOW, "café"), ("c", "COMPLETED", NOW, "ep-9"), ("d", "PROCESSING", NOW, None))
    got = resources.without_jobs_containing(ends, live, names)
    assert sorted(r.endpoint_name or "" for r in got.collect()) == ["", "ep-3", "ep-9"]
    assert resources.without_jobs_containing(ends, live.limit(0), names).count() == 7


def test_results_without_a_batch_number_keep_apart(spark):
    shape = "job_id string, batch_id string, status int, output_file_path string, error string"
    rows = [("j", str(i), 200, f"o{i}", None) for i in range(6)] + [("j", None, 500, "x", "e"), ("j", None, 500, "y", "e"), ("j", "abc", 500, "z", "e"), ("j", "42", 200, "o42", None)]
    got = sorted(((r.sub_batch, [x.batch_id for x in r.batch_results]) for r in infer.nested_results(spark.createDataFrame(rows, shape), 4).collect()), key=str)
    assert got == [(0, ["0", "1", "2", "3"]), (1, ["4", "5"]), (10, ["42"]), (None, ["abc"]), (None, [None]), (None, [None])]


@pytest.mark.parametrize("query,body,status,name,lifetime,error", [
    ("fileName=a%20b+c.mp4&expiration=600", None, 200, "a b c.mp4", 600, None), ("fileName=a", '{"fileName": "b"}', 200, "a", 3600, None),
    ("x=1", '{"fileName": "b"}', 400, None, None, "fileName is required"), ("fileName=", None, 400, "", None, "fileName is required"),
    ("", '{"fileName": "b", "expiration": 700}', 200, "b", 700, None), (None, '{"fileName": "b", "expiration": "12"}', 200, "b", 3600, None),
    (None, '{"fileName": "b", "expiration": "soon"}', 400, "b", None, "expiration is not a whole number"), ("fileName=a&expiration=1.5", None, 400, "a", None, "expiration is not a whole number"),
    (None, "{", 400, None, None, "Request body cannot be read"), (None, "[]", 400, None, None, "Request body cannot be read"), (None, "null", 400, None, None, "Request body cannot be read"),
    (None, None, 400, None, None, "Missing required parameters"), ("", "", 400, None, None, "Missing required parameters"), ("fileName=a&fileName=b&fileName", None, 200, "a", 3600, None),
])
def test_whole_upload_requests(spark, query, body, status, name, lifetime, error):
    got = jobs.parse_upload_requests(spark.createDataFrame([(1, query, body)], "key_of_row int, query string, body string")).first()
    assert (got.key_of_row, got.status_code, got.file_name, got.expires_in, got.error) == (1, status, name, lifetime, error)
    assert got.key == (f"uploads/{name}" if status == 200 else None) and got.content_type == ("application/octet-stream" if status == 200 else None)


def test_repaired_values(spark):
    """Zeros, probes that report nothing, keys that cannot be decoded, numbers beyond the total."""
    from frameline.functions import names as N
    from frameline.functions import sizing as Z

    rates = spark.createDataFrame([("30000/1001",), ("0/0",), ("N/A",), ("0/1",), ("25",), (None,), ("a/b",)], "v string").select(Z.frame_rate(F.col("v")).alias("r"))
    assert [None if r.r is None else float(r.r) for r in rates.collect()] == [29.97, None, None, 0.0, 25.0, None, None]
    keys = spark.createDataFrame([("f", 7, 1200), ("f", 12345, 1200)], "b string, n long, total long").select(N.frame_key(F.col("b"), F.col("n"), F.col("total"), F.lit("png")).alias("k"))
    assert [r.k for r in keys.collect()][1].count("12345") == 1
    body = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"a%zz.mp4"}}}]}'
    event = jobs.unpack_upload_event(spark.createDataFrame([(body,)], "body string")).first()
    assert event.status_code == 400 and "cannot be decoded" in event.error
    wide = jobs.pivot_task_attributes(spark.createDataFrame([("t", "duration", "N/A"), ("t", "frames_total", "12")], "task_id string, attr string, value string"), {"duration": "double", "frames_total": "long"}).first()
    assert (wide.duration, wide.frames_total) == (None, 12)
    kept = frames.keep_recompressed(spark.createDataFrame([(0, 0), (0, 5), (100, 80), (100, 95)], "size long, new_size long")).collect()
    assert [r.reduction_percent for r in kept if r.size == 100] == [20, 5] and all(r.reduction_percent is None for r in kept if r.size == 0)
    fleet = resources.fallback_capacity(spark.createDataFrame([(1, 0.0, 0)], "fleet_id long, fulfilled double, target long")).first()
    assert fleet.on_demand == 0


def test_counters_and_sets_of_a_job(spark):
    now_, later = NOW, NOW + timedelta(hours=1)
    current = spark.createDataFrame([("a", "NEW", 1, ["x"], now_), ("b", "NEW", None, None, now_)], "job_id string, status string, done long, ids array<string>, updated_at timestamp_ntz")
    shape = "job_id string, status string, done long, ids array<string>, updated_at timestamp_ntz, seq long"
    more = spark.createDataFrame([("a", "B", 2, ["y", "x"], later, 1), ("a", "C", 3, None, later, 2), ("b", None, 4, ["z"], later, 3), ("c", "A", None, [], now_, 1)], shape)
    got = {r.job_id: (r.status, r.done, r.ids) for r in jobs.upsert_jobs(current, more, add=["done"], union=["ids"], sequence="seq").collect()}
    assert got == {"a": ("C", 6, ["x", "y"]), "b": ("NEW", 4, ["z"]), "c": ("A", None, [])}


def test_retry_stops_at_the_limit(spark):
    rows = [(1, i, False) for i in range(1, 9)] + [(2, 1, False), (2, 2, True), (3, 1, False)]
    tries = spark.createDataFrame(rows, "frame_id int, seq int, ok boolean")
    got = {r.frame_id: (r.attempts, r.success, r.delay_seconds, r.failed) for r in frames.retry_outcome(tries, ["seq"]).collect()}
    assert got == {1: (3, False, 15.0, True), 2: (2, True, 5.0, False), 3: (1, False, 5.0, False)}


def test_gap_breaks_alarm_run(spark):
    at = [datetime(2024, 1, 1, 0, 5 * i) for i in (0, 1, 3, 4)]
    stats = spark.createDataFrame([("k", t, 9.0) for t in at], "k string, period_start timestamp_ntz, stat_value double")
    states = metrics.evaluate_alarms(stats, ["k"], 300, "GreaterThanThreshold", 5.0, 2)
    assert [r.state for r in states.orderBy("period_start").collect()] == ["OK", "ALARM", "OK", "ALARM"]
    assert [r.action for r in metrics.alarm_transitions(states, ["k"]).orderBy("period_start").collect()] == ["alarm_action", "ok_action", "alarm_action"]


def test_rules_of_several_lengths_in_one_pass(spark):
    from frameline.fixtures import Tables
    from frameline.registry import load

    at = [datetime(2024, 1, 1, 0, 5 * i) for i in (0, 1, 2, 3, 4, 5, 7, 8)]
    stats = spark.createDataFrame([("k", t, v) for t, v in zip(at, (9.0, 9.0, 1.0, 9.0, 9.0, 9.0, 9.0, None))], "name string, period_start timestamp_ntz, stat_value double")
    rules = spark.createDataFrame([(f"r{k}", "k", "GreaterThanThreshold", 5.0, k) for k in (1, 2, 3)] + [("other", "x", "GreaterThanThreshold", 5.0, 1), ("odd", "k", "Unknown", 0.0, 1)], metrics.RULE)
    rows = metrics.evaluate_rules(stats, rules, ["name"], 300).orderBy("alarm", "period_start").collect()
    got = {a: "".join(r.state[0] for r in rows if r.alarm == a) for a in ("r1", "r2", "r3", "odd")}
    assert got == {"r1": "AAOAAAAO", "r2": "OAOOAAOO", "r3": "OOOOOAOO", "odd": "OOOOOOOO"} and len(rows) == 32
    ruled = load()["evaluate_rules"].run(Tables(spark, "/root/testdata/sf0.01"))
    assert {r.periods for r in ruled.filter("state = 'ALARM'").select("periods").distinct().collect()} == {1, 2, 6}


def test_nothing_evaluated_is_compliant(spark):
    none = spark.createDataFrame([("r", "x", "INSUFFICIENT_DATA")], "rule_name string, resource_id string, compliance_type string")
    assert audit.compliance_overall(none).first().percent == 100.0
    assert tuple(audit.compliance_by_rule(none).first()) == ("r", 0, 0)


def test_retention_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "jobs")
    job(spark, ("j1", "COMPLETED", NOW - timedelta(days=10), "")).write.parquet(path)
    kept = inventory.completed_before(spark.read.parquet(path), now(), 7).select("job_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(status,COMPLETED)" in pushed and "LessThan(updated_at" in pushed
    assert "endpoints" not in plan and kept.count() == 1


def test_attempts_are_cut_before_the_shuffle(spark):
    tries = spark.createDataFrame([(1, 1, False)], "frame_id int, seq int, ok boolean")
    plan = frames.retry_outcome(tries, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_content_passes_in_small_batches(spark):
    """40 MB of contents reach the next worker in batches of a few megabytes, and unpacking is one pass."""
    from frameline.operators.image_rows import FLUSH_BYTES
    from frameline.operators.infer import gunzip_content, gzip_content

    rows = spark.range(400, numPartitions=1).selectExpr("'k' || id AS key", "encode(repeat(cast(100 + id AS string), 34000), 'UTF-8') AS content")
    rows = rows.unionByName(spark.createDataFrame([("none", None), (None, b"x")], "key string, content binary").coalesce(1))
    back = gunzip_content(gzip_content(rows).unionByName(gzip_content(rows.limit(3)).selectExpr("'plain' AS key", "content", "size", "new_size")))

    def sizes(batches):
        for batch in batches:
            yield type(batch).from_arrays([[batch.nbytes], [batch.num_rows]], ["bytes", "rows"])

    seen = back.select("content").mapInArrow(sizes, "bytes long, rows long").collect()
    assert max(r.bytes for r in seen) <= FLUSH_BYTES + 200_000 and sum(r.rows for r in seen) == 404
    got = {r.key: r for r in back.filter("key <> 'plain'").selectExpr("key", "sha2(content, 256) AS digest", "new_size").collect()}
    want = {r.key: r for r in rows.filter("key IS NOT NULL").selectExpr("key", "sha2(content, 256) AS digest", "octet_length(content) AS new_size").collect()}
    assert got.keys() == want.keys() and all(got[k].digest == want[k].digest and got[k].new_size == want[k].new_size for k in want)
    assert back.filter("key = 'plain' AND hex(substr(content, 1, 2)) = '1F8B'").count() == 3
    plan = gunzip_content(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
