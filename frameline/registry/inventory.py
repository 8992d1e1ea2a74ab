"""Queries over stored objects."""

from pyspark.sql import functions as F

from frameline import scratch_dir
from frameline.fixtures import JOB_NOW, cte
from frameline.operators import inventory as I
from frameline.registry import query
from frameline.registry.jobs import ts
from frameline.sources.files import read_inventory, read_upload_events
from frameline.streaming.run import run_to_table

NOW = f"TIMESTAMP '{JOB_NOW}'"
OWNED = "owned AS (SELECT *, split_part(key, '/', 1) AS job_id FROM objects)"
EXPIRED = f"expired AS (SELECT job_id FROM jobs WHERE status = 'COMPLETED' AND updated_at < {NOW} - INTERVAL 7 DAY)"


@query("inventory_scan", "S01", f"{cte('objects')} SELECT key, size, last_modified FROM objects WHERE starts_with(key, 'job-1')")
def _(t):
    return t("objects").filter(F.col("key").startswith("job-1"))


@query("prefer_compressed", "S03", f"""{cte('objects')} SELECT name, is_gz, key, size, last_modified FROM (SELECT *, regexp_replace(key, '[.]gz$', '') AS name, key LIKE '%.gz' AS is_gz, row_number() OVER (PARTITION BY regexp_replace(key, '[.]gz$', '') ORDER BY key DESC) AS r FROM objects) t WHERE r = 1""")
def _(t):
    return I.prefer_compressed(t("objects"))


@query("completed_before", "P12", f"{cte('jobs')} SELECT job_id, status, updated_at FROM jobs WHERE status = 'COMPLETED' AND updated_at < {NOW} - INTERVAL 7 DAY")
def _(t):
    return I.completed_before(t("jobs"), ts(JOB_NOW), 7).select("job_id", "status", "updated_at")


@query("compressible", "P13", f"{cte('objects')} SELECT key, size, last_modified FROM objects WHERE key NOT LIKE '%.gz'")
def _(t):
    return I.compressible(t("objects"))


@query("orphan_objects", "J01", f"{cte('objects', 'jobs')}, {OWNED} SELECT job_id, key, size, last_modified FROM owned WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.job_id = owned.job_id)")
def _(t):
    return I.orphan_objects(t("objects"), t("jobs"))


@query("orphan_bytes_by_job", "J01 A03", f"{cte('objects', 'jobs')}, {OWNED} SELECT job_id, count(*) AS objects, cast(sum(size) AS bigint) AS bytes FROM owned WHERE job_id NOT IN (SELECT job_id FROM jobs) GROUP BY job_id")
def _(t):
    return I.orphan_bytes_by_job(t("objects"), t("jobs"))


@query("expired_objects", "J02", f"{cte('objects', 'jobs')}, {OWNED}, {EXPIRED} SELECT job_id, key, size, last_modified FROM owned WHERE job_id IN (SELECT job_id FROM expired)")
def _(t):
    return I.expired_objects(t("objects"), t("jobs"), ts(JOB_NOW), 7)


@query("cleanup_summary", "A01", f"{cte('objects', 'jobs')}, {OWNED}, {EXPIRED} SELECT e.job_id, 'success' AS status, count(o.key) AS deleted_count FROM expired e LEFT JOIN owned o ON o.job_id = e.job_id GROUP BY e.job_id")
def _(t):
    return I.cleanup_summary(t("jobs"), t("objects"), ts(JOB_NOW), 7)


@query("compression_summary", "A02", f"{cte('objects')}, {OWNED} SELECT job_id, count(*) FILTER (WHERE size % 10 <> 0) AS compressed_count, count(*) AS total_objects FROM owned WHERE key NOT LIKE '%.gz' GROUP BY job_id")
def _(t):
    tried = I.with_job(I.compressible(t("objects"))).select("job_id", F.expr("size % 10 <> 0 AS ok"))
    return I.compression_summary(tried)


RESULTS = f"results AS (SELECT CASE WHEN key LIKE '%/temp/%' THEN 'temp' ELSE 'frames' END AS kind, key, size AS bytes, CASE WHEN size % 7 = 0 THEN 'access denied' END AS error FROM objects)"


def results(t):
    return t("objects").select(F.expr("CASE WHEN key LIKE '%/temp/%' THEN 'temp' ELSE 'frames' END AS kind"), "key", F.col("size").alias("bytes"), F.expr("CASE WHEN size % 7 = 0 THEN 'access denied' END AS error"))


@query("orphan_summary", "A03", f"{cte('objects')}, {RESULTS} SELECT kind, count(*) AS total_orphaned, count(*) FILTER (WHERE error IS NULL) AS deleted_count, count(error) AS errors, cast(sum(CASE WHEN error IS NULL THEN bytes END) AS bigint) AS deleted_bytes FROM results GROUP BY kind")
def _(t):
    return I.orphan_summary(results(t))


@query("orphan_errors", "A03", f"{cte('objects')}, {RESULTS} SELECT kind, key, error FROM results WHERE error IS NOT NULL")
def _(t):
    return I.orphan_errors(results(t))


@query("delete_calls", "W04", f"{cte('objects')}, {OWNED} SELECT job_id, key, size, last_modified, (row_number() OVER (PARTITION BY job_id ORDER BY cast('0x' || substr(md5(key), 1, 8) AS ubigint), key) - 1) // 3 AS call FROM owned")
def _(t):
    return I.delete_calls(I.with_job(t("objects")), size=3)


@query("delete_calls_by_store", "W04", f"{cte('objects')}, o AS (SELECT *, split_part(key, '/', 2) AS store FROM objects) SELECT store, call, count(*) AS keys FROM (SELECT store, (row_number() OVER (PARTITION BY store ORDER BY cast('0x' || substr(md5(key), 1, 8) AS ubigint), key) - 1) // 1000 AS call FROM o) t GROUP BY store, call")
def _(t):
    calls = I.delete_calls(I.with_job(t("objects"), 1).withColumnRenamed("job_id", "store"), ("store",))
    return calls.groupBy("store", "call").agg(F.count(F.lit(1)).alias("keys"))


RULES = ", ".join(f"('{p}', '{a}', {d}, {I.ACTION_RANK[a]})" for p, a, d in I.LIFECYCLE_RULES)


def lifecycle_sql(now: str) -> str:
    return f"""{cte('objects')}, rules(prefix, action, days, rank) AS (VALUES {RULES}),
aged AS (SELECT *, cast(floor((epoch_us(TIMESTAMP '{now}') - epoch_us(last_modified)) / 1e6 / 86400) AS bigint) AS age_days FROM objects),
best AS (SELECT key, max(rank) AS rank FROM aged JOIN rules ON (prefix = '' OR starts_with(key, prefix) OR contains(key, '/' || prefix)) AND age_days >= days GROUP BY key)
SELECT a.key, a.size, a.last_modified, a.age_days, coalesce((SELECT DISTINCT action FROM rules r WHERE r.rank = b.rank), 'NONE') AS action FROM aged a LEFT JOIN best b ON b.key = a.key"""


@query("lifecycle_action", "P23", lifecycle_sql("1998-06-15 12:00:00"))
def _(t):
    return I.lifecycle_action(t("objects"), ts("1998-06-15 12:00:00"))


STORED = "SELECT *, CASE size % 3 WHEN 0 THEN 'source' WHEN 1 THEN 'processed' ELSE 'final' END AS bucket, size % 7 = 0 AS incomplete FROM objects"
ALL_RULES = ", ".join(f"('{b}', '{p}', '{a}', {d}, {({**I.ACTION_RANK, 'ABORT': 0})[a]})" for b, p, a, d in I.STORE_RULES)


@query("inventory_prefix", "S01", f"{cte('objects')} SELECT * FROM objects WHERE starts_with(key, 'job-1')")
def _(t):
    path = scratch_dir(t.spark, "inventory")
    t("objects").write.parquet(path)
    return read_inventory(t.spark, path, prefix="job-1")


@query("read_upload_events", "S06", f"""{cte('upload_events')}, k AS (SELECT body, json_extract_string(body, '$.Records[0].s3.object.key') AS key FROM upload_events)
SELECT body FROM k WHERE key IS NULL OR (starts_with(key, 'data/src/real/') AND ends_with(key, '.MP4'))""")
def _(t):
    path = scratch_dir(t.spark, "notifications")
    t("upload_events").select("body").write.text(path)
    return run_to_table(t.spark, read_upload_events(t.spark, path, "data/src/real/", ".MP4", streaming=True), "uploads_seen")


@query("store_lifecycle", "P23", f"""{cte('objects', stored=STORED)}, rules(bucket, prefix, action, days, rank) AS (VALUES {ALL_RULES}),
aged AS (SELECT *, cast(floor((epoch_us(TIMESTAMP '1998-06-15 12:00:00') - epoch_us(last_modified)) / 1e6 / 86400) AS bigint) AS age_days FROM stored),
hit AS (SELECT a.bucket, a.key, a.age_days, r.action, r.days, r.rank FROM aged a JOIN rules r ON r.bucket = a.bucket AND (r.prefix = '' OR starts_with(key, r.prefix) OR contains(key, '/' || r.prefix)) AND (r.action = 'ABORT') = incomplete),
best AS (SELECT key, max(CASE WHEN age_days >= days THEN rank END) AS rank, min(CASE WHEN action = 'EXPIRE' THEN days END) AS expires_after FROM hit GROUP BY key)
SELECT a.*, coalesce((SELECT DISTINCT action FROM rules r WHERE r.rank = b.rank), 'NONE') AS action, b.expires_after FROM aged a LEFT JOIN best b ON b.key = a.key""")
def _(t):
    stored = t("objects").selectExpr("*", "CASE size % 3 WHEN 0 THEN 'source' WHEN 1 THEN 'processed' ELSE 'final' END AS bucket", "size % 7 = 0 AS incomplete")
    return I.store_lifecycle(stored, t.spark.createDataFrame(I.STORE_RULES, I.STORE_RULE), ts("1998-06-15 12:00:00"))


@query("maintenance_report", "U01", f"""{cte('objects', 'jobs', 'volumes', 'snapshots')}, {OWNED}, {EXPIRED}
SELECT 'expired' AS kind, key AS id, size AS bytes FROM owned WHERE job_id IN (SELECT job_id FROM expired)
UNION ALL SELECT 'orphan', key, size FROM owned WHERE job_id NOT IN (SELECT job_id FROM jobs)
UNION ALL SELECT 'volume', volume_id, NULL FROM volumes WHERE state = 'available' AND create_time < {NOW} - INTERVAL 24 HOUR AND coalesce(tag_key, '') <> 'KeepOrphaned'
UNION ALL SELECT 'snapshot', snapshot_id, NULL FROM snapshots s WHERE start_time < {NOW} - INTERVAL 7 DAY AND coalesce(tag_key, '') <> 'KeepOrphaned' AND NOT EXISTS (SELECT 1 FROM volumes v WHERE v.volume_id = s.volume_id)""")
def _(t):
    from frameline.plans.maintenance import maintenance_findings
    from frameline.registry.jobs import tagged

    return maintenance_findings(t("objects"), t("jobs"), tagged(t("volumes")), tagged(t("snapshots")), ts(JOB_NOW))
