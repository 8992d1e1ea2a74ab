"""Queries over job records and uploads."""

from pyspark.sql import functions as F

from frameline.fixtures import EVENT_NOW, JOB_NOW, cte
from frameline.functions import names
from frameline.operators import jobs as J
from frameline.registry import query
from frameline.sources import files

KEYS = "keys AS (SELECT event_id, replace(json_extract_string(body, '$.Records[0].s3.object.key'), '+', ' ') AS raw_key, json_extract_string(body, '$.Records[0].s3.bucket.name') AS bucket FROM upload_events), unpacked AS (SELECT event_id, bucket, replace(raw_key, '%20', ' ') AS key FROM keys)"
VIDEO = "(lower(key) LIKE '%.mp4' OR lower(key) LIKE '%.avi' OR lower(key) LIKE '%.mov' OR lower(key) LIKE '%.mkv')"


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("filter_videos", "P01", f"{cte('jobs')} SELECT job_id, video_name, CASE WHEN {VIDEO.replace('key', 'video_name')} THEN 'video' ELSE 'ignored' END AS outcome FROM jobs")
def _(t):
    videos, ignored = J.split_videos(t("jobs"), "video_name")
    both = videos.withColumn("outcome", F.lit("video")).unionByName(ignored)
    return both.select("job_id", "video_name", "outcome")


@query("unpack_upload_event", "P02", f"{cte('upload_events')}, {KEYS} SELECT event_id, bucket, key, CASE WHEN key IS NULL THEN 400 ELSE 200 END AS status_code, CASE WHEN key IS NULL THEN 'Missing key in event: s3' END AS error FROM unpacked")
def _(t):
    return J.unpack_upload_event(t("upload_events").select("event_id", "body")).drop("body")


@query("filter_uploads", "S06", f"{cte('upload_events')}, {KEYS} SELECT event_id FROM unpacked WHERE key IS NULL OR (starts_with(key, 'data/src/anime') AND key LIKE '%.MP4')")
def _(t):
    return files.filter_uploads(t("upload_events"), "data/src/anime", ".MP4").select("event_id")


@query("media_type", "P03", f"{cte('jobs')} SELECT job_id, split_part(source_key, '/', 3) AS media_type, split_part(source_key, '/', 3) = 'anime' AS is_anime FROM jobs")
def _(t):
    key = F.col("source_key")
    return t("jobs").select("job_id", names.media_type(key).alias("media_type"), names.is_anime_key(key).alias("is_anime"))


@query("task_uuid", "P04", f"{cte('jobs')} SELECT job_id, split_part(source_key, '/', 4) AS task_uuid FROM jobs")
def _(t):
    return t("jobs").select("job_id", names.task_uuid(F.col("source_key")).alias("task_uuid"))


@query("split_uri", "P05", f"{cte('requests')} SELECT job_id, batch_id, split_part(input_file_path, '/', 3) AS bucket, substr(input_file_path, 18) AS key FROM requests")
def _(t):
    return t("requests").withColumn("u", names.split_uri(F.col("input_file_path"))).select("job_id", "batch_id", "u.bucket", "u.key")


@query("split_name", "P06", f"{cte('objects')} SELECT key, split_part(key, '/', 3) AS base, regexp_replace(split_part(key, '/', 3), '[.][^.]*$', '') AS stem, CASE WHEN key LIKE '%.gz' THEN 'gz' ELSE 'png' END AS ext FROM objects")
def _(t):
    return t("objects").withColumn("s", names.split_name(F.col("key"))).select("key", "s.base", "s.stem", "s.ext")


HEADS = "heads AS (SELECT 'source-bucket' AS bucket, 'data/src/' || CASE WHEN event_type = 'view' THEN 'anime' ELSE 'real' END || '/u' || cast(user_id AS string) || '/my clip ' || cast(event_id AS string) || '.MP4' AS key, event_id * 10 AS content_length FROM events WHERE event_id % 3 = 0)"


@query("make_jobs", "P07 J17", f"""{cte('upload_events')}, {KEYS}, {HEADS}
SELECT 'job-' || md5(u.bucket || '/' || u.key) AS job_id, regexp_extract(u.key, '[^/]*$') AS video_name, u.bucket AS source_bucket, u.key AS source_key,
 coalesce(content_length, 0) AS content_length, CASE WHEN content_length IS NULL THEN 'application/octet-stream' ELSE 'video/mp4' END AS content_type, 'INITIATED' AS status, TIMESTAMP '{EVENT_NOW}' AS updated_at, cast(0 AS bigint) AS frames_total
FROM unpacked u LEFT JOIN heads h ON h.key = u.key AND h.bucket = u.bucket WHERE {VIDEO.replace('key', 'u.key')}""")
def _(t):
    prefix = F.when(F.col("event_type") == "view", "data/src/anime/u").otherwise("data/src/real/u")
    heads = t.raw("events").filter("event_id % 3 = 0").select(
        F.lit("source-bucket").alias("bucket"), F.concat(prefix, F.col("user_id"), F.lit("/my clip "), F.col("event_id"), F.lit(".MP4")).alias("key"),
        (F.col("event_id") * 10).alias("content_length"), F.lit("video/mp4").alias("content_type"),
    )
    uploads = J.unpack_upload_event(t("upload_events"))
    made = J.make_jobs(uploads, heads, ts(EVENT_NOW), F.concat(F.lit("job-"), F.md5(F.concat("bucket", F.lit("/"), "key"))))
    return made.select("job_id", "video_name", "source_bucket", "source_key", "content_length", "content_type", "status", "updated_at", F.col("frames.total").alias("frames_total"))


@query("validate_upload_requests", "P09", f"""{cte('requests')} SELECT job_id, batch_id, CASE WHEN batch_id % 6 = 5 THEN NULL ELSE 'uploads/' || input_file_path END AS key, 'application/octet-stream' AS content_type,
 CASE WHEN batch_id * 200 BETWEEN 300 AND 604800 THEN batch_id * 200 ELSE 3600 END AS expires_in, CASE WHEN batch_id % 6 = 5 THEN 'fileName is required' END AS error FROM requests""")
def _(t):
    asked = t("requests").select("job_id", "batch_id", F.expr("CASE WHEN batch_id % 6 = 5 THEN NULL ELSE input_file_path END AS file_name"), F.expr("batch_id * 200 AS expiration"))
    return J.validate_upload_requests(asked).drop("file_name")


# Every form of a request: both places, both number forms, empty, broken, and parameters that are missing or no number.
ASKED = """CASE batch_id % 5 WHEN 0 THEN 'fileName=my+clip%20' || batch_id || '.mp4&expiration=' || (batch_id * 200 + 100) WHEN 1 THEN CASE WHEN length(job_id) % 2 = 0 THEN 'expiration=600' ELSE 'contentType=video/mp4&fileName=a.mov&fileName=b.mov&expiration=x' END END AS query"""
SENT = """CASE WHEN batch_id % 5 = 2 THEN '{"fileName": "clip ' || job_id || '.mp4", "expiration": ' || CASE WHEN length(job_id) % 2 = 0 THEN '"86400"' ELSE '7' END || ', "contentType": "video/mp4"}' WHEN batch_id % 5 = 3 THEN CASE length(job_id) % 3 WHEN 0 THEN '{"fileName": ' WHEN 1 THEN '[1, 2]' ELSE '{"expiration": 900}' END WHEN batch_id % 5 = 4 THEN '' END AS body"""


@query("parse_upload_requests", "P09", f"""{cte('requests')}, sent AS (SELECT job_id, batch_id, {ASKED}, {SENT} FROM requests),
read_ AS (SELECT *, coalesce(query, '') <> '' AS asked, coalesce(body, '') <> '' AS held, CASE WHEN json_valid(coalesce(body, '')) THEN body END AS valid FROM sent),
p AS (SELECT *, CASE WHEN asked THEN CASE WHEN regexp_matches(query, '(^|&)fileName=') THEN url_decode(replace(regexp_extract(query, '(?:^|&)fileName=([^&]*)', 1), '+', ' ')) END ELSE json_extract_string(valid, '$.fileName') END AS file_name,
 CASE WHEN asked THEN CASE WHEN regexp_matches(query, '(^|&)contentType=') THEN regexp_extract(query, '(?:^|&)contentType=([^&]*)', 1) END ELSE json_extract_string(valid, '$.contentType') END AS content_type,
 CASE WHEN asked THEN CASE WHEN regexp_matches(query, '(^|&)expiration=') THEN regexp_extract(query, '(?:^|&)expiration=([^&]*)', 1) END ELSE json_extract_string(valid, '$.expiration') END AS lifetime FROM read_),
e AS (SELECT *, CASE WHEN NOT asked AND NOT held THEN 'Missing required parameters' WHEN NOT asked AND coalesce(json_type(valid), '') <> 'OBJECT' THEN 'Request body cannot be read' WHEN lifetime IS NOT NULL AND try_cast(lifetime AS bigint) IS NULL THEN 'expiration is not a whole number'
 WHEN coalesce(file_name, '') = '' THEN 'fileName is required' END AS error FROM p)
SELECT job_id, batch_id, file_name, CASE WHEN error IS NULL THEN coalesce(content_type, 'application/octet-stream') END AS content_type,
 CASE WHEN error IS NULL THEN CASE WHEN try_cast(lifetime AS bigint) BETWEEN 300 AND 604800 THEN try_cast(lifetime AS bigint) ELSE 3600 END END AS expires_in,
 CASE WHEN error IS NULL THEN 'uploads/' || file_name END AS key, CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status_code, error FROM e""")
def _(t):
    return J.parse_upload_requests(t("requests").selectExpr("job_id", "batch_id", ASKED, SENT))


@query("upsert_counters", "S05", """WITH c AS (SELECT 'job-' || l_orderkey AS job_id, count(*) AS n, string_agg(DISTINCT 'b-' || (l_partkey % 9), ',' ORDER BY 'b-' || (l_partkey % 9)) AS ids, arg_max('v-' || l_suppkey, l_shipdate::varchar || lpad(l_linenumber::varchar, 4, '0') || lpad(l_suppkey::varchar, 9, '0') || lpad(l_partkey::varchar, 9, '0')) AS model FROM lineitem GROUP BY l_orderkey)
SELECT 'job-' || o_orderkey AS job_id, coalesce(model, 'none') AS model, cast(5 + coalesce(n, 0) AS bigint) AS processed, CASE WHEN ids IS NULL THEN 'start' ELSE ids || ',start' END AS batch_ids FROM orders o LEFT JOIN c ON c.job_id = 'job-' || o_orderkey""")
def _(t):
    current = t.raw("orders").selectExpr("'job-' || o_orderkey AS job_id", "'none' AS model", "5L AS processed", "array('start') AS batch_ids", "timestamp_ntz'1990-01-01 00:00:00' AS updated_at")
    order = "lpad(l_linenumber, 4, '0') || lpad(l_suppkey, 9, '0') || lpad(l_partkey, 9, '0') AS seq"
    each = t.raw("lineitem").selectExpr("'job-' || l_orderkey AS job_id", "'v-' || l_suppkey AS model", "1L AS processed", "array('b-' || (l_partkey % 9)) AS batch_ids", "cast(l_shipdate AS timestamp_ntz) AS updated_at", order)
    after = J.upsert_jobs(current, each, add=["processed"], union=["batch_ids"], sequence="seq")
    return after.select("job_id", "model", "processed", F.array_join(F.array_sort("batch_ids"), ",").alias("batch_ids"))


VERSIONS = "versions AS (SELECT job_id, status, content_length, updated_at FROM jobs UNION ALL SELECT job_id, 'COMPLETED', NULL, updated_at + INTERVAL 1 DAY FROM jobs WHERE status = 'PROCESSING' AND cast(substr(job_id, 5) AS bigint) % 3 = 0)"


def changes(t):
    later = t("jobs").filter("status = 'PROCESSING' AND cast(substr(job_id, 5) AS bigint) % 3 = 0")
    return later.select("job_id", F.lit("COMPLETED").alias("status"), F.expr("updated_at + INTERVAL 1 DAY AS updated_at"))


@query("upsert_jobs", "S05", f"""{cte('jobs')}, {VERSIONS} SELECT job_id, arg_max(status, updated_at) AS status, arg_max(content_length, updated_at) AS content_length, max(updated_at) AS updated_at FROM versions GROUP BY job_id""")
def _(t):
    return J.upsert_jobs(t("jobs").select("job_id", "status", "content_length", "updated_at"), changes(t))


@query("latest_by", "W03", f"""{cte('jobs')}, {VERSIONS} SELECT job_id, status, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY updated_at DESC, status DESC) AS r FROM versions) t WHERE r = 1""")
def _(t):
    rows = t("jobs").select("job_id", "status", "updated_at").unionByName(changes(t))
    return J.latest_by(rows, ["job_id"], ["updated_at", "status"])


@query("pivot_task_attributes", "S10", f"""{cte('probes')} SELECT job_id AS task_id, cast(frames_total AS bigint) AS frames, vres, acodec, audio_seconds AS aduration, quality AS video_quality FROM probes""")
def _(t):
    kv = t("probes").select(F.col("job_id").alias("task_id"), F.expr(
        "stack(5, 'frames', cast(frames_total AS string), 'vres', vres, 'acodec', acodec, 'aduration', cast(audio_seconds AS string), 'video_quality', quality) AS (attr, value)"
    ))
    return J.pivot_task_attributes(kv, {"frames": "bigint", "vres": "string", "acodec": "string", "aduration": "double", "video_quality": "string"})


@query("normalize_status", "P26", f"""{cte('jobs')}, v AS (SELECT job_id, status, CASE status WHEN 'COMPLETED' THEN 'uploaded' WHEN 'FAILED' THEN 'error' WHEN 'INITIATED' THEN 'pending' ELSE 'upscaling' END AS file_status FROM jobs)
SELECT job_id, file_status, status FROM v""")
def _(t):
    spoken = F.expr("CASE status WHEN 'COMPLETED' THEN 'uploaded' WHEN 'FAILED' THEN 'error' WHEN 'INITIATED' THEN 'pending' ELSE 'upscaling' END")
    return t("jobs").select("job_id", spoken.alias("file_status")).withColumn("status", names.normalize_status(F.col("file_status")))


@query("task_status", "P27", f"""{cte('jobs')} SELECT job_id, status, CASE WHEN status = 'COMPLETED' THEN 'out/' || job_id || '.mp4' END AS output_key FROM jobs""")
def _(t):
    return J.task_status(t("jobs").withColumn("output_key", F.concat(F.lit("out/"), "job_id", F.lit(".mp4"))))


@query("jobs_by_status", "A16", f"{cte('jobs')} SELECT status, count(*) AS jobs FROM jobs GROUP BY status")
def _(t):
    return J.jobs_by(t("jobs"), "status")


@query("jobs_by_video", "A16", f"{cte('jobs')} SELECT video_name, count(*) AS jobs FROM jobs GROUP BY video_name")
def _(t):
    return J.jobs_by(t("jobs"), "video_name")


@query("job_progress", "A11", f"""{cte('frames', 'probes')}, f AS (SELECT job_id, n, max(CASE WHEN cache_etag = etag THEN 1 ELSE 0 END) AS p FROM frames GROUP BY 1, 2), s AS (SELECT job_id, count(*) AS e, sum(p) AS p FROM f GROUP BY 1)
SELECT b.job_id, b.frames_total AS total, coalesce(e, 0) AS extracted, cast(coalesce(p, 0) AS bigint) AS processed, round(coalesce(p, 0) * 100.0 / b.frames_total, 4) AS percent FROM probes b LEFT JOIN s ON s.job_id = b.job_id""")
def _(t):
    frames = t("frames").select("job_id", "n", F.expr("coalesce(cache_etag = etag, false) AS processed"))
    return J.job_progress(t("probes").select("job_id", F.col("frames_total").alias("total")), frames)


@query("stage_durations", "A15", f"""{cte('status_changes')}, m AS (SELECT job_id, min(CASE WHEN status = 'EXTRACTING' THEN ts END) AS started_at, min(CASE WHEN status = 'COMPLETED' THEN ts END) AS ended_at FROM status_changes WHERE status IN ('EXTRACTING', 'COMPLETED') GROUP BY job_id)
SELECT job_id, 'frame_extraction' AS stage, started_at, ended_at, round((epoch_us(ended_at) - epoch_us(started_at)) / 1e6, 3) AS seconds FROM m""")
def _(t):
    return J.stage_durations(t("status_changes"), "frame_extraction", "EXTRACTING", "COMPLETED")


EDGES = ", ".join(f"({'NULL' if a is None else repr(a)}, {b!r})" for a, b in J.ALLOWED_EDGES)


@query("stage_history", "W07", f"""{cte('status_changes')}, edges(a, b) AS (VALUES {EDGES}),
h AS (SELECT *, lag(status) OVER w AS prev_status, lead(ts) OVER w AS nt FROM status_changes WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id))
SELECT job_id, event_id, ts, status, prev_status, round((epoch_us(nt) - epoch_us(ts)) / 1e6, 3) AS seconds,
 NOT (EXISTS (SELECT 1 FROM edges WHERE a IS NOT DISTINCT FROM prev_status AND b = status) OR coalesce(prev_status = status, false)) AS illegal FROM h""")
def _(t):
    return J.stage_history(t("status_changes"))


@query("interrupted_jobs", "J13", f"""{cte('warnings', 'instances')} SELECT tag_value AS job_id, instance_id AS interrupted_instance_id, 'INTERRUPTED' AS status, TIMESTAMP '{EVENT_NOW}' AS interrupted_at FROM warnings w JOIN instances i ON i.resource_id = w.instance_id WHERE tag_key = 'JobId'""")
def _(t):
    return J.interrupted_jobs(t("warnings"), tagged(t("instances")), ts(EVENT_NOW))


def tagged(df):
    """Tag pair columns to the tag list a resource carries."""
    tag = F.array(F.struct(F.col("tag_key").alias("Key"), F.col("tag_value").alias("Value")))
    return df.withColumn("tags", F.when(F.col("tag_key").isNotNull(), tag)).drop("tag_key", "tag_value")


__all__ = ["JOB_NOW", "tagged", "ts"]
