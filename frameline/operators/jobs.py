"""Job records: admission of uploads, upserts, status views and stage history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameline import schemas
from frameline.functions import names
from frameline.operators.skew import salted_join, with_neighbours

# Limits and default of an upload link's lifetime in seconds.
EXPIRY_MIN, EXPIRY_MAX, EXPIRY_DEFAULT = 300, 604800, 3600
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Job attributes known to the task folders, with their types.
TASK_ATTRIBUTES = {
    "source": "string", "vid_filename": "string", "duration": "double", "vduration": "double", "aduration": "double",
    "frames": "bigint", "acodec": "string", "vcodec": "string", "vfps": "decimal(10,2)", "vres": "string", "abitrate": "bigint",
    "frame_type": "string", "is_anime": "string", "output_bucket": "string", "pipeline_status": "string", "video_quality": "string",
}

# Allowed status changes (none means the first record of a job).
ALLOWED_EDGES = (
    (None, "INITIATED"),
    ("INITIATED", "EXTRACTING"),
    ("EXTRACTING", "PROCESSING"),
    ("PROCESSING", "RECOMPOSING"),
    ("RECOMPOSING", "COMPLETED"),
    ("INITIATED", "FAILED"),
    ("EXTRACTING", "FAILED"),
    ("PROCESSING", "FAILED"),
    ("RECOMPOSING", "FAILED"),
    ("EXTRACTING", "INTERRUPTED"),
    ("PROCESSING", "INTERRUPTED"),
    ("INTERRUPTED", "PROCESSING"),
)


def filter_videos(df: DataFrame, key: str = "key") -> DataFrame:
    return df.filter(names.is_video(F.col(key)))


def split_videos(df: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Videos, and the rest labelled ``ignored``."""
    video = F.coalesce(names.is_video(F.col(key)), F.lit(False))
    return df.filter(video), df.filter(~video).withColumn("outcome", F.lit("ignored"))


def unpack_upload_event(events: DataFrame, first_record_only: bool = True, body: str = "body") -> DataFrame:
    """Bucket and decoded key per record; a record that lacks either, or whose key cannot be decoded, has status 400 and an error."""
    records = F.from_json(F.col(body), schemas.UPLOAD_EVENT)["Records"]
    rows = events.withColumn("_record", F.get(records, F.lit(0)) if first_record_only else F.explode_outer(records))
    bucket, key = F.col("_record.s3.bucket.name"), F.col("_record.s3.object.key")
    decoded = F.try_url_decode(key)
    lacks = F.when(F.col("_record.s3").isNull(), "s3").when(bucket.isNull(), "bucket").when(key.isNull(), "key")
    unreadable = F.when(decoded.isNull(), F.concat(F.lit("Key cannot be decoded: "), key))
    error = F.coalesce(F.concat(F.lit("Missing key in event: "), lacks), unreadable)
    return rows.select(
        *events.columns,
        bucket.alias("bucket"),
        decoded.alias("key"),
        F.when(error.isNull(), 200).otherwise(400).alias("status_code"),
        error.alias("error"),
    )


def make_jobs(uploads: DataFrame, heads: DataFrame | None, now: Column, job_id: Column | None = None) -> DataFrame:
    """New job records from unpacked uploads.

    ``heads`` holds ``bucket, key, content_length, content_type`` (one row per object); objects it does not
    know get size 0 and the default type. ``job_id`` is a random UUID unless given.
    """
    videos = filter_videos(uploads.filter(F.col("status_code") == 200))
    if heads is not None:
        found = heads.select("bucket", "key", "content_length", "content_type")
        keys = ["bucket", "key"]
        videos = videos.join(found, keys, "left") if videos.isStreaming else salted_join(videos, found, keys, "left")
    else:
        videos = videos.withColumn("content_length", F.lit(None).cast("long")).withColumn("content_type", F.lit(None).cast("string"))
    zero = F.lit(0).cast("long")
    return videos.select(
        (F.expr("uuid()") if job_id is None else job_id).alias("job_id"),
        names.base_name(F.col("key")).alias("video_name"),
        F.col("bucket").alias("source_bucket"),
        F.col("key").alias("source_key"),
        F.coalesce("content_length", zero).alias("content_length"),
        F.coalesce("content_type", F.lit(DEFAULT_CONTENT_TYPE)).alias("content_type"),
        F.lit("INITIATED").alias("status"),
        now.alias("created_at"),
        now.alias("updated_at"),
        F.struct(zero.alias("total"), zero.alias("extracted"), zero.alias("processed")).alias("frames"),
    )


def validate_upload_requests(df: DataFrame) -> DataFrame:
    """Adds the target key, the lifetime to use and an error for requests without a file name."""
    named = F.coalesce(F.length("file_name") > 0, F.lit(False))
    asked = F.coalesce(F.col("expiration"), F.lit(EXPIRY_DEFAULT))
    return df.select(
        *[c for c in df.columns if c not in ("expiration", "content_type")],
        F.coalesce(F.col("content_type") if "content_type" in df.columns else F.lit(None).cast("string"), F.lit(DEFAULT_CONTENT_TYPE)).alias("content_type"),
        F.when(asked.between(EXPIRY_MIN, EXPIRY_MAX), asked).otherwise(EXPIRY_DEFAULT).cast("bigint").alias("expires_in"),
        F.when(named, F.concat(F.lit("uploads/"), F.col("file_name"))).alias("key"),
        F.when(~named, "fileName is required").alias("error"),
    )


def parse_upload_requests(requests: DataFrame, query: str = "query", body: str = "body") -> DataFrame:
    """Upload requests as they arrive: parameters in a query string, else in a JSON body; the other columns stay.

    Gives what :func:`validate_upload_requests` gives, with ``file_name`` and ``status_code``. A request with neither
    form, with a body that is no JSON object, or with a lifetime that is no whole number has status 400 and an error, as
    has one without a file name. Of a parameter that is given twice the first counts; a body is read only where there is
    no query string.
    """
    asked, held = F.length(F.coalesce(query, F.lit(""))) > 0, F.length(F.coalesce(body, F.lit(""))) > 0
    read = F.try_parse_json(body)

    def parameter(name: str) -> Column:
        inside = F.regexp_extract(F.coalesce(query, F.lit("")), f"(?:^|&){name}=([^&]*)", 1)
        given = F.coalesce(query, F.lit("")).rlike(f"(?:^|&){name}=")
        return F.when(asked, F.when(given, F.try_url_decode(inside))).otherwise(F.try_variant_get(read, f"$.{name}", "string"))

    is_object = F.coalesce(F.schema_of_variant(read).startswith("OBJECT"), F.lit(False))
    lifetime = parameter("expiration")
    number = F.when(asked, lifetime.try_cast("long")).otherwise(F.try_variant_get(read, "$.expiration", "long"))
    problem = (
        F.when(~asked & ~held, "Missing required parameters")
        .when(~asked & ~is_object, "Request body cannot be read")
        .when(lifetime.isNotNull() & number.isNull(), "expiration is not a whole number")
    )
    kept = [c for c in requests.columns if c not in (query, body)]
    rows = requests.select(
        *kept, parameter("fileName").alias("file_name"), parameter("contentType").alias("content_type"), number.alias("expiration"), problem.alias("_problem")
    )
    checked = validate_upload_requests(rows)
    error = F.coalesce("_problem", "error")
    bad = error.isNotNull()
    return checked.select(
        *kept, "file_name", F.when(bad, None).otherwise(F.col("content_type")).alias("content_type"), F.when(bad, None).otherwise(F.col("expires_in")).alias("expires_in"),
        F.when(bad, None).otherwise(F.col("key")).alias("key"), F.when(bad, 400).otherwise(200).alias("status_code"), error.alias("error"),
    )


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key. The rank filter is pushed below the shuffle, so each map task sends one row per key."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def upsert_jobs(
    current: DataFrame, changes: DataFrame, key: str = "job_id", version: str = "updated_at",
    add: Sequence[str] = (), union: Sequence[str] = (), sequence: str | None = None,
) -> DataFrame:
    """Snapshot after applying partial updates.

    An attribute takes its newest non-null value; of equal versions the larger ``sequence`` (a column of ``changes``)
    wins, else the larger value. Attributes in ``add`` are increments and are summed, those in ``union`` are arrays
    whose distinct values are collected. One aggregation with map-side combine: many increments of one hot job are
    summed before the shuffle. A set holds as many values as the attribute of one job has.
    """
    attributes = [c for c in current.columns if c not in (key, version)]
    given = [c for c in changes.columns if c in attributes]
    rank = F.lit(-1).cast("long")
    old = current.withColumn("_rank", rank)
    new = changes.select(key, version, *given, (F.col(sequence).cast("long") if sequence else F.lit(0).cast("long")).alias("_rank"))
    both = old.unionByName(new, allowMissingColumns=True)

    def merged(c: str) -> Column:
        if c in add:
            return F.sum(c).cast(current.schema[c].dataType)
        if c in union:
            return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
        return F.max(F.when(F.col(c).isNotNull(), F.struct(version, "_rank", F.col(c).alias("v"))))["v"]

    return both.groupBy(key).agg(F.max(version).alias(version), *[merged(c).alias(c) for c in attributes]).select(*current.columns)


def pivot_task_attributes(kv: DataFrame, attributes: dict[str, str] | None = None) -> DataFrame:
    """Attribute rows ``(task_id, attr, value)`` to one typed row per task; the attribute list is fixed, so no scan for it.

    A value that does not fit the type of its attribute (probes report ``N/A``) is null.
    """
    attributes = TASK_ATTRIBUTES if attributes is None else attributes
    wide = [F.max(F.when(F.col("attr") == a, F.col("value"))).try_cast(t).alias(a) for a, t in attributes.items()]
    return kv.groupBy("task_id").agg(*wide)


def task_status(jobs: DataFrame) -> DataFrame:
    """Status per job, and where the video is once it is finished."""
    status = names.normalize_status(F.col("status"))
    return jobs.select("job_id", status.alias("status"), F.when(status == "COMPLETED", F.col("output_key")).alias("output_key"))


def jobs_by(jobs: DataFrame, column: str) -> DataFrame:
    return jobs.groupBy(column).agg(F.count(F.lit(1)).alias("jobs"))


def job_progress(jobs: DataFrame, frames: DataFrame) -> DataFrame:
    """Distinct extracted and processed frames per job against its total.

    ``frames`` holds ``job_id, n, processed``. Frames are reduced to one row per job before the join.
    """
    once = frames.groupBy("job_id", "n").agg(F.max("processed").alias("processed"))
    counts = once.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("processed")).alias("processed")
    )
    joined = jobs.select("job_id", "total").join(counts, "job_id", "left")
    extracted, processed = F.coalesce("extracted", F.lit(0)), F.coalesce("processed", F.lit(0))
    return joined.select(
        "job_id", "total", extracted.alias("extracted"), processed.alias("processed"),
        F.when(F.col("total") > 0, F.round(processed * 100.0 / F.col("total"), 4)).cast("double").alias("percent"),
    )


def stage_durations(marks: DataFrame, stage: str, start: str, end: str) -> DataFrame:
    """Seconds between the first start and first end mark per job; a mark without its pair gives null."""
    began = F.min(F.when(F.col("status") == start, F.col("ts")))
    ended = F.min(F.when(F.col("status") == end, F.col("ts")))
    pair = marks.filter(F.col("status").isin(start, end)).groupBy("job_id").agg(began.alias("started_at"), ended.alias("ended_at"))
    seconds = (F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return pair.select("job_id", F.lit(stage).alias("stage"), "started_at", "ended_at", F.round(seconds, 3).alias("seconds"))


def allowed_change(before: Column, after: Column) -> Column:
    ok = F.lit(False)
    for a, b in ALLOWED_EDGES:
        ok = ok | ((before.isNull() if a is None else (before == a)) & (after == b))
    return F.coalesce(ok, F.lit(False))


def stage_history(changes: DataFrame, chunk: str = "day") -> DataFrame:
    """Each status record with the time spent in it and whether the change into it was allowed.

    A repeated status is a poll result, not a change. ``chunk`` is the time unit in which neighbours are
    looked up, so that a job with endless records is handled by many tasks.
    """
    linked = with_neighbours(changes, ["job_id"], ["ts", "event_id"], F.date_trunc(chunk, "ts"), ["ts", "status"])
    before = F.col("prev.status")
    return linked.select(
        "job_id", "event_id", "ts", "status",
        before.alias("prev_status"),
        F.round((F.unix_micros(F.col("next.ts").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6, 3).alias("seconds"),
        (~(allowed_change(before, F.col("status")) | F.coalesce(before == F.col("status"), F.lit(False)))).alias("illegal"),
    )


def interrupted_jobs(warnings: DataFrame, instances: DataFrame, now: Column) -> DataFrame:
    """Job updates for instances about to be taken away: the value of the instance's ``JobId`` tag.

    Works on a stream of warnings against a static instance table. Instances without the tag give no update.
    """
    job = F.get(F.filter("tags", lambda t: t["Key"] == "JobId"), F.lit(0))["Value"]
    owned = instances.select(F.col("resource_id").alias("instance_id"), job.alias("job_id")).filter(F.col("job_id").isNotNull())
    joined = warnings.join(owned, "instance_id") if warnings.isStreaming else salted_join(warnings, owned, ["instance_id"])
    return joined.select(
        "job_id", F.col("instance_id").alias("interrupted_instance_id"), F.lit("INTERRUPTED").alias("status"), now.alias("interrupted_at")
    )
