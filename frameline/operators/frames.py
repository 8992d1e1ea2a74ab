"""Frame manifests: plans, batches, completeness, caches, retries and encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameline.functions import sizing
from frameline.operators.skew import expand_range, ranked_in_group, salted_join

# Quality -> encoder preset and rate factor; format -> codec; unknown or absent -> default.
QUALITY = {"low": ("fast", 28), "medium": ("medium", 23), "high": ("slow", 18), "ultra": ("veryslow", 15)}
DEFAULT_QUALITY = "medium"
CODEC = {"mp4": "libx264", "webm": "libvpx-vp9", "mkv": "libx264", "mov": "libx264"}
DEFAULT_FORMAT = "mp4"

# Batch memory (MB) and vCPU formula and limits.
BASE_MB, MIN_MB, MAX_MB = 2048, 2048, 30720
MB_PER_VCPU, MIN_VCPU, MAX_VCPU = 4096, 2, 16
BYTES_PER_PIXEL = 4

MIN_REDUCTION_PERCENT = 10


def _lookup(key: Column, table: dict, default) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


def encode_plan(tasks: DataFrame) -> DataFrame:
    """Preset, rate factor, codec and bitrate per task (``task_id, quality, format, bitrate``)."""
    quality, fmt = F.col("quality"), F.col("format")
    return tasks.select(
        "task_id",
        _lookup(quality, {k: v[0] for k, v in QUALITY.items()}, QUALITY[DEFAULT_QUALITY][0]).alias("preset"),
        _lookup(quality, {k: v[1] for k, v in QUALITY.items()}, QUALITY[DEFAULT_QUALITY][1]).alias("crf"),
        _lookup(fmt, CODEC, CODEC[DEFAULT_FORMAT]).alias("codec"),
        _lookup(fmt, {k: k for k in CODEC}, DEFAULT_FORMAT).alias("format"),
        F.lit("yuv420p").alias("pixel_format"),
        F.when(F.coalesce("bitrate", F.lit("0")) != "0", F.col("bitrate")).alias("bitrate"),
    )


def plan_frame_batches(tasks: DataFrame, size: Column | None = None) -> DataFrame:
    """Batches ``(job_id, batch, start_frame, end_frame)`` covering frames 1..total by the size tier of the total.

    Pure arithmetic on the total: no frame row is read and nothing is sorted.
    """
    size = sizing.batch_size_by_frames(F.col("frames_total")) if size is None else size
    sized = tasks.withColumn("batch_size", size.cast("long"))
    last = F.ceil(F.col("frames_total") / F.col("batch_size")).cast("long") - 1
    batches = expand_range(sized, F.lit(0), last, "batch", ["job_id"])
    start = F.col("batch") * F.col("batch_size") + 1
    return batches.withColumn("start_frame", start).withColumn("end_frame", F.least(start + F.col("batch_size") - 1, F.col("frames_total")))


def plan_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, size: int, name: str = "batch") -> DataFrame:
    """Numbers existing rows into batches of ``size`` in order (0-based), one task never holding a whole group."""
    ranked = ranked_in_group(df, keys, order, chunk, "_rank")
    return ranked.withColumn(name, sizing.int_div(F.col("_rank") - 1, size)).drop("_rank")


def batch_resources(plan: DataFrame) -> DataFrame:
    """Memory and vCPU per batch from ``width``, ``height`` and ``batch_size``."""
    pixels = F.col("width").cast("long") * F.col("height") * BYTES_PER_PIXEL * F.col("batch_size")
    memory = sizing.clamp(sizing.int_div(pixels, 1048576) + BASE_MB, MIN_MB, MAX_MB)
    vcpu = sizing.clamp(sizing.int_div(memory, MB_PER_VCPU) + 2, MIN_VCPU, MAX_VCPU)
    return plan.withColumn("memory_mb", memory).withColumn("vcpus", vcpu)


def keep_recompressed(df: DataFrame) -> DataFrame:
    """Decides per file whether the recompressed version (smaller by more than 10 whole percent) is kept; an empty file is not."""
    reduction = sizing.int_div((F.col("size") - F.col("new_size")) * 100, F.nullif(F.col("size"), F.lit(0)))
    return df.withColumn("reduction_percent", reduction).withColumn("keep_new", F.coalesce(reduction > MIN_REDUCTION_PERCENT, F.lit(False)))


def missing_frames(tasks: DataFrame, frames: DataFrame) -> DataFrame:
    """Frame numbers 1..total of each task without a frame; both sides are spread by job and number."""
    expected = expand_range(tasks.select("job_id", "total"), F.lit(1), F.col("total"), "n", ["job_id"]).select("job_id", "n")
    return expected.join(frames.select("job_id", F.col("n").cast("long").alias("n")), ["job_id", "n"], "left_anti")


def cache_status(remote: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``hit`` when the cached content tag equals the stored one, ``stale`` when it differs, ``miss`` when absent."""
    held = cache.select(*keys, F.col("etag").alias("_cached"))
    label = F.when(F.col("_cached").isNull(), "miss").when(F.col("_cached") == F.col("etag"), "hit").otherwise("stale")
    return remote.join(held, list(keys), "left").withColumn("cache", label).drop("_cached")


def remaining_frames(frames: DataFrame, checkpoints: DataFrame, markers: DataFrame) -> DataFrame:
    """Frames not in the last complete checkpoint of their job.

    ``checkpoints`` holds ``job_id, checkpoint_id, n``; ``markers`` one ``(job_id, checkpoint_id)`` per
    checkpoint that was finished. A job without a finished checkpoint starts over.
    """
    last = markers.groupBy("job_id").agg(F.max("checkpoint_id").alias("checkpoint_id"))
    done = salted_join(checkpoints, last, ["job_id", "checkpoint_id"], "left_semi").select("job_id", "n")
    return frames.join(done, ["job_id", "n"], "left_anti")


def recompose_plan(tasks: DataFrame, frames: DataFrame, audio: DataFrame) -> DataFrame:
    """Output seconds per task: the shorter of video and audio when there is audio, else the video.

    ``tasks`` has ``job_id, fps``; ``frames`` one row per frame; ``audio`` ``job_id, audio_seconds``. A task without
    frames has 0 of them; a rate of zero gives no length.
    """
    counts = frames.groupBy("job_id").agg(F.count_distinct("n").alias("frames"))
    rows = tasks.join(counts, "job_id", "left").fillna(0, ["frames"]).join(audio, "job_id", "left")
    video = F.round(F.col("frames") / F.nullif(F.col("fps"), F.lit(0.0)), 4)
    return rows.select(
        "job_id", "frames", "fps", "audio_seconds", video.alias("video_seconds"), F.least(video, "audio_seconds").alias("output_seconds"),
    )


def ready_to_encode(batches: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Per job: batches seen, batches succeeded, and ready when every planned batch succeeded.

    A batch may be reported many times (attempts); it counts once, by its best report.
    """
    best = batches.groupBy("job_id", "batch").agg(F.bool_or(F.col("status") == "SUCCEEDED").alias("ok"))
    counts = best.groupBy("job_id").agg(F.count(F.lit(1)).alias("batches"), F.count_if("ok").alias("succeeded"))
    if planned is None:
        return counts.withColumn("ready", F.col("batches") == F.col("succeeded"))
    joined = planned.select("job_id", "planned").join(counts, "job_id", "left").fillna(0, ["batches", "succeeded"])
    return joined.withColumn("ready", F.col("planned") == F.col("succeeded"))


def retry_outcome(attempts: DataFrame, order: Sequence[str], max_attempts: int = 3, base: float = 5.0, factor: float = 1.0) -> DataFrame:
    """Per frame: attempts made, success, total wait and terminal failure.

    Only the first ``max_attempts`` attempts count, and none after the first success. The wait after the
    k-th failure is ``base * factor**(k-1)`` seconds. The rank filter is applied on the map side, so a frame
    with endless attempts sends at most ``max_attempts`` rows per task.
    """
    rank = Window.partitionBy("frame_id").orderBy(*order)
    first = attempts.withColumn("_k", F.row_number().over(rank)).filter(F.col("_k") <= max_attempts)
    seen = first.groupBy("frame_id").agg(F.count(F.lit(1)).alias("_seen"), F.min(F.when(F.col("ok"), F.col("_k"))).alias("_ok_at"))
    made = F.coalesce("_ok_at", "_seen")
    failures = F.when(F.col("_ok_at").isNotNull(), F.col("_ok_at") - 1).otherwise(F.col("_seen"))
    wait = failures * base if factor == 1.0 else (F.pow(F.lit(factor), failures) - 1) / (factor - 1) * base
    return seen.select(
        "frame_id", made.cast("long").alias("attempts"), F.col("_ok_at").isNotNull().alias("success"),
        F.round(wait.cast("double"), 4).alias("delay_seconds"),
        (F.col("_ok_at").isNull() & (F.col("_seen") >= max_attempts)).alias("failed"),
    )


def frame_gaps(frames: DataFrame, chunk_size: int = 65536) -> DataFrame:
    """Runs of missing numbers between two present frames of a job.

    The frames of a job are gathered in slices of ``chunk_size`` numbers (so no list is longer), gaps inside a slice come
    from its sorted list, gaps between slices from the slice before: one shuffle of the frames, and a window over slices.
    """
    number = F.col("n").cast("long")
    slices = frames.filter(number.isNotNull()).groupBy("job_id", sizing.int_div(number, chunk_size).alias("_slice")).agg(F.array_sort(F.collect_set(number)).alias("_n"))
    along = Window.partitionBy("job_id").orderBy("_slice")
    slices = slices.withColumn("_before", F.lag(F.element_at("_n", -1)).over(along))
    listed = F.when(F.col("_before").isNull(), F.col("_n")).otherwise(F.concat(F.array("_before"), F.col("_n")))
    pairs = slices.select("job_id", F.explode(F.arrays_zip(F.slice(listed, 1, F.size(listed) - 1).alias("a"), F.slice(listed, 2, F.size(listed) - 1).alias("b"))).alias("_p"))
    a, b = F.col("_p.a"), F.col("_p.b")
    return pairs.filter(b - a > 1).select("job_id", (a + 1).alias("gap_start"), (b - 1).alias("gap_end"), (b - a - 1).alias("missing"))


def ordered_frames(frames: DataFrame) -> DataFrame:
    """By job, then by frame number (not text)."""
    return frames.orderBy("job_id", F.col("n").cast("long"))
