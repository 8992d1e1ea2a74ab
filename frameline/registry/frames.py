"""Queries over frame manifests."""

from pyspark.sql import functions as F

from frameline.fixtures import cte
from frameline.functions import names, sizing
from frameline.operators import frames as R
from frameline.registry import query

SIZE = "CASE WHEN frames_total > 1000 THEN 20 WHEN frames_total > 500 THEN 15 WHEN frames_total > 200 THEN 10 ELSE 5 END"
RATE = "CASE fps WHEN '30000/1001' THEN 29.97 WHEN '25/1' THEN 25.0 WHEN '24000/1001' THEN 23.97 END"


def sized(t):
    return t("probes").select("job_id", "frames_total", F.get(F.split("vres", "x"), F.lit(0)).cast("int").alias("width"), F.get(F.split("vres", "x"), F.lit(1)).cast("int").alias("height"))


@query("frame_key", "P08", f"{cte('probes')} SELECT job_id, 'clip_' || lpad(cast(1 + frames_total // 2 AS string), cast(length(cast(frames_total AS string)) AS int), '0') || '.png' AS frame_key FROM probes")
def _(t):
    middle = sizing.int_div(F.col("frames_total"), 2) + 1
    return t("probes").select("job_id", names.frame_key(F.lit("clip"), middle, F.col("frames_total"), F.lit("png")).alias("frame_key"))


@query("encode_plan", "P14", f"""{cte('probes')}, p AS (SELECT job_id, quality, CASE frames_total % 6 WHEN 0 THEN 'mp4' WHEN 1 THEN 'webm' WHEN 2 THEN 'mkv' WHEN 3 THEN 'mov' WHEN 4 THEN 'gif' END AS format, CASE frames_total % 3 WHEN 0 THEN '0' WHEN 1 THEN '5M' END AS bitrate FROM probes)
SELECT job_id AS task_id, CASE quality WHEN 'low' THEN 'fast' WHEN 'high' THEN 'slow' WHEN 'ultra' THEN 'veryslow' ELSE 'medium' END AS preset,
CASE quality WHEN 'low' THEN 28 WHEN 'high' THEN 18 WHEN 'ultra' THEN 15 ELSE 23 END AS crf, CASE WHEN format = 'webm' THEN 'libvpx-vp9' ELSE 'libx264' END AS codec,
CASE WHEN format IN ('webm', 'mkv', 'mov') THEN format ELSE 'mp4' END AS format, 'yuv420p' AS pixel_format, CASE WHEN bitrate <> '0' THEN bitrate END AS bitrate FROM p""")
def _(t):
    return R.encode_plan(t("probes").selectExpr(
        "job_id AS task_id", "quality", "CASE frames_total % 6 WHEN 0 THEN 'mp4' WHEN 1 THEN 'webm' WHEN 2 THEN 'mkv' WHEN 3 THEN 'mov' WHEN 4 THEN 'gif' END AS format",
        "CASE frames_total % 3 WHEN 0 THEN '0' WHEN 1 THEN '5M' END AS bitrate",
    ))


@query("frame_rate", "P15", f"{cte('probes')} SELECT job_id, fps, cast({RATE} AS double) AS frame_rate FROM probes")
def _(t):
    return t("probes").select("job_id", "fps", sizing.frame_rate(F.col("fps")).alias("frame_rate"))


@query("batch_size_by_frames", "P16", f"{cte('probes')} SELECT job_id, {SIZE} AS batch_size FROM probes")
def _(t):
    return t("probes").select("job_id", sizing.batch_size_by_frames(F.col("frames_total")).alias("batch_size"))


@query("batch_size_by_memory", "P17", f"""{cte('fleet')}, m AS (SELECT fleet_id, CASE WHEN fleet_id % 10 = 9 THEN NULL ELSE fleet_id * 500 END AS free_mb FROM fleet)
SELECT fleet_id, CASE WHEN fleet_id * 500 > 30000 THEN 4 WHEN fleet_id * 500 > 15000 THEN 2 ELSE 1 END AS host_batch, CASE WHEN free_mb IS NULL THEN 4 ELSE cast(least(greatest(floor(free_mb * 0.8 / 500), 1), 16) AS int) END AS gpu_batch FROM m""")
def _(t):
    free = F.expr("CASE WHEN fleet_id % 10 = 9 THEN NULL ELSE fleet_id * 500 END")
    return t("fleet").select("fleet_id", sizing.batch_size_by_host_memory(F.col("fleet_id") * 500).alias("host_batch"), sizing.batch_size_by_gpu_memory(free).alias("gpu_batch"))


@query("batch_resources", "P18", f"""{cte('probes')}, p AS (SELECT job_id, cast(split_part(vres, 'x', 1) AS bigint) * cast(split_part(vres, 'x', 2) AS bigint) * 4 * ({SIZE}) // 1048576 + 2048 AS mb FROM probes), q AS (SELECT job_id, least(greatest(mb, 2048), 30720) AS memory_mb FROM p)
SELECT job_id, memory_mb, least(greatest(memory_mb // 4096 + 2, 2), 16) AS vcpus FROM q""")
def _(t):
    plan = sized(t).withColumn("batch_size", sizing.batch_size_by_frames(F.col("frames_total")))
    return R.batch_resources(plan).select("job_id", "memory_mb", "vcpus")


@query("choose_tile", "P20", f"""{cte('probes')} SELECT job_id, CASE WHEN frames_total % 5 = 0 THEN 256 WHEN vres = '1920x1080' THEN 1024 ELSE 0 END AS tile FROM probes""")
def _(t):
    asked = F.when(F.col("frames_total") % 5 == 0, 256)
    return sized(t).select("job_id", sizing.choose_tile(F.col("height"), F.col("width"), asked).alias("tile"))


@query("keep_recompressed", "P21", f"""{cte('objects')}, n AS (SELECT key, size, cast(floor(size * cast(CASE WHEN size % 2048 = 0 THEN 0.85 ELSE 0.95 END AS double)) AS bigint) AS new_size FROM objects)
SELECT key, size, new_size, (size - new_size) * 100 // size AS reduction_percent, (size - new_size) * 100 // size > 10 AS keep_new FROM n""")
def _(t):
    smaller = F.expr("cast(floor(size * cast(CASE WHEN size % 2048 = 0 THEN 0.85 ELSE 0.95 END AS double)) AS bigint)")
    return R.keep_recompressed(t("objects").select("key", "size", smaller.alias("new_size")))


@query("plan_frame_batches", "W04", f"""{cte('probes')}, s AS (SELECT job_id, frames_total, cast({SIZE} AS bigint) AS batch_size FROM probes), b AS (SELECT *, unnest(range(0, (frames_total + batch_size - 1) // batch_size)) AS batch FROM s)
SELECT job_id, batch, batch_size, batch * batch_size + 1 AS start_frame, least(batch * batch_size + batch_size, frames_total) AS end_frame FROM b""")
def _(t):
    return R.plan_frame_batches(t("probes").select("job_id", "frames_total")).drop("frames_total")


@query("archive_batches", "W04", f"""{cte('frames')}, f AS (SELECT DISTINCT job_id, n FROM frames), r AS (SELECT job_id, n, (row_number() OVER (PARTITION BY job_id ORDER BY n) - 1) // 2 AS archive FROM f)
SELECT job_id, archive, cast(min(n) AS bigint) AS first_frame, cast(max(n) AS bigint) AS last_frame, count(*) AS frames FROM r GROUP BY job_id, archive""")
def _(t):
    frames = t("frames").select("job_id", F.col("n").cast("long").alias("n")).distinct()
    rows = R.plan_batches(frames, ["job_id"], ["n"], sizing.int_div(F.col("n"), 65536), 2, "archive")
    return rows.groupBy("job_id", "archive").agg(F.min("n").alias("first_frame"), F.max("n").alias("last_frame"), F.count(F.lit(1)).alias("frames"))


@query("missing_frames", "J08", f"""{cte('frames')}, e AS (SELECT job_id, unnest(range(1, 8)) AS n FROM (SELECT DISTINCT job_id FROM frames) j)
SELECT job_id, n FROM e WHERE NOT EXISTS (SELECT 1 FROM frames f WHERE f.job_id = e.job_id AND f.n = e.n)""")
def _(t):
    frames = t("frames")
    tasks = frames.select("job_id").distinct().withColumn("total", F.lit(7).cast("long"))
    return R.missing_frames(tasks, frames)


@query("cache_status", "J09", f"""{cte('frames')} SELECT job_id, n, etag, CASE WHEN cache_etag IS NULL THEN 'miss' WHEN cache_etag = etag THEN 'hit' ELSE 'stale' END AS cache FROM frames""")
def _(t):
    frames = t("frames")
    cache = frames.filter("cache_etag IS NOT NULL").select("job_id", "n", F.col("cache_etag").alias("etag"))
    return R.cache_status(frames.select("job_id", "n", "etag"), cache, ["job_id", "n"])


@query("remaining_frames", "J10", f"""{cte('frames')}, f AS (SELECT DISTINCT job_id, n, cast(substr(job_id, 5) AS bigint) AS k FROM frames)
SELECT job_id, n FROM f WHERE NOT (k % 2 = 0 AND n <= 1 + k % 6)""")
def _(t):
    frames = t("frames").select("job_id", "n").distinct()
    number = F.expr("cast(substr(job_id, 5) AS bigint)")
    early = frames.filter(F.col("n") <= 1 + number % 6).withColumn("checkpoint_id", F.lit("0002"))
    older = frames.filter(F.col("n") <= 7).withColumn("checkpoint_id", F.lit("0001"))
    unfinished = frames.withColumn("checkpoint_id", F.lit("0003"))
    markers = frames.filter(number % 2 == 0).select("job_id", F.explode(F.array(F.lit("0001"), F.lit("0002"))).alias("checkpoint_id")).distinct()
    return R.remaining_frames(frames, early.unionByName(older).unionByName(unfinished), markers)


@query("recompose_plan", "J11", f"""{cte('frames', 'probes')}, c AS (SELECT job_id, count(DISTINCT n) AS frames FROM frames GROUP BY job_id), p AS (SELECT job_id, cast({RATE} AS double) AS fps, audio_seconds FROM probes),
v AS (SELECT p.job_id, coalesce(frames, 0) AS frames, fps, audio_seconds, round(coalesce(frames, 0) / nullif(fps, 0), 4) AS video_seconds FROM p LEFT JOIN c ON p.job_id = c.job_id)
SELECT *, least(video_seconds, audio_seconds) AS output_seconds FROM v""")
def _(t):
    probes = t("probes")
    audio = probes.filter("acodec IS NOT NULL").select("job_id", "audio_seconds")
    return R.recompose_plan(probes.select("job_id", sizing.frame_rate(F.col("fps")).alias("fps")), t("frames"), audio)


BATCHED = "b AS (SELECT 'task-' || cast(frame_id % 97 AS string) AS job_id, cast(floor(frame_id / 20) AS bigint) AS batch, CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END AS status FROM attempts)"


@query("ready_to_encode", "A12", f"""{cte('attempts')}, {BATCHED}, o AS (SELECT job_id, batch, bool_or(status = 'SUCCEEDED') AS ok FROM b GROUP BY 1, 2)
SELECT job_id, count(*) AS batches, count(*) FILTER (WHERE ok) AS succeeded, bool_and(ok) AS ready FROM o GROUP BY job_id""")
def _(t):
    return R.ready_to_encode(t("attempts").selectExpr(
        "'task-' || cast(frame_id % 97 AS string) AS job_id", "cast(floor(frame_id / 20) AS bigint) AS batch", "CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END AS status"
    ))


ORDER = ["at", "seq", "p", "s"]


def retry_sql(limit: int, wait_ok: str, wait_bad: str) -> str:
    return f"""{cte('attempts')}, k AS (SELECT frame_id, ok, row_number() OVER (PARTITION BY frame_id ORDER BY attempts."at", seq, p, s, ok DESC) AS k FROM attempts),
s AS (SELECT frame_id, count(*) AS seen, min(CASE WHEN ok THEN k END) AS w FROM k WHERE k <= {limit} GROUP BY frame_id)
SELECT frame_id, coalesce(w, seen) AS attempts, w IS NOT NULL AS success, cast(CASE WHEN w IS NOT NULL THEN {wait_ok} ELSE {wait_bad} END AS double) AS delay_seconds, w IS NULL AND seen >= {limit} AS failed FROM s"""


@query("retry_outcome", "W05", retry_sql(3, "5 * (w - 1)", "5 * seen"))
def _(t):
    return R.retry_outcome(t("attempts").withColumn("nok", F.expr("NOT ok")), [*ORDER, "nok"])


@query("retry_outcome_backoff", "W05", retry_sql(5, "5 * (power(2, w - 1) - 1)", "5 * (power(2, seen) - 1)"))
def _(t):
    return R.retry_outcome(t("attempts").withColumn("nok", F.expr("NOT ok")), [*ORDER, "nok"], 5, 5.0, 2.0)


@query("frame_gaps", "W06", f"""{cte('frames')}, f AS (SELECT DISTINCT job_id, cast(n AS bigint) AS n FROM frames), l AS (SELECT job_id, n, lead(n) OVER (PARTITION BY job_id ORDER BY n) AS m FROM f)
SELECT job_id, n + 1 AS gap_start, m - 1 AS gap_end, m - n - 1 AS missing FROM l WHERE m - n > 1""")
def _(t):
    return R.frame_gaps(t("frames"))


@query("ordered_frames", "O01", f"{cte('frames')} SELECT job_id, n, etag FROM frames ORDER BY job_id, n")
def _(t):
    return R.ordered_frames(t("frames").select("job_id", "n", "etag"))
