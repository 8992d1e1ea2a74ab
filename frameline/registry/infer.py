"""Queries over inference requests, results and stored content."""

from pyspark.sql import functions as F

from frameline import scratch_dir
from frameline.fixtures import cte
from frameline.operators import frames as R
from frameline.operators import infer as X
from frameline.operators import jobs as J
from frameline.registry import query
from frameline.sources import files

ANIME = "lower(is_anime) IN ('yes', 'true')"
VARIANT = "CASE WHEN model_variant IN ('real_sr', 'classical_sr', 'lightweight_sr', 'jpeg_car') THEN model_variant ELSE 'real_sr' END"
INSTALLED = ("real_sr", "classical_sr", "lightweight_sr", "jpeg_car")


@query("route_model", "P19", f"{cte('requests')} SELECT job_id, batch_id, CASE WHEN lower(face_enhanced) = 'yes' THEN 'face' WHEN {ANIME} THEN 'anime' ELSE 'standard' END AS model, CASE WHEN {ANIME} THEN 'family_a' ELSE 'family_b' END AS family FROM requests")
def _(t):
    return X.route_model(t("requests")).select("job_id", "batch_id", "model", "family")


@query("resolve_variant", "J12", f"{cte('requests')} SELECT job_id, batch_id, {VARIANT} AS variant, CASE WHEN model_variant = 'jpeg_car' THEN 1 ELSE 4 END AS scale FROM requests")
def _(t):
    return X.resolve_variant(t("requests"), INSTALLED).select("job_id", "batch_id", "variant", "scale")


FORM = "conv_id % 3"


@query("explode_requests", "X04", f"""{cte('requests')}, r AS (SELECT *, cast(substr(job_id, 6) AS bigint) AS n FROM requests)
SELECT n, batch_id AS turn, job_id, cast(batch_id AS string) AS batch_id, input_file_path, NULL AS error FROM r WHERE n % 4 IN (0, 1)
UNION ALL SELECT n, batch_id, job_id, cast(batch_id AS string), input_file_path || '.b', NULL FROM r WHERE n % 4 = 1
UNION ALL SELECT n, batch_id, job_id, cast(k AS string), input_file_path || CASE k WHEN 1 THEN '.b' ELSE '' END, NULL FROM r, range(0, 2) q(k) WHERE n % 4 = 2
UNION ALL SELECT n, batch_id, NULL, NULL, NULL, 'unreadable request' FROM r WHERE n % 4 = 3""")
def _(t):
    r = t("requests").selectExpr("cast(substr(job_id, 6) AS bigint) AS n", "batch_id AS turn", "job_id", "cast(batch_id AS string) AS batch_id", "input_file_path")
    first = "named_struct('job_id', job_id, 'batch_id', batch_id, 'input_file_path', input_file_path)"
    second = "named_struct('job_id', job_id, 'batch_id', batch_id, 'input_file_path', input_file_path || '.b')"
    paths = "array(named_struct('input_file_path', input_file_path), named_struct('input_file_path', input_file_path || '.b'))"
    body = f"CASE n % 4 WHEN 0 THEN to_json({first}) WHEN 1 THEN to_json(array({first}, {second})) WHEN 2 THEN to_json(named_struct('job_id', job_id, 'batch', {paths})) ELSE 'no json' END AS body"
    return X.explode_requests(r.selectExpr("n", "turn", body)).select("n", "turn", "job_id", "batch_id", "input_file_path", "error")


def requests_with_images(t):
    asked = X.resolve_variant(t("requests"), INSTALLED).select(
        "job_id", "batch_id", F.regexp_replace("input_file_path", "/in/", "/out/").alias("output_file_path"), F.col("variant").alias("model_key"), "image_id"
    )
    return asked.join(t.images(), "image_id", "left").drop("image_id")


def failing(model, img, row):
    if row["batch_id"] % 5 == 3:
        raise RuntimeError("out of memory")
    return X.nearest_predict(model, img, row)


def results(t):
    return X.infer(requests_with_images(t), X.nearest_loader, failing)


RESULTS = f"""sums AS (SELECT image_id, sum(v) AS v FROM pixels GROUP BY 1), results AS (SELECT job_id, batch_id, CASE WHEN v IS NULL OR batch_id % 5 = 3 THEN 500 ELSE 200 END AS status,
 CASE WHEN v IS NULL THEN NULL WHEN batch_id % 5 = 3 THEN NULL ELSE replace(input_file_path, '/in/', '/out/') END AS output_file_path,
 CASE WHEN v IS NULL THEN 'Failed to read image' WHEN batch_id % 5 = 3 THEN 'out of memory' END AS error,
 CASE WHEN v IS NULL OR batch_id % 5 = 3 THEN 0 WHEN model_variant = 'jpeg_car' THEN v ELSE v * 16 END AS checksum FROM requests r LEFT JOIN sums s ON s.image_id = r.image_id)"""


@query("infer", "X01 X02", f"{cte('requests', 'pixels')}, {RESULTS} SELECT * FROM results")
def _(t):
    return results(t).select("job_id", "batch_id", "status", "output_file_path", "error", X.checksum(F.col("data")).alias("checksum"))


@query("batch_rollup", "A04", f"{cte('requests', 'pixels')}, {RESULTS} SELECT job_id, 200 AS status, count(*) AS total_processed, count(*) FILTER (WHERE status <> 200) AS failed FROM results GROUP BY job_id")
def _(t):
    return X.batch_rollup(results(t).select("job_id", "status"))


@query("nested_results", "A04 O03", f"{cte('requests', 'pixels')}, {RESULTS} SELECT job_id, batch_id // 4 AS sub_batch, string_agg(batch_id || ':' || status, ',' ORDER BY batch_id) AS batch_results FROM results GROUP BY 1, 2")
def _(t):
    nested = X.nested_results(results(t), 4)
    return nested.withColumn("batch_results", F.array_join(F.transform("batch_results", lambda r: F.concat_ws(":", r["batch_id"], r["status"])), ","))


@query("ordered_results", "O03", f"{cte('requests', 'pixels')}, {RESULTS} SELECT job_id, batch_id, status FROM results ORDER BY job_id, batch_id")
def _(t):
    return X.ordered_results(results(t)).select("job_id", "batch_id", "status")


def stored(t):
    return t("payloads").select(
        F.concat(F.lit("job-"), F.col("doc_id") % 7).alias("job_id"), F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("key"),
        F.encode("text", "UTF-8").alias("content"),
    )


@query("gzip_content", "X03", "SELECT 'doc_' || doc_id || '.txt' AS key, strlen(text) AS size, md5(text) AS content_md5 FROM documents")
def _(t):
    back = X.gunzip_content(X.gzip_content(stored(t)))
    return back.select("key", F.col("new_size").alias("size"), F.md5("content").alias("content_md5"))


@query("write_frames", "S04", "SELECT 'job-' || doc_id % 7 AS job_id, 'doc_' || doc_id || '.txt' AS key, k AS copy, md5(text) AS content_md5 FROM documents, (VALUES ('plain'), ('gzip')) v(k)")
def _(t):
    path = scratch_dir(t.spark, "frames")
    files.write_frames(stored(t), path, compress=True)
    back = t.spark.read.parquet(path).withColumn("copy", F.when(F.col("key").endswith(".gz"), "gzip").otherwise("plain"))
    plain = X.gunzip_content(back, keep=("job_id", "copy"))
    return plain.select("job_id", "key", "copy", F.md5("content").alias("content_md5"))


@query("read_frames", "S02", "SELECT source, cast(sum(strlen(text) + 1) AS bigint) AS bytes FROM documents GROUP BY source")
def _(t):
    path = scratch_dir(t.spark, "content")
    t.raw("documents").select("source", "text").write.partitionBy("source").option("maxRecordsPerFile", 100_000).text(path)
    found = files.read_frames(t.spark, path, "*.txt")
    source = F.regexp_extract("key", "/source=([^/]*)/", 1)
    return found.groupBy(source.alias("source")).agg(F.sum(F.octet_length("content").cast("long")).alias("bytes"))


@query("inventory_listing", "S01", "SELECT source, cast(sum(strlen(text) + 1) AS bigint) AS bytes FROM documents GROUP BY source")
def _(t):
    path = scratch_dir(t.spark, "listing")
    t.raw("documents").select("source", "text").write.partitionBy("source").option("maxRecordsPerFile", 100_000).text(path)
    found = files.read_inventory(t.spark, path, format="binaryFile").filter(F.col("key").endswith(".txt"))
    return found.groupBy(F.regexp_extract("key", "/source=([^/]*)/", 1).alias("source")).agg(F.sum("size").alias("bytes"))


@query("read_manifest", "S07", f"{cte('requests')} SELECT '/data/' || replace(input_file_path, 's3://', '') AS path FROM requests")
def _(t):
    path = scratch_dir(t.spark, "manifest")
    t("requests").select(F.concat(F.regexp_replace("input_file_path", "s3://", ""), F.lit(" 480x320"))).write.text(path)
    return files.read_manifest(t.spark, path, "/data")


@query("read_pair_manifest", "S08", "SELECT CASE WHEN vec_id % 9 <> 0 THEN '/gt/' || vec_id || '.png' END AS gt_path, CASE WHEN vec_id % 9 <> 0 THEN '/lq/' || vec_id || 'x4.png' END AS lq_path, CASE WHEN vec_id % 9 = 0 THEN 'expected two paths: ' || vec_id || '.png' END AS error FROM embeddings")
def _(t):
    path = scratch_dir(t.spark, "pairs")
    t.raw("embeddings").selectExpr("CASE WHEN vec_id % 9 = 0 THEN vec_id || '.png' ELSE vec_id || '.png, ' || vec_id || 'x4.png' END").write.text(path)
    return files.read_pair_manifest(t.spark, path, "/gt", "/lq/")


@query("write_report", "S09", f"{cte('jobs')} SELECT status, count(*) AS jobs FROM jobs GROUP BY status")
def _(t):
    path = scratch_dir(t.spark, "report")
    files.write_report(J.jobs_by(t("jobs"), "status"), path)
    return t.spark.read.schema("status string, jobs bigint").option("mode", "FAILFAST").json(path)


@query("checkpoint_resume", "S11 J10", f"{cte('frames')} SELECT DISTINCT job_id, n FROM frames WHERE n > 3")
def _(t):
    path = scratch_dir(t.spark, "processed")
    frames = t("frames").select("job_id", "n").distinct()
    for name, upto in (("0001", 1), ("0002", 3)):
        files.write_checkpoint(frames.filter(F.col("n") <= upto), path, name)
    checkpoints = files.read_checkpoint(t.spark, path)
    return R.remaining_frames(frames, checkpoints, checkpoints.select("job_id", "checkpoint_id").distinct())
