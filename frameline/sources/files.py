"""Readers and writers: inventories, frame content, events, manifests, reports, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameline import schemas


def read_inventory(spark: SparkSession, path: str, prefix: str | None = None, format: str = "parquet") -> DataFrame:
    """Key, size and time of stored objects.

    ``parquet`` reads an inventory table, with the prefix test pushed to the scan; ``binaryFile`` lists a
    folder and never opens a file, as the content column is not selected.
    """
    if format == "binaryFile":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        rows = files.select(
            F.col("path").alias("key"), F.col("length").alias("size"),
            F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        )
    else:
        rows = spark.read.format(format).load(path)
    return rows if prefix is None else rows.filter(F.col("key").startswith(prefix))


def read_frames(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Raw bytes per frame file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("key"), F.col("length").alias("size"), "content")


def write_frames(frames: DataFrame, path: str, compress: bool = False) -> None:
    """Store ``(job_id, key, content)`` by job; with ``compress`` a gzip twin of each frame is stored too.

    Rows are rebalanced by job before the write: adaptive execution cuts a job with very many frames into parts of the
    advisory size, each written by a task of its own, and puts small jobs together, which end up in few files.
    """
    from frameline.operators.infer import gzip_content

    rows = frames.select("job_id", "key", "content")
    if compress:
        twin = gzip_content(rows, keep=("job_id",)).select("job_id", "key", "content")
        rows = rows.unionByName(twin)
    rows.hint("rebalance", "job_id").write.mode("overwrite").partitionBy("job_id").option("maxRecordsPerFile", 100_000).parquet(path)


def _upload_keys(text: Column, prefix: str | None, suffix: str | None) -> Column | None:
    """Keep rows with any record whose key has the prefix and suffix; malformed rows stay."""
    if prefix is None and suffix is None:
        return None
    keys = F.from_json(text, schemas.UPLOAD_EVENT)["Records"]["s3"]["object"]["key"]

    def wanted(key: Column) -> Column:
        ok = F.lit(True)
        if prefix is not None:
            ok = ok & key.startswith(prefix)
        if suffix is not None:
            ok = ok & key.endswith(suffix)
        return F.coalesce(ok, F.lit(True))

    return F.coalesce(F.exists(keys, wanted), F.lit(True))


def filter_uploads(events: DataFrame, prefix: str | None = None, suffix: str | None = None) -> DataFrame:
    condition = _upload_keys(F.col("body"), prefix, suffix)
    return events if condition is None else events.filter(condition)


def read_upload_events(
    spark: SparkSession, path: str, prefix: str | None = None, suffix: str | None = None, streaming: bool = False
) -> DataFrame:
    """Upload notifications, one JSON document per line, as a ``body`` column."""
    reader = spark.readStream if streaming else spark.read
    events = reader.text(path).withColumnRenamed("value", "body")
    return filter_uploads(events, prefix, suffix)


def join_path(root: str | Column, name: Column) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.when(name.startswith("/"), name).otherwise(F.concat_ws("/", F.rtrim(root, F.lit("/")), name))


def read_manifest(spark: SparkSession, path: str, root: str) -> DataFrame:
    """One image path per line: the first space-separated token below ``root``."""
    return manifest_paths(spark.read.text(path), root)


def manifest_paths(lines: DataFrame, root: str) -> DataFrame:
    token = F.get(F.split(F.trim("value"), " "), F.lit(0))
    return lines.select(join_path(root, token).alias("path"))


def read_pair_manifest(spark: SparkSession, path: str, gt_root: str, lq_root: str) -> DataFrame:
    """``gt, lq`` per line; a line without exactly two parts has an error instead of paths."""
    return pair_manifest_paths(spark.read.text(path), gt_root, lq_root)


def pair_manifest_paths(lines: DataFrame, gt_root: str, lq_root: str) -> DataFrame:
    parts = F.split(F.trim("value"), ", ")
    good = F.size(parts) == 2
    return lines.select(
        F.when(good, join_path(gt_root, F.get(parts, F.lit(0)))).alias("gt_path"),
        F.when(good, join_path(lq_root, F.get(parts, F.lit(1)))).alias("lq_path"),
        F.when(~good, F.concat(F.lit("expected two paths: "), F.col("value"))).alias("error"),
    )


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_checkpoint(frames: DataFrame, path: str, checkpoint_id: str) -> None:
    """Processed frame keys of one checkpoint, distinct and sorted inside each file."""
    keys = frames.select("job_id", "n").distinct().sortWithinPartitions("job_id", "n")
    keys.write.mode("overwrite").parquet(f"{path.rstrip('/')}/checkpoint_id={checkpoint_id}")


def read_checkpoint(spark: SparkSession, path: str, checkpoint_id: str | None = None) -> DataFrame:
    """One checkpoint (partition pruned) or all of them."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows.withColumn("checkpoint_id", F.col("checkpoint_id").cast("string"))
    return rows if checkpoint_id is None else rows.filter(F.col("checkpoint_id") == checkpoint_id)
