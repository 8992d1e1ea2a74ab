"""Stored objects: retention, orphans, compression, lifecycle and maintenance reports.

Nothing is deleted; every job here gives a table of what should be done.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.functions import names
from frameline.operators.frames import plan_batches
from frameline.operators.skew import salted_join

DELETE_CALL_SIZE = 1000

# Lifecycle rules of the intermediate store as (prefix, action, days); "" means any key.
LIFECYCLE_RULES = (
    ("", "IA", 7),
    ("", "GLACIER", 14),
    ("", "EXPIRE", 30),
    ("frames/", "IA", 3),
    ("frames/", "EXPIRE", 15),
    ("temp/", "EXPIRE", 1),
)
# Rules of all stores as (store, prefix, action, days). ABORT is for uploads that were never completed.
STORE_RULES = (
    ("source", "", "IA", 30),
    ("source", "", "GLACIER", 90),
    ("source", "", "DEEP_ARCHIVE", 180),
    ("source", "", "ABORT", 1),
    *(("processed", *rule) for rule in LIFECYCLE_RULES),
    ("processed", "", "ABORT", 1),
    ("final", "", "IA", 30),
    ("final", "", "GLACIER", 90),
    ("final", "", "ABORT", 1),
)
STORE_RULE = "bucket string, prefix string, action string, days int"
# Later actions replace earlier ones.
ACTION_RANK = {"IA": 1, "GLACIER": 2, "DEEP_ARCHIVE": 3, "EXPIRE": 4}


def prefer_compressed(objects: DataFrame) -> DataFrame:
    """One row per object: its ``.gz`` twin where there is one, else the plain object (one combined aggregation)."""
    gz = F.col("key").endswith(".gz")
    plain = F.regexp_replace("key", r"\.gz$", "")
    held = F.struct(gz.alias("is_gz"), *objects.columns)
    best = objects.groupBy(plain.alias("name")).agg(F.max(held).alias("best"))
    return best.select("name", "best.*")


def completed_before(jobs: DataFrame, now: Column, days: int) -> DataFrame:
    return jobs.filter((F.col("status") == "COMPLETED") & (F.col("updated_at") < now - F.make_dt_interval(F.lit(days))))


def compressible(objects: DataFrame, enabled: bool = True) -> DataFrame:
    return objects.filter(~F.col("key").endswith(".gz")) if enabled else objects.limit(0)


def with_job(objects: DataFrame, part: int = 0) -> DataFrame:
    return objects.withColumn("job_id", names.key_part(F.col("key"), part))


def orphan_objects(objects: DataFrame, jobs: DataFrame, part: int = 0) -> DataFrame:
    """Objects whose job part names no known job."""
    return salted_join(with_job(objects, part), jobs.select("job_id"), ["job_id"], "left_anti")


def expired_objects(objects: DataFrame, jobs: DataFrame, now: Column, days: int, part: int = 0) -> DataFrame:
    """Objects of jobs finished before the retention limit."""
    done = completed_before(jobs, now, days).select("job_id")
    return salted_join(with_job(objects, part), done, ["job_id"], "left_semi")


def _per_job(objects: DataFrame, part: int = 0) -> DataFrame:
    return with_job(objects, part).groupBy("job_id").agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes"))


def orphan_bytes_by_job(objects: DataFrame, jobs: DataFrame, part: int = 0) -> DataFrame:
    """Objects and bytes per unknown job. Objects are reduced to one row per job before the anti join."""
    return _per_job(objects, part).join(jobs.select("job_id"), "job_id", "left_anti")


def cleanup_summary(jobs: DataFrame, objects: DataFrame, now: Column, days: int, part: int = 0) -> DataFrame:
    """Objects to delete per expired job, 0 where there are none."""
    done = completed_before(jobs, now, days).select("job_id")
    counted = done.join(_per_job(objects, part).select("job_id", "objects"), "job_id", "left")
    return counted.select("job_id", F.lit("success").alias("status"), F.coalesce("objects", F.lit(0)).alias("deleted_count"))


def compression_summary(results: DataFrame) -> DataFrame:
    """Per job: objects compressed and objects tried. ``results`` has ``job_id, ok``."""
    return results.groupBy("job_id").agg(F.count_if("ok").alias("compressed_count"), F.count(F.lit(1)).alias("total_objects"))


def orphan_summary(results: DataFrame) -> DataFrame:
    """Totals over deletion results ``(kind, key, bytes, error)``; :func:`orphan_errors` lists the errors as rows."""
    ok = F.col("error").isNull()
    return results.groupBy("kind").agg(
        F.count(F.lit(1)).alias("total_orphaned"), F.count_if(ok).alias("deleted_count"),
        F.count_if(~ok).alias("errors"), F.sum(F.when(ok, F.col("bytes"))).alias("deleted_bytes"),
    )


def orphan_errors(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNotNull()).select("kind", "key", "error")


def delete_calls(objects: DataFrame, keys: tuple[str, ...] = ("job_id",), size: int = DELETE_CALL_SIZE) -> DataFrame:
    """Numbers the objects of each job into delete calls of at most ``size`` keys.

    The order inside a job is by key hash: a call is a set, and hash chunks spread one huge job over many tasks.
    """
    hashed = objects.withColumn("_h", F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("long"))
    return plan_batches(hashed, list(keys), ["_h", "key"], F.shiftright("_h", 22), size, "call").drop("_h")


def lifecycle_action(objects: DataFrame, now: Column, rules: Iterable[tuple[str, str, int]] = LIFECYCLE_RULES, any_part: bool = True) -> DataFrame:
    """Storage action due per object at ``now``: the furthest action of all rules that match and are due.

    Rules are few and given as a list, so they become one array expression per row: no join, no shuffle.
    With ``any_part`` a prefix may start at any path part, else only at the start of the key.
    """
    age = F.floor((F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_modified").cast("timestamp"))) / 86400)
    due = []
    for prefix, action, days in rules:
        key = F.col("key")
        hit = F.lit(True) if prefix == "" else (key.startswith(prefix) | key.contains("/" + prefix)) if any_part else key.startswith(prefix)
        due.append(F.when(hit & (age >= days), F.struct(F.lit(ACTION_RANK[action]).alias("rank"), F.lit(action).alias("action"))))
    furthest = F.array_max(F.array(*due))
    return objects.withColumn("age_days", age).withColumn("action", F.coalesce(furthest["action"], F.lit("NONE")))


def store_lifecycle(objects: DataFrame, rules: DataFrame, now: Column, any_part: bool = True) -> DataFrame:
    """Storage action due per object at ``now`` under a table of rules for all stores.

    ``objects`` have ``bucket``, ``key``, ``last_modified`` and may have ``incomplete`` (an upload that was begun and not
    ended: only ABORT applies to it, and only to it). ``rules`` have the columns of ``STORE_RULE``; of the actions that are
    due the furthest wins, ``expires_after`` is the lowest expiry of all rules that match, due or not. A null bucket or
    key, and a bucket without rules, give NONE. With ``any_part`` a prefix may start at any path part.

    A prefix join without an exploded row: the rules of a bucket become one map from prefix to what is due when, and the
    beginnings of a key that are as long as some prefix are looked up in it. The rules of a store are bounded by the store
    itself (a thousand a bucket), so the side that is joined has a bounded row for each bucket and Spark broadcasts it by
    its size; objects are neither shuffled nor multiplied.
    """
    ranks = F.create_map(*[F.lit(x) for pair in {**ACTION_RANK, "ABORT": 0}.items() for x in pair])
    step = F.struct(ranks[F.col("action")].alias("rank"), "action", "days")
    of_prefix = rules.groupBy("bucket", "prefix").agg(F.collect_list(step).alias("steps"))
    of_bucket = of_prefix.groupBy("bucket").agg(
        F.map_from_entries(F.collect_list(F.struct("prefix", "steps"))).alias("_rules"), F.collect_set(F.length("prefix")).alias("_sizes")
    )
    key = F.coalesce("key", F.lit(""))
    parts = F.split(key, "/")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/")) if any_part else F.array(key)
    beginnings = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.transform(F.filter("_sizes", lambda n: n <= F.length(s)), lambda n: F.substring(s, F.lit(1), n)))))
    steps = F.flatten(F.filter(F.transform(beginnings, lambda b: F.try_element_at("_rules", b)), lambda x: x.isNotNull()))
    age = F.floor((F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_modified").cast("timestamp"))) / 86400)
    incomplete = F.coalesce("incomplete", F.lit(False)) if "incomplete" in objects.columns else F.lit(False)
    matching = F.filter(F.col("_steps"), lambda x: incomplete == (x["action"] == "ABORT"))
    furthest = F.array_max(F.filter(matching, lambda x: F.col("age_days") >= x["days"]))
    lowest = F.array_min(F.transform(F.filter(matching, lambda x: x["action"] == "EXPIRE"), lambda x: x["days"]))
    found = objects.withColumn("age_days", age).join(of_bucket, "bucket", "left")
    found = found.withColumn("_steps", F.when(F.col("key").isNotNull(), F.coalesce(steps, F.array().cast("array<struct<rank:int,action:string,days:int>>"))))
    return found.select(*objects.columns, "age_days", F.coalesce(furthest["action"], F.lit("NONE")).alias("action"), lowest.alias("expires_after"))


def maintenance_report(**kinds: DataFrame) -> DataFrame:
    """All findings under one another: ``kind, id, bytes`` per named input having ``id, bytes``."""
    report = None
    for kind, rows in kinds.items():
        part = rows.select(F.lit(kind).alias("kind"), "id", "bytes")
        report = part if report is None else report.unionByName(part)
    return report
