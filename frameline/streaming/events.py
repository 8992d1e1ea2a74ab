"""Streams of uploads, messages, warnings and objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.operators import audit, inventory, jobs


def jobs_from_uploads(events: DataFrame, heads: DataFrame | None, now: Column, job_id: Column | None = None) -> DataFrame:
    """Upload notifications to job records; object metadata, if any, is a static table."""
    return jobs.make_jobs(jobs.unpack_upload_event(events), heads, now, job_id)


def dedupe_messages(messages: DataFrame, id: str = "message_id", horizon: str = "1 hour", time: str = "ts") -> DataFrame:
    """One message per id within the horizon. Which copy survives depends on arrival; the set of ids does not."""
    return messages.withWatermark(time, horizon).dropDuplicatesWithinWatermark([id])


def fan_out(messages: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """One row per message and queue whose condition holds; write it partitioned by ``queue``."""
    queues = F.array_compact(F.array(*[F.when(condition, queue) for queue, condition in routes.items()]))
    return messages.withColumn("queue", F.explode(queues))


def dead_letters_batch(receives: DataFrame, limit: int = 5) -> DataFrame:
    """Messages received more than ``limit`` times."""
    counts = receives.groupBy("message_id").agg(F.count(F.lit(1)).alias("receives"))
    return counts.filter(F.col("receives") > limit).select("message_id")


def incremental_orphans(objects: DataFrame, known_jobs: DataFrame, new_jobs: DataFrame | None = None, horizon: str = "1 day", delay: str = "1 hour", salts: int = 16) -> DataFrame:
    """New objects of a listing stream that belong to no known job (static table) and to no job that arrives in time.

    With ``new_jobs``, a stream of ``job_id, ts``, an object (``ts``) is given out only when the watermark has passed
    its time by ``horizon`` and no job of its id has come with a time at most ``horizon`` before or after. Without it, an
    object is judged by the static table alone. The objects of one job are spread over ``salts`` groups, its one row is
    repeated for each.
    """
    unknown = inventory.with_job(objects).join(known_jobs.select("job_id"), "job_id", "left_anti")
    if new_jobs is None:
        return unknown
    left = unknown.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).withWatermark("ts", delay).alias("o")
    right = new_jobs.select("job_id", F.col("ts").alias("job_ts")).withWatermark("job_ts", delay)
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("j")
    near = F.expr(f"j.job_ts >= o.ts - INTERVAL {horizon} AND j.job_ts <= o.ts + INTERVAL {horizon}")
    met = left.join(right, (F.col("o.job_id") == F.col("j.job_id")) & (F.col("o.salt") == F.col("j.salt")) & near, "left_outer")
    return met.filter(F.col("j.job_ts").isNull()).select("o.*").drop("salt")


def audit_findings(events: DataFrame, delay: str = "10 minutes", period: str = "5 minutes", threshold: int = 1) -> DataFrame:
    """Findings per kind and period; a period with at least ``threshold`` findings is an alarm."""
    hits = audit.audit_hits(events).withWatermark("ts", delay)
    counts = hits.groupBy(F.window("ts", period).alias("_w"), "finding").agg(F.count(F.lit(1)).alias("findings"))
    state = F.when(F.col("findings") >= threshold, "ALARM").otherwise("OK")
    return counts.select(F.col("_w.start").alias("period_start"), "finding", "findings", state.alias("state"))
