"""Instances, endpoints, volumes and fleets: selection, idleness, leaks and capacity."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.operators.skew import salted_join

# Fulfilled percentage below which a share of the gap is bought on demand.
SHORTAGE_POLICY = ((50, "aggressive", 0.75), (80, "balanced", 0.5))
SHORTAGE_REST = ("minimal", 0.25)
KEEP_TAG = ("KeepOrphaned", "true")
EXCLUDE_TAG = ("AutoShutdownExclude", "true")


def has_tag(key: str, value: str) -> Column:
    return F.coalesce(F.exists("tags", lambda t: (t["Key"] == key) & (t["Value"] == value)), F.lit(False))


def without_tag(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows not carrying the tag; no tags at all counts as not carrying it."""
    return df.filter(~has_tag(key, value))


def select_resources(df: DataFrame, state: str | None = None, tag: tuple[str, str] | None = None, prefix: str | None = None,
                     state_column: str = "state", name_column: str = "resource_id") -> DataFrame:
    """By state, by tag (value ``*`` keeps all) and by name prefix; each is optional."""
    if state is not None:
        df = df.filter(F.col(state_column) == state)
    if tag is not None and tag[1] != "*":
        df = df.filter(has_tag(*tag))
    if prefix:
        df = df.filter(F.col(name_column).startswith(prefix))
    return df


def orphan_volumes(volumes: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    old = F.col("create_time") < now - F.make_dt_interval(hours=F.lit(hours))
    return without_tag(volumes.filter((F.col("state") == "available") & old), *KEEP_TAG)


def orphan_snapshots(snapshots: DataFrame, volumes: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Old, untagged snapshots of volumes that are gone; a null volume id counts as gone."""
    old = snapshots.filter(F.col("start_time") < now - F.make_dt_interval(F.lit(days)))
    return salted_join(without_tag(old, *KEEP_TAG), volumes.select("volume_id"), ["volume_id"], "left_anti")


def idle_instances(instances: DataFrame, metrics: DataFrame, now: Column, minutes: int = 30, percent: float = 10.0) -> DataFrame:
    """Running, not excluded instances with at least one CPU period in the span and none above the limit.

    Points are filtered by name and time (pushed to the scan) and averaged per 5 minutes before any join.
    """
    span = (F.col("ts") >= now - F.make_dt_interval(mins=F.lit(minutes))) & (F.col("ts") < now)
    points = metrics.filter((F.col("name") == "CPUUtilization") & span)
    periods = points.groupBy("resource_id", F.window(F.col("ts"), "5 minutes")).agg(F.avg("value").alias("average"))
    busiest = periods.groupBy("resource_id").agg(F.max("average").alias("max_average"), F.count(F.lit(1)).alias("periods"))
    candidates = without_tag(select_resources(instances, "running"), *EXCLUDE_TAG)
    return candidates.select("resource_id").join(busiest.filter(F.col("max_average") <= percent), "resource_id")


def idle_endpoints(endpoints: DataFrame, metrics: DataFrame, now: Column, minutes: int = 60, calls: int = 5) -> DataFrame:
    """In-service endpoints with fewer calls than the limit; an endpoint without points is idle."""
    span = (F.col("ts") >= now - F.make_dt_interval(mins=F.lit(minutes))) & (F.col("ts") < now)
    sums = metrics.filter((F.col("name") == "Invocations") & span).groupBy("endpoint_name").agg(F.sum("value").alias("calls"))
    total = F.coalesce("calls", F.lit(0.0))
    serving = select_resources(endpoints, "InService", state_column="endpoint_status")
    return serving.select("endpoint_name").join(sums, "endpoint_name", "left").filter(total < calls).select("endpoint_name", total.alias("calls"))


def without_active_jobs(endpoints: DataFrame, jobs: DataFrame, separator: str = ",") -> DataFrame:
    """Endpoints that no initiated or processing job lists.

    The job's endpoint list is split and reduced to distinct names, so the test is an equi anti join.
    """
    live = jobs.filter(F.col("status").isin("PROCESSING", "INITIATED"))
    used = live.select(F.explode(F.split("endpoints", separator)).alias("endpoint_name")).distinct()
    return endpoints.join(used, "endpoint_name", "left_anti")


NAMES = 200_000  # names of an automaton


def without_jobs_containing(endpoints: DataFrame, jobs: DataFrame, names: int = NAMES) -> DataFrame:
    """As :func:`without_active_jobs` for free-text endpoint fields: the name may be any part of the text.

    The names become an automaton that finds all of them in one pass over a text, however many there are and whatever
    their lengths. At most about ``names`` of them are in one automaton: they are dealt by hash into as many shards as
    that takes, each shard is one pass over the live jobs, and an endpoint that is found is given out once a task.
    """
    known = endpoints.select("endpoint_name").filter(F.col("endpoint_name").isNotNull()).distinct()
    shards = max(1, -(-known.count() // names))
    texts = jobs.filter(F.col("status").isin("PROCESSING", "INITIATED")).select("endpoints").filter(F.col("endpoints").isNotNull())
    used = None
    for shard in range(shards):
        part = known.filter(F.pmod(F.xxhash64("endpoint_name"), F.lit(shards)) == shard)
        found = _names_in(texts, [r[0] for r in part.collect()])
        used = found if used is None else used.unionByName(found)
    return endpoints.join(used.distinct(), "endpoint_name", "left_anti")


def _names_in(texts: DataFrame, names: list[str]) -> DataFrame:
    """``endpoint_name``: those of ``names`` that are part of some text, each once a task. The empty name is part of any."""
    held = texts.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for name in held.value:
            if name:
                automaton.add_word(name, name)
        automaton.make_automaton()
        found: set[str] = set()
        for batch in batches:
            found.update([""] if len(batch) and "" in held.value else [])
            if len(automaton):
                for text in batch["endpoints"]:
                    found.update(name for _, name in automaton.iter(text))
        yield pd.DataFrame({"endpoint_name": sorted(found)}, dtype="object")

    return texts.mapInPandas(run, "endpoint_name string")


def fallback_capacity(fleet: DataFrame) -> DataFrame:
    """On-demand units to buy for the missing capacity; an over-full fleet, or one without a target, needs none."""
    percent = F.try_divide("fulfilled", "target") * 100
    gap = F.greatest(F.col("target") - F.col("fulfilled"), F.lit(0.0))
    label, share = None, None
    for limit, name, part in SHORTAGE_POLICY:
        label = F.when(percent < limit, name) if label is None else label.when(percent < limit, name)
        share = F.when(percent < limit, F.lit(part)) if share is None else share.when(percent < limit, F.lit(part))
    label, share = label.otherwise(SHORTAGE_REST[0]), share.otherwise(F.lit(SHORTAGE_REST[1]))
    wanted = F.ceil(gap * share)
    return fleet.withColumn("strategy", label).withColumn("on_demand", F.when(gap > 0, F.greatest(wanted, F.lit(1))).otherwise(0).cast("long"))


def leak_report(volumes: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Subject and text of the leak notice; no row when nothing was deleted.

    Inputs are deletion results with ``error`` (null when deleted); only their totals are joined.
    """
    def totals(df: DataFrame) -> DataFrame:
        ok = F.col("error").isNull()
        return df.agg(F.struct(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("deleted"), F.count_if(~ok).alias("errors")).alias("t"))

    both = totals(volumes).select(F.col("t").alias("v"), totals(snapshots).scalar().alias("s"))
    text = "volumes without owner: %d found, %d removed, %d failed\nsnapshots without owner: %d found, %d removed, %d failed"
    return both.filter((F.col("v.deleted") > 0) | (F.col("s.deleted") > 0)).select(
        F.format_string("unused storage removed: volumes %d, snapshots %d", "v.deleted", "s.deleted").alias("subject"),
        F.format_string(text, "v.total", "v.deleted", "v.errors", "s.total", "s.deleted", "s.errors").alias("message"),
    )
