"""The scheduled maintenance run as one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.operators import inventory, resources


def maintenance_findings(
    objects: DataFrame, jobs: DataFrame, volumes: DataFrame, snapshots: DataFrame, now: Column,
    retention_days: int = 7, volume_hours: int = 24, snapshot_days: int = 7,
) -> DataFrame:
    """Expired objects, orphan objects, unattached volumes and orphan snapshots in one table."""
    none = F.lit(None).cast("long").alias("bytes")
    expired = inventory.expired_objects(objects, jobs, now, retention_days).select(F.col("key").alias("id"), F.col("size").alias("bytes"))
    orphan = inventory.orphan_objects(objects, jobs).select(F.col("key").alias("id"), F.col("size").alias("bytes"))
    idle_volumes = resources.orphan_volumes(volumes, now, volume_hours).select(F.col("volume_id").alias("id"), none)
    lost = resources.orphan_snapshots(snapshots, volumes, now, snapshot_days).select(F.col("snapshot_id").alias("id"), none)
    return inventory.maintenance_report(expired=expired, orphan=orphan, volume=idle_volumes, snapshot=lost)
