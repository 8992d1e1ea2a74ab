"""Period statistics and sliding idle checks over a metric stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameline.operators.metrics import metric_stats, statistic


def stream_stats(points: DataFrame, period: str, stat: str, dims: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """Tumbling statistics; a period is given out once the watermark has passed its end."""
    return metric_stats(points.withWatermark("ts", delay), period, stat, dims)


def idle_sliding(
    points: DataFrame, key: str = "resource_id", name: str = "CPUUtilization", fine: str = "5 minutes", span: str = "30 minutes",
    every: str = "15 minutes", percent: float = 10.0, delay: str = "10 minutes",
) -> DataFrame:
    """Spans in which a resource had points and no fine period averaged above the limit.

    Fine averages first, then sliding spans over them: the repeated rows of the sliding step are the
    averages, not the points.
    """
    timed = points.filter(F.col("name") == name)
    timed = timed.withWatermark("ts", delay) if points.isStreaming else timed
    averages = timed.groupBy(F.window("ts", fine).alias("window"), key).agg(F.avg("value").alias("average"))
    spans = averages.groupBy(F.window(F.window_time("window"), span, every).alias("_w"), key).agg(
        F.max("average").alias("_max"), F.count(F.lit(1)).alias("periods")
    )
    return spans.filter(F.col("_max") <= percent).select(
        key, F.col("_w.start").alias("span_start"), F.col("_w.end").alias("span_end"), F.round("_max", 8).alias("max_average"), "periods"
    )


def low_traffic_sliding(
    points: DataFrame, key: str = "endpoint_name", name: str = "Invocations", span: str = "60 minutes", every: str = "60 minutes",
    calls: float = 5.0, delay: str = "10 minutes",
) -> DataFrame:
    """Spans in which an endpoint's calls stayed below the limit. Endpoints without any point are found by the batch job."""
    timed = points.filter(F.col("name") == name)
    timed = timed.withWatermark("ts", delay) if points.isStreaming else timed
    sums = timed.groupBy(F.window("ts", span, every).alias("_w"), key).agg(statistic("Sum").alias("calls"))
    return sums.filter(F.col("calls") < calls).select(key, F.col("_w.start").alias("span_start"), F.col("_w.end").alias("span_end"), "calls")
