"""Reports over stage timings of repeated runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMINGS = ("extraction_time", "upscale_time", "recompose_time")
RUN_KEY = ("video_name", "resolution", "duration", "model")


def benchmark_means(runs: DataFrame) -> DataFrame:
    """Mean of each stage and of the total per video and model."""
    total = sum((F.col(c) for c in TIMINGS[1:]), F.col(TIMINGS[0]))
    means = [F.round(F.avg(c), 4).alias(c) for c in TIMINGS]
    return runs.groupBy(*RUN_KEY).agg(*means, F.round(F.avg(total), 4).alias("total_time"))


def benchmark_series(means: DataFrame) -> DataFrame:
    """Total time against video length, one ordered series per model."""
    return means.select("model", "duration", "video_name", "total_time").distinct().orderBy("model", "duration", "video_name")
