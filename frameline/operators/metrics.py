"""Metric statistics, alarms, cost and budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATISTICS = {"Average": F.avg, "Sum": F.sum, "Maximum": F.max}
COMPARISONS = {
    "GreaterThanThreshold": lambda v, x: v > x,
    "LessThanThreshold": lambda v, x: v < x,
    "GreaterThanOrEqualToThreshold": lambda v, x: v >= x,
}
# Queue counters and the statistic shown for each.
QUEUE_PANELS = {"Submitted": "Sum", "Pending": "Average", "Running": "Average", "Failed": "Sum"}
BUDGET_WARN, BUDGET_LIMIT, BUDGET_FORECAST = 0.8, 1.0, 0.9
# Sums and averages of doubles depend on row order; digits kept so that equal data gives equal results.
DIGITS = {"Average": 8, "Sum": 4, "Maximum": 8}


def statistic(name: str, value: str | Column = "value") -> Column:
    return F.round(STATISTICS[name](value), DIGITS[name])


def metric_stats(points: DataFrame, period: str, stat: str, dims: Sequence[str]) -> DataFrame:
    """One statistic per period and dimensions; works on batches and (after a watermark) on streams."""
    grouped = points.groupBy(F.window("ts", period).alias("_w"), *dims).agg(statistic(stat).alias("stat_value"), F.count(F.lit(1)).alias("points"))
    return grouped.select(F.col("_w.start").alias("period_start"), *dims, "stat_value", "points")


def metric_rollup(points: DataFrame, fine: str = "task_id", coarse: str = "phase") -> DataFrame:
    """The same metric per (task, phase) and per phase, from one pass; ``level`` tells them apart."""
    grouped = points.groupingSets([[F.col(fine), F.col(coarse), F.col("name")], [F.col(coarse), F.col("name")]], F.col(fine), F.col(coarse), F.col("name")).agg(
        F.grouping(fine).alias("_g"), statistic("Sum").alias("total"), statistic("Average").alias("average"), F.count(F.lit(1)).alias("points")
    )
    level = F.when(F.col("_g") == 0, f"{fine}+{coarse}").otherwise(coarse)
    return grouped.select(level.alias("level"), fine, coarse, "name", "total", "average", "points")


def error_counts(points: DataFrame) -> DataFrame:
    return points.filter(F.col("name") == "error_count").groupBy("phase").agg(F.count(F.lit(1)).alias("errors"), statistic("Sum").alias("error_total"))


def host_metrics(points: DataFrame, period: str) -> DataFrame:
    """Average, lowest and highest reading per instance, metric and period."""
    grouped = points.groupBy("resource_id", "name", F.window("ts", period).alias("_w")).agg(
        statistic("Average").alias("average"), F.min("value").alias("lowest"), F.max("value").alias("highest")
    )
    return grouped.select("resource_id", "name", F.col("_w.start").alias("period_start"), "average", "lowest", "highest")


def version_report(points: DataFrame) -> DataFrame:
    """Runs, mean duration and failures per model version and phase."""
    duration = F.when(F.col("name") == "duration", F.col("value"))
    return points.groupBy("phase", "model_version").agg(
        F.count(duration).alias("runs"), statistic("Average", duration).alias("mean_duration"), F.count_if(F.col("name") == "error_count").alias("failures")
    )


def queue_dashboard(points: DataFrame, period: str, panels: dict[str, str] | None = None) -> DataFrame:
    """Queue and period to one column per counter, each with its own statistic, in one aggregation."""
    panels = QUEUE_PANELS if panels is None else panels
    wide = [statistic(stat, F.when(F.col("name") == name, F.col("value"))).alias(name.lower()) for name, stat in panels.items()]
    grouped = points.filter(F.col("name").isin(*panels)).groupBy("queue", F.window("ts", period).alias("_w")).agg(*wide)
    return grouped.select("queue", F.col("_w.start").alias("period_start"), *[n.lower() for n in panels])


RULE = "alarm string, name string, comparison string, threshold double, periods int"


def rule_breach(value: Column) -> Column:
    """Whether a value breaches the rule in the columns ``comparison`` and ``threshold``; unknown comparisons never do."""
    hit = None
    for name, holds in COMPARISONS.items():
        test = holds(value, F.col("threshold"))
        hit = F.when(F.col("comparison") == name, test) if hit is None else hit.when(F.col("comparison") == name, test)
    return F.coalesce(hit, F.lit(False))


def _with_state(rows: DataFrame, series: Sequence[str], period_seconds: int, periods: Column) -> DataFrame:
    """``state`` from ``breach``: ALARM where at least ``periods`` periods in a row, this one the last, breach.

    Islands of breaches are found in one pass over a series in time order (lag and running maximum share one sort): an
    island starts behind a period that does not breach, or at the first period behind a gap.
    """
    along = Window.partitionBy(*series).orderBy("_at")
    timed = rows.withColumn("_at", F.unix_seconds(F.col("period_start").cast("timestamp"))).withColumn("_before", F.lag("_at").over(along))
    gap = F.col("_before").isNull() | (F.col("_before") < F.col("_at") - period_seconds)
    starts = F.when(~F.col("breach"), F.col("_at") + period_seconds).when(gap, F.col("_at"))
    timed = timed.withColumn("_start", F.max(starts).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    run = F.when(F.col("breach"), (F.col("_at") - F.col("_start")) / period_seconds + 1).otherwise(0)
    return timed.withColumn("state", F.when(run >= periods, "ALARM").otherwise("OK")).drop("_at", "_before", "_start")


def evaluate_alarms(stats: DataFrame, keys: Sequence[str], period_seconds: int, comparison: str, threshold: float, periods: int) -> DataFrame:
    """State per period under one rule: ``ALARM`` when this and the previous ``periods - 1`` periods all breach.

    A missing period breaks the run. Input is one row per key and period, so a window holds at most as many
    rows as there are periods in the time span, whatever the number of raw points.
    """
    breach = COMPARISONS[comparison](F.col("stat_value"), F.lit(threshold))
    return _with_state(stats.withColumn("breach", F.coalesce(breach, F.lit(False))), keys, period_seconds, F.lit(periods))


def evaluate_rules(stats: DataFrame, rules: DataFrame, keys: Sequence[str], period_seconds: int, metric: str = "name") -> DataFrame:
    """State per alarm, series and period for a whole table of rules (columns of ``RULE``) in one pass.

    A rule watches every series whose ``metric`` column is its ``name``; ``keys`` (``metric`` among them) make a series.
    Rows are ``stats`` with ``alarm``, ``periods``, ``breach`` and ``state``; a metric without a rule has none.
    """
    watched = rules.select("alarm", F.col("name").alias(metric), "comparison", "threshold", "periods")
    rows = stats.join(watched, metric).withColumn("breach", rule_breach(F.col("stat_value")))
    return _with_state(rows, ["alarm", *keys], period_seconds, F.col("periods")).drop("comparison", "threshold")


def alarm_transitions(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Periods in which the state differs from the period before (the first counts when it is ALARM)."""
    along = Window.partitionBy(*keys).orderBy("period_start")
    before = F.lag("state", 1, "OK").over(along)
    changed = states.withColumn("prev_state", before).filter(F.col("state") != F.col("prev_state"))
    return changed.withColumn("action", F.when(F.col("state") == "ALARM", "alarm_action").otherwise("ok_action"))


def composite_alarm(*members: DataFrame) -> DataFrame:
    """ALARM in a period when any member is; members need ``period_start, state`` only."""
    every = None
    for m in members:
        part = m.select("period_start", "state")
        every = part if every is None else every.unionByName(part)
    alarm = F.bool_or(F.col("state") == "ALARM")
    return every.groupBy("period_start").agg(F.when(alarm, "ALARM").otherwise("OK").alias("state"))


def running_charge(costs: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Charge of the month so far per day and dimensions; days are summed before the window (at most 31 rows each)."""
    daily = costs.groupBy(F.to_date("day").alias("day"), *dims).agg(F.sum("charge").alias("charge"))
    month = Window.partitionBy(*dims, F.trunc("day", "month")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("day", *dims, F.round(F.sum("charge").over(month), 2).alias("running_charge"))


def cost_by(charges: DataFrame, panels: Sequence[Sequence[str]], dims: Sequence[str]) -> DataFrame:
    """Daily maximum of a running charge for several dimension sets at once.

    ``panel`` holds the grouping id, so that equal null dimensions of different panels stay apart.
    """
    sets = [[F.col("day"), *[F.col(d) for d in panel]] for panel in panels]
    return charges.groupingSets(sets, F.col("day"), *[F.col(d) for d in dims]).agg(
        F.grouping_id().cast("int").alias("panel"), F.max("running_charge").alias("highest")
    )


def budget_tracking(costs: DataFrame, budget: float) -> DataFrame:
    """Month-to-date cost per calendar day against a monthly budget.

    A day without a cost row counts 0. The forecast extends the month's run rate to its last day. The
    calendar has one row per day of the data's span, and every window at most 31 rows.
    """
    daily = costs.groupBy(F.to_date("day").alias("day")).agg(F.sum("charge").alias("charge"))
    span = daily.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    filled = calendar.join(daily, "day", "left").select("day", F.coalesce("charge", F.lit(0.0)).alias("charge"))
    month = Window.partitionBy(F.trunc("day", "month")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    to_date = F.round(F.sum("charge").over(month), 2)
    rows = filled.select("day", to_date.alias("month_to_date"))
    forecast = F.round(F.col("month_to_date") / F.dayofmonth("day") * F.dayofmonth(F.last_day("day")), 6)
    return rows.select(
        "day", "month_to_date", forecast.alias("forecast"),
        F.least("month_to_date", F.lit(budget * BUDGET_WARN)).alias("capped_warning"),
        F.least("month_to_date", F.lit(float(budget))).alias("capped_budget"),
        (F.col("month_to_date") > budget * BUDGET_WARN).alias("over_80"),
        (F.col("month_to_date") > budget * BUDGET_LIMIT).alias("over_100"),
        (forecast > budget * BUDGET_FORECAST).alias("forecast_over_90"),
    )
