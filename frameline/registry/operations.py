"""Queries over metrics, alarms, cost, resources, audit and timings."""

from pyspark.sql import functions as F

from frameline.fixtures import EVENT_NOW, JOB_NOW, cte
from frameline.operators import audit as A
from frameline.operators import metrics as M
from frameline.operators import resources as R
from frameline.operators import timings as B
from frameline.registry import query
from frameline.registry.jobs import tagged, ts

CLOCK = f"TIMESTAMP '{EVENT_NOW}'"
JOB_CLOCK = f"TIMESTAMP '{JOB_NOW}'"


@query("without_tag", "P10", f"{cte('instances')} SELECT resource_id, state FROM instances WHERE NOT (coalesce(tag_key, '') = 'AutoShutdownExclude' AND tag_value = 'true')")
def _(t):
    return R.without_tag(tagged(t("instances")), *R.EXCLUDE_TAG).select("resource_id", "state")


@query("select_resources", "P11", f"{cte('instances')} SELECT resource_id, state FROM instances WHERE state = 'running' AND tag_key = 'AutoShutdownExclude' AND tag_value = 'true' AND starts_with(resource_id, 'i-1')")
def _(t):
    return R.select_resources(tagged(t("instances")), "running", R.EXCLUDE_TAG, "i-1").select("resource_id", "state")


@query("fallback_capacity", "P22", f"""{cte('fleet')}, p AS (SELECT *, fulfilled / target * 100 AS pct, greatest(target - fulfilled, 0) AS gap FROM fleet)
SELECT fleet_id, fulfilled, target, CASE WHEN pct < 50 THEN 'aggressive' WHEN pct < 80 THEN 'balanced' ELSE 'minimal' END AS strategy,
cast(CASE WHEN gap > 0 THEN greatest(ceil(gap * CASE WHEN pct < 50 THEN 0.75 WHEN pct < 80 THEN 0.5 ELSE 0.25 END), 1) ELSE 0 END AS bigint) AS on_demand FROM p""")
def _(t):
    return R.fallback_capacity(t("fleet"))


@query("orphan_volumes", "J04", f"{cte('volumes')} SELECT volume_id, state, create_time FROM volumes WHERE state = 'available' AND create_time < {JOB_CLOCK} - INTERVAL 24 HOUR AND coalesce(tag_key, '') <> 'KeepOrphaned'")
def _(t):
    return R.orphan_volumes(tagged(t("volumes")), ts(JOB_NOW)).drop("tags")


@query("orphan_snapshots", "J03", f"""{cte('snapshots', 'volumes')} SELECT snapshot_id, volume_id, start_time FROM snapshots s WHERE start_time < {JOB_CLOCK} - INTERVAL 7 DAY AND coalesce(tag_key, '') <> 'KeepOrphaned'
 AND NOT EXISTS (SELECT 1 FROM volumes v WHERE v.volume_id = s.volume_id)""")
def _(t):
    return R.orphan_snapshots(tagged(t("snapshots")), t("volumes"), ts(JOB_NOW)).select("snapshot_id", "volume_id", "start_time")


@query("idle_instances", "J05", f"""{cte('instances', 'metrics')}, p AS (SELECT resource_id, time_bucket(INTERVAL 5 MINUTE, ts) AS b, avg(value) AS a FROM metrics WHERE name = 'CPUUtilization' AND ts >= {CLOCK} - INTERVAL 2160 MINUTE AND ts < {CLOCK} GROUP BY 1, 2),
b AS (SELECT resource_id, max(a) AS max_average, count(*) AS periods FROM p GROUP BY 1)
SELECT i.resource_id, round(max_average, 4) AS max_average, periods FROM instances i JOIN b ON b.resource_id = i.resource_id WHERE state = 'running' AND coalesce(tag_key, '') <> 'AutoShutdownExclude' AND max_average <= 25""")
def _(t):
    idle = R.idle_instances(tagged(t("instances")), t("metrics"), ts(EVENT_NOW), 2160, 25.0)
    return idle.withColumn("max_average", F.round("max_average", 4))


@query("idle_endpoints", "J06", f"""{cte('endpoints', 'metrics')}, s AS (SELECT endpoint_name, sum(value) AS calls FROM metrics WHERE name = 'Invocations' AND ts >= {CLOCK} - INTERVAL 1440 MINUTE AND ts < {CLOCK} GROUP BY 1)
SELECT e.endpoint_name, round(coalesce(calls, 0), 4) AS calls FROM endpoints e LEFT JOIN s ON s.endpoint_name = e.endpoint_name WHERE endpoint_status = 'InService' AND coalesce(calls, 0) < 40""")
def _(t):
    return R.idle_endpoints(t("endpoints"), t("metrics"), ts(EVENT_NOW), 1440, 40).withColumn("calls", F.round("calls", 4))


ACTIVE = "active AS (SELECT endpoints FROM jobs WHERE status IN ('PROCESSING', 'INITIATED'))"


@query("without_active_jobs", "J07", f"""{cte('endpoints', 'jobs')}, {ACTIVE} SELECT endpoint_name, endpoint_status FROM endpoints e WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT unnest(string_split(endpoints, ',')) AS name FROM active) a WHERE a.name = e.endpoint_name)""")
def _(t):
    return R.without_active_jobs(t("endpoints"), t("jobs"))


@query("without_jobs_containing", "J07", f"""{cte('endpoints', 'jobs')}, {ACTIVE} SELECT endpoint_name, endpoint_status FROM endpoints e WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT endpoints FROM active) a WHERE contains(a.endpoints, e.endpoint_name))""")
def _(t):
    return R.without_jobs_containing(t("endpoints"), t("jobs"))


@query("leak_report", "A17", f"""{cte('snapshots', 'volumes')}, v AS (SELECT count(*) AS n, count(*) FILTER (WHERE volume_id LIKE '%7') AS bad FROM volumes WHERE state = 'available'), s AS (SELECT count(*) AS n, count(*) FILTER (WHERE snapshot_id LIKE '%7') AS bad FROM snapshots)
SELECT format('unused storage removed: volumes {{}}, snapshots {{}}', v.n - v.bad, s.n - s.bad) AS subject,
 format('volumes without owner: {{}} found, {{}} removed, {{}} failed', v.n, v.n - v.bad, v.bad) || chr(10) || format('snapshots without owner: {{}} found, {{}} removed, {{}} failed', s.n, s.n - s.bad, s.bad) AS message FROM v, s""")
def _(t):
    volumes = t("volumes").filter("state = 'available'").select(F.expr("CASE WHEN volume_id LIKE '%7' THEN 'in use' END AS error"))
    snapshots = t("snapshots").select(F.expr("CASE WHEN snapshot_id LIKE '%7' THEN 'in use' END AS error"))
    return R.leak_report(volumes, snapshots)


def stats_sql(period: str, agg: str, dims: str, where: str = "true") -> str:
    return f"SELECT time_bucket(INTERVAL {period}, ts) AS period_start, {dims}, round({agg}(value), {8 if agg == 'avg' else 4}) AS stat_value, count(*) AS points FROM metrics WHERE {where} GROUP BY ALL"


def plain(df):
    """Window starts back to the zone-less type of the tables."""
    return df.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


@query("metric_stats", "A08", f"{cte('metrics')} {stats_sql('5 MINUTE', 'avg', 'name, phase')}")
def _(t):
    return plain(M.metric_stats(t("metrics"), "5 minutes", "Average", ["name", "phase"]))


@query("metric_stats_daily", "A08", f"{cte('metrics')} {stats_sql('1 DAY', 'sum', 'name, resource_id')}")
def _(t):
    return plain(M.metric_stats(t("metrics"), "1 day", "Sum", ["name", "resource_id"]))


@query("metric_rollup", "A09", f"""{cte('metrics')} SELECT CASE WHEN grouping(task_id) = 0 THEN 'task_id+phase' ELSE 'phase' END AS level, task_id, phase, name, round(sum(value), 4) AS total, round(avg(value), 8) AS average, count(*) AS points
FROM metrics GROUP BY GROUPING SETS ((task_id, phase, name), (phase, name))""")
def _(t):
    return M.metric_rollup(t("metrics"))


@query("error_counts", "A10", f"{cte('metrics')} SELECT phase, count(*) AS errors, round(sum(value), 4) AS error_total FROM metrics WHERE name = 'error_count' GROUP BY phase")
def _(t):
    return M.error_counts(t("metrics"))


@query("host_metrics", "A18", f"{cte('metrics')} SELECT resource_id, name, time_bucket(INTERVAL 6 HOUR, ts) AS period_start, round(avg(value), 8) AS average, min(value) AS lowest, max(value) AS highest FROM metrics GROUP BY ALL")
def _(t):
    return plain(M.host_metrics(t("metrics"), "6 hours"))


@query("version_report", "A19", f"{cte('metrics')} SELECT phase, model_version, count(*) FILTER (WHERE name = 'duration') AS runs, round(avg(CASE WHEN name = 'duration' THEN value END), 8) AS mean_duration, count(*) FILTER (WHERE name = 'error_count') AS failures FROM metrics GROUP BY ALL")
def _(t):
    return M.version_report(t("metrics"))


COUNTERS = "CASE name WHEN 'CPUUtilization' THEN 'Submitted' WHEN 'Invocations' THEN 'Pending' WHEN 'duration' THEN 'Running' WHEN 'error_count' THEN 'Failed' END"


@query("queue_dashboard", "A14", f"""{cte('metrics')}, q AS (SELECT phase AS queue, {COUNTERS} AS name, ts, value FROM metrics)
SELECT queue, time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, round(sum(CASE WHEN name = 'Submitted' THEN value END), 4) AS submitted, round(avg(CASE WHEN name = 'Pending' THEN value END), 8) AS pending,
round(avg(CASE WHEN name = 'Running' THEN value END), 8) AS running, round(sum(CASE WHEN name = 'Failed' THEN value END), 4) AS failed FROM q WHERE name IS NOT NULL GROUP BY ALL""")
def _(t):
    return plain(M.queue_dashboard(t("metrics").selectExpr("phase AS queue", f"{COUNTERS} AS name", "ts", "value"), "5 minutes"))


def alarm_sql(limit: float, k: int, minutes: int, op: str = ">") -> str:
    cond = " AND ".join(
        ["breach"] + [f"coalesce(lag(breach, {i}) OVER w AND lag(period_start, {i}) OVER w = period_start - INTERVAL {i * minutes} MINUTE, false)" for i in range(1, k)]
    )
    return f"SELECT *, CASE WHEN {cond} THEN 'ALARM' ELSE 'OK' END AS state FROM (SELECT *, stat_value {op} {limit} AS breach FROM stats) b WINDOW w AS (PARTITION BY name, phase ORDER BY period_start)"


STATS = {"stats": stats_sql("360 MINUTE", "avg", "name, phase")}


def states(t, k=2, limit=25.0, comparison="GreaterThanThreshold"):
    stats = M.metric_stats(t("metrics"), "6 hours", "Average", ["name", "phase"])
    return M.evaluate_alarms(stats, ["name", "phase"], 21600, comparison, limit, k)


@query("evaluate_alarms", "W01", f"{cte('metrics', **STATS)} {alarm_sql(20.0, 2, 360)}")
def _(t):
    return plain(states(t, limit=20.0))


@query("evaluate_alarms_low", "W01", f"{cte('metrics', **STATS)} {alarm_sql(30.0, 6, 360, '<')}")
def _(t):
    return plain(states(t, 6, 30.0, "LessThanThreshold"))


# 25 rules: for each metric, three comparisons, and runs of 1, 2 and 6 periods that the data reach.
WATCHED = ("CPUUtilization", "Invocations", "duration", "frame_count", "error_count")
KINDS = (("high", "GreaterThanThreshold", 20.0, 1), ("raised", "GreaterThanThreshold", 10.0, 2), ("steady", "GreaterThanOrEqualToThreshold", 5.0, 6),
         ("low", "LessThanThreshold", 25.0, 2), ("idle", "LessThanThreshold", 60.0, 6))
ALARM_RULES = [(f"{kind}-{name}", name, comparison, threshold, periods) for name in WATCHED for kind, comparison, threshold, periods in KINDS]
SIGNS = {"GreaterThanThreshold": ">", "LessThanThreshold": "<", "GreaterThanOrEqualToThreshold": ">="}


def alarm_rules(t):
    return t.spark.createDataFrame(ALARM_RULES, M.RULE)


def rules_sql(stats: str = "stats", seconds: int = 21600) -> str:
    """Named selects that end in ``ruled``: every rule on every series of its metric."""
    series, breach = "alarm, name, phase", " ".join(f"WHEN '{c}' THEN stat_value {sign} threshold" for c, sign in SIGNS.items())
    return f"""rules(alarm, name, comparison, threshold, periods) AS (VALUES {', '.join(map(str, ALARM_RULES))}),
joined AS (SELECT s.*, alarm, periods, CASE comparison {breach} END AS breach FROM {stats} s JOIN rules r ON r.name = s.name),
gaps AS (SELECT *, lag(period_start) OVER (PARTITION BY {series} ORDER BY period_start) AS before FROM joined),
islands AS (SELECT *, sum(CASE WHEN NOT breach OR before IS NULL OR epoch(period_start) - epoch(before) > {seconds} THEN 1 ELSE 0 END) OVER (PARTITION BY {series} ORDER BY period_start) AS island FROM gaps),
ruled AS (SELECT * EXCLUDE (before, island), CASE WHEN count(*) FILTER (WHERE breach) OVER (PARTITION BY {series}, island ORDER BY period_start) >= periods THEN 'ALARM' ELSE 'OK' END AS state FROM islands)"""


@query("evaluate_rules", "W01", f"{cte('metrics', **STATS)}, {rules_sql()} SELECT * FROM ruled")
def _(t):
    stats = M.metric_stats(t("metrics"), "6 hours", "Average", ["name", "phase"])
    return plain(M.evaluate_rules(stats, alarm_rules(t), ["name", "phase"], 21600))


@query("alarm_transitions", "W02", f"""{cte('metrics', **STATS, states=alarm_sql(20.0, 2, 360))} SELECT * FROM (SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY name, phase ORDER BY period_start) AS prev_state, CASE WHEN state = 'ALARM' THEN 'alarm_action' ELSE 'ok_action' END AS action FROM states) s WHERE state <> prev_state""")
def _(t):
    return plain(M.alarm_transitions(states(t, limit=20.0), ["name", "phase"]))


@query("composite_alarm", "U02", f"""{cte('metrics', **STATS, states=alarm_sql(20.0, 2, 360))} SELECT period_start, CASE WHEN bool_or(state = 'ALARM') THEN 'ALARM' ELSE 'OK' END AS state FROM states WHERE name IN ('duration', 'error_count') GROUP BY period_start""")
def _(t):
    every = states(t, limit=20.0)
    return plain(M.composite_alarm(every.filter("name = 'duration'"), every.filter("name = 'error_count'")))


DAILY = "SELECT cast(day AS date) AS day, service, usage_type, sum(charge) AS charge FROM costs GROUP BY ALL"
RUNNING = "SELECT day, service, usage_type, round(sum(charge) OVER (PARTITION BY service, usage_type, date_trunc('month', day) ORDER BY day), 2) AS running_charge FROM daily"


@query("running_charge", "A13", f"{cte('costs', daily=DAILY)} {RUNNING}")
def _(t):
    return M.running_charge(t("costs"), ["service", "usage_type"])


@query("cost_by", "A13", f"""{cte('costs', daily=DAILY, charges=RUNNING)} SELECT day, service, usage_type, cast(grouping_id(day, service, usage_type) AS int) AS panel, max(running_charge) AS highest FROM charges GROUP BY GROUPING SETS ((day, service), (day, service, usage_type), (day, usage_type))""")
def _(t):
    dims = ["service", "usage_type"]
    return M.cost_by(M.running_charge(t("costs"), dims), [["service"], dims, ["usage_type"]], dims)


@query("budget_tracking", "W08", f"""{cte('costs')}, daily AS (SELECT cast(day AS date) AS day, sum(charge) AS charge FROM costs GROUP BY 1), c AS (SELECT cast(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS date) AS day FROM daily),
m AS (SELECT c.day, round(sum(coalesce(charge, 0)) OVER (PARTITION BY date_trunc('month', c.day) ORDER BY c.day), 2) AS month_to_date FROM c LEFT JOIN daily d ON d.day = c.day),
f AS (SELECT *, round(month_to_date / day(day) * day(last_day(day)), 6) AS forecast FROM m)
SELECT day, month_to_date, forecast, least(month_to_date, 24000000.0::double) AS capped_warning, least(month_to_date, 30000000.0::double) AS capped_budget, month_to_date > 24000000.0 AS over_80, month_to_date > 30000000.0 AS over_100, forecast > 27000000.0 AS forecast_over_90 FROM f""")
def _(t):
    return M.budget_tracking(t("costs"), 30_000_000)


@query("classify_audit", "P24", f"""{cte('audit')} SELECT event_id, coalesce(error_code LIKE '%UnauthorizedOperation' OR error_code LIKE 'AccessDenied%', false) AS unauthorized, user_type = 'Root' AND invoked_by IS NULL AND event_kind <> 'AwsServiceEvent' AS root_use, event_name = 'AttachRolePolicy' AS policy_change FROM audit""")
def _(t):
    return A.classify_audit(t("audit")).select("event_id", "unauthorized", "root_use", "policy_change")


@query("route_events", "P25", f"""{cte('audit')}, e AS (SELECT event_id, event_name AS fn, error_code IS NULL AS ok, event_kind FROM audit)
SELECT event_id, 'pipeline_completion' AS route FROM e WHERE ok AND fn = 'AttachRolePolicy' AND event_kind = 'AwsApiCall' UNION ALL SELECT event_id, 'pipeline_failure' FROM e WHERE NOT ok AND fn IN ('AttachRolePolicy', 'GetObject') AND event_kind = 'AwsApiCall'""")
def _(t):
    events = t("audit").select(
        "event_id", F.when(F.col("event_kind") == "AwsApiCall", A.FUNCTION_SOURCE).otherwise("other").alias("source"), F.col("event_name").alias("function_name"),
        F.when(F.col("error_code").isNull(), A.SUCCESS_DETAIL).otherwise(A.FAILURE_DETAIL).alias("detail_type"),
    )
    return A.route_events(events, ["AttachRolePolicy"], ["AttachRolePolicy", "GetObject"]).select("event_id", "route")


@query("compliance_by_rule", "A05", f"{cte('evaluations')} SELECT rule_name, count(*) FILTER (WHERE compliance_type = 'COMPLIANT') AS compliant, count(*) FILTER (WHERE compliance_type = 'NON_COMPLIANT') AS non_compliant FROM evaluations GROUP BY rule_name")
def _(t):
    return A.compliance_by_rule(t("evaluations"))


@query("non_compliant_details", "A05", f"{cte('evaluations')} SELECT rule_name, resource_id, resource_type FROM evaluations WHERE compliance_type = 'NON_COMPLIANT'")
def _(t):
    return A.non_compliant_details(t("evaluations"))


@query("compliance_overall", "A06", f"{cte('evaluations')} SELECT count(*) AS evaluated, count(*) FILTER (WHERE compliance_type = 'COMPLIANT') AS compliant, round(count(*) FILTER (WHERE compliance_type = 'COMPLIANT') / count(*) * 100, 4) AS percent FROM evaluations WHERE compliance_type <> 'INSUFFICIENT_DATA'")
def _(t):
    return A.compliance_overall(t("evaluations"))


MEANS = "SELECT video_name, resolution, duration, model, round(avg(extraction_time), 4) AS extraction_time, round(avg(upscale_time), 4) AS upscale_time, round(avg(recompose_time), 4) AS recompose_time, round(avg(extraction_time + upscale_time + recompose_time), 4) AS total_time FROM bench_runs GROUP BY ALL"


@query("benchmark_means", "A07", f"{cte('bench_runs')} {MEANS}")
def _(t):
    return B.benchmark_means(t("bench_runs"))


@query("benchmark_series", "O02 U03", f"{cte('bench_runs', means=MEANS)} SELECT DISTINCT model, duration, video_name, total_time FROM means ORDER BY model, duration")
def _(t):
    return B.benchmark_series(B.benchmark_means(t("bench_runs")))
