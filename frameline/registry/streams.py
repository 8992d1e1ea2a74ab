"""Queries that run a stream to its end and give the table it wrote."""

from pyspark.sql import functions as F

from frameline import scratch_dir
from frameline.fixtures import EVENT_NOW, cte
from frameline.operators import jobs as J
from frameline.registry import query
from frameline.registry.jobs import KEYS, VIDEO, tagged, ts
from frameline.registry.operations import alarm_rules, plain, rules_sql, stats_sql
from frameline.streaming import events as E
from frameline.streaming import state as S
from frameline.streaming import windows as W
from frameline.streaming.run import event_time, run_to_table

CLOSED = "(SELECT max(ts) FROM metrics) - INTERVAL 10 MINUTE"


@query("jobs_from_uploads", "T01 S06", f"""{cte('upload_events')}, {KEYS} SELECT 'job-' || md5(bucket || '/' || key) AS job_id, regexp_extract(key, '[^/]*$') AS video_name, key AS source_key, 'INITIATED' AS status FROM unpacked WHERE {VIDEO}""")
def _(t):
    made = E.jobs_from_uploads(t.stream("upload_events"), None, ts(EVENT_NOW), F.concat(F.lit("job-"), F.md5(F.concat("bucket", F.lit("/"), "key"))))
    return run_to_table(t.spark, made.select("job_id", "video_name", "source_key", "status"), "uploads")


@query("dedupe_messages", "T02", f"{cte('messages')} SELECT DISTINCT message_id FROM messages")
def _(t):
    twice = event_time(t.stream("messages")).union(event_time(t.stream("messages")))
    return run_to_table(t.spark, E.dedupe_messages(twice, horizon="60 days").select("message_id"), "dedupe")


@query("fan_out", "T03", f"""{cte('status_changes')} SELECT event_id, 'extraction' AS queue FROM status_changes WHERE status = 'INITIATED' UNION ALL SELECT event_id, 'processing' FROM status_changes WHERE status = 'EXTRACTING'
 UNION ALL SELECT event_id, 'notification' FROM status_changes WHERE status IN ('COMPLETED', 'FAILED') UNION ALL SELECT event_id, 'audit' FROM status_changes""")
def _(t):
    status = F.col("status")
    routes = {"extraction": status == "INITIATED", "processing": status == "EXTRACTING", "notification": status.isin("COMPLETED", "FAILED"), "audit": F.lit(True)}
    return run_to_table(t.spark, E.fan_out(t.stream("status_changes"), routes).select("event_id", "queue"), "queues", ["queue"])


@query("dead_letters", "T04", f"{cte('messages')} SELECT message_id FROM messages GROUP BY message_id HAVING count(*) > 5")
def _(t):
    return run_to_table(t.spark, S.dead_letters(t.stream("messages"), retention_days=60), "dead")


@query("dead_letters_batch", "T04", f"{cte('messages')} SELECT message_id FROM messages GROUP BY message_id HAVING count(*) > 5")
def _(t):
    return E.dead_letters_batch(t("messages"))


STAGE = "CASE event_id % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'process' ELSE 'recompose' END AS stage"
FIRSTS = "f AS (SELECT job_id, " + ", ".join(
    f"coalesce(min(CASE WHEN stage = '{s}' AND status = '{x}' THEN ts END), TIMESTAMP '9999-12-31') AS {s}_{x}" for s in S.STAGES for x in ("COMPLETED", "FAILED")
) + f" FROM (SELECT *, {STAGE} FROM status_changes) c GROUP BY job_id)"
VERDICT = "CASE " + " ".join(
    f"WHEN {s}_FAILED < {s}_COMPLETED THEN '{s}_failed' WHEN {s}_COMPLETED = TIMESTAMP '9999-12-31' THEN '{s}_waiting'" for s in S.STAGES
) + " ELSE 'COMPLETED' END AS state"


@query("job_state_machine", "T05", f"{cte('status_changes')}, {FIRSTS}, v AS (SELECT job_id, {VERDICT} FROM f) SELECT * FROM v WHERE state NOT LIKE '%waiting'")
def _(t):
    return S.latest_verdicts(run_to_table(t.spark, S.job_state_machine(t.stream("status_changes").withColumn("stage", F.expr(STAGE))), "machine"))


@query("job_states_batch", "T05", f"{cte('status_changes')}, {FIRSTS} SELECT job_id, {VERDICT} FROM f")
def _(t):
    return S.job_states_batch(t("status_changes").withColumn("stage", F.expr(STAGE)))


@query("stream_stats", "T06", f"{cte('metrics')}, s AS ({stats_sql('5 MINUTE', 'avg', 'name, phase')}) SELECT * FROM s WHERE period_start + INTERVAL 5 MINUTE <= {CLOSED}")
def _(t):
    stats = W.stream_stats(event_time(t.stream("metrics")), "5 minutes", "Average", ["name", "phase"])
    return plain(run_to_table(t.spark, stats, "stats"))


@query("stream_stats_daily", "T06", f"{cte('metrics')}, s AS ({stats_sql('1 DAY', 'sum', 'name, resource_id')}) SELECT * FROM s WHERE period_start + INTERVAL 1 DAY <= {CLOSED}")
def _(t):
    stats = W.stream_stats(event_time(t.stream("metrics")), "1 day", "Sum", ["name", "resource_id"])
    return plain(run_to_table(t.spark, stats, "daily"))


def closed_stats(t):
    """A stream of the closed six-hour periods."""
    folder = scratch_dir(t.spark, "alarmstats")
    stats = W.stream_stats(event_time(t.stream("metrics")), "6 hours", "Average", ["name", "phase"])
    run_to_table(t.spark, stats, "alarmstats", path=folder)
    return t.spark.readStream.schema(stats.schema).parquet(f"{folder}/rows")


@query("streaming_rules", "T07", f"{cte('metrics', stats=f"SELECT * FROM ({stats_sql('360 MINUTE', 'avg', 'name, phase')}) g WHERE period_start + INTERVAL 360 MINUTE <= {CLOSED}")}, {rules_sql()}, c AS (SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY alarm, name, phase ORDER BY period_start) AS earlier FROM ruled) SELECT alarm, name || '/' || phase AS alarm_key, period_start, state FROM c WHERE state <> earlier")
def _(t):
    return plain(run_to_table(t.spark, S.streaming_rules(closed_stats(t), alarm_rules(t), ["name", "phase"], 21600), "rules"))


RUNS = """b AS (SELECT name || '/' || phase AS alarm_key, period_start, stat_value > 20 AS breach FROM stats), s AS (SELECT *, CASE WHEN breach AND coalesce(lag(breach) OVER w AND lag(period_start) OVER w = period_start - INTERVAL 360 MINUTE, false) THEN 'ALARM' ELSE 'OK' END AS state FROM b WINDOW w AS (PARTITION BY alarm_key ORDER BY period_start)),
c AS (SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY alarm_key ORDER BY period_start) AS before FROM s)"""


@query("streaming_alarms", "T07", f"{cte('metrics', stats=f"SELECT * FROM ({stats_sql('360 MINUTE', 'avg', 'name, phase')}) g WHERE period_start + INTERVAL 360 MINUTE <= {CLOSED}")}, {RUNS} SELECT alarm_key, period_start, state FROM c WHERE state <> before")
def _(t):
    alarms = S.streaming_alarms(closed_stats(t), F.concat_ws("/", "name", "phase"), F.col("stat_value") > 20, 21600, 2)
    return plain(run_to_table(t.spark, alarms, "alarms"))


SPANS = f"""a AS (SELECT resource_id, time_bucket(INTERVAL 5 MINUTE, ts) AS p, avg(value) AS average FROM metrics WHERE name = 'CPUUtilization' GROUP BY ALL),
e AS (SELECT resource_id, average, time_bucket(INTERVAL 15 MINUTE, p) - k * INTERVAL 15 MINUTE AS span_start FROM a, range(0, 2) r(k)),
s AS (SELECT resource_id, span_start, span_start + INTERVAL 30 MINUTE AS span_end, round(max(average), 8) AS max_average, count(*) AS periods FROM e GROUP BY ALL)"""


@query("idle_sliding", "T08", f"{cte('metrics')}, {SPANS} SELECT * FROM s WHERE max_average <= 10 AND span_end <= (SELECT max(ts) FROM metrics WHERE name = 'CPUUtilization') - INTERVAL 10 MINUTE")
def _(t):
    idle = W.idle_sliding(event_time(t.stream("metrics")))
    return spans(run_to_table(t.spark, idle, "idle"))


@query("low_traffic_sliding", "T08", f"""{cte('metrics')}, s AS (SELECT endpoint_name, time_bucket(INTERVAL 60 MINUTE, ts) AS span_start, time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE AS span_end, round(sum(value), 4) AS calls FROM metrics WHERE name = 'Invocations' GROUP BY ALL)
SELECT * FROM s WHERE calls < 5 AND span_end <= (SELECT max(ts) FROM metrics WHERE name = 'Invocations') - INTERVAL 10 MINUTE""")
def _(t):
    return spans(run_to_table(t.spark, W.low_traffic_sliding(event_time(t.stream("metrics"))), "traffic"))


def spans(df):
    return df.withColumn("span_start", F.col("span_start").cast("timestamp_ntz")).withColumn("span_end", F.col("span_end").cast("timestamp_ntz"))


@query("interruption_stream", "T09", f"{cte('warnings', 'instances')} SELECT tag_value AS job_id, instance_id AS interrupted_instance_id, 'INTERRUPTED' AS status FROM warnings w JOIN instances i ON i.resource_id = w.instance_id WHERE tag_key = 'JobId'")
def _(t):
    updates = J.interrupted_jobs(t.stream("warnings"), tagged(t("instances")), ts(EVENT_NOW))
    return run_to_table(t.spark, updates.drop("interrupted_at"), "interrupted")


@query("progress_stream", "T10", f"{cte('frames')} SELECT job_id, cast(1 + cast(substr(job_id, 5) AS bigint) % 4 AS bigint) AS total FROM frames GROUP BY job_id HAVING count(DISTINCT n) >= 1 + cast(substr(job_id, 5) AS bigint) % 4")
def _(t):
    seen = t.stream_raw("lineitem").selectExpr("'job-' || cast(l_orderkey AS string) AS job_id", "l_linenumber AS n", "l_shipdate AS ts")
    totals = t.raw("orders").selectExpr("'job-' || cast(o_orderkey AS string) AS job_id", "cast(1 + o_orderkey % 4 AS bigint) AS total")
    return run_to_table(t.spark, S.progress_stream(seen, totals), "progress")


@query("audit_alarms", "T11", f"""{cte('audit')}, h AS (SELECT ts, 'unauthorized' AS finding FROM audit WHERE error_code IS NOT NULL UNION ALL SELECT ts, 'root_use' FROM audit WHERE user_type = 'Root' AND invoked_by IS NULL AND event_kind <> 'AwsServiceEvent' UNION ALL SELECT ts, 'policy_change' FROM audit WHERE event_name = 'AttachRolePolicy')
SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, finding, count(*) AS findings, CASE WHEN count(*) >= 1 THEN 'ALARM' ELSE 'OK' END AS state FROM h GROUP BY 1, 2) g WHERE period_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM h) - INTERVAL 10 MINUTE""")
def _(t):
    return plain(run_to_table(t.spark, E.audit_findings(event_time(t.stream("audit"))), "audit"))


@query("incremental_orphans", "T12", f"{cte('objects', 'jobs')} SELECT DISTINCT split_part(key, '/', 1) AS job_id, key FROM objects WHERE split_part(key, '/', 1) NOT IN (SELECT job_id FROM jobs)")
def _(t):
    columns = "'job-' || cast(l_orderkey AS string) || CASE WHEN l_linestatus = 'F' THEN '/frames/frame_' ELSE '/temp/frame_' END || lpad(cast(l_linenumber AS string), 4, '0') || CASE WHEN l_returnflag = 'A' THEN '.png.gz' ELSE '.png' END AS key"
    found = E.incremental_orphans(t.stream_raw("lineitem").selectExpr(columns), t("jobs"))
    return run_to_table(t.spark, found.select("job_id", "key"), "orphans").distinct()

