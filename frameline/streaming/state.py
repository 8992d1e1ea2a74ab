"""Keyed state: dead letters, the job state machine, alarms over periods in a row, completion.

Rows are reduced before the shuffle (:mod:`frameline.streaming.combine`), so a hot key is no large group. Keys are dealt to
a fixed number of groups, and the keyed operator is called once for a group. State has a fixed size for a key (completion:
a bit for a frame until the job is complete) and a finite life: event-time timers drop it a stated number of days after
the last row of its key; rows that come later than the stated delay are left out. Processing-time expiry is not used:
what is forgotten would depend on when a run happens. Results do not depend on the order of rows inside a batch.

The newer ``transformWithStateInPandas`` was tried for all three operators and brought no gain: both calls cost
milliseconds a group (README has the figures), so the keyed call stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from frameline.operators.metrics import rule_breach
from frameline.streaming.combine import combined, frame_bitmaps
from frameline.streaming.run import use_rocksdb

STAGES = ("extract", "process", "recompose")
DAY_MS = 86_400_000
GROUPS = 1 << 11  # groups of keys, each one state


Step = Callable[[tuple, list[tuple], "tuple | None"], "tuple[tuple, list]"]


def _keyed(
    rows: DataFrame, key: str | tuple[str, ...], fields: Sequence[str], step: Step, value: str, output: str, keep_days: float, delay: str, groups: int = GROUPS,
) -> DataFrame:
    """Calls ``step(key, rows, value)`` for each key of a batch; it returns the new value and the output rows.

    ``rows`` are reduced and need ``seen``, the time of a row in milliseconds; the step gets their ``fields`` as tuples. The
    value is forgotten ``keep_days`` after the latest, as soon as the watermark, which stays ``delay`` behind, has passed.
    A call of Spark's keyed operator costs milliseconds, so keys are dealt to ``groups`` by their hash and a group is one
    call and one state, holding the values of its keys. ``groups`` must stay the same as long as a checkpoint is used.
    """
    use_rocksdb(rows.sparkSession)
    keys = [key] if isinstance(key, str) else list(key)
    keep_ms, columns, width = int(keep_days * DAY_MS), [c.split()[0] for c in output.split(", ")], len(keys)

    def run(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark, parts, out = state.getCurrentWatermarkMs(), {}, []
        held = {tuple(h[:width]): tuple(h[width:]) for h in state.get[0]} if state.exists else {}
        if not state.hasTimedOut:
            for chunk in chunks:
                for row in zip(*[chunk[c].tolist() for c in (*keys, *fields, "seen")]):
                    parts.setdefault(row[:width], []).append(row[width:])
        held = {k: h for k, h in held.items() if k in parts or h[-1] >= watermark}
        for one, new in parts.items():
            *before, last, _ = held.get(one, (0, 0))
            after, told = step(one, [r[:-1] for r in new], tuple(before) or None)
            last = max([last, *[int(r[-1]) for r in new if not pd.isna(r[-1])]])
            held[one] = (*after, last, max(last, watermark) + keep_ms)
            out += told
        if held:
            state.update(([(*k, *h) for k, h in held.items()],))
            state.setTimeoutTimestamp(max(min(h[-1] for h in held.values()), watermark))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=columns)

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    timed = rows.withColumn("seen_at", F.timestamp_millis("seen")).withWatermark("seen_at", delay)
    dealt = timed.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    held = f"held array<struct<{kinds}, {value}, last bigint, until bigint>>"
    return dealt.groupBy("_group").applyInPandasWithState(run, output, held, "append", "EventTimeTimeout")


def _millis(time: str | Column) -> Column:
    return F.unix_millis((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def dead_letters(receives: DataFrame, limit: int = 5, retention_days: float = 14, delay: str = "1 hour") -> DataFrame:
    """Messages received more than ``limit`` times (5 receives are allowed), each given out once.

    A message is forgotten ``retention_days`` after its last receive, by event time.
    """

    def count(key: tuple, rows: list[tuple], value: tuple | None) -> tuple[tuple, list]:
        before = value[0] if value else 0
        after = before + sum(int(n) for n, in rows)
        return (after,), [(key[0],)] if before <= limit < after else []

    rows = receives.select("message_id", F.lit(1).cast("bigint").alias("n"), _millis("ts").alias("seen"))
    reduced = combined(rows, ["message_id"], {"n": "sum", "seen": "max"})
    return _keyed(reduced, "message_id", ["n"], count, "n bigint", "message_id string", retention_days, delay)


def job_states_batch(changes: DataFrame) -> DataFrame:
    """Where each job stands: its stages done in a row, and whether the next one failed first.

    ``changes`` holds ``job_id, stage, status, ts``. Only the first COMPLETED and first FAILED of a stage
    count, so one aggregation is enough. This is also what the stream must add up to.
    """
    first = [
        F.min(F.when((F.col("stage") == s) & (F.col("status") == status), F.col("ts"))).alias(f"{s}_{status}")
        for s in STAGES for status in ("COMPLETED", "FAILED")
    ]
    return _verdict(changes.groupBy("job_id").agg(*first))


def _verdict(firsts: DataFrame) -> DataFrame:
    never = F.lit("9999-12-31 00:00:00").cast("timestamp")
    state, open_path = F.lit("COMPLETED"), []
    for s in STAGES:
        done, failed = (F.coalesce(F.col(f"{s}_{x}").cast("timestamp"), never) for x in ("COMPLETED", "FAILED"))
        open_path.append((F.when(failed < done, f"{s}_failed"), (done == never) & (failed == never), s))
    for failed, waiting, s in reversed(open_path):
        state = F.coalesce(failed, F.when(waiting, f"{s}_waiting"), state)
    return firsts.select("job_id", state.alias("state"))


def job_state_machine(changes: DataFrame, keep_days: float = 30, delay: str = "1 hour") -> DataFrame:
    """Ends of jobs (all stages done, or a stage failed before it was done): ``job_id, state, revision``.

    The state of a job is the first COMPLETED and first FAILED time of every stage. An end is given out as soon as it is
    known. A record that arrives late may change it (also back to waiting); the job is then given out again with the next
    revision, so its highest revision (:func:`latest_verdicts`) does not depend on the order in which records arrive.
    A job is forgotten ``keep_days`` after its last record, by event time, whether it has ended or not.
    """
    slots = [(s, x) for s in STAGES for x in ("COMPLETED", "FAILED")]

    def advance(key: tuple, rows: list[tuple], value: tuple | None) -> tuple[tuple, list]:
        *held, told, revision = value or (*[None] * len(slots), None, 0)
        for stage, status, at in rows:
            if (stage, status) in slots and not pd.isna(at):
                i = slots.index((stage, status))
                held[i] = at if held[i] is None else min(held[i], at)
        end, over = "COMPLETED", True
        for i, stage in enumerate(STAGES):
            done, failed = held[2 * i], held[2 * i + 1]
            if failed is not None and (done is None or failed < done):
                end = f"{stage}_failed"
                break
            if done is None:
                end, over = f"{stage}_waiting", False
                break
        news = end != told and (over or told is not None)
        if news:
            told, revision = end, revision + 1
        return (*held, told, revision), [(key[0], end, revision)] if news else []

    at = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    needed = changes.filter(F.col("status").isin("COMPLETED", "FAILED")).select("job_id", "stage", "status", at.alias("at"), _millis("ts").alias("seen"))
    reduced = combined(needed, ["job_id", "stage", "status"], {"at": "min", "seen": "max"})
    value = ", ".join(f"{s}_{x} double" for s, x in slots) + ", told string, revision bigint"
    return _keyed(reduced, "job_id", ["stage", "status", "at"], advance, value, "job_id string, state string, revision bigint", keep_days, delay)


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """``job_id, state`` of the jobs that are at an end by their highest revision."""
    newest = verdicts.groupBy("job_id").agg(F.max_by("state", "revision").alias("state"))
    return newest.filter(~F.col("state").endswith("_waiting"))


def streaming_alarms(stats: DataFrame, key: Column, breach: Column, period_seconds: int, periods: int, keep_days: float = 30) -> DataFrame:
    """Alarm changes under one rule over a stream of closed period statistics; a missing period breaks the run."""
    rows = stats.select(F.lit("").alias("alarm"), key.alias("alarm_key"), "period_start", F.coalesce(breach, F.lit(False)).alias("breach"), F.lit(periods).alias("periods"))
    return _alarm_changes(rows, period_seconds, keep_days).drop("alarm")


def streaming_rules(stats: DataFrame, rules: DataFrame, keys: Sequence[str], period_seconds: int, metric: str = "name", keep_days: float = 30) -> DataFrame:
    """``alarm, alarm_key, period_start, state``: alarm changes of a static table of rules over a stream of statistics.

    As :func:`frameline.operators.metrics.evaluate_rules`; ``alarm_key`` is the series, its keys joined by ``/``.
    """
    watched = rules.select("alarm", F.col("name").alias(metric), "comparison", "threshold", "periods")
    rows = stats.join(watched, metric).select("alarm", F.concat_ws("/", *keys).alias("alarm_key"), "period_start", rule_breach(F.col("stat_value")).alias("breach"), "periods")
    return _alarm_changes(rows, period_seconds, keep_days)


def _alarm_changes(rows: DataFrame, period_seconds: int, keep_days: float) -> DataFrame:
    """A series has one row a period, so even a whole history in one batch is small.

    Periods of a series must not come in an earlier batch than periods before them, which holds for closed windows. A
    series that has been silent for ``keep_days`` is forgotten (the gap has ended its run, an alarm starts anew).
    """

    def follow(key: tuple, new: list[tuple], value: tuple | None) -> tuple[tuple, list]:
        at, length, alarm = value or (None, 0, False)
        out = []
        for now, hit, periods in sorted(new, key=lambda r: r[0]):
            unbroken = at is not None and now == at + period_seconds
            length = (length + 1 if unbroken else 1) if hit else 0
            at, before, alarm = now, alarm, length >= periods
            if alarm != before:
                out.append((*key, now, "ALARM" if alarm else "OK"))
        return (at, length, alarm), out

    timed = rows.withColumn("at", F.unix_seconds(F.col("period_start").cast("timestamp"))).drop("period_start").withColumn("seen", F.col("at") * 1000)
    changes = _keyed(timed, ("alarm", "alarm_key"), ["at", "breach", "periods"], follow, "at bigint, length bigint, alarm boolean", "alarm string, alarm_key string, at bigint, state string", keep_days, "0 seconds")
    return changes.select("alarm", "alarm_key", F.timestamp_seconds("at").alias("period_start"), "state")


def progress_stream(frames: DataFrame, jobs: DataFrame, time: str = "ts", keep_days: float = 30, delay: str = "1 hour") -> DataFrame:
    """Completion signal per job, once, from a stream of frames (``job_id, n``) and a static ``job_id, total`` table.

    A frame that comes again counts once. Frames are reduced to bitmaps before the shuffle, and the state of a job is
    such bitmaps, dropped when it is complete. A job is forgotten ``keep_days`` after its last frame, by event time.
    """

    def count(key: tuple, rows: list[tuple], value: tuple | None) -> tuple[tuple, list]:
        frames, done, blocks, bits = value or (0, False, (), ())
        total = max(int(r[0]) for r in rows)
        if done:
            return (frames, True, [], []), []
        held = {int(b): int.from_bytes(bytes(x), "little") for b, x in zip(blocks, bits)}
        for _, block, more in rows:
            old = held.get(block, 0)
            held[block] = new = old | int.from_bytes(bytes(more), "little")
            frames += new.bit_count() - old.bit_count()
        if frames >= total:
            return (frames, True, [], []), [(key[0], total)]
        return (frames, False, list(held), [x.to_bytes((x.bit_length() + 7) // 8, "little") for x in held.values()]), []

    known = frames.select("job_id", "n", _millis(time).alias("at")).join(jobs.select("job_id", "total"), "job_id")
    reduced = frame_bitmaps(known).withColumnRenamed("at", "seen")
    value = "frames bigint, done boolean, blocks array<bigint>, bits array<binary>"
    return _keyed(reduced, "job_id", ["total", "block", "bits"], count, value, "job_id string, total bigint", keep_days, delay)
