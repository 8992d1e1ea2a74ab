"""Reduces the rows of a stream before they are shuffled.

A streaming ``groupBy`` always keeps state, so Spark has no partial aggregation that a keyed operator could start from.
These passes do that step: each task reduces what it reads, in bounded memory, to one row for a key. However many rows a
key has, its group then holds at most a few rows for each task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

HELD = 1 << 16  # keys a task holds before it gives them out
BLOCK = 1 << 13  # frames of a bitmap
SENT = 1 << 12  # bitmaps of a record batch


def combined(rows: DataFrame, keys: Sequence[str], folds: dict[str, str]) -> DataFrame:
    """``keys`` and each column of ``folds`` reduced by its function (``sum``, ``min`` or ``max``), several rows a key."""
    names = [*keys, *folds]
    shape = T.StructType([rows.schema[n] for n in names])

    def fold(table: pa.Table) -> pa.Table:
        done = table.group_by(list(keys), use_threads=False).aggregate(list(folds.items()))
        return done.select([*keys, *[f"{c}_{f}" for c, f in folds.items()]]).rename_columns(names).cast(table.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            fresh = fold(pa.Table.from_batches([batch]))
            held = fresh if held is None else fold(pa.concat_tables([held, fresh]))
            if held.num_rows >= HELD:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return rows.select(*names).mapInArrow(run, shape)


def frame_bitmaps(frames: DataFrame) -> DataFrame:
    """``job_id, total, block, bits, at`` from ``job_id, n, total, at``: the frames of a task as bitmaps.

    A bitmap holds ``BLOCK`` neighbouring frame numbers, ``at`` is the latest time. A task holds ``HELD`` bitmaps before it
    gives them out. Numbers below 1 and rows without a job or number are left out.
    """
    shape = pa.schema([("job_id", pa.string()), ("total", pa.int64()), ("block", pa.int64()), ("bits", pa.binary()), ("at", pa.int64())])

    def given(held: dict) -> Iterator[pa.RecordBatch]:
        rows = [(job, total, block, bits.to_bytes((bits.bit_length() + 7) // 8, "little"), at) for (job, block), (bits, total, at) in held.items()]
        for start in range(0, len(rows), SENT):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[start : start + SENT]), shape)], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for job, n, total, at in zip(*[c.to_pylist() for c in batch.columns]):
                if job is None or n is None or total is None or n < 1:
                    continue
                block, bit = divmod(int(n) - 1, BLOCK)
                bits, most, latest = held.get((job, block), (0, total, at))
                held[job, block] = (bits | 1 << bit, max(most, total), at if latest is None else latest if at is None else max(latest, at))
            if len(held) >= HELD:
                yield from given(held)
                held = {}
        yield from given(held)

    return frames.select("job_id", "n", "total", "at").mapInArrow(run, "job_id string, total bigint, block bigint, bits binary, at bigint")
