"""Building blocks that keep one hot key from landing in one task.

All of them are plain DataFrame compositions: coarse pre-aggregation, value chunks as extra partition
keys, and deterministic salts (a hash of the row, so a retried task sends every row to the same place).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
HOT_KEYS = 256  # keys the sketch may name, at most
TRACKED = 8192  # counters of the sketch
HOT_SHARE = 0.005  # share of all rows above which a key is hot


def small_enough(df: DataFrame) -> bool:
    """Whether the values of ``df`` take less than the session's broadcast threshold, by one pass over it."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()).groups()
    limit = int(number) << 10 * " kmgt".index(unit or " ")
    if limit < 0:
        return False
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c, kind in df.dtypes if "<" not in kind), F.lit(16))
    nested = sum((F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c, kind in df.dtypes if "<" in kind), F.lit(0))
    return df.agg(F.coalesce(F.sum(width + nested), F.lit(0)).alias("n")).first()["n"] <= limit


def _whole(on: Sequence[str]) -> Column:
    """The key as one value: itself, or the texts of its columns."""
    return F.col(on[0]) if len(on) == 1 else F.concat_ws("\x1f", *[F.col(k).cast("string") for k in on])


def _hashable(df: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """``_key``: the keys that hold more than ``share`` of the rows, at most ``HOT_KEYS`` of them.

    One pass with a frequent-items sketch of fixed size, merged from the tasks: a key with that many rows cannot be
    missed (its error is below the share as long as the sketch has more counters than 1 / share), and no key is shuffled.
    The pass reads all columns, as the join does, so a shuffle below both is made once and used again.
    """
    held = df.select(_whole(on).alias("k"), F.xxhash64(*_hashable(df)).alias("_row"))
    found = held.agg(F.expr(f"approx_top_k(k, {HOT_KEYS}, {TRACKED})").alias("top"), F.count("k").alias("rows"), F.max("_row").alias("_row"))
    each = found.filter(F.col("_row").isNotNull()).select("rows", F.explode("top").alias("t")).filter(F.col("t.count") > F.col("rows") * share)
    return each.select(F.col("t.item").alias("_key"))


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join where a key of ``big`` may repeat without bound and ``small`` has few rows per key.

    A ``small`` below the broadcast threshold (its values are measured) is broadcast: nothing of ``big`` moves, so keys
    do not matter. Otherwise the keys a sketch names as hot are spread over ``salts`` groups by a hash of the row, and
    only their rows of ``small`` are repeated, once for each group; all other keys are joined as they are. Both sides
    stay complete. ``how`` keeps ``big`` on the left: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat the right side")
    if small_enough(small):
        return big.join(F.broadcast(small), list(on), how)
    if len(on) > 1 and [dict(big.dtypes)[k] for k in on] != [dict(small.dtypes)[k] for k in on]:
        raise ValueError("the columns of a compound key differ in type")
    hot = F.broadcast(hot_keys(big, on).withColumn("_hot", F.lit(True)))  # at most HOT_KEYS rows
    spread = F.pmod(F.xxhash64(*_hashable(big)), F.lit(salts)).cast("int")
    left = big.withColumn("_key", _whole(on)).join(hot, "_key", "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0)).drop("_hot", "_key")
    copies = F.sequence(F.lit(0), F.when(F.col("_hot"), salts - 1).otherwise(0))
    right = small.withColumn("_key", _whole(on)).join(hot, "_key", "left").withColumn("_salt", F.explode(copies)).drop("_hot", "_key")
    if how in ("left_semi", "left_anti") and [dict(big.dtypes)[k] for k in on] == [dict(small.dtypes)[k] for k in on]:
        # one key that is never null: no filter of nulls is put below a semi join, so it shares its shuffle with an anti join
        placed = right.dropna(subset=list(on)).select(F.struct(*on, "_salt").alias("_place"))
        rest = [F.col(f"`{c}`") for c in big.columns if c not in on]
        found = left.select(F.struct(*on, "_salt").alias("_place"), *rest).join(placed, "_place", how)
        return found.select(*[F.col("_place")[k].alias(k) for k in on], *rest)
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def expand_range(df: DataFrame, low: Column, high: Column, name: str, spread: Sequence[str], block: int = 4096) -> DataFrame:
    """One row per integer of ``[low, high]``.

    The range is cut into blocks first and the blocks are shuffled by ``spread`` and block number, so that
    one very long range is expanded by many tasks. Empty ranges give no row.
    """
    blocks = (
        df.filter(high >= low)
        .withColumn("_lo", low.cast("long"))
        .withColumn("_hi", high.cast("long"))
        .withColumn("_block", F.explode(F.expr(f"sequence(0L, (_hi - _lo) div {block})")))
        .repartition(*spread, "_block")
    )
    return blocks.withColumn(
        name, F.explode(F.expr(f"sequence(_lo + _block * {block}, least(_hi, _lo + _block * {block} + {block - 1}))"))
    ).drop("_lo", "_hi", "_block")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


HOT_ROWS = 1_000_000


def _chunked(df: DataFrame, keys: Sequence[str], chunk: Column, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_chunk``, null but for groups of more than ``hot_rows`` rows; and the rows of those groups.

    Groups are counted first (with map-side combine), so only the hot ones are cut, and whatever is computed per chunk
    is a table of the chunks of hot groups.
    """
    if not keys:
        rows = df.withColumn("_chunk", chunk)
        return rows, rows
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_many")).filter(F.col("_many") > hot_rows)
    hot = F.broadcast(hot)  # one row for each hot_rows rows at most; a shuffle by the group would put it into one task
    rows = _null_safe(df, hot, keys, "left").withColumn("_chunk", F.when(F.col("_many").isNotNull(), chunk))
    return rows.drop("_many"), rows.filter(F.col("_many").isNotNull()).drop("_many")


def ranked_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str = "rank", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``row_number`` per group without ever sorting more than a chunk of a large group in one task.

    ``chunk`` must never decrease along ``order``. Groups of at most ``hot_rows`` rows are numbered as they are; larger
    ones inside (group, chunk), the offset of a chunk being the running total of the chunk sizes before it.
    """
    rows, hot = _chunked(df, keys, chunk, hot_rows)
    sizes = hot.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    numbered = rows.withColumn("_inside", F.row_number().over(inside))
    return (
        _null_safe(numbered, offsets, [*keys, "_chunk"], "left")
        .withColumn(name, (F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_inside")).cast("long"))
        .drop("_chunk", "_inside", "_offset")
    )


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``prev`` and ``next`` structs holding ``values`` of the row before and after within the group.

    Same chunking as :func:`ranked_in_group`: neighbours inside a chunk come from a window over the chunk,
    neighbours across a chunk edge from the first and last row of every chunk.
    """
    rows, hot = _chunked(df, keys, chunk, hot_rows)
    held = F.struct(*[F.col(v) for v in values])
    sortable = F.struct(*[F.col(o) for o in order], held.alias("_held"))
    edges = hot.groupBy(*keys, "_chunk").agg(F.min(sortable).alias("_first"), F.max(sortable).alias("_last"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    edges = edges.select(
        *keys, "_chunk",
        F.lag("_last._held").over(along).alias("_before"),
        F.lead("_first._held").over(along).alias("_after"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    linked = rows.withColumn("_prev", F.lag(held).over(inside)).withColumn("_next", F.lead(held).over(inside))
    return (
        _null_safe(linked, edges, [*keys, "_chunk"], "left")
        .withColumn("prev", F.coalesce("_prev", "_before"))
        .withColumn("next", F.coalesce("_next", "_after"))
        .drop("_chunk", "_prev", "_next", "_before", "_after")
    )
