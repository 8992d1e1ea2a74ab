"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameline.session import scratch_dir

_CONTROL_SPACE = re.compile("[\x1c-\x1f]")
_UNICODE_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ASCII_WORD = re.compile("[^ \t-\r]+")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` (long) and ``text`` (null: empty) alone, so that other columns can neither clash nor be shuffled."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_space(text: str) -> list[str]:
    """Pieces between runs of Unicode white space (``str.split`` also cuts at U+001C to U+001F, which is no white space)."""
    if _CONTROL_SPACE.search(text):
        return [x for x in _UNICODE_SPACE.split(text) if x]
    return text.split()


def ascii_words(text: str) -> list[str]:
    """Words between runs of ASCII space, tab, LF, VT, FF and CR."""
    if text.isascii() and not _CONTROL_SPACE.search(text):
        return text.split()
    return _ASCII_WORD.findall(text)
