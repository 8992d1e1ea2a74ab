"""Runs a stream over what is there now, into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameline.session import scratch_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State too large for the heap, and keyed state with timers, need this store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def run_to_table(spark: SparkSession, stream: DataFrame, purpose: str, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Processes everything available, appends it to Parquet and returns the table.

    Output and checkpoint live in the shared scratch folder; running again with the same ``path`` goes on
    where the last run stopped.
    """
    path = scratch_dir(spark, purpose) if path is None else path
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/_progress").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need an instant, the tables hold zone-less times: read them as UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
