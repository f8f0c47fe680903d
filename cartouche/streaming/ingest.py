"""Incremental ingest: landed pages to cleaned rows, id dedup, batches merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartouche.operators import clean
from cartouche.operators.ordered import pick_first
from cartouche.sources.files import PARTITION_COLUMNS


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def durable_state(spark: SparkSession) -> None:
    """Keep the state of streams that start from now on in RocksDB on the executors' disks, outside the heap, and save its
    changes (not whole snapshots) with every micro-batch, so that a restart or a lost executor replays a short log."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def cleaned(rows: DataFrame, view: str) -> DataFrame:
    """The batch cleaning of one view; it is stateless, so a stream takes it unchanged."""
    return clean.apply_view_rules(clean.identified(rows)[0], view)


def append_partitions(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Drain what has landed into partitioned Parquet (``availableNow``), exactly once per file."""
    keys = partition_by or [c for c in PARTITION_COLUMNS if c in stream.columns]
    return (
        stream.writeStream.format("parquet")
        .partitionBy(*keys)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def dedup_ids(stream: DataFrame, time: str = "fetched_at", lateness: str = "1 day") -> DataFrame:
    """First row per filing id within the lateness; state is dropped behind the watermark and kept outside the heap."""
    durable_state(stream.sparkSession)
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["filing_id"])


def land_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", build: Callable[[DataFrame], DataFrame] = lambda batch: batch
) -> StreamingQuery:
    """Drain a stream into ``path/batch=N``, one folder per micro-batch.

    Nothing landed before is read or rewritten; a batch that runs again after a failure replaces its own folder. In
    ``update`` mode a drained run holds every group, also those that a watermark would keep open.
    """

    durable_state(stream.sparkSession)

    def land(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def merged(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of landed batches, the last per key: by ``order``, then by batch. An upsert at read; ``compact`` stores it."""
    landed = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    return pick_first(landed, keys, [*(order or []), F.col("batch").desc()]).drop("batch")


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: list[str], order: list[Column] | None = None) -> None:
    """Write the merged rows as a table of their own, for instance once a day."""
    merged(spark, path, schema, keys, order).write.mode("overwrite").parquet(target)
