"""Incremental runs: a cursor over lines, a stream of new files, seen keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.rollup import next_start
from corpusmill.sources.jsonl import exists
from corpusmill.sources.staging import staged

#: Folders that the keys of a batch are dealt to.
BUCKETS = 64


def since(rows: DataFrame, cursor: int) -> DataFrame:
    """Lines from the cursor on."""
    return rows.where(F.col("line_num") >= cursor)


def unpurified(rows: DataFrame) -> DataFrame:
    """Rows that still name refs or history."""
    return rows.where(F.col("has_refs_key") | F.col("has_history_key"))


def run_incrementally(spark: SparkSession, directory: str, checkpoint: str, process: Callable[[DataFrame, int], DataFrame], state: str):
    """New JSONL files below ``directory`` in micro-batches.

    ``process(lines, batch)`` returns (line_num, run_status) rows. They are
    appended to ``state`` under their batch number, so a replayed batch
    overwrites its own part, and the cursor is derived from all of them: it
    never passes the earliest failure.
    """
    lines = spark.readStream.text(directory)

    def commit(batch: DataFrame, number: int) -> None:
        process(batch, number).select("line_num", "run_status").write.mode("overwrite").parquet(f"{state}/batch={number}")

    return lines.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cursor_of(spark: SparkSession, state: str) -> DataFrame:
    """The next start over all committed batches."""
    return next_start(spark.read.parquet(state), "line_num", "run_status")


def first_seen(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """T5: a stream's first row of each key; keys are forgotten after ``delay``."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def first_ever(stream: DataFrame, keys: list[str], store: str, checkpoint: str):
    """T5: starts a query that keeps a stream's first row of each key, ever, below ``store``.

    A batch is held against the keys of all batches before it, which lie
    beside the rows in buckets of their hash, so nothing is forgotten after
    any delay or restart. A batch that is replayed reads the same earlier keys
    and overwrites its own part. Of rows of one batch with one key any one
    stays; null keys are one key. ``first_rows`` reads the result.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        key = F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)
        rows = batch.withColumn("k_key", key).withColumn("k_bucket", F.pmod(F.xxhash64("k_key"), F.lit(BUCKETS)).cast("int")).dropDuplicates(["k_key"])
        if exists(spark, f"{store}/keys"):
            before = spark.read.schema("k_key string, k_bucket int, batch long").parquet(f"{store}/keys").where(F.col("batch") < number)
            rows = rows.join(before.select("k_key", "k_bucket"), ["k_bucket", "k_key"], "left_anti")
        new = staged(rows)
        new.drop("k_key", "k_bucket").write.mode("overwrite").parquet(f"{store}/rows/batch={number}")
        new.select("k_key", "k_bucket").repartition("k_bucket").write.mode("overwrite").partitionBy("k_bucket").parquet(f"{store}/keys/batch={number}")

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_rows(spark: SparkSession, store: str) -> DataFrame:
    """What ``first_ever`` has kept so far."""
    return spark.read.parquet(f"{store}/rows").drop("batch")


def windowed_counts(events: DataFrame, time: str, key: str, width: str, delay: str) -> DataFrame:
    """T7, an addition of this engine: counts of each key in tumbling windows with a watermark."""
    counted = events.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), key, "n")
