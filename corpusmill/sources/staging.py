"""Intermediate tables in the folder that the session names for them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str = "t") -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the warehouse takes its place; on a
    cluster, where executors do not share the driver's disk, it must be set.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{base.rstrip('/')}/corpusmill-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` written below the shared folder and read again: a short plan, and nothing to recompute."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
