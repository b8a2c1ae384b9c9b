"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: The word separators of every contract here: space and U+0009 to U+000D.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names it; only where that is unset on a local
    master (tests, a laptop) a folder in the warehouse takes its place.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{base.rstrip('/')}/corpusmill-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "t", compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    It cuts the lineage, and a lost executor costs no recomputation.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Jobs that run inside send texts to Python ``rows`` at a time, so the buffers between the two stay small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def held_by_process(key: str, make: Callable[[], T]) -> T:
    """What ``make`` gave when this process first asked for ``key``.

    Functions travel to tasks by value, and their globals with them, so a
    plain global is made anew for every task. A module of this process's own
    outlasts them, and so does the Python process, which Spark uses again.
    """
    module = sys.modules.setdefault("_corpusmill_held", ModuleType("_corpusmill_held"))
    if key not in module.__dict__:
        module.__dict__[key] = make()
    return module.__dict__[key]


#: Bytes of text that a task takes apart at a time.
PART_BYTES = 2 << 20


def in_parts(batches: Iterator[pa.RecordBatch], column: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, a row at least; word lists take many times a text's room."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        slot = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield batch.slice(a, b - a)


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def share_of(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null keys count as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
