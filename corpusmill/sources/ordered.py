"""One file in a given order, written by many tasks.

Spark's own writers leave a folder of parts. Here each task writes its part
below a hidden folder beside the target and reports its number; when all have
ended the driver's side strings the parts together in that order, copying a
few megabytes at a time, and renames once. A task that failed and ran again
leaves a part that nobody names, a job that failed leaves the old target.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are copied at a time.
PIECE = 4 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark finds it in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:///", system.makeQualified(place).toUri().toString())


def _source():
    """The data source; made here so that it travels to the tasks by value."""
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    @dataclass
    class Part(WriterCommitMessage):
        number: int
        name: str
        rows: int

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.target, self.hidden = options["target"], options["hidden"]
            self.header, self.separator, self.footer, self.empty = (bytes.fromhex(options[k]) for k in ("header", "separator", "footer", "empty"))
            self.piece = int(options["piece"])

        def _store(self):
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.target)
            hidden = fs.FileSystem.from_uri(self.hidden)[1]
            return store, path, hidden

        def write(self, iterator):
            from pyspark import TaskContext

            store, _, hidden = self._store()
            task = TaskContext.get()
            name, n = f"part-{task.partitionId():06d}-{task.taskAttemptId()}", 0
            with store.open_output_stream(f"{hidden}/{name}", compression=None) as out:
                for row in iterator:
                    out.write((self.separator if n else b"") + row[0].encode())
                    n += 1
            return Part(task.partitionId(), name, n)

        def commit(self, messages):
            store, path, hidden = self._store()
            parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number)
            with store.open_output_stream(f"{hidden}/whole", compression=None) as out:
                out.write(self.header if parts else self.empty)
                for k, part in enumerate(parts):
                    out.write(self.separator if k else b"")
                    with store.open_input_stream(f"{hidden}/{part.name}", compression=None) as data:
                        while piece := data.read(self.piece):
                            out.write(piece)
                out.write(self.footer if parts else b"")
            store.move(f"{hidden}/whole", path)
            store.delete_dir(hidden)

        def abort(self, messages):
            store, _, hidden = self._store()
            store.delete_dir(hidden)

    class OneFile(DataSource):
        @classmethod
        def name(cls):
            return "one_ordered_file"

        def schema(self):
            return "value string"

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return OneFile


def write_one_file(rows: DataFrame, path: str, *order: str | Column, text: Column | str = "raw", header: str = "", separator: str = "\n", footer: str = "\n", empty: str = "") -> str:
    """The texts of ``rows`` as one file at ``path``, in the given order, with ``separator`` between them.

    Rows alike in ``order`` stand in any order; nulls come first. A null text
    is an empty one. A table without rows gives a file of ``empty``.
    """
    spark = rows.sparkSession
    target = qualified(spark, path)
    folder, _, name = target.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hidden)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    spark.dataSource.register(_source())
    marks = {k: v.encode().hex() for k, v in (("header", header), ("separator", separator), ("footer", footer), ("empty", empty))}
    value = F.col(text) if isinstance(text, str) else text
    lines = rows.orderBy(*order).select(F.coalesce(value.cast("string"), F.lit("")).alias("value"))
    lines.write.format("one_ordered_file").options(target=target, hidden=hidden, piece=str(PIECE), **marks).mode("append").save()
    return target
