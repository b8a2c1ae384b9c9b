"""A stream of the lines that are appended to files.

Spark's text stream sees new files only. Here an offset is the number of bytes
of each file that have been read, always up to the end of a line, so a line
comes once, whole, however often the file grows and the stream is restarted
from its checkpoint. Long additions are cut into ranges that tasks read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.sources.ordered import qualified

#: Bytes of a file that one task reads, and that are looked through at a time for the last end of a line.
RANGE = 64 << 20
LOOK = 1 << 16


def _source():
    """The data source; made here so that it travels to the tasks by value."""
    import json
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    def files(uri: str, suffix: str):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        info = store.get_file_info(path)
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(path, recursive=True))
            return store, sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not f.base_name.startswith((".", "_")))
        return store, [(path, info.size)] if info.type == fs.FileType.File else []

    def last_end(store, path: str, start: int, size: int, look: int) -> int:
        """The place behind the last line break before ``size``, not before ``start``."""
        with store.open_input_file(path) as data:
            at = size
            while at > start:
                first = max(start, at - look)
                found = data.read_at(at - first, first).rfind(b"\n")
                if found >= 0:
                    return first + found + 1
                at = first
        return start

    @dataclass
    class Range(InputPartition):
        path: str
        first: int
        last: int
        floor: int

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.uri, self.suffix = options["uri"], options.get("suffix", "")
            self.range, self.look = int(options["range"]), int(options["look"])
            self.seen = {}

        def initialOffset(self):
            return {"files": "{}"}

        def latestOffset(self):
            store, found = files(self.uri, self.suffix)
            ends = {}
            for path, size in found:
                known = self.seen.get(path, 0)
                ends[path] = last_end(store, path, known, size, self.look) if size > known else known
            self.seen = ends
            return {"files": json.dumps(ends, sort_keys=True)}

        def partitions(self, start, end):
            before, after = json.loads(start["files"]), json.loads(end["files"])
            self.seen = {**after, **self.seen}
            out = []
            for path, last in sorted(after.items()):
                floor = before.get(path, 0)
                out += [Range(path, a, min(a + self.range, last), floor) for a in range(floor, last, self.range)]
            return out

        def read(self, partition):
            import io

            from pyarrow import fs

            store, _ = fs.FileSystem.from_uri(self.uri)
            with io.BufferedReader(store.open_input_file(partition.path), 1 << 20) as data:
                # a line belongs to the range that holds its first byte
                data.seek(max(partition.first - 1, partition.floor))
                at = data.tell()
                if partition.first > partition.floor:
                    skipped = data.readline()
                    while skipped and not skipped.endswith(b"\n"):
                        skipped = data.readline()
                    at = data.tell()
                while at < partition.last:
                    line = data.readline()
                    if not line:
                        break
                    yield partition.path, at, line.rstrip(b"\n").decode("utf-8", "replace")
                    at += len(line)

        def commit(self, end):
            pass

    class Appended(DataSource):
        @classmethod
        def name(cls):
            return "appended_lines"

        def schema(self):
            return "path string, at long, raw string"

        def streamReader(self, schema):
            return Reader(self.options)

    return Appended


def appended_lines(spark: SparkSession, path: str, suffix: str = ".jsonl") -> DataFrame:
    """A stream of (path, at, raw): each line that is appended to the file, or to the files below the folder, and the byte it begins at.

    A line without its end waits for it. A file that shrinks or is replaced by
    another of its name is not seen as new; files whose names begin with a dot
    or an underscore, or end in another way than ``suffix``, are left out.
    """
    spark.dataSource.register(_source())
    return spark.readStream.format("appended_lines").options(uri=qualified(spark, path), suffix=suffix, range=str(RANGE), look=str(LOOK)).load()
