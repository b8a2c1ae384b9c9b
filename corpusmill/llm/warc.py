"""WARC archives: a sink and a sequential reader.

One gzip member holds one record. The sink runs in tasks and writes each
archive under a temporary name that it then renames, so a repeated task leaves
the same files. The reader takes archives from Spark's binaryFile source,
inflates member after member in small pieces, frames blocks by
Content-Length and verifies each payload digest.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import scratch_dir, stage, table

#: Equal payloads from this many bytes on are stored once.
REVISIT_BYTES = 100
#: An archive is closed once its records' payloads reach this size.
ARCHIVE_BYTES = 8 << 20
PIECE = 1 << 16
DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record that is framed wrongly or whose payload has another digest."""


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def record(row: dict) -> bytes:
    """The gzip member of one record."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, row['w_name'])}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(row['url'] or '')}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    head += [f"X-Page-ID: {row['page_id']}"] if row["page_id"] is not None else []
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        head += [f"X-Refers-To-Page-ID: {row['refers_to']}"] if row["refers_to"] is not None else []
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n", 6, mtime=0)


def _sink(directory: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(directory)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        out, name, size, count, done = None, "", 0, 0, []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                store.move(f"{root}/_tmp-{attempt}-{name}", f"{root}/{name}")
                done.append((name, count))
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"part-{part:06d}-{len(done):04d}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/_tmp-{attempt}-{name}", compression=None)
                out.write(record(row | {"w_name": f"{name}/{count}"}))
                size, count = size + len(row["payload"] or b""), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())], ["archive", "records"])

    return write


class _Inflated:
    """The members of an archive, each inflated in pieces as it is read."""

    def __init__(self, data):
        self.data, self.at = memoryview(data), 0

    def next_member(self) -> bool:
        self.z, self.buffer = zlib.decompressobj(31), bytearray()
        return self.at < len(self.data)

    def _more(self) -> bool:
        if self.z.eof:
            return False
        if self.at >= len(self.data):
            raise WarcError("the archive ends inside a member")
        piece = self.data[self.at : self.at + PIECE]
        try:
            self.buffer += self.z.decompress(piece)
        except zlib.error as e:
            raise WarcError(str(e)) from None
        self.at += len(piece) - len(self.z.unused_data)
        return True

    def line(self) -> bytes:
        while (end := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                raise WarcError("the head is cut off")
        out = bytes(self.buffer[:end])
        del self.buffer[: end + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise WarcError("the block is shorter than Content-Length")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def end(self) -> None:
        while self._more():
            pass
        if bytes(self.buffer) != b"\r\n\r\n":
            raise WarcError("the block is longer than Content-Length")


def read_records(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of one archive."""
    source = _Inflated(data)
    while source.next_member():
        if not source.line().startswith(b"WARC/"):
            raise WarcError("no WARC version line")
        head = {}
        while line := source.line():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        if not re.fullmatch(r"\d+", head.get("content-length", "")):
            raise WarcError("no Content-Length")
        block = source.take(int(head["content-length"]))
        source.end()
        if head.get("warc-type") == "response":
            if "sha256:" + hashlib.sha256(block).hexdigest() != head.get("warc-payload-digest"):
                raise WarcError("the payload has another digest")
        yield head, block


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _source(keep_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows = []
                for head, block in read_records(archive.as_buffer()):
                    page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
                    n = int(head["x-payload-length"])
                    if head["warc-type"] == "response" and n != len(block):
                        raise WarcError("the payload has another length")
                    rows.append(
                        {
                            "page_id": None if page is None else int(page),
                            "url": head["warc-target-uri"],
                            "payload": block if keep_payload and head["warc-type"] == "response" else None,
                            "payload_bytes": n,
                            "payload_digest": head["warc-payload-digest"].removeprefix("sha256:"),
                            "record_type": head["warc-type"],
                            "refers_to": None if refers is None else int(refers),
                        }
                    )
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _READ)

    return read


def _qualified(spark: SparkSession, directory: str) -> str:
    """``directory``, made if it is not there, with the scheme of the file system that Spark finds it in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    return re.sub(r"^file:/+", "file:///", system.makeQualified(path).toUri().toString())


def write_archives(pages: DataFrame, directory: str) -> DataFrame:
    """Write (page_id, url, html) below ``directory``; one row for each archive. Other columns are not read.

    A null html is an empty payload. Of rows with equal payloads of at least
    ``REVISIT_BYTES`` bytes the one with the smallest page_id (null last; among
    equal ids one with the smallest url, null last) is a response and the
    others revisit it. An empty table gives no archive.
    """
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", data.alias("payload")).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    url = F.struct(F.col("url").isNull().alias("none"), "url")
    ids = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"), F.min(url).alias("w_url"))
    ids = stage(ids, "ids")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id")
    shared = ids.groupBy("payload_digest").agg(F.min(order).alias("w_first"), F.sum("n").alias("n")).where("n > 1").select("payload_digest", "w_first")
    rows = rows.join(stage(shared, "shared"), "payload_digest", "left").withColumn("w_main", F.lit(True))
    repeated = ids.where("n > 1")
    if not repeated.isEmpty():
        # rows that share a page_id and a payload are counted, not numbered; then one of them is the response
        names = repeated.select(F.col("payload_digest").alias("r_digest"), F.col("page_id").alias("r_id"), "w_url")
        marked = rows.drop("w_main").join(names, (F.col("payload_digest") == F.col("r_digest")) & F.col("page_id").eqNullSafe(F.col("r_id")), "left").drop("r_digest", "r_id")
        keys = ["page_id", "url", "payload_bytes", "payload_digest", "w_first", "w_url"]
        many = marked.where(F.col("w_url").isNotNull()).groupBy(*keys).agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
        many = many.withColumn("w_nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).withColumn("w_main", (F.col("w_nth") == 1) & (url == F.col("w_url")))
        own = [*keys[:-1], "payload", "w_main"]
        rows = marked.where(F.col("w_url").isNull()).withColumn("w_main", F.lit(True)).select(*own).unionByName(many.select(*own))
    other = F.col("w_first").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("w_first.page_id")) & F.col("w_main"))
    typed = rows.select(
        "page_id", "url", "payload_bytes", "payload_digest",
        F.when(other, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        F.when(other, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(other, F.col("w_first.page_id")).alias("refers_to"),
    )
    # sorted: a repeated task cuts the same rows into the same archives
    sink = _sink(_qualified(pages.sparkSession, directory))
    return stage(typed.sortWithinPartitions("payload_digest", "page_id", "url", "record_type").mapInArrow(sink, "archive string, records long"), "archives")


def read_archives(spark: SparkSession, directory: str, keep_payload: bool = True) -> DataFrame:
    """A row for each record of all archives below ``directory``; a null url reads as an empty one, a revisit has no payload.

    An archive that is cut off, framed wrongly or whose payload has another
    digest raises ``WarcError``. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(directory).select("content")
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.mapInArrow(_source(keep_payload), schema)


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_dir(spark) + "/warc"
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), directory)
    return read_archives(spark, directory, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when first_id is null or first_id = page_id then 'response' else 'revisit' end as record_type,
  case when first_id <> page_id then first_id end as refers_to
from f
"""
