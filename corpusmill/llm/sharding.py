"""Sharding by histogram sort.

Each row gets a 63-bit key, a hash of its id, its text's checksum and size and
its number among rows alike in these, so shards are also a shuffle of the
corpus, and the same one on every run and cluster. Splitters are looked for in rounds: a round counts the exact bytes in
equal cells of the key ranges that still hold a splitter, and keeps for each
splitter the cell it falls into, until the nearest cell boundary is within the
tolerance of the wanted byte count. Only such counts come to the driver, at
most 1,024 in the first round and 256 times the shards in later ones. Then
rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import stage, table
from corpusmill.operators.ordering import placed
from corpusmill.schema import free

KEY_BITS = 63
FIRST_BITS = 10
NEXT_BITS = 8
#: Part of a shard's bytes by which a splitter may miss.
TOLERANCE = 0.001
#: Rows alike that are dealt out at a time.
BLOCK_ROWS = 4096
#: Mean rows that share a cell when slots are numbered.
CELL_ROWS = 2048


@dataclass(frozen=True)
class Splitters:
    keys: tuple[int, ...]
    rounds: int
    total_bytes: int
    rows: int


def _key(*columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def _sized(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.withColumns({"size": (F.octet_length(data) + 8).cast("long"), "text_crc32": F.crc32(data)})


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, s_row and s_key of each row, for any order of the rows.

    A null text counts as empty: 8 bytes and the checksum of no bytes. Rows
    alike in the first three stand for each other, so they are counted and
    dealt out again, numbered by s_row; many of them are dealt from blocks.
    """
    alike = _sized(docs.select("doc_id", "text")).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    blocks = alike.withColumn("s_block", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(BLOCK_ROWS).cast("long"))))
    few = blocks.where(F.col("n") <= BLOCK_ROWS)
    many = blocks.where(F.col("n") > BLOCK_ROWS).repartition("doc_id", "text_crc32", "s_block")
    last = F.least(F.col("n"), F.col("s_block") + BLOCK_ROWS) - 1
    rows = few.unionByName(many).withColumn("s_row", F.explode(F.sequence("s_block", last)))
    return rows.select("doc_id", "size", "text_crc32", "s_row").withColumn("s_key", _key("doc_id", "text_crc32", "size", "s_row"))


def find_splitters(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> Splitters:
    """Key boundaries that cut (s_key, size) into ``n_shards`` of near equal size."""
    found = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, n = int(found[0] or 0), int(found[1])
    slack = tolerance * total / n_shards
    #: splitter -> (prefix of its cell, bits of the prefix, bytes below the cell)
    open_: dict[int, tuple[int, int, int]] = {j: (0, 0, 0) for j in range(1, n_shards)}
    done: dict[int, int] = {}
    rounds = 0
    while open_ and total:
        rounds += 1
        bits = next(iter(open_.values()))[1]
        step = min(FIRST_BITS if not bits else NEXT_BITS, KEY_BITS - bits)
        cell = F.shiftright(F.col("s_key"), KEY_BITS - bits - step)
        prefixes = sorted({p for p, _, _ in open_.values()})
        held = rows if not bits else rows.where(F.shiftright(F.col("s_key"), KEY_BITS - bits).isin(prefixes))
        counted = sorted((int(c), int(s)) for c, s in held.groupBy(cell.alias("cell")).agg(F.sum("size")).collect())
        still = {}
        for j, (prefix, _, below) in open_.items():
            wanted = total * j / n_shards
            for c, size in (x for x in counted if x[0] >> step == prefix):
                if below + size > wanted:
                    break
                below += size
            else:
                c, size = ((prefix + 1) << step) - 1, 0
            width = KEY_BITS - bits - step
            if wanted - below <= slack or below + size - wanted <= slack or width == 0:
                done[j] = (c if wanted - below <= below + size - wanted else c + 1) << width
            else:
                still[j] = (c, bits + step, below)
        open_ = still
    keys = tuple(done.get(j, 0) for j in range(1, n_shards))
    return Splitters(keys, rounds, total, n)


def shard_of(key: Column, splitters: Splitters) -> Column:
    """The number of splitters at or below the key."""
    out = F.lit(0)
    for s in splitters.keys:
        out = out + (key >= F.lit(s)).cast("int")
    return out


def shard(docs: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for each row of (doc_id, text).

    Slots run from 0 in each shard in key order. They are numbered in cells of
    some thousand rows, each of which starts at the count of the rows before
    it, so no task holds a shard. Empty input gives empty output; with fewer
    rows than shards some shards stay empty.
    """
    rows = stage(keyed(docs), "keys")
    splitters = find_splitters(rows, n_shards, tolerance)
    cells = max(6, (max(1, splitters.rows) // CELL_ROWS).bit_length())
    placed = rows.withColumn("shard", shard_of(F.col("s_key"), splitters)).withColumn("s_cell", F.shiftright("s_key", KEY_BITS - cells))
    ahead = Window.partitionBy("shard").orderBy("s_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "s_cell").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "s_cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("s_start"))
    )
    inside = F.row_number().over(Window.partitionBy("shard", "s_cell").orderBy("s_key", F.asc_nulls_first("doc_id"), "text_crc32", "size", "s_row")) - 1
    return placed.join(starts, ["shard", "s_cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("s_start") + inside).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, n_shards: int, path: str, tolerance: float = TOLERANCE) -> Splitters:
    """Write whole documents below ``path``, one folder a shard, in one exchange. A column named shard is replaced.

    Rows alike in id, size and checksum are numbered in the order of a hash of
    all their columns, so a rerun puts the same rows into the same shards;
    rows alike in everything stand for each other.
    """
    number, key, size, crc, cell, order = (free(docs.columns, n) for n in ("s_row", "s_key", "size", "text_crc32", "s_cell", "s_order"))
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.withColumns({size: (F.octet_length(data) + 8).cast("long"), crc: F.crc32(data), order: F.xxhash64(*docs.columns)})
    # sorted and staged: both passes must see the same numbers
    rows = placed(sized, ["doc_id", crc, size], [order], number).withColumn(number, F.col(number) - 1).withColumn(key, _key("doc_id", crc, size, number))
    rows = stage(rows, "numbered")
    splitters = find_splitters(rows.select(F.col(key).alias("s_key"), F.col(size).alias("size")), n_shards, tolerance)
    cells = max(1, splitters.total_bytes // n_shards // (256 << 20) + 1)
    out = rows.withColumn("shard", shard_of(F.col(key), splitters)).withColumn(cell, F.pmod(F.col(key), F.lit(cells)))
    keep = [c for c in docs.columns if c.lower() != "shard"]
    out.repartition(n_shards * cells, "shard", cell).select(*keep, "shard").write.partitionBy("shard").parquet(path)
    return splitters


def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
