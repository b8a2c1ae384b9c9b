"""Embedding near-duplicates by lattice hashing.

In each table a vector is projected to eight dimensions at random and decoded
to the nearest point of the E8 lattice. A vector is a member of its own cell
and probes the neighbouring cells nearest to its projection. In a cell the
cosines of members with members and with probing vectors are computed in double
precision, in blocks; only counts and a spanning set of links leave the task.
A pair that meets in several tables counts where it meets first.

Equal vectors are one class with a weight, named by a digest. Vectors whose
components are all single-precision numbers travel as such, which loses
nothing. Cells above ``BLOCK`` entries are
cut into blocks and each pair of blocks is a task's unit, so no cell is one
task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import stage, table
from corpusmill.llm.graph import components, spanning

TABLES, PROBES = 5, 4
#: Lattice step against the expected projected length of a unit vector's part.
STEP = 0.5657
BLOCK = 1024
_SEED = 20_240_611


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i + 1, 8):
            for s in (1.0, -1.0):
                for t in (1.0, -1.0):
                    v = np.zeros(8)
                    v[i], v[j] = s, t
                    out.append(v)
    for m in range(256):
        v = np.array([1.0 if m >> k & 1 else -1.0 for k in range(8)]) / 2
        if v.sum() % 2 == 0:
            out.append(v)
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum."""
    r = np.rint(x)
    d = x - r
    odd = np.flatnonzero(r.sum(axis=1).astype(np.int64) & 1)
    k = np.abs(d[odd]).argmax(axis=1)
    r[odd, k] += np.where(d[odd, k] >= 0, 1.0, -1.0)
    return r


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the closer of the even integer points and those shifted by a half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    near = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(near[:, None], a, b)


def _mix(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit number for each lattice point."""
    # mixed one by one: factors in proportion would give many points one number
    factors = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        factors = (factors ^ (factors >> np.uint64(30))) * np.uint64(c)
    factors |= np.uint64(1)
    h = ((2 * points).astype(np.int64).astype(np.uint64) * factors).sum(axis=-1, dtype=np.uint64) + np.uint64(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(c)
    return (h ^ (h >> np.uint64(33))).astype(np.int64)


class Lattice:
    """Cells of unit vectors of one dimension: (vectors, tables, 1 + probes) numbers, the own cell first."""

    def __init__(self, dimension: int, threshold: float, tables: int, probes: int):
        self.probes, self.roots = probes, _roots()
        width = STEP * np.sqrt(8 / dimension) * np.sqrt((2 - 2 * threshold) / 0.1)
        self.maps = []
        for t in range(tables):
            rng = np.random.default_rng([_SEED, dimension, t])
            m = rng.standard_normal((dimension, 8))
            m = np.linalg.qr(m)[0] if dimension >= 8 else m / np.sqrt(dimension)
            self.maps.append((m / width, rng.random(8) * 2, dimension * 1000 + t))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        out = np.empty((len(unit), len(self.maps), 1 + self.probes), np.int64)
        for t, (m, shift, salt) in enumerate(self.maps):
            x = unit @ m + shift
            own = decode_e8(x)
            out[:, t, 0] = _mix(own, salt)
            if self.probes:
                closer = (x - own) @ self.roots.T
                near = np.argsort(-closer, axis=1, kind="stable")[:, : self.probes]
                for k in range(self.probes):
                    out[:, t, 1 + k] = _mix(own + self.roots[near[:, k]], salt)
        return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows over their length; by their largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _packed(x: np.ndarray) -> bytes:
    """A vector's bytes, in single precision (marked by a first byte) where that is exact; -0.0 becomes 0.0."""
    x = x + 0.0
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return b"4" + short.tobytes() if (short == x).all() else b"8" + x.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if raw[:1] == b"4" else np.float64, offset=1).astype(np.float64)


def _unit(raw: list[bytes]) -> np.ndarray:
    return scaled(np.stack([*map(_unpacked, raw)]))


def _first_meeting(ca: np.ndarray, cb: np.ndarray, table_: int, kind: np.ndarray) -> np.ndarray:
    """Whether pairs (cells of a, cells of b; a the smaller row) meet nowhere before (table, kind).

    Kinds in a table: 0 same cell, 1 the smaller probes the larger's cell, 2 the other way.
    """
    first = np.ones(len(ca), bool)
    for t in range(table_ + 1):
        same = ca[:, t, 0] == cb[:, t, 0]
        one = (ca[:, t, 1:] == cb[:, t, :1]).any(axis=1)
        two = (cb[:, t, 1:] == ca[:, t, :1]).any(axis=1)
        if t < table_:
            first &= ~(same | one | two)
        else:
            first &= ~((kind >= 1) & same) & ~((kind == 2) & one)
    return first


class _Unit:
    """Links in one block or between two blocks of a cell."""

    def __init__(self, threshold: float, tables: int, probes: int):
        self.threshold, self.lattice, self.args = threshold, {}, (threshold, tables, probes)

    def links(self, table_: int, row: np.ndarray, member: np.ndarray, block: np.ndarray, weight: np.ndarray, raw: list[bytes]):
        """(row, summed weight of its links, smallest row reached) of rows with links."""
        unit = _unit(raw)
        order = np.argsort(row, kind="stable")
        row, member, block, weight, unit = row[order], member[order], block[order], weight[order], unit[order]
        d = unit.shape[1]
        if d not in self.lattice:
            self.lattice[d] = Lattice(d, *self.args)
        two = block.min() != block.max()
        left, right = [], []
        for at in range(0, len(row), 256):
            close = unit[at : at + 256] @ unit.T >= self.threshold
            close &= np.arange(len(row))[None, :] > np.arange(at, at + len(close))[:, None]
            close &= member[at : at + 256, None] | member[None, :]
            if two:
                close &= block[at : at + 256, None] != block[None, :]
            i, j = np.nonzero(close)
            left.append(i + at)
            right.append(j)
        i, j = np.concatenate(left), np.concatenate(right)
        if not len(i):
            return row[:0], weight[:0], row[:0]
        used = np.unique(np.concatenate([i, j]))
        cells = np.zeros((len(row), *self.args[1:2], 1 + self.args[2]), np.int64)
        cells[used] = self.lattice[d].cells(unit[used])
        kind = np.where(member[i] & member[j], 0, np.where(member[j], 1, 2))
        kept = np.concatenate([_first_meeting(cells[i[s : s + 65536]], cells[j[s : s + 65536]], table_, kind[s : s + 65536]) for s in range(0, len(i), 65536)])
        i, j = i[kept], j[kept]
        if not len(i):
            return row[:0], weight[:0], row[:0]
        n = np.bincount(i, weight[j], len(row)) + np.bincount(j, weight[i], len(row))
        root = spanning(len(row), i, j)
        at = np.flatnonzero(n)
        return row[at], n[at].astype(np.int64), row[root[at]]


def near_vectors(vectors: DataFrame, threshold: float = 0.95, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding); other columns are not read.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and keep their own component; so do vectors of another
    length than their neighbour's. Repeated rows count as vectors of their
    own. component_id is the smallest vec_id reachable, nulls aside. An empty
    table gives an empty table.
    """
    kind = dict(vectors.dtypes)["vec_id"]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v in batch.column(1):
                x = None if not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                raw.append(_packed(x) if x is not None and np.isfinite(x).all() and x.any() else None)
            names = [r and hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "v", "raw"])

    rows = stage(vectors.select("vec_id", "embedding").mapInArrow(named, f"vec_id {kind}, v binary, raw binary"), "rows")
    classes = rows.where("v is not null").groupBy("v").agg(F.first("raw").alias("raw"), F.count(F.lit(1)).alias("weight"))
    classes = stage(classes.withColumn("row", F.monotonically_increasing_id()), "classes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Lattice] = {}
        for batch in batches:
            rows_, vectors_ = batch.column(0).to_numpy(), [*map(_unpacked, batch.column(1).to_pylist())]
            sizes = np.fromiter(map(len, vectors_), np.int64, len(vectors_))
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                if d not in known:
                    known[d] = Lattice(int(d), threshold, tables, probes)
                cells = known[d].cells(scaled(np.stack([vectors_[i] for i in at])))
                shape = cells.shape
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(rows_[at], shape[1] * shape[2])),
                        pa.array(np.tile(np.repeat(np.arange(shape[1], dtype=np.int32), shape[2]), len(at))),
                        pa.array(cells.reshape(-1)),
                        pa.array(np.tile(np.arange(shape[2]) == 0, len(at) * shape[1])),
                    ],
                    ["row", "t", "cell", "member"],
                )

    entries = stage(classes.select("row", "raw").mapInArrow(hashed, "row long, t int, cell long, member boolean"), "entries")
    sizes = entries.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("member").cast("int")).alias("m")).where("n > 1 and m > 0")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("row", "t"), F.col("blocks")).cast("int")
    placed = (
        entries.join(sizes.select("t", "cell", blocks.alias("blocks")), ["t", "cell"])
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("row", "t", "cell", "member", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )

    keys = ["t", "cell", "lo", "hi"]
    dealt = placed.join(classes.select("row", "weight", "raw"), "row").repartition(*keys).sortWithinPartitions(*keys)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(threshold, tables, probes)
        held: list[pa.RecordBatch] = []

        def flush():
            whole = pa.Table.from_batches(held)
            if whole.num_rows < 2:
                return None
            raw = whole.column("raw").to_pylist()
            # a number of the hash can name cells of two lengths
            sizes = np.fromiter((len(r) // (4 if r[:1] == b"4" else 8) for r in raw), np.int64, len(raw))
            out = []
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = whole.take(pa.array(at))
                cols = [part.column(c).to_numpy() for c in ("row", "member", "block", "weight")]
                out.append(unit.links(int(part.column("t")[0].as_py()), *cols, [raw[i] for i in at]))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]), pa.int64()) for k in range(3)], ["row", "n", "root"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                mark = tuple(marks[:, a])
                if mark != last and held:
                    found = flush()
                    if found is not None and found.num_rows:
                        yield found
                    held.clear()
                last = mark
                held.append(batch.slice(a, b - a))
        if held and (found := flush()) is not None:
            yield found

    found = stage(dealt.select("row", "t", "cell", "member", "block", "lo", "hi", "weight", "raw").mapInArrow(meet, "row long, n long, root long"), "found")
    links = found.groupBy("row").agg(F.sum("n").alias("links"))
    roots = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    found_links = (
        classes.select("row", "v", "weight").join(links, "row", "left").join(roots.select(F.col("a").alias("row"), F.col("b").alias("root")), "row", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "row").alias("root"))
    )
    whole = stage(rows.select("vec_id", "v").join(found_links, "v", "left"), "named")
    least = whole.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = whole.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("vec_id").cast(kind), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def op1_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP1_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from reach r join links l on r.b = l.a),
n as (select a, count(*) as n from links group by 1)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, r.c as component_id, e.vec_id = r.c as kept
from embeddings e left join n on n.a = e.vec_id join (select a, min(b) as c from reach group by 1) r on r.a = e.vec_id
"""
