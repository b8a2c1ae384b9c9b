"""MinHash near-duplicates with sequential Bayesian verification.

A document is the set of its distinct word shingles, as 64-bit hashes.
Documents with equal sets are one class. Signatures of classes are cut into
bands; classes that share a band are candidates. A candidate pair's signatures
are compared batch by batch, and the pair is dropped as soon as the posterior
probability of reaching the threshold falls below ``MISS``.

The first pass compares the first ``FIRST_PLACES`` places, bucket by bucket.
Classes connected by its survivors form a cluster. The second pass compares
whole signatures inside clusters and confirms survivors on full sets.

In both passes a group is cut into blocks, each pair of blocks is one unit of
work, pairs that links connect already are skipped, and only a spanning set of
links leaves a unit. No pair is written out, so a group of thousands of near
copies costs rows in proportion to its size, and no group is one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, stage, table
from corpusmill.llm.graph import components, spanning

BANDS, ROWS = 25, 5
#: Signature places compared before each look at the posterior.
BATCH = 25
#: Chosen probability of dropping a pair that reaches the threshold.
MISS = 1e-6
KNOWN_WORDS = 200_000
#: Places that the pass over buckets looks at.
FIRST_PLACES = 2 * BATCH
#: Mean classes and bytes of sets in a block of a group, and columns of an incidence matrix at a time.
BLOCK_ROWS, BLOCK_BYTES, COLUMNS = 4096, 8 << 20, 4096
#: Rows of a unit whose pairs are all formed together with those of other units, and pairs compared at a time.
SMALL, PAIRS = 16, 65_536
#: Shingles of a block that are counted at a time.
SHINGLES = 500_000
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def _multipliers() -> np.ndarray:
    """Odd 64-bit factors, one for each place of a signature."""
    out = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _M1
    for _ in range(2):
        out = (out ^ (out >> np.uint64(29))) * _M3
    return out | np.uint64(1)


class Shingler:
    """Distinct shingle hashes of texts; hashes of words are kept while they are few."""

    def __init__(self, width: int):
        self.width, self.place, self.hashes = width, {}, np.zeros(0, np.uint64)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        # bytes: lower() changes A-Z only and split() takes exactly space and U+0009 to U+000D
        listed = [t.encode().lower().split() if t else [] for t in texts]
        missing = {w for t in listed for w in t if w not in self.place}
        if len(self.place) + len(missing) > KNOWN_WORDS and self.place:
            self.place, self.hashes = {}, self.hashes[:0]
            missing = {w for t in listed for w in t}
        if missing:
            new = np.frombuffer(b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in missing]), np.uint64)
            self.place.update(zip(missing, range(len(self.place), len(self.place) + len(missing)), strict=True))
            self.hashes = np.concatenate([self.hashes, new])
        return [self._set(self.hashes[np.fromiter(map(self.place.__getitem__, t), np.int64, len(t))]) for t in listed]

    def _set(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return h
        n = max(1, len(h) - self.width + 1)
        out = np.full(n, min(len(h), self.width), np.uint64) * _M2
        for k in range(min(self.width, len(h))):
            out = (out ^ h[k : k + n]) * _M1
            out ^= out >> np.uint64(32)
        return np.unique(out * _M3)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 middle bits of each factor's smallest product; its upper bits are small numbers."""
    low = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 2048):
        np.minimum(low, (factors[:, None] * shingles[None, at : at + 2048]).min(axis=1), out=low)
    return (low >> np.uint64(16)).astype(np.uint16)


def least_matches(threshold: float, places: int, miss: float = MISS) -> list[int]:
    """For 1 to ``places`` compared places, the matches below which a pair is dropped.

    With a uniform prior the posterior of the similarity after m matches in n
    is Beta(m + 1, n - m + 1), and P(similarity >= t) is the probability of at
    most m successes in n + 1 trials at t.
    """
    out = []
    for n in range(1, places + 1):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, d_class (16 bytes; null for an empty set) and signature."""
    factors = _multipliers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in in_parts(batches, 1):
            sets = shingler.sets(batch.column(1).to_pylist())
            classes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            marks = [signature(s, factors).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.binary()), pa.array(marks, pa.binary())], ["doc_id", "n_shingles", "d_class", "d_marks"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, d_class binary, d_marks binary")


def _merged(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs (a, b) of sorted sets, one by one."""
    out = np.empty(len(a), np.int64)
    for k, (i, j) in enumerate(zip(a, b, strict=True)):
        # both are sorted without repeats: a value of both stands next to itself
        merged = np.sort(np.concatenate([sets[i], sets[j]]), kind="stable")
        out[k] = (merged[1:] == merged[:-1]).sum()
    return out


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs (a, b) of sorted sets.

    Many pairs among few sets are one product of their incidence matrix with
    itself, taken over the shingles that two sets hold, some columns at a time.
    The sets are cut at common values, so that some SHINGLES are held at once.
    """
    own, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(a) <= 4 * len(own):
        return _merged(sets, a, b)
    product = np.zeros((len(own), len(own)), np.float32)
    parts = sum(len(sets[k]) for k in own) // SHINGLES + 1
    ends = [np.uint64((1 << 64) * p // parts) for p in range(1, parts)]
    at = [np.concatenate([[0], np.searchsorted(sets[k], ends), [len(sets[k])]]).astype(np.int64) for k in own]
    for p in range(parts):
        slices = [sets[k][c[p] : c[p + 1]] for k, c in zip(own, at, strict=True)]
        rows = np.repeat(np.arange(len(own)), [len(s) for s in slices])
        _, column, count = np.unique(np.concatenate(slices), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        column, rows = (np.cumsum(count > 1) - 1)[column[shared]], rows[shared]
        order = np.argsort(column, kind="stable")
        column, rows = column[order], rows[order]
        cuts = np.searchsorted(column, np.arange(0, int((count > 1).sum()) + COLUMNS, COLUMNS))
        for k in range(len(cuts) - 1):
            part = np.zeros((len(own), COLUMNS), np.float32)
            part[rows[cuts[k] : cuts[k + 1]], column[cuts[k] : cuts[k + 1]] - k * COLUMNS] = 1
            product += part @ part.T
    return product[place[: len(a)], place[len(a) :]].astype(np.int64)


class _Verifier:
    """Linked places in sorted rows of units; a unit is one block of a group or two of its blocks."""

    def __init__(self, percent: int):
        self.percent, self.least = percent, least_matches(percent / 100, BANDS * ROWS)

    def _survivors(self, marks: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose posterior stays above the chosen miss probability through all batches."""
        matches = np.zeros(len(a), np.int64)
        for at in range(0, marks.shape[1], BATCH):
            matches += (marks[a, at : at + BATCH] == marks[b, at : at + BATCH]).sum(axis=1)
            stay = matches >= self.least[min(at + BATCH, marks.shape[1]) - 1]
            a, b, matches = a[stay], b[stay], matches[stay]
        return a, b

    def _linked(self, marks: np.ndarray, sets: list[np.ndarray] | None, a: np.ndarray, b: np.ndarray, few: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs (a, b) those that are confirmed, or, without sets, not ruled out."""
        parts = [self._survivors(marks, a[k : k + PAIRS], b[k : k + PAIRS]) for k in range(0, len(a), PAIRS)]
        a, b = (np.concatenate([p[k] for p in parts]) if parts else a for k in range(2))
        if sets is None or not len(a):
            return a, b
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        common = _merged(sets, a, b) if few else _intersections(sets, a, b)
        good = 100 * common >= self.percent * (sizes[a] + sizes[b] - common)
        return a[good], b[good]

    def _large(self, block: np.ndarray, marks: np.ndarray, sets: list[np.ndarray] | None) -> np.ndarray:
        """The smallest place that each place of one unit reaches; pairs that are connected already are not looked at."""
        n, at = len(block), 0
        label, place = np.arange(n), np.arange(n)
        two = block.min() != block.max()
        while at < n:
            # a few rows against all others join what is alike; then only the rest is compared
            rows = place[at : at + (1 if at == 0 else 4 if at == 1 else 32)]
            open_ = label[rows][:, None] != label[None, :]
            if at > 1:
                open_ &= place[None, :] > rows[:, None]
                if two:
                    open_ &= block[rows][:, None] != block[None, :]
            i, j = np.nonzero(open_)
            a, b = self._linked(marks, sets, rows[i], j, few=False)
            if len(a):
                label = spanning(n, np.concatenate([a, place]), np.concatenate([b, label]))
            at += len(rows)
        return label

    def roots(self, unit: np.ndarray, block: np.ndarray, marks: np.ndarray, sets: list[np.ndarray] | None) -> np.ndarray:
        """The smallest place that each row reaches inside its unit; rows of a unit stand together."""
        starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        sizes = np.diff(np.append(starts, len(unit)))
        small = np.repeat(sizes <= SMALL, sizes)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, min(SMALL, int(sizes.max()))):
            i = np.flatnonzero((unit[d:] == unit[:-d]) & small[d:])
            left.append(i)
            right.append(i + d)
        a, b = self._linked(marks, sets, np.concatenate(left), np.concatenate(right), few=True)
        found = [(a, b)]
        for at, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            own = slice(at, at + size)
            found.append((np.arange(at, at + size), at + self._large(block[own], marks[own], sets and sets[own])))
        return spanning(len(unit), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(d_class, d_set) of the documents named in ``wanted`` (doc_id), made again from their texts."""
    # by sorting at every size: the ids grow with the table, so no plan may rest on sending them to all
    ids = wanted.select(F.col("doc_id").alias("w_id")).distinct().hint("merge")
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in in_parts(batches, 0):
            sets = [s.tobytes() for s in shingler.sets(batch.column(0).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["d_class", "d_set"])

    return texts.select("text").mapInArrow(run, "d_class binary, d_set binary")


def _spanned(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning set of the links among members (group, blocks, c_id, d_marks, and d_set or not) of one group.

    The group is cut into ``blocks``. Without d_set a link is what the signatures at hand do not rule out.
    """
    exact = "d_set" in members.columns
    keys, rest = ["group", "lo", "hi"], ["c_id", "d_marks", *["d_set"] * exact]
    dealt = (
        members.withColumn("block", F.pmod(F.xxhash64("c_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", *rest)
        .repartition(*keys).sortWithinPartitions(*keys)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verifier = _Verifier(percent)
        held: list[pa.RecordBatch] = []

        def links(rows: pa.Table) -> pa.RecordBatch:
            number = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in keys])
            unit = np.cumsum(np.append(True, (number[:, 1:] != number[:, :-1]).any(axis=0)))
            marks = np.frombuffer(b"".join(rows.column("d_marks").to_pylist()), np.uint16).reshape(rows.num_rows, -1)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("d_set")] if exact else None
            root = verifier.roots(unit, rows.column("block").to_numpy(), marks, sets)
            at = np.flatnonzero(root != np.arange(len(root)))
            names = rows.column("c_id").combine_chunks()
            return pa.RecordBatch.from_arrays([names.take(pa.array(at)), names.take(pa.array(root[at]))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            number = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            cuts = np.flatnonzero((number != number[:, -1:]).any(axis=0))
            last = int(cuts[-1]) + 1 if len(cuts) else 0
            # the last unit may go on in the next batch
            before = held and tuple(held[-1].column(k)[-1].as_py() for k in range(3)) != tuple(number[:, -1].tolist())
            if last or before:
                yield links(pa.Table.from_batches([*held, *[batch.slice(0, last)] * bool(last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield links(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of (doc_id, text).

    Links documents whose shingle sets have 100 * intersection >= ``percent``
    * union. A null or blank text has an empty set and links with nothing.
    component_id is the smallest doc_id reachable, nulls aside; a row whose
    doc_id is null and alone gets a null component and is kept. Repeated rows
    form one class and are all kept if their doc_id is the smallest. An empty
    table gives an empty table.
    """
    rows = stage(_profiles(docs, width), "profiles")
    whole = rows.where(F.col("d_class").isNotNull())
    # one signature of each class, equal sets have equal ones; from here on a number stands for a class
    marks = whole.groupBy("d_class").agg(F.min("doc_id").alias("doc_id"), F.first("d_marks").alias("d_marks"), F.first("n_shingles").alias("n_shingles"))
    marks = stage(marks.withColumn("c_id", F.monotonically_increasing_id()), "classes")

    def keys(i: Column) -> Column:
        return F.xxhash64(F.substring(F.col("d_marks"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)), i)

    banded = marks.select("c_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), keys)).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    begin = marks.select("c_id", F.substring("d_marks", 1, 2 * FIRST_PLACES).alias("d_marks"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_ROWS)).cast("int")
    bucketed = banded.join(shared.withColumn("blocks", blocks), "key").join(begin, "c_id")
    clusters = components(_spanned(bucketed.select(F.col("key").alias("group"), "blocks", "c_id", "d_marks"), percent))
    clusters = clusters.unionByName(clusters.select(F.col("b").alias("a"), "b").distinct()).select(F.col("a").alias("c_id"), F.col("b").alias("root"))
    members = stage(clusters.join(marks, "c_id"), "members")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK_ROWS), F.sum("n_shingles") * 8 / F.lit(BLOCK_BYTES))).cast("int")
    sizes = members.groupBy("root").agg(blocks.alias("blocks"))
    sets = _sets_of(docs, members, width).dropDuplicates(["d_class"])
    whole_sets = members.join(sizes, "root").select(F.col("root").alias("group"), "blocks", "c_id", "d_class", "d_marks").join(sets, "d_class").drop("d_class")
    links = stage(_spanned(whole_sets, percent), "links")
    roots = components(links)
    # classes hold their smallest doc_id, so components are named from classes alone
    grouped = marks.select("c_id", "d_class", "doc_id").join(roots.select(F.col("a").alias("c_id"), F.col("b").alias("root")), "c_id", "left").withColumn("root", F.coalesce("root", "c_id"))
    grouped = stage(grouped, "grouped")
    named = grouped.join(grouped.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("d_class", "component_id")
    out = rows.select("doc_id", "n_shingles", "d_class").join(named, "d_class", "left")
    component = F.when(F.col("d_class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def op3_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


OP3_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
    else list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) end) as g
  from w),
n as (select doc_id, count(*) as n from s group by 1),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join both_ways l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.c as component_id, d.doc_id = r.c as kept
from documents d left join n using (doc_id) join (select a, min(b) as c from reach group by 1) r on r.a = d.doc_id
"""
