"""Windows, orderings and limits. Every order has a tie-breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import let, strip
from corpusmill.schema import free
from corpusmill.sources.staging import staged


def severity_rank(severity: Column) -> Column:
    """O1: CRITICAL 0 to LOW 3, others 99."""
    out = F.lit(99)
    for k, s in enumerate(fixed.SEVERITIES):
        out = F.when(severity == s, k).otherwise(out)
    return out


def first_eligible(rows: DataFrame, order: str, eligible: Column, limit: int) -> DataFrame:
    """Rows with ``chosen``: the first ``limit`` eligible ones.

    A limit over the eligible keys alone and a semi join: a running count over
    all rows would need them in one task.
    """
    first = rows.where(eligible).select(order).orderBy(order).limit(limit).withColumn("w_in", F.lit(True))
    return rows.join(first, order, "left").withColumn("chosen", F.coalesce("w_in", F.lit(False))).drop("w_in")


def first_of_each(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W2."""
    return rows.withColumn("w_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("w_n = 1").drop("w_n")


def _ranged(rows: DataFrame, order: list[str | Column], at: str, part: str) -> DataFrame:
    """``rows`` written in order, with their place in it and the number of their range; a key with many rows fills many ranges."""
    held = staged(rows.orderBy(*order).withColumn(at, F.monotonically_increasing_id()))
    return held.withColumn(part, F.shiftright(at, 33))


def running(rows: DataFrame, keys: list[str], order: list[str | Column], value: Column, name: str, total: str | None = None) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of their key up to and with their own, and, if named, over all of them.

    Rows are sorted into ranges of (keys, order). A sum inside a range adds to
    the sums of a key's earlier ranges, of which there is one row for each, so
    a key with a third of all rows is no task's burden. Null keys are one key;
    rows alike in ``order`` stand in any order, alike for all results of one call.
    """
    at, part, amount, ahead, whole = (free(rows.columns, f"r_{n}") for n in ("at", "part", "value", "ahead", "whole"))
    held = _ranged(rows.withColumn(amount, value.cast("bigint")), [*keys, *order], at, part)
    sums = held.groupBy(*keys, part).agg(F.sum(amount).alias(ahead))
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum(ahead).over(own.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(k).alias(f"{ahead}_{i}") for i, k in enumerate(keys)], F.col(part).alias(f"{part}_2"), before.alias(ahead), F.sum(ahead).over(own).alias(whole))
    alike = F.col(part) == F.col(f"{part}_2")
    for i, k in enumerate(keys):
        alike = alike & F.col(k).eqNullSafe(F.col(f"{ahead}_{i}"))
    inside = F.sum(amount).over(Window.partitionBy(*keys, part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0))
    out = held.withColumn(name, inside).join(staged(sums), alike).withColumn(name, F.col(name) + F.col(ahead))
    return out.select(*rows.columns, name, *([F.col(whole).alias(total)] if total else []))


def placed(rows: DataFrame, keys: list[str], order: list[str | Column], name: str, total: str | None = None) -> DataFrame:
    """``rows`` with their number from 1 in their key's order, and the key's rows if ``total`` names that."""
    return running(rows, keys, order, F.lit(1), name, total)


def numbered_versions(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """A version from 1 for each name, the last one active."""
    count = free(rows.columns, "w_count")
    return placed(rows, [name], order, "version", count).withColumn("version", F.col("version").cast("int")).withColumn("is_active", (F.col("version") == F.col(count)).cast("int")).drop(count)


def sections(lines: DataFrame, document: str, line: str, is_header: Column) -> DataFrame:
    """Header lines open sections; first and last line and the number of lines of each."""
    numbered = running(lines, [document], [line], is_header.cast("int"), "section").where("section > 0")
    return numbered.groupBy(document, "section").agg(F.min(line).alias("first_line"), F.max(line).alias("last_line"), F.count(F.lit(1)).alias("n_lines"))


def top(rows: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of an order."""
    return rows.orderBy(*order).limit(n)


def sampled(rows: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """N rows by a seeded hash of their key, alike on every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def shortened_refs(refs: Column, most: int = 16, characters: int = 800) -> Column:
    """The first references, long contexts cut, and a note on how many are left out; a notice if there are none."""
    none = F.coalesce(F.size(refs), F.lit(0)) <= 0

    def shown(r: Column, i: Column) -> Column:
        cut = let(strip(F.coalesce(r["context"], F.lit(""))), lambda c: F.when(F.length(c) > characters, F.concat(F.substring(c, 1, characters), F.lit("..."))).otherwise(c))
        return F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] source: "), strip(F.coalesce(r["source"], F.lit(""))), F.lit("\ncontext: "), cut)

    listed = F.transform(F.slice(refs, 1, most), shown)
    rest = F.size(refs) - most
    return F.when(none, fixed.NO_REFS).otherwise(F.array_join(F.when(rest > 0, F.array_append(listed, F.format_string(fixed.MORE_REFS, rest))).otherwise(listed), "\n\n"))
