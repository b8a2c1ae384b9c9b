"""Mixing sources to target weights by systematic sampling.

Every source gets a number of words to take (``targets``). Within a source the
expected copies of a document are the same, target / source size, so the
prefix sum of expected copies at a document is that ratio times its rank. One
random offset is added and a copy is emitted for each integer that the prefix
sum crosses on the document.

Within a source documents stand by size band (an eighth of a doubling), then by
a hash of doc_id and text, at every size of the table. Neighbours in rank are
alike in size, which holds the words taken near the target. Ranks are found
without putting a source into one task: a band is cut into ranges of the hash
of about ``PART_ROWS`` rows, a table of counts gives the number of rows before
each range, and the rank inside a range is a row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import n_words, stage, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2.0
#: Mean rows of a range of hashes; their number grows with the input and does not change the order.
PART_ROWS = 1024

_KEYS = ("m_null", "m_src", "m_band", "m_part")
#: What ``mix`` adds, and what it needs on the way.
ADDED = ("m_size", "m_source_size", "m_target", "m_copies")
OWN = (*ADDED, *_KEYS, "m_hash", "m_parts", "m_before", "m_rank", "m_ratio", "m_u", "m_copy")


def _offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) for each source."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), source))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``target`` for each row of (m_null, m_src, source_size): one row a source.

    Sources in the order of their code points, null last, weigh ``weights``
    repeated, and share ``share`` times all words. A target stops at
    ``ceiling`` times its source's size and the excess goes to the others by
    weight until none is above. That is the level L at which
    sum(min(cap, L * weight)) is the amount to share; with sources sorted by
    cap / weight, the capped ones come first. The table has one row a source,
    so its windows are small whatever the number of documents.
    """
    order = Window.orderBy("m_null", F.col("m_src").cast("binary"))
    ranked = sizes.withColumn("at", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    capped = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = capped.withColumn("level", level).withColumn("is_capped", F.col("level") >= F.col("cap") / F.col("weight"))
    # the level falls from the first uncapped source on, so that one's is the largest
    common = F.max(F.when(~F.col("is_capped"), F.col("level"))).over(everything)
    return levelled.withColumn("common", common).select(
        "m_null",
        "m_src",
        "source_size",
        F.when(F.col("is_capped"), F.col("cap")).otherwise(F.col("common") * F.col("weight")).alias("target"),
    )


def _band(size: Column) -> Column:
    """Sizes by their four highest bits."""
    bits = F.length(F.bin(size))
    return (bits * 16 + F.when(bits > 4, F.expr("shiftright(m_size, length(bin(m_size)) - 4)")).otherwise(size)).cast("int")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: float = CEILING, seed: int = 17) -> DataFrame:
    """``docs`` with m_size, m_source_size, m_target and m_copies added.

    ``docs`` needs doc_id, text and source; other columns pass through. A null
    text has size 0, a null source is a source of its own that comes last, a
    null doc_id counts as empty text in the hash. Ties go by doc_id, nulls
    first; rows alike in all three are interchangeable, and since nothing
    tells them apart they share one range. Repeated rows are sampled one by
    one. Documents of a source whose size is 0 get no copies. A text is counted
    whole, however long. An empty table gives an empty table. Columns of ``docs`` that bear a name of this
    operator's own (``OWN``) are replaced.
    """
    docs = docs.drop(*OWN)
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col("text"), F.lit(""))))
    sized = (
        docs.withColumn("m_size", n_words(F.col("text")))
        .withColumn("m_null", F.col("source").isNull())
        .withColumn("m_src", F.coalesce(F.col("source").cast("string"), F.lit("")))
        .withColumn("m_band", _band(F.col("m_size")))
        .withColumn("m_hash", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"))
    )
    band = ["m_null", "m_src", "m_band"]
    bands = stage(sized.groupBy(*band).agg(F.count(F.lit(1)).alias("n"), F.sum("m_size").alias("w")), "bands")
    plan = targets(bands.groupBy("m_null", "m_src").agg(F.sum("w").alias("source_size")), weights, share, ceiling)

    def running(*by: str, order: str) -> Column:
        span = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(span), F.lit(0))

    bands = bands.withColumn("in_bands", running("m_null", "m_src", order="m_band")).withColumn("m_parts", F.ceil(F.col("n") / F.lit(PART_ROWS)))
    bands = stage(bands.join(plan, ["m_null", "m_src"]).select(*band, "m_parts", "in_bands", F.col("source_size").alias("m_source_size"), F.col("target").alias("m_target")), "plan")
    # ranges of the hash, so that a finer cut leaves the order alone
    dealt = sized.join(bands, band).withColumn("m_part", F.floor(F.col("m_hash") * F.col("m_parts") / F.lit(4294967296.0)).cast("int"))
    counts = stage(dealt.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n")), "counts")
    starts = stage(counts.select(*_KEYS, running(*band, order="m_part").alias("in_parts")), "starts")
    inside = F.row_number().over(Window.partitionBy(*_KEYS).orderBy("m_hash", F.asc_nulls_first("doc_id")))
    ratio = F.when(F.col("m_source_size") > 0, F.col("m_target") / F.col("m_source_size")).otherwise(F.lit(0.0))
    u = _offset(F.concat(F.col("m_null").cast("string"), F.lit("|"), F.col("m_src")), seed)
    rank = (F.col("in_bands") + F.col("in_parts") + inside).cast("double")
    return (
        dealt.join(starts, list(_KEYS))
        .withColumn("m_rank", rank)
        .withColumn("m_ratio", ratio)
        .withColumn("m_u", u)
        .withColumn(
            "m_copies",
            (F.floor(F.col("m_ratio") * F.col("m_rank") + F.col("m_u")) - F.floor(F.col("m_ratio") * (F.col("m_rank") - 1) + F.col("m_u"))).cast("long"),
        )
        .select(*docs.columns, "m_size", "m_source_size", "m_target", "m_copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row for each copy that ``mix`` decided on, with the input's columns."""
    own = [c for c in mixed.columns if c not in ADDED]
    return mixed.where("m_copies > 0").withColumn("m_copy", F.explode(F.sequence(F.lit(1), F.col("m_copies").cast("int")))).select(*own)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id",
        F.col("m_size").alias("size"),
        F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_size") * F.col("m_copies")).alias("taken"),
        F.col("m_copies").alias("copies"),
    )


OP5_SQL = r"""
with sized as (
  select doc_id, source is null as is_null, coalesce(source, '') as src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 8) as bigint) as h
  from documents),
sizes as (select is_null, src, cast(sum(size) as bigint) as source_size from sized group by all),
ranked as (
  select *, row_number() over (order by is_null, encode(src)) - 1 as pos from sizes),
weighed as (
  select *, case pos % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight,
         source_size * 2.0::double as cap, sum(source_size) over () * 1.5::double as total from ranked),
levels as (
  select *, (total - coalesce(sum(cap) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from weighed window before as (order by cap / weight, pos rows between unbounded preceding and 1 preceding)),
plan as (
  select is_null, src, source_size,
         case when level >= cap / weight then cap
              else max(case when level < cap / weight then level end) over () * weight end as target,
         cast(('0x' || substr(md5('17|' || (case when is_null then 'true' else 'false' end) || '|' || src), 1, 8)) as bigint) / 4294967296.0::double as u
  from levels),
placed as (
  select s.doc_id, s.size, p.source_size, p.target, p.u,
         case when p.source_size > 0 then p.target / p.source_size else 0 end as ratio,
         row_number() over (partition by s.is_null, s.src order by length(bin(s.size)) * 16 + (s.size >> greatest(length(bin(s.size)) - 4, 0)), s.h, s.doc_id nulls first) as k
  from sized s join plan p using (is_null, src)),
copied as (
  select *, cast(floor(ratio * k + u) - floor(ratio * (k - 1) + u) as bigint) as copies from placed)
select doc_id, cast(size as bigint) as size, source_size, target, cast(size * copies as bigint) as taken, copies from copied
"""
