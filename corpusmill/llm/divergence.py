"""How the sources of a language differ in their words.

Counts of (lang, source, term) leave the tasks already summed. Each group's
frequency of each kept term is a whole number of billionths, smoothed, so a
term that a group lacks has the group's baseline.

Distances between sources are sums over all kept terms. Only terms that occur
are looked at: over those, in units of some terms and two blocks of sources,
a unit sums |p - q| less the distance of the two baselines, and the baselines'
distance times the number of kept terms is added at the end.

The terms that stand out most in a group are found by radix selection. Rounds
over ten bits of the value count, for all groups at once, how many terms have
which next bits, and follow the bits that hold the k-th largest value. Terms
tied at that value are told apart in the same way by two bytes of their UTF-8
at a time, smallest first, until the rest is needed whole. No group is sorted;
at most k terms of each get a rank.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, stage, table

#: Documents of a language that a kept term is in.
LEAST_DOCS = 30
#: Terms that are ranked in a group.
TOP = 50
SCALE = 1_000_000_000
SMOOTHING = 5
#: Values are below 2 ** 30: a frequency is at most SCALE + 1.
VALUE_BITS, DIGIT_BITS = 30, 10
#: Bytes of a term that one round of refining looks at.
DIGIT_BYTES = 2
#: Entries that a task holds before it passes its sums on.
HELD = 400_000
#: Mean terms of a unit, and sources of a block.
UNIT_TERMS, BLOCK_SOURCES = 128, 128

#: ASCII letters in lower case, blanks for all other ASCII, other bytes as they are.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Stretches of ASCII letters and of characters beyond ASCII; A-Z in lower case."""
    return text.translate(_FOLD).split()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush():
        nonlocal size
        for (lang, source), (n, docs) in held.items():
            found = list(n)
            for at in range(0, len(found), 1 << 16):
                terms = found[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
        held.clear()
        size = 0

    for batch in in_parts(batches, 2):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            group = held.setdefault((lang, source), (Counter(), Counter()))
            words = terms_of(text.encode())
            before = len(group[0])
            group[0].update(words)
            group[1].update(set(words))
            size += len(group[0]) - before
        if size >= HELD:
            yield from flush()
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; null lang, source and text count as ''."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    sums = plain.mapInArrow(_summed, "lang string, source string, term string, n long, docs long")
    return sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _frequency(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)) in whole decimal numbers; null where nothing is kept."""
    up = (count + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(11,0)")
    down = (total + SMOOTHING * kept).cast("decimal(20,0)")
    return F.when(kept > 0, F.call_function("div", up, down) + 1)


def _boundary(hist: DataFrame, keys: list[str], need: str, largest_first: bool) -> DataFrame:
    """Of (keys, digit, n, need) the digit of each group in which the need-th row lies.

    Adds before (rows ahead of the digit) and all (rows of the group). Groups
    with fewer rows than needed have no such digit and are left out.
    """
    order = F.col("digit").desc() if largest_first else F.col("digit").asc()
    ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = hist.withColumn("upto", F.sum("n").over(ahead)).withColumn("before", F.col("upto") - F.col("n"))
    return upto.where((F.col("before") < F.col(need)) & (F.col("upto") >= F.col(need)))


def select_top(rows: DataFrame, keys: list[str], value: str, item: str, k: int) -> DataFrame:
    """The ``k`` rows of each group with the largest ``value``, ties by ``item`` in UTF-8 order; whole groups with fewer rows.

    ``value`` is a long from 0 to 2 ** VALUE_BITS - 1, ``item`` a string that
    occurs once in a group. Keys are not null. Rows keep their columns.
    """
    digits = VALUE_BITS // DIGIT_BITS
    bytes_ = F.encode(F.col(item), "UTF-8")
    state = None
    for r in range(digits):
        shift = VALUE_BITS - (r + 1) * DIGIT_BITS
        inside = rows.select(*keys, F.col(value).alias("v"))
        if state is not None:
            inside = inside.join(state, keys).where(F.shiftright("v", shift + DIGIT_BITS) == F.col("prefix"))
        else:
            inside = inside.withColumn("need", F.lit(k).cast("long"))
        hist = inside.groupBy(*keys, "need", F.shiftright("v", shift).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        found = _boundary(hist, keys, "need", largest_first=True)
        state = stage(found.select(*keys, F.col("digit").alias("prefix"), (F.col("need") - F.col("before")).alias("need"), F.col("n").alias("tied")), "digit")
    threshold = state.withColumnRenamed("prefix", "t_value")
    marked = rows.join(threshold.select(*keys, "t_value"), keys, "left")
    above = marked.where(F.col("t_value").isNull() | (F.col(value) > F.col("t_value"))).drop("t_value")
    tied = marked.where(F.col(value) == F.col("t_value")).drop("t_value")
    # as many as needed: the whole tie goes in, bounded by no bytes
    done = [threshold.where("tied = need").select(*keys, F.lit(0).alias("t_length"), F.lit(b"").alias("t_bytes"))]
    open_ = stage(threshold.where("tied > need").select(*keys, "need", F.lit(0).alias("t_length"), F.lit(b"").alias("t_bytes")), "ties")
    while not open_.isEmpty():
        place = F.col("t_length")
        inside = tied.select(*keys, bytes_.alias("b")).join(open_, keys).where(F.substring(F.col("b"), F.lit(1), place) == F.col("t_bytes"))
        digit = F.substring(F.col("b"), place + 1, F.lit(DIGIT_BYTES))
        hist = inside.groupBy(*keys, "need", "t_length", "t_bytes", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        found = _boundary(hist, keys, "need", largest_first=False).select(
            *keys, (F.col("need") - F.col("before")).alias("need"), (place + DIGIT_BYTES).alias("t_length"), F.concat("t_bytes", "digit").alias("t_bytes"), "n"
        )
        found = stage(found, "bytes")
        done.append(found.where("n = need").select(*keys, "t_length", "t_bytes"))
        open_ = found.where("n > need").drop("n")
    bounds = done[0]
    for d in done[1:]:
        bounds = bounds.unionByName(d)
    taken = tied.join(bounds, keys).where(F.substring(bytes_, F.lit(1), F.col("t_length")) <= F.col("t_bytes")).drop("t_length", "t_bytes")
    return above.unionByName(taken)


def _distances(key: tuple, rows: pa.Table) -> pa.Table:
    """Of one unit: for each two of its sources, the sum over its terms of |p - q| less the distance of the baselines.

    Each source has a row without a term, so that those with none of the
    unit's terms stand there with their baseline.
    """
    lang, _, left, right = (x.as_py() for x in key)
    absent = rows.column("term").is_null().to_numpy()
    number, value = rows.column("s_no").to_numpy(), rows.column("p").to_numpy()
    order = np.argsort(number[absent])
    sources, base = number[absent][order], value[absent][order]
    terms = rows.column("term").combine_chunks().drop_null().dictionary_encode()
    p = np.repeat(base[:, None], max(1, len(terms.dictionary)), axis=1)
    p[np.searchsorted(sources, number[~absent]), terms.indices.to_numpy(zero_copy_only=False)] = value[~absent]
    block = sources // BLOCK_SOURCES
    out = ([], [], [])
    for i in np.flatnonzero(block == left):
        # within one block each two once, between two blocks from the left one
        js = np.flatnonzero((block == right) & ((sources > sources[i]) | (left != right)))
        out[0].append(np.full(len(js), sources[i]))
        out[1].append(sources[js])
        out[2].append((np.abs(p[js] - p[i]) - np.abs(base[js] - base[i])[:, None]).sum(axis=1))
    a, b, d = (np.concatenate(x) for x in out)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "d": pa.array(d, pa.int64())})


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, both ways.

    ``rows`` has (lang, source, term, p), ``groups`` (lang, source, s_no,
    n_sources, kept, base). A row goes to one unit for each block of sources.
    The result has all pairs of a language's sources, which is what is asked for.
    """
    last_block = F.ceil(F.col("n_sources") / F.lit(BLOCK_SOURCES)).cast("int") - 1
    parts = F.greatest(F.lit(1), F.ceil(F.col("kept") / F.lit(UNIT_TERMS)).cast("int"))
    own = (F.col("s_no") / F.lit(BLOCK_SOURCES)).cast("int")
    blocks = groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last_block)))
    unit = ["lang", "part", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "s_no"]
    held = rows.join(blocks, ["lang", "source"]).withColumn("part", F.pmod(F.xxhash64("term"), parts).cast("int")).select(*unit, "term", "p")
    everyone = blocks.where("kept > 0").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(*unit, F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    sums = held.unionByName(everyone).groupBy("lang", "part", "left", "right").applyInArrow(_distances, "lang string, a long, b long, d long")
    sums = sums.groupBy("lang", F.col("a").alias("low"), F.col("b").alias("high")).agg(F.sum("d").alias("d"))
    first = groups.select("lang", F.col("source").alias("a_source"), F.col("s_no").alias("a"), F.col("base").alias("a_base"), "kept", own.alias("block"))
    second = blocks.select("lang", F.col("source").alias("b_source"), F.col("s_no").alias("b"), F.col("base").alias("b_base"), F.col("other").alias("block"))
    pairs = first.join(second, ["lang", "block"]).where(F.col("a") != F.col("b"))
    found = pairs.withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")}).join(sums, ["lang", "low", "high"], "left")
    value = F.coalesce("d", F.lit(0)) + F.col("kept") * F.abs(F.col("a_base") - F.col("b_base"))
    return found.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.coalesce(value, F.lit(0)).cast("long").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) from lang, source and text.

    Part ``pair`` holds the distance of a source to each other source of its
    language, part ``term`` the ``top`` kept terms that a source uses more
    than its language as a whole. A term is kept where at least
    ``least_docs`` documents of the language hold it. Null lang, source and
    text count as ''. A group without kept terms has its baseline everywhere;
    in a language without kept terms all distances are 0. Repeated rows count
    each time. Texts are taken whole. Ranks go by value, largest first, and
    then by item in UTF-8 order. An empty table gives an empty table; other
    columns are not read.
    """
    counts = stage(term_counts(docs), "counts", "zstd")
    groups = docs.groupBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).agg(F.count(F.lit(1)).alias("rows"))
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stage(counts.drop("docs").join(in_lang.drop("docs"), ["lang", "term"]), "kept", "zstd")
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    numbered = groups.select("lang", "source", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("s_no"), F.count(F.lit(1)).over(of_lang).alias("n_sources"))
    full = numbered.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["kept", "lang_total", "total"])
    groups = stage(full.withColumn("base", _frequency(F.lit(0).cast("long"), F.col("total"), F.col("kept"))), "groups")
    rows = kept.join(groups.select("lang", "source", "kept", "lang_total", "total"), ["lang", "source"])
    rows = rows.select("lang", "source", "term", _frequency(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _frequency(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    rows = stage(rows, "frequencies", "zstd")
    pairs = _pairs(rows.drop("q"), groups).withColumn("part", F.lit("pair"))
    higher = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = select_top(higher, ["lang", "source"], "value", "item", top).withColumn("part", F.lit("term"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    both = pairs.select("lang", "source", "part", "item", "value").unionByName(terms.select("lang", "source", "part", "item", "value"))
    return both.withColumn("rank", F.row_number().over(ranked))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP13_SQL = r"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
t as (select id, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*) as n from t group by lang, term having count(distinct id) >= 30),
langs as (select lang, count(*) as v, sum(n) as total from kept group by lang),
groups as (select distinct lang, source from d),
c as (select t.lang, t.source, t.term, count(*) as n from t join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) as total from c group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)::hugeint) // (coalesce(s.total, 0)::hugeint + 5 * l.v::hugeint) as p,
         1 + (1000000000::hugeint * (k.n + 5)::hugeint) // (l.total::hugeint + 5 * l.v::hugeint) as q
  from groups g join langs l using (lang) join kept k using (lang)
  left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join totals s on s.lang = g.lang and s.source = g.source),
far as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(f.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join far f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from p where n > 0 and p > q),
ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""
