"""A training corpus in five stages, each over what the one before kept.

Toxic documents go, then those whose language is not clear, then near
duplicates; the rest is mixed to source weights and encoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import language, minhash, mixing, pieces, toxicity
from corpusmill.llm.common import stage, table
from corpusmill.schema import free

def _beside(docs: DataFrame, names: Iterable[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` on ``docs``, whose columns that bear one of a step's own names stand under another one meanwhile; the columns come back as they were."""
    taken = {n.lower() for n in names}
    other = {}
    for c in docs.columns:
        other[c] = free([*docs.columns, *taken, *other.values()], c) if c.lower() in taken else c
    out = step(docs.select(*[F.col(c).alias(n) for c, n in other.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in other.items()])


#: A document stays if one language makes up this share of it.
LEAST_SHARE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold of op4.

    Null and empty texts score low and stay, repeats stay or go together, a
    text is read whole. Rows without an id are scored like others but are not
    learned from. An empty table, or one without labels of both kinds, stays
    as it is. Other columns pass through, whatever their names.
    """
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _beside(docs, ["x_score"], lambda d: toxicity.score(d, machine).where(F.col("x_score") < toxicity.THRESHOLD))


def drop_unclear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that makes up at least LEAST_SHARE.

    Null texts and those without a letter go, repeats stay or go together. An
    empty table gives an empty table. Other columns pass through, whatever
    their names; a null lang is not learned from.
    """
    model = language.fit(docs)
    found = (F.col("l_lang") != "und") & (F.col("l_score") >= LEAST_SHARE)
    return _beside(docs, language.ADDED, lambda d: language.identify(d, model).where(found))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at 0.8, the first in the table.

    Rows are told apart by a number of their own, so documents that share a
    doc_id, or have none, stay if their texts differ, and of equal rows one
    stays. Null and blank texts link with nothing and stay. An empty table
    gives an empty table; other columns pass through.
    """
    number = free(docs.columns, "x_row")
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), width=5, percent=80)
    kept = found.where("kept").select(F.col("doc_id").alias(number))
    return rows.join(kept, number, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null sources are one source, texts without a word are never taken, and
    repeated rows are sampled one by one. Null ids and very long texts are
    rows like others. An empty table gives an empty table. Other columns pass
    through, whatever their names.
    """
    return _beside(docs, mixing.OWN, lambda d: mixing.emit(mixing.mix(d)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each copy, by doc_id.

    Null texts have no tokens, repeats are encoded one by one, a text is
    encoded whole. Null ids stay null. An empty table gives an empty table;
    other columns are not read, so their names do no harm.
    """
    return pieces.encode_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unclear_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Trained models and merges are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
