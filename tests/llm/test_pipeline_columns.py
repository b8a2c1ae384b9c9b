"""Stages of the pipeline on odd tables: users' columns, null and repeated ids, ties, empty tables. And shards on every cluster alike."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    own = docs.withColumns({"x_score": F.lit(7.0), "l_score": F.lit("mine"), "m_size": F.lit("big"), "X_Row": F.lit(1), "L_Lang": F.lit(3), "q_of_words": F.lit("q"), "n_tokens": F.lit("t"), "m_u": F.array(F.lit(1))})
    more = own.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    again = own.limit(2).withColumn("text", F.concat("text", F.lit(" and some more")))
    empty = own.limit(2).withColumns({"text": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    return own.unionByName(own.limit(5)).unionByName(more).unionByName(again).unionByName(empty).cache()


@pytest.mark.parametrize("k", range(4))
def test_columns_keep_name_type_and_value(spark, odd, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd, SF)
    assert out.dtypes == odd.dtypes, name
    rows = out.collect()
    assert rows and all((r.x_score, r.l_score, r.m_size, r.X_Row, r.L_Lang, r.q_of_words, r.n_tokens, r.m_u) == (7.0, "mine", "big", 1, 3, "q", "t", [1]) for r in rows)
    before, after = (Counter((r.doc_id, r.text, r.source) for r in rs) for rs in (odd.collect(), rows))
    assert set(after) <= set(before)
    none = stage(spark, odd.limit(0), SF)
    assert none.dtypes == odd.dtypes and none.count() == 0


def test_encoding_of_odd_tables(spark, odd):
    out = corpus_pipeline.encode(spark, odd, SF)
    assert out.count() == odd.count() and out.where("doc_id is null").count() == 3
    assert corpus_pipeline.encode(spark, odd.limit(0), SF).count() == 0


def test_shards_do_not_depend_on_splits(spark, tmp_path):
    rows = [(k % 300 if k % 7 else None, f"text {k % 200}") for k in range(2000)] + [(5, "same")] * 700
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def dealt(d, n):
        return Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.shard(d.repartition(n), 6).collect())

    assert dealt(df, 3) == dealt(df.orderBy("text"), 11)
    wide = df.withColumn("size", F.lit("own")).withColumn("extra", F.xxhash64("doc_id", "text"))

    def written(d, n, path):
        sharding.write_shards(d.repartition(n), 6, path)
        return Counter(map(tuple, spark.read.parquet(path).select("doc_id", "text", "size", "extra", "shard").collect()))

    first = written(wide, 3, str(tmp_path / "a"))
    assert first == written(wide, 8, str(tmp_path / "b")) and sum(first.values()) == len(rows)
