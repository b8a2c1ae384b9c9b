"""The full-text index against SQLite's, and streams that grow, stop and go on."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import retrieval
from corpusmill.streaming import cursor, tail

WORDS = ["Herz", "heart", "café", "CAFE", "naïve", "a_b", "x", "drug_9", "日本語", "42", "é", "rate", "OR", "Über", "o'clock", "b", "two-part"]


def test_index_is_sqlites(spark, tmp_path):
    db = sqlite3.connect(":memory:")
    try:
        db.execute("create virtual table t using fts5(source, context, entity_name, category unindexed, tokenize='unicode61')")
    except sqlite3.OperationalError:
        pytest.skip("no fts5")
    rng = random.Random(5)
    rows = [(k, *(" ".join(rng.choices(WORDS, k=rng.randint(0, n))) for n in (2, 6, 1)), "heart only unindexed") for k in range(1, 120)]
    rows[7] = (8, None, None, None, None)
    rows[9] = (10, "a b", "plain", "", None)
    rows[30] = (31, "x a", "b x", "", None)  # a phrase does not cross columns
    db.executemany("insert into t(rowid, source, context, entity_name, category) values (?,?,?,?,?)", rows)
    queries = ["heart", "cafe!", "Über; rate?", "a_b", "drug_9 x", "nothing here", "日本語 42", "b x", "", "é", "naive two-part", "heart OR rate", "AND heart", "rate a_b NOT", "x_ AND he"]
    queries += [" ".join(rng.choices(WORDS, k=3)) for _ in range(20)]
    want = {}
    import re

    for n, q in enumerate(queries):
        words = [w for w in re.sub(r"[^\w\s]", " ", q).split() if len(w) > 1]
        if not words:
            continue
        try:
            want[n] = {(r[0], "fts5_match") for r in db.execute("select rowid from t where t match ? limit 5", (" OR ".join(words),))}
        except sqlite3.OperationalError:
            found, seen = set(), set()
            for w in words[:3]:
                for r in db.execute("select rowid, context from t where context like ? limit 3", (f"%{w}%",)):
                    if r[1] not in seen:
                        seen.add(r[1])
                        found.add((r[0], "keyword_like_match"))
            want[n] = found
    index = spark.createDataFrame(rows, "row_id long, source string, context string, entity_name string, category string")
    lasting = retrieval.FullText(spark, str(tmp_path / "index"), buckets=4).add(index.where("row_id <= 60")).add(index.where("row_id > 60"))
    got = {}
    for r in lasting.search(spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")).collect():
        got.setdefault(r.query_id, set()).add((r.row_id, r.method))
    assert got == {n: w for n, w in want.items() if w}
    assert any(m == "keyword_like_match" for w in want.values() for _, m in w)


def test_appended_lines_come_once(spark, tmp_path, monkeypatch):
    folder, log = tmp_path / "in", tmp_path / "in" / "a.jsonl"
    folder.mkdir()
    monkeypatch.setattr(tail, "RANGE", 16)
    monkeypatch.setattr(tail, "LOOK", 5)

    def run(name):
        tail.appended_lines(spark, str(folder)).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.path.rsplit("/", 1)[1], r.at, r.raw) for r in spark.read.parquet(str(tmp_path / name)).collect())

    wanted = []
    for step, text in enumerate(["one\nzwei é\n", "", "three is a longer line than a range\n\nhalf", " and whole\nlast\n"]):
        with open(log, "ab") as f:
            f.write(text.encode())
        if step == 2:
            (folder / "b.jsonl").write_text("other\n")
            (folder / "c.txt").write_text("not read\n")
        data, at, wanted = log.read_bytes(), 0, [("b.jsonl", 0, "other")] if step >= 2 else []
        for line in data[: data.rfind(b"\n") + 1].split(b"\n")[:-1]:
            wanted.append(("a.jsonl", at, line.decode()))
            at += len(line) + 1
        assert run("out") == sorted(wanted)
    assert len(run("again")) == len(wanted)


def test_keys_are_never_forgotten(spark, tmp_path):
    source, store = tmp_path / "s", str(tmp_path / "store")
    for step, ids in enumerate([[1, 2, 2, None], [2, 3], [1, 3, None, 4]]):
        spark.createDataFrame([(k, f"b{step}") for k in ids], "k long, v string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("k long, v string").option("maxFilesPerTrigger", 1).parquet(str(source))
        cursor.first_ever(stream, ["k"], store, str(tmp_path / "cp")).awaitTermination()
    got = sorted(((r.k, r.v) for r in cursor.first_rows(spark, store).collect()), key=str)
    assert got == sorted([(1, "b0"), (2, "b0"), (None, "b0"), (3, "b1"), (4, "b2")], key=str)
    assert cursor.first_rows(spark, store).where(F.col("k").isNull()).count() == 1


def test_what_many_queries_find_is_not_written(spark, tmp_path, monkeypatch):
    """Texts are written once, in the index, however many queries find them by entity or by a word."""
    from pathlib import Path

    from corpusmill.operators import retrieval
    from corpusmill.sources import staging

    base = str(tmp_path / "shared")
    own = lambda _, name="t": f"{base}/{staging.uuid.uuid4().hex}/{name}"
    monkeypatch.setattr(retrieval, "scratch", own)
    monkeypatch.setattr(staging, "scratch", own)
    text = lambda k: " ".join(f"w{(k * 7919 + j * 104729) % 1000003:06d}" for j in range(400))
    index = spark.createDataFrame([(k, "src1", "s", text(k) + " alpha") for k in range(100)], "row_id long, entity_name string, source string, context string")
    asked = spark.createDataFrame([(k, "about src1" if k % 2 else "alpha OR beta", "src1" if k % 2 else "none") for k in range(60)], "query_id long, query string, entity string")
    out = retrieval.local_tier(asked, index).groupBy("method").count().collect()
    assert {r["method"]: r["count"] for r in out} == {"entity_like_match": 3000, "keyword_like_match": 90}
    size = lambda pattern: sum(p.stat().st_size for p in Path(base).glob(pattern) if p.suffix == ".parquet")
    assert size("**/*.parquet") < 3 * size("*/full-text/rows/**/*.parquet")


def test_matches_are_not_dealt_anew(spark, tmp_path, monkeypatch):
    """Entity matches grow with queries times rows, and texts are long: neither goes through a shuffle."""
    from corpusmill.operators import retrieval
    from corpusmill.sources import staging

    monkeypatch.setattr(staging, "scratch", lambda _, name="t": f"{tmp_path}/shared/{staging.uuid.uuid4().hex}/{name}")
    text = lambda k: " ".join(f"w{(k * 7919 + j * 104729) % 1000003:06d}" for j in range(400)) + " Alphabet"
    index = staging.staged(spark.createDataFrame([(k, "src1", "s", text(max(k, 1))) for k in range(1000)], "row_id long, entity_name string, source string, context string"))
    lasting = retrieval.FullText(spark, str(tmp_path / "index"), buckets=4).add(index)
    queries = [("about src1", "none"), ("alpha OR beta", "none"), ("w000000 AND alphabet", "none"), ("nothing here", "none"), ("W007919", "none")]
    asked = staging.staged(spark.createDataFrame([(k, *queries[k % 5]) for k in range(1000)], "query_id long, query string, entity string"))
    web = asked.select("query_id", F.lit(-1).cast("long").alias("row_id"), F.lit("web").alias("source"), F.lit("").alias("context"), F.lit("web").alias("method"))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    def run(*known):
        local, *hits = retrieval.local_hits(asked, index, lasting) if known else (retrieval.local_tier(asked, index, lasting),)
        out = retrieval.first_tier(local, web, found=tuple(hits)).select("query_id", "row_id", "method", "tier")
        staging.staged(out, "out").createOrReplaceTempView("out")
        return {(r.q, r.method, r.tier): (r.n, r.least, r.most) for r in spark.sql("select query_id % 5 as q, method, tier, count(*) as n, min(row_id) as least, max(row_id) as most from out group by 1, 2, 3").collect()}

    before = set(shuffled())
    got = run("hits")
    after = sum(n for name, n in shuffled().items() if name not in before)
    # rows 0 and 1 hold the same text, which counts once
    assert got == {
        (0, "entity_like_match", 1): (200_000, 0, 999), (1, "keyword_like_match", 1): (400, 0, 2), (2, "keyword_like_match", 1): (400, 0, 2), (3, "web", 2): (200, -1, -1), (4, "fts5_match", 1): (400, 0, 1),
    }
    assert after < 150_000
    assert run() == got


def test_matches_lie_in_runs(spark, tmp_path, monkeypatch):
    """Matches without texts are the pairs of queries and rows of a name, in far fewer bytes of a file than a byte a pair."""
    from corpusmill.operators import retrieval
    from corpusmill.sources import staging

    monkeypatch.setattr(staging, "scratch", lambda _, name="t": f"{tmp_path}/shared/{staging.uuid.uuid4().hex}/{name}")
    rows = [(k, f"src{k * k % 7}", "s", "text") for k in range(2000)] + [(2001, None, "s", "text"), (None, "src1", "s", "text"), (2002, "", "s", "text")]
    index = staging.staged(spark.createDataFrame(rows, "row_id long, entity_name string, source string, context string"))
    lasting = retrieval.FullText(spark, str(tmp_path / "index"), buckets=4).add(index.where("row_id is not null"))
    queries = [(f"about src{k % 3}", "SRC" if k % 5 == 0 else f"none{k}") for k in range(1500)]
    asked = spark.createDataFrame([(k, *q) for k, q in enumerate(queries)], "query_id long, query string, entity string")
    want = sorted((k, r[0] is None, r[0] or 0) for k, (q, e) in enumerate(queries) for r in rows if r[1] is not None and (e.lower() in r[1] or r[1] in q))
    for together, most in ((retrieval.TOGETHER, retrieval.AT_ONCE), (3, 2)):
        monkeypatch.setattr(retrieval, "TOGETHER", together)
        monkeypatch.setattr(retrieval, "AT_ONCE", most)
        few = asked if together > 3 else asked.where("query_id < 30")
        out = staging.staged(retrieval.local_hits(few, index, lasting, texts=False)[0], f"out{together}")
        assert out.columns == ["query_id", "row_id", "method"] and {r.method for r in out.select("method").distinct().collect()} == {"entity_like_match"}
        pairs = out.toPandas()
        got = sorted(zip(pairs.query_id.tolist(), pairs.row_id.isna().tolist(), pairs.row_id.fillna(0).astype(int).tolist()))
        assert got == [w for w in want if together > 3 or w[0] < 30]
    assert sum(p.stat().st_size for p in tmp_path.glob("shared/*/out256/*.parquet")) < len(want) / 4
