"""The ten operators on small tables, against brute force, and their edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import common, lattice, language, minhash, mixing, pieces, quality, recurrent, sharding, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return WORD.findall(t or "")


def corpus(n=60):
    """Documents with nulls, empty, blank, long and repeated texts, and a hot source."""
    rng = np.random.default_rng(5)
    syllables = "ba ko ri tu me sa lo ni".split()
    rows = []
    for i in range(n):
        size = [0, 1, 3, 40, 120][i % 5]
        t = " ".join("".join(rng.choice(syllables, 2)) for _ in range(size))
        rows.append((i, t + ("\n" + t if i % 9 == 0 else ""), ["en", "de"][i % 2], f"s{i % 4}" if i % 3 else "hot", len(t)))
    rows[7] = (7, None, None, None, None)
    rows[8] = (8, " \t\n", "en", None, 3)
    rows += [(100, rows[3][1], "en", "hot", 1), (101, rows[3][1] + " end", "en", "hot", 1), (102, "long " * 3000, "de", "hot", 1), (3, rows[3][1], "en", "hot", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_slices_of_batches():
    batch = pa.record_batch({"i": range(6), "t": ["a" * 5, None, "", "é" * 15, "c", "d" * 9]})
    for most in (1, 8, 1000):
        parts = list(common.in_parts([batch, batch.slice(0, 0)], 1, most))
        assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
        assert all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[:-1]) <= most for p in parts)


# -- 1 ----------------------------------------------------------------------


def test_e8_is_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) * 2
    p = lattice.decode_e8(x)
    near = ((x - p) ** 2).sum(1)
    for r in lattice._roots():
        assert (near <= ((x - p - r) ** 2).sum(1) + 1e-9).all()
    assert near.max() <= 1 + 1e-9


def brute_links(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: 0 for i, _ in rows}
    comp = {i: i for i, _ in rows}
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            u, v = good[a][1], good[b][1]
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                i, j = good[a][0], good[b][0]
                links[i] += 1
                links[j] += 1
                low, high = sorted((comp[i], comp[j]))
                comp = {k: low if c == high else c for k, c in comp.items()}
    return {i: (links[i], comp[i]) for i in links}


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(40)]
    base = np.array(rows[0][1])
    rows += [(100 + k, (base + rng.normal(size=16) * 0.02).tolist()) for k in range(20)]
    rows += [(200 + k, rows[1][1]) for k in range(15)] + [(300, (np.array(rows[1][1]) * 3).tolist())]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, []), (404, [1.0, 2.0]), (405, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_vectors(df, block=block).collect()}
    assert got == brute_links(rows)


def test_vectors_empty(spark):
    assert lattice.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# -- 2 ----------------------------------------------------------------------


def test_lm_base_is_exact(spark, docs):
    got = sorted(recurrent.score_documents(docs).collect(), key=str)
    rows = docs.select("doc_id", "text").collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter()
    for r in rows:
        if not held(r.doc_id):
            c.update([*words((r.text or "").translate(low)), "\n"])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in rows:
        t = [*words((r.text or "").translate(low)), "\n"]
        want[(r.doc_id, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_carries_state_and_sums_to_one():
    model = recurrent.Model([b"\n", b"a", b"b"], np.array([5.0, 3.0, 2.0]), 12, 5)
    rng = np.random.default_rng(0)
    doc = rng.integers(0, 4, 100).astype(np.int32)
    whole = model.scores([doc])[0]
    p, h, total = model.shape.view(model.flat), np.zeros((1, recurrent.HIDDEN), np.float32), 0.0
    for k, goal in enumerate(doc):
        given = np.array([[model.head + 1 if k == 0 else doc[k - 1]]])
        s, h, _ = recurrent._forward(p, given, h, keep=False)
        every = np.exp(recurrent._log_probabilities(p, model.shape, np.repeat(s[0], 4, axis=0), np.arange(4)))
        assert abs(every.sum() - 1) < 1e-4
        total += math.log(every[goal])
    assert abs(whole - total) < 1e-3
    assert abs(model.scores([doc[:3], doc, doc[:0]])[1] - whole) < 1e-3


def test_lm_gradient_and_learning():
    shape = recurrent.Shape(20)
    flat = shape.start(np.ones(20), 1.0).astype(np.float64)
    rng = np.random.default_rng(0)
    ids, goal, h = rng.integers(0, 21, (4, 3)), rng.integers(0, 21, (4, 3)), np.zeros((3, recurrent.HIDDEN))

    def loss(f):
        g = np.zeros_like(f)
        views = shape.view(g)
        out = recurrent._gradients(shape.view(f), shape, views, ids, goal, h)[1]
        shape.view(g)["e"][views["touched"]] = views["rows"]
        return out, g

    _, g = loss(flat)
    for i in rng.integers(0, len(flat), 20):
        e = np.zeros_like(flat)
        e[i] = 1e-4
        assert abs((loss(flat + e)[0] - loss(flat - e)[0]) / 2e-4 - g[i]) < 5e-4
    model = recurrent.Model([b"%d" % i for i in range(20)], np.full(20, 100.0), 2000, 20)
    stream = np.tile(np.arange(20, dtype=np.int32), 8000)
    before = model.scores([stream[:200]])[0]
    trainer = recurrent.Trainer(model.flat, model.shape, 0.02)
    for _ in range(2):
        trainer.learn(stream)
    model.flat = trainer.flat
    assert model.scores([stream[:200]])[0] > before / 2


def test_lm_learns_from_every_token(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k % 50}" for k in range(3000 + i))) for i in range(12)] + [(50, None), (51, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.col("doc_id") != 3)

    def counting(self, stream):
        self.flat[0] += len(stream)

    monkeypatch.setattr(recurrent.Trainer, "learn", counting)
    # weights are averaged over trainers, so one trainer's sum is the sum; a chunk holds a few documents
    monkeypatch.setattr(recurrent, "CHUNK_TOKENS", 7000)
    staged = recurrent._staged(docs.coalesce(1))
    counts = staged.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    model = recurrent.fit(staged.where("word is null").select("text", "learn").coalesce(1), counts)
    # each document has its start besides its tokens
    first = model.shape.start(np.ones(model.head), 1.0)[0]
    assert abs(model.flat[0] - first - sum(len(recurrent.tokens_of(t)) + 1 for i, t in rows if i != 3)) < 1


def test_lm_scores_by_brute_force(spark, monkeypatch):
    """The query's scores against the model said word by word, over several blocks and with words outside the head."""
    monkeypatch.setattr(recurrent, "BLOCK_BYTES", 3000)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, int(rng.integers(1, 90))) % 60)) for i in range(80)] + [(None, "w1 w2"), (900, None), (901, ""), (902, "W1 neverseen w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = docs.withColumn("learn", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) != 0)
    staged = recurrent._staged(marked)
    assert staged.select("block").distinct().count() > 3
    counts = staged.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    model = recurrent.fit(staged.where("word is null").select("text", "learn"), counts, head=20)
    known = {bytes(r.word): r.n for r in counts.collect()}
    p, n = model.shape.view(model.flat), recurrent.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))

    def slow(text):
        h, given, total = np.zeros(n), model.head + 1, 0.0
        for w in [*(text or "").encode().lower().split(), b"\n"]:
            x = p["e"][given].astype(float)
            gates = sig(x[: 2 * n] + h @ p["u"][:, : 2 * n])
            new = np.tanh(x[2 * n :] + (gates[n:] * h) @ p["u"][:, 2 * n :])
            h = h + gates[:n] * (new - h)
            given = model.place.get(w, model.head)
            cls = given // recurrent.CLASS if given < model.head else model.shape.classes
            logits = h @ p["wc"] + p["bc"]
            total += logits[cls] - np.log(np.exp(logits).sum())
            if given < model.head:
                own = slice(cls * recurrent.CLASS, (cls + 1) * recurrent.CLASS)
                inner = p["wo"][own] @ h + p["bo"][own]
                total += inner[given - cls * recurrent.CLASS] - np.log(np.exp(inner).sum())
            else:
                total += np.log((known.get(w, 0) + 0.1) / (model.tail + 0.1 * (model.tail_distinct + 1)))
        return total / np.log(10)

    got = Counter((r.doc_id, r.n_tokens, round(r.score, 2)) for r in recurrent.score_staged(staged, counts, model).collect())
    want = Counter((i, len((t or "").split()) + 1, round(slow(t), 2)) for i, t in rows)
    assert sum((got - want).values()) <= 2  # a figure may stand on the edge of rounding
    assert {k[:2] for k in got} == {k[:2] for k in want}


def test_lm_without_training_rows(spark, empty):
    assert recurrent.score_documents(empty).count() == 0
    only = spark.createDataFrame([(i, "a b") for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    r = recurrent.score_documents(only).first()
    assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_language_model_words_are_exchanged_once_by_word(spark):
    """F op2: words were exchanged for their sums, and again, beside the sums, for the join with them."""
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 4000, 300))) for i in range(120)] + [(500, None)], "doc_id long, text string").repartition(3).cache()
    staged = recurrent._staged(docs.withColumn("learn", common.share_of(F.col("doc_id"), 10) != 0))
    rows = staged.where("word is not null").select("block", "word", "n").collect()
    sums = Counter()
    for r in rows:
        sums[bytes(r.word)] += r.n
    known = recurrent._known(staged).collect()
    assert sorted((r.block, bytes(r.word), r.n) for r in known) == sorted((r.block, bytes(r.word), sums[bytes(r.word)]) for r in rows)
    assert Counter(bytes(r.word) for r in known if r.first) == Counter(set(sums))
    before, limit = exchanged(spark, "shuffleWriteRecords"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = recurrent.score_documents(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        docs.unpersist()
    assert len(got) == 121 and exchanged(spark, "shuffleWriteRecords") - before < 2.5 * len(rows)


# -- 3 ----------------------------------------------------------------------


def brute_near(rows, width, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = words((t or "").translate(low))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = [x if c == y else c for c in comp]
    out = Counter()
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[k] and rows[j][0] is not None]
        out[(i, len(sets[k]), min(ids, default=None))] += 1
    return out


@pytest.mark.parametrize(("width", "rows", "size", "small", "pairs", "shingles"), [(2, 4096, 8 << 20, 16, 65_536, 500_000), (5, 4096, 8 << 20, 16, 65_536, 500_000), (2, 5, 1500, 2, 7, 50), (2, 64, 8 << 20, 2, 65_536, 50)])
def test_near_duplicates(spark, monkeypatch, width, rows, size, small, pairs, shingles):
    # small blocks send the same groups through the paths of large ones
    for name, value in (("BLOCK_ROWS", rows), ("BLOCK_BYTES", size), ("SMALL", small), ("PAIRS", pairs), ("SHINGLES", shingles)):
        monkeypatch.setattr(minhash, name, value)
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(50)]
    rows = [(i, t) for i, t, *_ in corpus(30)]
    for g in range(4):
        base = list(rng.choice(vocab, 60))
        for k in range(12):
            t = list(base)
            for _ in range(k % 5):
                t[rng.integers(0, 60)] = f"X{rng.integers(0, 9)}"
            rows.append((1000 + 100 * g + k, " ".join(t)))
    rows += [(None, "A b c d e f"), (5000, "a B c d e f"), (5001, "one"), (5002, "one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, width=width).collect())
    assert got == brute_near(rows, width, 80)


def test_intersections():
    rng = np.random.default_rng(4)
    pool = np.arange(300, dtype=np.uint64) * np.uint64(60_000_000_000_000_000)
    sets = [np.sort(rng.choice(pool, rng.integers(1, 200), replace=False)) for _ in range(40)]
    a, b = np.triu_indices(40, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)]
    assert minhash._intersections(sets, a, b).tolist() == minhash._merged(sets, a, b).tolist() == want


def test_pruning_bound():
    least = minhash.least_matches(0.8, 125)
    assert least[124] < 0.8 * 125 and least == sorted(least)
    # the chance that a pair at the threshold is dropped at any look stays small
    rng = np.random.default_rng(0)
    m = np.cumsum(rng.random((20000, 125)) < 0.8, axis=1)
    assert (m[:, 24::25] < np.array(least[24::25])).any(axis=1).mean() < 1e-3


def test_near_duplicates_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0


# -- 4 ----------------------------------------------------------------------


def test_string_kernel_by_definition():
    from itertools import combinations

    def phi(s):
        out = Counter()
        for at in combinations(range(len(s)), 3):
            out["".join(s[i] for i in at)] += toxicity.LAMBDA ** (at[-1] - at[0] + 1)
        return out

    names = ["idiot", "idxiot", "iddiot", "banana", "größe", "abc"]
    got = toxicity.kernel(names, names)
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            x, y = phi(a), phi(b)
            dot = lambda u, v: sum(w * v[k] for k, w in u.items())
            assert abs(got[i, j] - dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))) < 1e-9


def test_toxicity_tolerates_gaps(spark):
    rng = np.random.default_rng(4)
    plain = ["".join(rng.choice(list("aeioubcdfglmnprst"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        t = list(rng.choice(plain, 30))
        if i % 5 == 0:
            t[rng.integers(0, 30)] = ["zworthok", "qidiotik"][i % 2]
        rows.append((i, " ".join(t)))
        labels.append((i, 0, int(i % 5 == 0)))
    clean = " ".join(plain[:30])
    rows += [(9000, clean + " z-worthok."), (9001, clean + " q i d i o t i k yes"), (9002, clean + " zworxthok"), (9003, clean), (9004, None), (9005, ""), (9006, clean + " ZWORTHOK")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("x_extra", F.lit(1))
    machine = toxicity.fit(docs, spark.createDataFrame(labels + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.x_score for r in toxicity.score(docs, machine).collect()}
    assert all(got[i] >= 0.7 for i in (9000, 9001, 9002, 9006)) and all(got[i] < 0.7 for i in (9003, 9004, 9005))
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in held)


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none) is None
    assert {r.x_score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(empty, None).count() == 0


# -- 5 ----------------------------------------------------------------------


def test_mixing(spark, docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r.m_size == len(words(r.text)) and r.m_copies in (0, 1, 2)
        sizes[r.source] += r.m_size
        taken[r.source] += r.m_size * r.m_copies
        target[r.source] = r.m_target
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= 2 * sizes[s]}
        if not over:
            want |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ -= over
    assert target == pytest.approx(want)
    again = Counter((r.doc_id, r.m_size, r.source, r.m_copies) for r in mixing.mix(docs).collect())
    assert again == Counter((r.doc_id, r.m_size, r.source, r.m_copies) for r in rows)
    assert mixing.emit(mixing.mix(docs)).count() == sum(r.m_copies for r in rows)
    assert mixing.mix(empty).count() == 0


def test_clashing_columns(spark, docs):
    odd = docs.withColumn("m_size", F.lit("x")).withColumn("m_mine", F.lit(1)).withColumn("q_of_words", F.lit(2)).withColumn("llr", F.lit(3)).withColumn("l_lang", F.lit(4)).withColumn("ids", F.lit(5)).withColumn("x_score", F.lit(6))
    mixed = mixing.emit(mixing.mix(odd))
    assert "m_mine" in mixed.columns and "m_size" not in mixed.columns and mixed.count() > 0
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score_quality(odd, labels)
    assert scored.columns.count("llr") == 1 and dict(scored.dtypes)["llr"] == "double" and scored.count() == docs.count()
    for out in (language.identify(odd, language.fit(odd)), pieces.encode(odd), toxicity.score(odd, None), minhash.near_duplicates(odd), sharding.shard(odd, 3), recurrent.score_documents(odd)):
        assert len(set(out.columns)) == len(out.columns) and out.count() == docs.count()


def test_mixing_near_target(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 60)), "a" if i % 3 else "b") for i in range(9000)]
    r = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(F.sum(F.col("m_size") * F.col("m_copies")).alias("t"), F.first("m_target").alias("w")).collect()
    assert all(abs(x.t - x.w) < 0.002 * x.w for x in r)


# -- 6 ----------------------------------------------------------------------


def test_sharding(spark, docs, empty):
    many = spark.range(4000).select((F.col("id") % 900).alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 40).cast("int")).alias("text"))
    got = sharding.shard(many.unionByName(docs.select("doc_id", "text").limit(3)), 7).collect()
    assert len(got) == 4003
    size = Counter()
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        size[s] = sum(r["size"] for r in got if r.shard == s)
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 7
    few = {(r.doc_id, r["size"], r.text_crc32) for r in sharding.shard(docs, 24).collect()}
    assert few == {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert sharding.shard(empty, 24).count() == 0


def test_sharding_null_ids_spread(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    counts = [r["count"] for r in sharding.shard(df, 3).groupBy("shard").count().collect()]
    assert len(counts) == 3 and max(counts) - min(counts) < 20


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, 4, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


# -- 7 ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


TEXTS = ["", " ", "  a  b ", "\t\n", "▁", "▁▁a", "日本語 テスト　x", "emoji 😀é", "\x00a\x01", "<s> </s> <unk> <0x41>", "x" * 400, "a" + " " * 40 + "b", "Grüße, das ist ein Satz.\nNeue Zeile"]


def test_pieces_equal_the_library(spark, library):
    df = spark.createDataFrame([*enumerate(TEXTS), (99, None)], "doc_id long, text string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in pieces.encode_digests(df).collect():
        ids = library.encode(TEXTS[r.doc_id] if r.doc_id < 99 else "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else ""))
    for r in pieces.decode(pieces.encode(df)).collect():
        t = r.text or ""
        ids = library.encode(t)
        assert r.ids == ids and r.decoded == (library.decode(ids) if ids else "")
        assert b"".join(t.encode()[a:b] for a, b in zip(r.starts, r.ends, strict=True)) == t.encode()


def test_digests_come_from_ids_and_spans(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {r.doc_id: (sha(",".join(map(str, r.ids)).encode()), sha(np.array([*r.starts, *r.ends], "<i4").tobytes())) for r in pieces.encode(docs).collect()}
    assert {r.doc_id: (r.ids_sha256, r.spans_sha256) for r in pieces.encode_digests(docs).collect()} == want
    codec = pieces.PieceCodec(pieces.model_path())
    for t in TEXTS:
        normal, starts = codec.normalizer.aligned(t)
        assert (normal, starts.tolist()) == codec.normalizer.normalize(t)
    # a wrong id shows in what is decoded
    word, ids = "▁Satz", codec.library.encode("▁Satz")
    codec.cache[word] = codec._part(word, [*ids[:-1], ids[-1] + 1])
    got = codec.whole("Satz")
    assert got[3] != b"Satz" and got[3].decode() == codec.decode(got[0].tolist())


def double_array(keys):
    """A compiled map's trie, built by brute force, and its blob."""
    import struct

    blob, values = b"", {}
    for k, v in keys.items():
        values[k] = len(blob)
        blob += v + b"\0"
    units = [0] * 4096
    used = {0}
    next_base = [256]

    def build(node, prefix):
        children = sorted({k[len(prefix)] for k in keys if k.startswith(prefix) and len(k) > len(prefix)})
        base = next_base[0]
        next_base[0] += 256
        offset = node ^ base
        has = prefix in keys
        units[node] |= (offset << 10) | (int(has) << 8)
        if has:
            units[base] = values[prefix] | 0x80000000
        for c in children:
            assert base ^ c not in used
            used.add(base ^ c)
            units[base ^ c] = c
        for c in children:
            build(base ^ c, prefix + bytes([c]))

    build(0, b"")
    body = struct.pack("<4096I", *units)
    return struct.pack("<I", len(body)) + body + blob


def test_character_map_takes_the_longest_prefix():
    charmap = pieces.CharMap(double_array({"ﬁ".encode(): b"fi", b"a": b"b", b"aa": b"c", "　".encode(): b" "}))
    assert charmap.longest(b"aaa", 0) == (2, b"c") and charmap.longest(b"xa", 1) == (1, b"b") and charmap.longest(b"x", 0) is None
    n = pieces.Normalizer(charmap, dummy=True, squeeze=True, escape=True)
    text, starts = n.normalize(" ﬁ　 aaa ")
    assert text == "▁fi▁cb" and starts == [0, 1, 1, 4, 8, 10, 12]


# -- 8 ----------------------------------------------------------------------


def test_language_mixture(spark, empty):
    rng = np.random.default_rng(7)
    make = lambda s, n: " ".join("".join(rng.choice(s.split(), 3)) for _ in range(n))
    en, de = "th er on an re he in", "sch ung ein ver ü ä keit"
    rows = [(i, make(en if i % 2 else de, 60), "en" if i % 2 else "de") for i in range(400)]
    rows += [(1000, make(en, 200) + " " + make(de, 100), None), (1001, None, None), (1002, " 12 ?! ", "en"), (1003, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("extra", F.lit(1))
    got = {r.doc_id: r for r in language.identify(df, language.fit(df)).collect()}
    assert all(got[i].l_lang == ("en" if i % 2 else "de") for i in range(400))
    assert all(got[i].l_lang == "und" and got[i].l_score == 0 for i in (1001, 1002, 1003))
    mixed = got[1000]
    assert mixed.l_langs == ["en", "de"] and abs(mixed.l_shares[0] - 2 / 3) < 0.05
    assert language.identify(empty, language.fit(empty)).count() == 0
    none = language.identify(df, language.fit(df.withColumn("lang", F.lit(None).cast("string"))))
    assert {r.l_lang for r in none.collect()} == {"und"}


# -- 9 ----------------------------------------------------------------------


def test_quality_counts(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_quality(docs.withColumn("extra", F.lit("x")), labels).collect()
    assert len(rows) == docs.count() and rows[0].extra == "x"
    for r in rows:
        t = r.text or ""
        w = words(t)
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        twice = {x for x, n in Counter(windows).items() if n > 1}
        cover = {k + j for k, x in enumerate(windows) if x in twice for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not r.base_failed and r.llr >= r.threshold)
    assert quality.score_quality(empty, labels).count() == 0


def test_quality_ratio(spark, docs):
    trusted = spark.createDataFrame([(3,), (4,), (13,)], "doc_id long")
    buckets = 64
    ratios = quality.fit_ratios(docs.select("doc_id", "text"), trusted, buckets)
    assert len(ratios) == buckets and any(ratios)
    grams = docs.select("doc_id", F.explode(quality._let(quality._hashes(quality.words(F.col("text"))), lambda h: quality._buckets(h, buckets))).alias("b")).collect()
    raw, good = Counter(r.b for r in grams), Counter(r.b for r in grams if r.doc_id in (3, 4, 13))
    n, m = sum(raw.values()) + buckets, sum(good.values()) + buckets
    want = [math.log((good[b] + 1) / m) - math.log((raw[b] + 1) / n) for b in range(1, buckets + 1)]
    assert ratios == pytest.approx(want)
    none = quality.score_quality(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.where(F.col("kept") == F.col("base_failed")).count() == 0


def exchanged(spark, what):
    """What all stages so far wrote to exchanges, ``shuffleWriteBytes`` or ``shuffleWriteRecords``."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(getattr(stages.apply(i), what)() for i in range(stages.size()))

def test_quality_exchanges_half_of_the_texts_at_most(spark):
    """F op9: both halves' texts were exchanged, for the fit and for the threshold."""
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(f"{x:08x}" for x in rng.integers(0, 1 << 32, 2000))) for i in range(200)], "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    size = docs.agg(F.sum(F.length("text"))).first()[0]

    before, limit = exchanged(spark, "shuffleWriteBytes"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = quality.score_quality(docs, labels).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        docs.unpersist()
    assert len(rows) == 200 and exchanged(spark, "shuffleWriteBytes") - before < 0.7 * size
    # the same split and the same target as by an explicit choice of ids
    fit = {r.doc_id for r in quality.trusted_ids(labels).where(quality.in_fit(labels)).collect()}
    chosen = spark.createDataFrame([(i,) for i in sorted(fit)], "doc_id long")
    assert 0 < len(fit) < 67
    assert quality.fit_ratios(docs, quality.trusted_ids(labels), 64, quality.in_fit(labels)) == quality.fit_ratios(docs, chosen, 64)


# -- 10 ---------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "ü" * 100
    rows = [(5, "http://a/", big), (3, "http://b/", big), (9, "http://c/\r\nX: y", "x" * 99), (8, None, "x" * 99), (1, "u", None), (2, "u", ""), (4, "u", "z" * 300_000), (7, "u", big), (7, "u", big), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    where = f"file://{tmp_path}/w"
    archives = warc.write_archives(df, where)
    assert archives.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_archives(spark, where).collect()
    want = Counter((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    shared = [r for r in got if r.payload_bytes == len(big.encode())]
    assert sorted((r.record_type, r.page_id or 0, r.refers_to) for r in shared) == [("response", 3, None)] + [("revisit", i, 3) for i in (0, 5, 7, 7)]
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    assert {bytes(r.payload) for r in got if r.page_id == 3} == {big.encode()}
    assert warc.read_archives(spark, where, keep_payload=False).where("payload is not null").count() == 0


def member(**change):
    row = {"record_type": "response", "payload": b"abc" * 50000, "w_name": "a", "url": "u", "payload_digest": hashlib.sha256(b"abc" * 50000).hexdigest(), "payload_bytes": 150000, "page_id": 1, "refers_to": None} | change
    return warc.record(row)


def test_warc_reader_is_strict():
    data = member()
    assert [b for _, b in warc.read_records(data + data)] == [b"abc" * 50000] * 2
    with pytest.raises(warc.WarcError, match="digest"):
        list(warc.read_records(member(payload_digest="0" * 64)))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(data[:-20]))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(b"plain"))


def test_warc_empty(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, f"file://{tmp_path}/e")
    assert warc.read_archives(spark, f"file://{tmp_path}/e").count() == 0


# -- pipeline ---------------------------------------------------------------


def test_pipeline_decisions_take_effect(spark, tmp_path, library):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    en, de = "th er on an re he in".split(), "sch ung ein ver ü ä keit".split()
    rows, labels = [], []
    for i in range(240):
        t = ["".join(rng.choice(en if i % 2 else de, 3)) for _ in range(40)]
        if i % 6 == 0:
            t[5] = "zworthok"
        rows.append((i, " ".join(t), "en" if i % 2 else "de", f"s{i % 3}", 1))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(500, rows[1][1], "en", "s1", 1), (501, rows[1][1] + " end", "en", "s1", 1), (502, "1 2 3", "en", "s1", 1), (503, rows[1][1] + " z-worth-ok", "en", "s0", 1)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, f in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(f(spark, docs, str(tmp_path)).collect(), DOC)
        kept[name] = Counter(r.doc_id for r in docs.collect())
    assert set(kept["toxicity"]) == {i for i, *_ in rows if not (i < 240 and i % 6 == 0) and i != 503}
    assert set(kept["language_id"]) == set(kept["toxicity"]) - {502}
    assert set(kept["near_duplicates"]) == set(kept["language_id"]) - {500, 501}
    assert set(kept["mixing"]) <= set(kept["near_duplicates"]) and max(kept["mixing"].values()) <= 2
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in final) == kept["mixing"]
    text = {i: t for i, t, *_ in rows}
    assert all(r.n_tokens == len(library.encode(text[r.doc_id])) for r in final)


def test_quality_learns_from_all_trusted_rows(spark):
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_ids(labels).count() == 30_000
    for n in (1, 2, 10, 3000, 50_000):
        scores = spark.range(n).select(F.when(F.col("id") % 7 != 3, F.rand(n) - 0.5).alias("s"))
        for share in (0.0, 0.005, 0.5, 1.0):
            assert quality.exact_quantile(scores, "s", share) == pytest.approx(scores.agg(F.percentile("s", F.lit(share))).first()[0], abs=1e-12)
    assert quality.exact_quantile(scores.limit(0), "s", 0.5) is None
