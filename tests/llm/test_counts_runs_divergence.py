"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from corpusmill.llm import counting, divergence, periods

SEPARATORS = " \t\n\x0b\x0c\r"


def split(text):
    """Words by one look at each character."""
    words, word = [], ""
    for c in text or "":
        if c in SEPARATORS:
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return words + [word] * bool(word)


# -- 11 ---------------------------------------------------------------------

TEXTS = ["", None, "hello there", "hello there", "  <|endoftext|> ends", "tab\tnew\nline", "x" * 20_000, "日本語 ½ é́ \U0001f600", "word " * 5_000, "Hello THERE"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k if k != 4 else None, t, f"u{k}", k) for k, t in enumerate(TEXTS)] + [(0, "hello there", "u0", 0)] * 30
    return spark.createDataFrame(rows, "doc_id long, text string, t_digest string, n_tokens long").repartition(4)


def cache_rows(spark, cache):
    return spark.read.parquet(cache).count()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, texts, tmp_path, name):
    path, cache = counting.installed(name), f"file://{tmp_path}/cache"
    if name.endswith("json"):
        own = tokenizers.Tokenizer.from_file(path)
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    else:
        own = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(own.encode(t))
    out = counting.count_tokens(texts, path, cache)
    assert out.columns == ["doc_id", "t_digest", "n_bytes", "n_tokens"]
    got = Counter((r.doc_id, r.t_digest, r.n_bytes, r.n_tokens) for r in out.collect())
    want = Counter((r.doc_id, r.t_digest, len((r.text or "").encode()), count(r.text or "")) for r in texts.collect())
    assert got == want
    # one row for each content; the lower-casing tokenizer does not tell two of them apart
    contents = len({t or "" for t in TEXTS}) - (name == "word_bpe_49k.json")
    assert cache_rows(spark, cache) == contents


def test_only_misses_are_encoded(spark, texts, tmp_path, monkeypatch):
    path, cache = counting.installed("byte_bpe_50k.json"), f"file://{tmp_path}/cache"
    first = sorted(map(tuple, counting.count_tokens(texts, path, cache).select("n_bytes", "n_tokens").collect()))
    held = cache_rows(spark, cache)
    # a cached count is believed: nothing is encoded again
    monkeypatch.setattr(counting, "_encoded", lambda path: pytest.fail("nothing is missing"))
    assert sorted(map(tuple, counting.count_tokens(texts, path, cache).select("n_bytes", "n_tokens").collect())) == first
    monkeypatch.undo()
    more = texts.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "something new"), (98, "something new")], "doc_id long, text string"))
    # by a shuffle, as where many are missing
    monkeypatch.setattr(counting, "SENT_DIGESTS", 0)
    assert counting.count_tokens(more, path, cache).count() == texts.count() + 2
    assert cache_rows(spark, cache) == held + 1
    # an append that ran twice does not double rows
    spark.read.parquet(cache).drop("version").write.mode("append").parquet(f"{cache}/version={counting.Tokenizer(path).version()}")
    assert counting.count_tokens(more, path, cache).count() == texts.count() + 2


def test_versions_do_not_share_counts(spark, texts, tmp_path):
    cache = f"file://{tmp_path}/cache"
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        counting.count_tokens(texts, counting.installed(name), cache).count()
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    with pytest.raises(ValueError):
        counting.Tokenizer("vocabulary.txt")


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert counting.count_tokens(none, counting.installed("byte_bpe_50k.json"), f"file://{tmp_path}/c").count() == 0
    assert periods.find_runs(none).count() == 0
    assert divergence.audit(none).count() == 0


def test_op11(spark):
    sf = "/root/testdata/sf0.001"
    own = tokenizers.Tokenizer.from_file(counting.installed("byte_bpe_50k.json"))
    want = sorted((r.doc_id, len((r.text or "").encode()), n := len(own.encode(r.text or "", add_special_tokens=False).ids), n > 512) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, counting.op11_token_counts(spark, sf).collect())) == want


# -- 12 ---------------------------------------------------------------------


def brute_runs(words, least=12):
    """Every (start, length, period) by comparing words period by period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q):
                stretch = words[i : i + length]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in drop)


def test_runs_by_brute_force():
    rng = random.Random(3)
    fibonacci = [["a"], ["a", "b"]]
    while len(fibonacci[-1]) < 200:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    slices = [[fibonacci[-1], ["a"] * 300, list("ab") * 100, []]]
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, letters = rng.choice([0, 1, 5, 30, 80, 150]), rng.choice([1, 2, 3, 5, 50])
            w = [chr(97 + rng.randrange(letters)) for _ in range(n)]
            if rng.random() < 0.7 and n > 5:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 2))
                w = w[:a] + (w[a : a + p] * n)[: n - a]
            texts.append(w + w[: n // 2] + w if rng.random() < 0.3 else w)
        slices.append(texts)
    for texts in slices:
        for least in (2, 12):
            got = periods.runs_of([[x.encode() for x in t] for t in texts], least)
            assert got == [brute_runs(t, least) for t in texts]


def test_find_runs_of_odd_rows(spark):
    line = "one two three four five "
    rows = [(1, None, "x", 1), (None, "", "y", 2), (2, " \t\n", "z", 3), (3, line * 3, "a", 4), (3, line * 3, "a", 4), (4, "v " * 60_000, "b", 5), (5, "a\x1cb c\xa0d", "c", 6), (6, "a " * 11, "d", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, r_key string, r_runs long").repartition(3)
    out = periods.find_runs(df)
    assert out.columns == ["doc_id", "r_key", "r_words", "r_runs", "r_collapsed"]
    got = sorted(((r.r_key, r.r_words, [tuple(x) for x in r.r_runs], r.r_collapsed) for r in out.collect()), key=str)
    assert got == sorted([
        ("x", 0, [], ""), ("y", 0, [], ""), ("z", 0, [], ""), ("a", 15, [(0, 15, 5)], line.strip()), ("a", 15, [(0, 15, 5)], line.strip()),
        ("b", 60_000, [(0, 60_000, 1)], "v"), ("c", 2, [], "a\x1cb c\xa0d"), ("d", 11, [], " ".join("a" * 11)),
    ], key=str)


def test_op12(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = split(r.text)
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        start, length, period = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want[r.doc_id] = (len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in periods.op12_periodic_runs(spark, sf).collect()}
    assert got == want and any(w[0] for w in want.values())


# -- 13 ---------------------------------------------------------------------


def brute_audit(rows, least, top):
    n, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        folded = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text or "")
        terms = [t for t in folded.split(" ") if t]
        groups.add((lang, source))
        n[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in in_docs[lang].items() if k >= least]
        sources = [g for g in groups if g[0] == lang]

        def frequency(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = frequency(sum((n[g] for g in sources), Counter()))
        p = {g: frequency(n[g]) for g in sources}
        for g in sources:
            pair = [(sum(abs(p[g][t] - p[o][t]) for t in kept), o[1]) for o in sources if o != g]
            term = [(p[g][t] - q[t], t) for t in kept if n[g][t] and p[g][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((*g, part, item, value, rank))
    return out


def test_audit_by_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    words = ["the", "The", "naïve", "naı", "日本", "日", "ab", "abc", "abcd", "abce", "zz", "\U0001f600x", "it's", "x1y", *(a + b + "tail" * 9 for a in "pqr" for b in "stu")]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None, "é"])) for _ in range(400)]
    rows += [(None, "en", "silent"), ("", "en", "silent"), ("only here", "fr", "a"), (None, "fr", "b"), ("lone", "it", "a"), ("the " * 4000, "en", "a")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, p long, term string").repartition(5)
    assert {tuple(r) for r in divergence.audit(docs, 5, 4).collect()} == brute_audit(rows, 5, 4)
    # many units, blocks and flushes
    for name, value in (("UNIT_TERMS", 3), ("BLOCK_SOURCES", 2), ("HELD", 5)):
        monkeypatch.setattr(divergence, name, value)
    assert {tuple(r) for r in divergence.audit(docs, 5, 4).collect()} == brute_audit(rows, 5, 4)


def test_select_top_with_ties(spark):
    rng = random.Random(9)
    rows = [("big", rng.choice([7, 7, 7, 1 << 29, 3]), "t" * (k % 40) + chr(97 + k % 26) + str(k)) for k in range(500)]
    rows += [("same", 5, "prefix" * 10 + str(k)) for k in range(60)] + [("few", 9, "a"), ("few", 0, "b")] + [("exact", 1, x) for x in "abcd"] + [("nested", 2, "a" * k) for k in range(12)]
    df = spark.createDataFrame(rows, "g string, v long, i string").repartition(4)
    got = {tuple(r) for r in divergence.select_top(df, ["g"], "v", "i", 4).collect()}
    want = {r for g in ("big", "same", "few", "exact", "nested") for r in sorted((x for x in rows if x[0] == g), key=lambda x: (-x[1], x[2].encode()))[:4]}
    assert got == want


def test_columns_of_the_queries(spark):
    sf = "/root/testdata/sf0.001"
    want = {
        counting.op11_token_counts: "doc_id:bigint,n_bytes:bigint,n_tokens:bigint,over_limit:boolean",
        periods.op12_periodic_runs: "doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string",
        divergence.op13_source_divergence: "lang:string,source:string,part:string,item:string,value:bigint,rank:int",
    }
    for query, columns in want.items():
        out = query(spark, sf)
        assert ",".join(f"{n}:{t}" for n, t in out.dtypes) == columns
    digests = periods.op12_periodic_runs(spark, sf).where(F.col("runs_sha256").isNull() | F.col("collapsed_sha256").isNull())
    assert digests.isEmpty()
