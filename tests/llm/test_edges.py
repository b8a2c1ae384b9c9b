"""Edge cases: odd magnitudes, signs that are no letters, null ids, clashing columns, repeats, empty tables; and columns of the queries."""

import hashlib
from collections import Counter

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

from corpusmill.llm import graph, language, lattice, mixing, pieces, queries, warc


def test_vectors_of_any_magnitude(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=16)
    rows = [(1, (v * 1e-200).tolist(), "x"), (2, (v * 1e200).tolist(), "y"), (3, v.tolist(), "z"), (4, (-v).tolist(), "z"), (5, [0.0] * 15 + [-0.0], "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (0, 4, True), 5: (0, 5, True)}


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9501 meet in one of the tables; a miss in ten thousand is allowed."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    pair = 0.9501 * a + np.sqrt(1 - 0.9501**2) * b
    net = lattice.Lattice(64, 0.95, lattice.TABLES, lattice.PROBES)
    x, y = net.cells(a), net.cells(pair)
    met = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2))
    assert (~met).mean() <= 2e-4


def test_hub_and_chain(spark):
    edges = [(0, k) for k in range(1, 400)] + [(1000 + k, 1001 + k) for k in range(60)]
    got = {r.a: r.b for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 400)} | {1000 + k: 1000 for k in range(1, 61)}


def test_signs_of_numbers_are_no_letters(spark):
    rows = [(1, "½ ² ① Ⅷ", None), (2, "hello²world there", "en"), (3, "hello world there", "en"), (4, "hallo welt da ist", "de"), (5, "x" * 100_000, None), (5, "x" * 100_000, None), (None, "hello there", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(df, language.fit(df, holdout=0)).collect()
    assert [r.l_lang for r in found if r.doc_id == 1] == ["und"] and [r.l_lang for r in found if r.doc_id == 2] == ["en"]
    twice = [(r.l_lang, r.l_score) for r in found if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert language.words_of("a²b ½") == ["a", "b"]


def test_mixing_without_ids_and_of_many_parts(spark, monkeypatch):
    rows = [(None, "w " * (k % 9), "a") for k in range(40)] + [(k, "w " * 30, "b") for k in range(60)] + [(7, "w " * 30, "b")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def taken():
        return Counter((r.doc_id, r.m_size, r.source, r.m_copies) for r in mixing.mix(df).collect())

    one = taken()
    monkeypatch.setattr(mixing, "PART_ROWS", 4)
    assert taken() == one and sum(one.values()) == len(rows)


def test_pieces_of_odd_tables(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    long = "wort " * 30_000 + "x" * 5_000
    df = spark.createDataFrame([(1, long, "p"), (1, long, "q"), (None, None, "r")], "doc_id long, text string, n_tokens string")
    got = pieces.encode_digests(df).collect()
    ids = library.encode(long)
    assert [r.n_tokens for r in got] == [len(ids), len(ids), 0] and got[0].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert pieces.encode_digests(df.limit(0)).count() == 0


def test_warc_repeats_and_other_columns(spark, tmp_path):
    big = "p" * 500
    rows = [(7, "b", big, 1), (7, "a", big, 2), (7, "a", big, 3), (None, None, "", 4), (None, None, None, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload long")
    warc.write_archives(df, f"{tmp_path}/w")
    got = Counter((r.page_id, r.url, r.record_type, r.refers_to) for r in warc.read_archives(spark, f"{tmp_path}/w").collect())
    assert got == Counter({(7, "a", "response", None): 1, (7, "a", "revisit", 7): 1, (7, "b", "revisit", 7): 1, (None, "", "response", None): 2})


def test_columns_of_queries(spark):
    sf = "/root/testdata/sf0.001"
    want = {
        "op1_lattice_hashing": ["vec_id", "n_links", "component_id", "kept"], "op4_toxicity": ["doc_id", "held_out", "score", "predicted"], "op6_shard_documents": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op7_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    }
    for name, columns in want.items():
        out = queries.QUERIES[name](spark, sf)
        assert out.columns[: len(columns)] == columns
        if "held_out" in columns:
            assert out.where(F.col("held_out") != (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3 if name[2] == "4" else 5)) == (1 if name[2] == "4" else 0))).isEmpty()
            assert out.where("score < 0 or score > 1").isEmpty()


def test_pieces_of_new_chunks_are_not_taken_one_by_one(monkeypatch):
    """op7: each chunk that was not cached had its pieces spelled, measured and put into decimals one at a time."""
    codec, library = pieces.PieceCodec(pieces.model_path()), sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    slow = pieces.PieceCodec(pieces.model_path())
    # a user piece that no text has: every character by its own step
    slow.normalizer = pieces.Normalizer(None, slow.normalizer.dummy, False, slow.normalizer.escape, ("never in a text",))
    assert codec.normalizer.plain and not slow.normalizer.plain

    def stop(*args):
        raise AssertionError("a chunk was decoded by itself")

    monkeypatch.setattr(pieces.PieceCodec, "_decoded", stop)
    for t in ("a\nb", "漢字😀 x\n\n", "▁ ▁\n", "  \x00\U0010ffff é", "", "\n", "Wort\tWort <0x0A> ⁇", "😀"):
        ids, first, end, decoded, decimals = codec.whole(t)
        want = library.encode(t)
        assert ids.tolist() == want and decoded.decode() == (library.decode(want) if want else "") and decimals.decode() == ",".join(map(str, want))
        assert b"".join(t.encode()[a:b] for a, b in zip(first, end, strict=True)) == t.encode()
        assert all(np.array_equal(x, y) for x, y in zip(slow.arrays(t), (ids, first, end), strict=True))
        # a byte piece lies on its own byte
        assert all(t.encode()[a:b] == bytes([codec.byte[i]]) for i, a, b in zip(ids, first, end, strict=True) if codec.byte[i] >= 0)
    assert all(isinstance(x, bytes) for x in codec.cache.values())
