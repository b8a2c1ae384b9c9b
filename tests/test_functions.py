"""Text functions against plain Python written from their description."""

import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import clean, fixed, text, think
from corpusmill.operators import gates
from corpusmill.plans import scan


def values(spark, rows, **columns):
    """One row of results for each input row."""
    names = [f"c{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + ", ".join(f"{n} string" for n in names))
    return df.orderBy("k").select(*[f(*[F.col(n) for n in names]).alias(c) for c, f in columns.items()]).collect()


def test_blank_and_unicode_policy(spark):
    rows = [("　 a b\n",), ("\x1c x",), ("",)]
    assert [r.s for r in values(spark, rows, s=text.strip)] == ["a b", "x", ""]
    assert [r.s for r in values(spark, [("中文，A-b",)], s=lambda c: text.sub(c, r"[^\w\s]"))] == ["中文Ab"]


def test_numbers(spark):
    got = values(spark, [(" 88.9 ",), ("x",), (None,), ("inf",), ("-3.7",)], n=text.truncate_int)
    assert [r.n for r in got] == [88, 90, 90, 90, -3]


def python_repeats(t, chunk=50, threshold=0.8):
    if len(t) < 150:
        return False
    a, b = t[: len(t) // 2], t[len(t) // 2 :]
    pieces = [a[i : i + chunk] for i in range(0, len(a) - chunk, chunk // 2)]
    return bool(pieces) and sum(p in b for p in pieces) / len(pieces) > threshold


def test_repetition(spark):
    base = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(200))
    rows = [("a" * 149,), (base + base,), (base * 3,), (base,), ("ab" * 75,), ("",)]
    assert [r.r for r in values(spark, rows, r=text.repeats)] == [python_repeats(t) for (t,) in rows]


def test_similarity(spark):
    rows = [("a b c", "a b d"), ("", "a"), ("中文 ab。", "中文 cd"), ("A, a!", "a")]
    assert [round(r.s, 6) for r in values(spark, rows, s=text.similarity)] == [round(2 / 3, 6), 0.0, 0.5, 1.0]


def test_json_blocks(spark):
    rows = [('x {"a": [1]} y',), ('```json\n{"a": 1}\n```',), ("[1, 2] {",), ("none",), ("{bad",)]
    got = values(spark, rows, g=text.json_greedy, f=text.json_fenced, o=text.json_object, d=lambda c: text.json_or(c, "[]"))
    assert [r.g for r in got] == ['{"a": [1]}', '{"a": 1}', "[1, 2] {", "none", "{bad"]
    assert [r.f for r in got] == ['{"a": [1]}', '{"a": 1}', "[1, 2]", "none", "{bad"]
    assert [r.o for r in got] == ['{"a": [1]}', '{"a": 1}', None, None, None]
    assert got[3].d == "[]"


def test_think_rules_differ(spark):
    rows = [(" <think>a</think>b",), ("<think>a</think>x<think>c</think> d",), ("<think>open",), ("plain",)]
    got = values(spark, rows, s=think.split_strict, t=think.split_tight, n=lambda c: F.size(think.all_thinks(c)), f=think.body_after_first, l=think.body_after_last, w=think.body_without_thinks)
    assert [r.s.found for r in got] == [True, True, False, False]
    assert [r.t.found for r in got] == [False, True, False, False]
    assert [r.n for r in got] == [1, 2, 0, 0]
    assert [r.f for r in got] == ["b", "x<think>c</think> d", "<think>open", "plain"]
    assert [r.l for r in got] == ["b", " d", "<think>open", "plain"]
    assert [r.w for r in got] == ["b", "x d", "<think>open", "plain"]


@pytest.mark.parametrize(
    ("label", "ok"),
    [("示例视角1", False), ("提示：缺少医疗问题", False), ("You are a rigorous data processing API", False), ("成分构成", True), ("功效主治", True), ("药代动力学", True), ("", False), ("a", False), ("x" * 17, False), ("abcdefghi", False)],
)
def test_facet_gate(spark, label, ok):
    assert (values(spark, [(label,)], r=gates.facet_reason)[0].r == "") == ok


def test_facet_reasons_and_repeats(spark):
    assert [r.r for r in values(spark, [("",), ("a",), ("abcdefghi",)], r=gates.facet_reason)] == ["empty facet", "facet length must be 2-16 chars", "facet contains too much English text"]
    rows = spark.createDataFrame([(1, 0, "药理"), (1, 1, " 药理 "), (2, 0, "药理")], "rec int, pos int, label string")
    got = gates.sort_facets(rows, "rec", "label", "pos").orderBy("rec", "pos").collect()
    assert [r.reason for r in got] == ["", "duplicate facet", ""]


def test_answer_guard(spark):
    rows = [("抱歉", ""), ("推理链", ""), ("x", "y" * 119), ("x", "y" * 120), ("x", ""), ("x", "<think>" + "y" * 119 + "</think>")]
    got = [r.r for r in values(spark, rows, r=gates.answer_reason)]
    assert got == ["safety refusal", "prompt pollution", "lazy reasoning (too short: 119 chars)", "", "", "lazy reasoning (too short: 119 chars)"]


def test_rewrites_match_python(spark):
    samples = ["首先，药物其次，作用综上所述，好", "然而其次，药物", "x refs y", "根据refs显示", "证据refs中 《a》 PMID: 12", "我们需要从药理视角来看，这很好。从X角度分析，y（见？）", '{"step_id": 1, "logic": "a"} [b]']

    def ordered(t, rules):
        for p, flags, new in rules:
            t = re.sub(p, new, t, flags=(re.I if "i" in flags else 0) | (re.S if "s" in flags else 0))
        return t.strip()

    got = values(spark, [(s,) for s in samples], a=clean.strip_noise, b=clean.smooth_transitions, c=clean.scrub_leakage)
    assert [r.a for r in got] == [ordered(s, fixed.PRE_STRIP) for s in samples]
    assert [r.b for r in got] == [ordered(s, [(p, "i", n) for p, n in fixed.TRANSITIONS]) for s in samples]
    expected = [re.sub("\n{3,}", "\n\n", re.sub(r"[ \t]{2,}", " ", ordered(s, [(p, "i", "") for p in fixed.LEAKAGE]))).strip() for s in samples]
    assert [r.c for r in got] == [e if e == e.strip() else e.strip() for e in expected]


def test_clean_lines(spark):
    t = "保留一\r\n我们被要求输出\n{\n\n\n\n\nP1: 步骤\n保留二\x0b根据证据，直接提取\n"
    assert values(spark, [(t,)], c=clean.clean_lines)[0].c == "保留一\n\n保留二"


def test_identifiers(spark):
    t = "执行标准：YBH00012，批准文号XK2020001；完"
    rows = [(t, "见 YBH00012"), (t, ""), (t, "XK2020001"), ("ABCD123 与 XABCD1234", "XABCD1234"), ("ABCD999 与 XABCD9990", "XABCD9990 x")]
    got = [r.c for r in values(spark, rows, c=lambda a, b: clean.drop_unsupported(a, b))]
    assert got == ["执行标准：YBH00012，完", t, "，批准文号XK2020001；完", "ABCD123 与 XABCD1234", "ABCD999 与 XABCD9990"]


def test_helpers(spark):
    got = values(spark, [("a  b",)], p=lambda c: text.preview(c, 2), h=text.escape_html, s=lambda c: text.search_terms(F.lit("ab, c de!")), n=lambda c: text.int_list(F.lit("1, 2;x,3")), m=lambda c: text.mapping_key(c))[0]
    assert (got.p, got.h, got.s, got.n, got.m) == ("a ...", "a  b", ["ab", "de"], [1, 2, 3], "ab")
    html = '<html><title> T&amp; </title><meta name="description" content="D"><script>x</script><p>a<br>b</p>'
    got = values(spark, [(html,)], t=text.title, d=text.meta_description, v=text.strip_html, s=lambda c: text.snippet(c, F.lit("b"), 2))[0]
    assert (got.t, got.d, got.v, got.s) == ("T&amp;", "D", "T&amp; a b", "a b")


def test_judge_defaults(spark):
    rows = [('{"semantic_purity_score": "88.9", "logical_coherence_score": 70}',), ("oops",)]
    a, b = (r.s for r in values(spark, rows, s=gates.judge_scores))
    assert (a.purity, a.rigor, a.depth) == (88, 90, 90)
    assert (b.purity, b.rigor, b.depth, b.reason) == (0, 0, 0, "Evaluation error")


def test_safe_facets(spark):
    rows = [("有何不良反应", "分子机制"), ("成分是什么", "示例视角"), ("x", "JSON schema"), ("x", "y")]
    assert [r.f for r in values(spark, rows, f=gates.safe_facet)] == ["不良反应机制边界", "成分构成", "临床事实核验", ""]
    got = values(spark, [("有何不良反应", "分子机制")], one=lambda q, f: gates.downgrade_skip(q, f, F.lit(1)), two=lambda q, f: gates.downgrade_skip(q, f, F.lit(2)))[0]
    assert got.one.downgrade and not got.two.downgrade


def test_washed_answers_by_python(spark):
    """The query's ordered rewrites with the fixed values, said with Python's own patterns over whole texts."""
    import hashlib
    import os
    import re

    import pyarrow.parquet as pq

    from corpusmill.functions import fixed
    from corpusmill.plans.text_queries import QUERIES

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no driver tables")
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    got = {r.doc_id: r for r in QUERIES["washed_answers"](spark, sf).collect()}
    assert set(got) == set(docs)
    for k, text in docs.items():
        t = "首先，根据参考资料显示图谱关系，其次" + text + "综上所述，refs《实体库:x》锚点（见？）"
        a = b = c = t
        for p, new in fixed.TRANSITIONS:
            a = re.sub(p, new, a, flags=re.IGNORECASE)
        for p in fixed.LEAKAGE:
            b = re.sub(p, "", b, flags=re.IGNORECASE)
        b = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]{2,}", " ", b)).strip()
        for old, new in fixed.WASH:
            c = c.replace(old, new)
        d = re.sub(fixed.DRAFT_TAIL, "", t.strip())
        for p in fixed.META_OPENINGS:
            d = re.sub(p, "", d).strip()
        d = re.sub(fixed.FACET_PHRASE, "", d, flags=re.IGNORECASE).strip()
        d = re.sub(f"^[{fixed.OPENING_PUNCTUATION}]", "", d).strip()
        collapsed = any(x in t for x in fixed.COLLAPSE_LITERALS) or any(re.search(p, t) for p in fixed.COLLAPSE_PATTERNS)
        r = got[k]
        assert (r.a_md5, r.b_md5, r.c_md5, r.d_md5, r.collapsed) == (md5(a.strip()), md5(b), md5(c), md5(d), collapsed), k


def test_numbers_and_blanks_of_any_length(spark):
    """Numbers beyond every integer type, and long runs of blanks in time."""
    import time

    long = "9" * 50
    rows = [(f"{long} 501 499 0{'0' * 45}7 {long}% 2024",)]
    assert values(spark, rows, n=lambda c: scan.unsupported_numbers(c, F.lit("")))[0].n == ["501", long]
    got = [r.n for r in values(spark, [("1e12",), ("-3.9",), ("inf",), ("1e300",), (None,)], n=text.truncate_int)]
    assert got == [10**12, -3, 90, 9223372036854775807, 90]
    assert values(spark, [(f"1,{long},7x",)], n=text.int_list)[0].n == [1, 7]
    blanks = "a" + " " * 100_000 + "b" + "\u3000" * 100_000
    values(spark, [("a ",)], n=text.strip)
    began = time.time()
    assert len(values(spark, [(blanks,)], n=text.strip)[0].n) == 100_002
    assert time.time() - began < 5
    twice = "word " * 20_000
    began = time.time()
    assert values(spark, [(twice,)], n=text.repeats)[0].n is True and time.time() - began < 10


def test_codes_of_long_keys(spark, tmp_path):
    from corpusmill.plans.text_queries import QUERIES

    spark.createDataFrame([(123457, "n"), (7, "n")], "p_partkey bigint, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r.strict for r in QUERIES["identifier_evidence_filter"](spark, str(tmp_path)).collect()}
    assert "YB12345，" in got[123457] and "YB00007，" in got[7]


def test_words_that_a_pattern_needs():
    from corpusmill.functions import fixed, text

    assert [text.needed(p) for p in ("没有(直接)?(提到|提供).*机制", "从.*?视角，", "a|首先", "首先要?(其次)?", "[首先]+", "实?", r"\brefs\b")] == ["没有", "视角", None, "首先", None, None, None]
    assert text.lean(r"(?:\b|^)首先[，,\s]*", "i") == r"(?Ud)(?=首先)(?:\b|^)首先[，,\s]*" and text.lean(r"\brefs\b", "i").startswith("(?Udi)(?=r)")
    assert text.lean(fixed.WASH[0][0], "i") == text.rx(fixed.WASH[0][0])


def test_lean_rules_give_what_plain_ones_give(spark):
    import random

    from pyspark.sql import functions as F

    from corpusmill.functions import clean, fixed, text

    rng = random.Random(4)
    bits = ["首先", "首先要明确", "其次，", "第三", "refs", " RAG ", "《实体库:x》", "实体库中", "综上所述", "（见？）", "根据参考资料显示", "a", " ", "\n", "，", "从某视角来看", "最终结论是", "因此", "　"]
    df = spark.createDataFrame([("".join(rng.choices(bits, k=rng.randint(0, 14))),) for _ in range(300)] + [(None,)], "t string")
    t = F.col("t")
    rules = [(p, "i", r) for p, r in fixed.TRANSITIONS] + [(p, "i", "") for p in fixed.LEAKAGE]
    plain = t
    for p, f, r in rules:
        plain = F.regexp_replace(plain, text.rx(p, f), text.replacement(r))
    assert df.where(~clean.rewrite(t, rules).eqNullSafe(plain)).isEmpty()
    assert df.where(~text.strip(t).eqNullSafe(F.trim(t, F.lit(text.BLANKS)))).isEmpty()
    for p in (*fixed.COLLAPSE_PATTERNS, *fixed.STRUGGLES):
        assert df.where(~text.has(t, p).eqNullSafe(t.rlike(text.rx(p)))).isEmpty()


def test_small_files_are_dealt_to_all_cores(spark):
    from corpusmill.plans.rule_queries import QUERIES

    for name in ("plan_violations", "shortened_evidence", "judge_parsing"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
