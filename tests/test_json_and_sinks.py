"""JSON as Python reads and writes it, files in a given order, lines that a text lost, sums over skewed keys."""

import datetime
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import clean, fixed, text
from corpusmill.operators import gates, linkage, ordering
from corpusmill.plans import scan
from corpusmill.sources import jsonl, ordered, reports

ODD = [
    '{"Q":"a"} tail', "{'Q':'a'}", '{"a": NaN}', '{"a": -Infinity, "b": "NaN \\" Infinity"}', '{"a": Infinityx}', '{"a": -NaN}', '{"a":1} {"b":2}', '{"a":1}}', '{"a":1}] }', "[1,2]", "1", "1,2", '"x"', "", " ", "null",
    '{"a":1,}', '{"a":01}', '{"a":"x\ty"}', '{"a":"x\\ty"}', '{"a":1,"a":2}', '\n {"a" : "it\'s"} \r\n', '{"a":"\\u00e9\\ud83d\\ude00"}', '{"a":"\\\\", "b":\'c\'}', '{"a":"\\\\\\"\'"}', "{", '{"a":tru}', '{"a":true}', "{}",
    '　{"a":1}', '{"a":1} ', '{"a":"\x02"}', "NaN", "-Infinity", "['a']", '{"a":[1,{"b":[]}]}', '{"a":1e400}', '{"a":-0.5E+3}', '{"a":.5}', "nan", '{"NaN":NaN}', "[NaN,NaN]", '"NaN"NaN', '{"a":"b"NaN}',
]


def python_reads(t):
    try:
        json.loads(t)
        return True
    except ValueError:
        return False


def test_strict_json_is_pythons(spark):
    rng = random.Random(4)
    alphabet = ['"', "'", "\\", "{", "}", "[", "]", ":", ",", "1", "NaN", "a", " ", "null", '"k"', "\n", "-", "Infinity"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.strict_json(F.col("t")).alias("s"), text.strict_object(F.col("t")).alias("o")).collect()
    for r in got:
        assert (r.s is not None) == python_reads(r.t), r.t
        assert (r.o is not None) == (python_reads(r.t) and isinstance(json.loads(r.t), dict)), r.t
        if r.s is not None:
            plain = json.loads(r.t, parse_constant=lambda _: None)
            assert json.loads(r.s) == plain
    assert df.limit(0).select(text.strict_json(F.col("t"))).count() == 0
    assert spark.createDataFrame([(None,)], "t string").select(text.strict_json(F.col("t")).alias("s")).first().s is None


def test_lines_are_parsed_as_python_does(spark, tmp_path):
    lines = ["\t", "　", "", '{"Q":"a"} tail', "{'Q':'a'}", '{"Q":"a","x":NaN}', '{"Q":"b","refs":null}', '[{"Q":"a"}]', " {\"Q\":\"it's\"} "]
    (tmp_path / "l.jsonl").write_text("\n".join(lines) + "\n")
    got = {r.line_num: (r.parse_status, r.q, r.has_refs_key) for r in jsonl.parsed(jsonl.numbered_lines(spark, str(tmp_path / "l.jsonl"))).collect()}
    assert got == {1: ("blank", None, False), 2: ("blank", None, False), 3: ("blank", None, False), 4: ("error", None, False), 5: ("error", None, False), 6: ("ok", "a", False), 7: ("ok", "b", True), 8: ("error", None, False), 9: ("ok", "it's", False)}
    own = spark.createDataFrame([(1, '{"Q":"a"}', "mine")], "line_num long, raw string, s_whole string")
    assert jsonl.parsed(own).first().s_whole == "mine"


def test_judges_fail_closed(spark):
    cases = {
        '{"semantic_purity_score":"95"} {"b":1}': (0, 0, 0), '{"semantic_purity_score":95} trailing': (95, 90, 90), "{'semantic_purity_score':95}": (0, 0, 0),
        '{"semantic_purity_score":95,"logical_coherence_score":10}': (95, 90, 90), "": (0, 0, 0), "[95]": (0, 0, 0),
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    got = {r.a: (r.s.purity, r.s.rigor, r.s.depth) for r in df.select("a", gates.judge_scores(F.col("a")).alias("s")).collect()}
    assert got == cases
    audits = spark.createDataFrame([('{"verdict":"KEEP"} {"verdict":"KEEP"}',), ('[{"verdict":"KEEP"}]',), ('x {"verdict":"KEEP"} y',)], "a string")
    assert [r.r.audit_status for r in audits.select(gates.audit_result(F.col("a")).alias("r")).collect()] == ["PARSE_ERROR", "OK", "OK"]


def test_json_is_written_as_python_does(spark):
    values = ["".join(map(chr, range(128))), 'a"b\\c/', " é\U0001f600\x7f", "", None, "\\u001F", "\x1f\\u001F"]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v string")
    got = {r.k: r.j for r in df.select("k", text.python_json({"v": F.col("v"), "k": F.col("k")}).alias("j")).collect()}
    assert got == {k: json.dumps({"v": v, "k": k}, ensure_ascii=False, sort_keys=True) for k, v in enumerate(values)}


def test_array_sinks_with_equal_null_and_other_keys(spark, tmp_path):
    at = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    rows = [(None, at, "x\x1f\"", 1), (None, None, "x\x1f\"", 1), (1, at, "b", None), (1, at, "b", None), (0, None, None, 3)]
    df = spark.createDataFrame(rows, "k long, t timestamp, v string, n long").repartition(3)
    want = [{"v": r[2], "n": r[3]} for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None))]
    jsonl.write_json_array(df, str(tmp_path / "parts"), "k", "t")
    joined = "".join(p.read_text() for p in sorted((tmp_path / "parts").glob("part-*.txt")))
    assert json.loads(joined) == want
    for order in (("k", "t"), ("k",)):
        jsonl.write_array_file(df.select("k", "t", "v", "n") if order[1:] else df.drop("t"), str(tmp_path / "one.json"), *order)
        assert (tmp_path / "one.json").read_text() == json.dumps(want, ensure_ascii=False, indent=2)
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["one.json"] or {p.name for p in tmp_path.iterdir()} >= {"one.json", "parts"}
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".one.json-")]
    jsonl.write_array_file(df.limit(0), str(tmp_path / "one.json"), "k", "t")
    assert (tmp_path / "one.json").read_text() == "[]"


def test_one_file_in_order_and_after_a_failed_job(spark, tmp_path):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.format_string("line %d é", "id").alias("raw")).repartition(7)
    target = str(tmp_path / "lines.txt")
    ordered.write_one_file(df, target, F.desc("k"))
    assert (tmp_path / "lines.txt").read_text() == "\n".join(f"line {k} é" for k in range(19_999, -1, -1)) + "\n"
    broken = df.withColumn("raw", F.when(F.col("k") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("raw")))
    with pytest.raises(Exception, match="no"):
        ordered.write_one_file(broken, target, "k")
    assert (tmp_path / "lines.txt").read_text().startswith("line 19999")


def test_removed_lines(spark):
    rng = random.Random(2)
    cases = [("a\nb\n a\n\nc\nb", "c\n x"), ("", "a"), ("a", ""), ("a\na", "a"), ("a\n\n", ""), (None, "a"), ("a\nb", None)]
    cases += [("\n".join(rng.choices("abcde ", k=rng.randint(0, 12))), "\n".join(rng.choices("abc ", k=rng.randint(0, 4)))) for _ in range(60)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k long, b string, a string")
    for r in df.select("*", clean.removed_lines(F.col("b"), F.col("a")).alias("r")).collect():
        if r.b is None:
            assert r.r is None
            continue
        kept = {x.strip() for x in (r.a or "").split("\n")}
        assert r.r == [x.strip() for x in r.b.split("\n") if x.strip() and x.strip() not in kept], (r.b, r.a)
    long = spark.createDataFrame([("\n".join(f"l{i % 70_000}" for i in range(100_000)), "\n".join(f"l{i}" for i in range(0, 70_000, 2)))], "b string, a string")
    began = time.time()
    got = long.select(F.size(clean.removed_lines(F.col("b"), F.col("a"))).alias("n")).first().n
    assert got == 50_000 and time.time() - began < 15


def test_running_sums_over_a_key_with_most_rows(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", None, "b"]), rng.randint(0, 10**9), rng.randint(0, 5)) for _ in range(3000)]
    rows = list({(k, o): (k, o, v) for k, o, v in rows}.values())
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(9)
    got = {(r.k, r.o): (r.total, r.whole) for r in ordering.running(df, ["k"], ["o"], F.col("v"), "total", "whole").collect()}
    for key in ("hot", "a", None, "b"):
        mine, total = sorted(r[1:] for r in rows if r[0] == key), 0
        for o, v in mine:
            total += v
            assert got[key, o] == (total, sum(v for _, v in mine))
    assert len(got) == len(rows)
    assert ordering.placed(df.limit(0), ["k"], ["o"], "n").count() == 0
    numbered = ordering.numbered_versions(df, "k", ["o"]).where("is_active = 1").select("k", "version").collect()
    assert {r.k: r.version for r in numbered} == {key: sum(r[0] == key for r in rows) for key in ("hot", "a", None, "b")}


def test_containing_is_the_nested_loop(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcé\n ", k=rng.randint(0, 40))) for _ in range(200)] + [None, "", "x" * 3000 + "needle in it"]
    terms = ["", "a", "ab", "é\n", "abcab", "abcabca", "needle in it", "nowhere at all", None, "x" * 50, "\U0001f600", "ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    asked = spark.createDataFrame(list(enumerate(terms)), "n long, w string")
    got = sorted((r.k, r.n) for r in linkage.containing(rows, asked, "t", "w").collect())
    assert got == sorted((k, n) for k, t in enumerate(texts) for n, w in enumerate(terms) if t is not None and w is not None and w in t)
    assert linkage.containing(rows, asked.limit(0), "t", "w").columns == ["k", "t", "n", "w"]
    assert linkage.containing(rows.limit(0), asked, "t", "w").count() == 0


def test_log_signatures_by_default(spark):
    logs = spark.createDataFrame([("a", "x 触发高可用防拒答与去污染兜底方案 y"), ("b", "nothing")], "file string, value string")
    got = sorted((r.file, r.signature) for r in scan.logged(logs).collect())
    assert got == sorted(("a", s) for s in fixed.LOG_FALLBACKS if s in "触发高可用防拒答与去污染兜底方案")
    assert ("a", fixed.LOG_FALLBACKS[-1]) in got


def test_current_against_raw(spark):
    issue = "line_num long, planner string, issue_type string, severity string, detail string, rank int"
    mine = spark.createDataFrame([(2, "p", "A", "HIGH", "", 1), (1, "p", "B", "LOW", "", 3), (9, "p", "C", "CRITICAL", "", 0), (1, "p", "A", "HIGH", "", 1)], issue)
    raw = spark.createDataFrame([(5, "p", "A", "HIGH", "", 1), (4, "p", "B", "LOW", "", 3)], issue)
    out = scan.scan_report(mine, raw)
    assert {(r.corpus, r.issue_type, r.n) for r in out["counts"].collect()} == {("current", "A", 2), ("current", "B", 1), ("current", "C", 1), ("raw", "A", 1), ("raw", "B", 1)}
    assert sorted((r.corpus, r.place, r.line_num) for r in out["listed"].collect()) == [("current", 1, 9), ("current", 2, 1), ("current", 3, 2), ("current", 4, 1), ("raw", 1, 5)]


def test_reports_and_logs(spark, tmp_path):
    (tmp_path / "run_[1-2]_20260101_120000.md").write_text("数据集第 9 行 x 数据集第 4 行")
    (tmp_path / "other.md").write_text("数据集第 7 行")
    got = {r.file: (r.first_line, r.last_line, r.new_name) for r in reports.logged_ranges(reports.logged_lines(spark, str(tmp_path / "*.md"))).collect()}
    assert got == {"run_[1-2]_20260101_120000.md": (4, 9, "run_[4-9]_20260101_120000.md"), "other.md": (7, 7, "other_[7-7].md")}
    diffs = spark.createDataFrame([(3, "b", "o", "p"), (3, "a", "o", "p"), (1, "c", "o", "p")], "line_number long, facet string, original string, purified string")
    rows = spark.createDataFrame([(1, "success", None), (3, "success", None), (2, "rollback", "why"), (9, "skipped_no_think", None), (8, "skipped", None)], "line_num long, run_status string, reason string")
    reports.write_report(reports.run_report(diffs, rows), str(tmp_path / "report.txt"))
    lines = [x for x in (tmp_path / "report.txt").read_text().split("\n") if x]
    assert lines[:7] == ["# Purification run", "- lines purified: 2", "- facets purified: 3", "- success: 2", "- rollback: 1", "- skipped: 2", "- line 2, rollback: why"]
    assert [x for x in lines if x.startswith("#")][1:] == ["## line 1", "### c", "## line 3", "### a", "### b"]
    log = spark.createDataFrame([("t", 1)], "task_id string, round int")
    assert reports.append_events(log, str(tmp_path / "log")) and reports.append_events(log, str(tmp_path / "log"))
    assert sorted(json.loads(r.value)["task_id"] for r in spark.read.text(str(tmp_path / "log")).collect()) == ["t", "t"]
    with pytest.warns(UserWarning):
        assert not reports.append_events(log, "nowhere://x/y")
    dim = "array<struct<label:string,score:double,reason:string>>"
    audit = spark.createDataFrame([("t", "rejected", "q", 5.5, True, 2, [("l", 3.0, "r")], [(1, "f", "failed")])], f"task_id string, status string, query string, avg_score double, refusal_avoided boolean, refs_count int, failed_dimensions {dim}, facet_diagnostics array<struct<index:int,facet:string,status:string>>")
    for _ in range(2):
        reports.append_rejections(audit, str(tmp_path / "rej"))
    assert [json.loads(r.value)["query"] for r in spark.read.text(str(tmp_path / "rej/generation_rejections.jsonl")).collect()] == ["q", "q"]
    assert spark.read.text(str(tmp_path / "rej/generation_rejections.md")).where("value = '- l: 3.0, r'").count() == 2


def test_stricter_gate_of_collapsed_texts(spark):
    cases = {"现有资料未提供": (False, True), "看 refs 吧": (False, True), "prefs": (False, False), "我的推理链": (False, True), "从患者视角来说，好": (True, False), "根据资料显示": (True, True), "a [b": (True, True), "平稳": (False, False), "": (False, False)}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: (r.a, r.b) for r in df.select("t", clean.collapsed(F.col("t")).alias("a"), clean.collapsed_strictly(F.col("t")).alias("b")).collect()}
    assert got == cases


def test_noise_tells_its_planner(spark):
    planners = "array<struct<planner:string,answer:string>>"
    refs = "array<struct<source:string,context:string>>"
    own = [("a", "<think>干净</think>x"), ("b", "<think>我们被要求输出 JSON</think>y")]
    df = spark.createDataFrame([(1, own, None, False, False, own, None, False, False)], f"line_num long, planners {planners}, refs {refs}, has_refs_key boolean, has_history_key boolean, raw_planners {planners}, raw_refs {refs}, raw_has_refs_key boolean, raw_has_history_key boolean")
    r = scan.structural_audit(df).first()
    assert r.noisy_planners == 1 and [(n.planner_index, n.planner, n.traces) for n in r.noise] == [(1, "b", ["被要求", "JSON/Schema"])]


def test_containing_by_blocks_and_by_stretches(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choices("abc é\U0001f600", k=rng.randint(0, 400))) for _ in range(60)]
    long_ = [t[a : a + n] for t in texts if len(t) > 200 for a, n in ((rng.randint(0, 60), rng.choice((31, 47, 63, 64, 120))),)]
    short = ["".join(rng.choices("abc ", k=rng.randint(1, 8))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    for terms in (long_ + short, long_ + short[:5], short, long_):
        asked = spark.createDataFrame(list(enumerate(terms)), "n long, w string")
        got = sorted((r.k, r.n) for r in linkage.containing(rows, asked, "t", "w").collect())
        assert got == sorted((k, n) for k, t in enumerate(texts) for n, w in enumerate(terms) if w in t)
