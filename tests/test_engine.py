"""Sources, joins, roll-ups, model boundary, pipelines and the stream, on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import boundary, gates, linkage, ordering, rollup
from corpusmill.plans import pipelines, purify, scan
from corpusmill.sources import jsonl, reports
from corpusmill.streaming import cursor


def record(q, answers, **more):
    return json.dumps({"Q": q, "planners": [{"planner": f"p{i}", "answer": a} for i, a in enumerate(answers)], "summary": "s"} | more, ensure_ascii=False)


@pytest.fixture
def corpus(tmp_path):
    lines = [record("q1", ["<think>a</think>b"], refs=None), "", "{bad", record("q4", [], history=[]), record("q5", ["<think>c</think>d", "e"])]
    (tmp_path / "c.jsonl").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "c.jsonl")


def test_jsonl_keeps_places(spark, corpus):
    rows = jsonl.read_records(spark, corpus).orderBy("line_num").collect()
    assert [(r.line_num, r.parse_status) for r in rows] == [(1, "ok"), (2, "blank"), (3, "error"), (4, "ok"), (5, "ok")]
    assert [(r.has_refs_key, r.has_history_key) for r in rows] == [(True, False), (False, False), (False, False), (False, True), (False, False)]
    assert jsonl.count_lines(spark, corpus) == 5 and jsonl.count_lines(spark, corpus + "x") == 0
    assert jsonl.exploded(jsonl.read_records(spark, corpus, 5, 5)).count() == 2


def test_lines_of_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("\n".join(f"{i}" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = jsonl.numbered_lines(spark, str(tmp_path / "big.txt"))
        assert rows.where(F.col("line_num") != F.col("raw").cast("bigint")).isEmpty() and rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_append_guard(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    rows = spark.createDataFrame([("x", "X"), ("y", "Y")], "c string, r string")
    assert jsonl.append_both(spark, rows, a, b, F.col("c"), F.col("r")) == 2
    assert jsonl.append_both(spark, rows, a, b, F.col("c"), F.col("r")) == 2
    assert jsonl.count_lines(spark, a) == jsonl.count_lines(spark, b) == 4
    rows.select("c").write.mode("append").text(a)
    with pytest.raises(ValueError, match="lines and"):
        jsonl.append_both(spark, rows, a, b, F.col("c"), F.col("r"))
    with pytest.raises(ValueError, match="missing"):
        jsonl.append_both(spark, rows, a, str(tmp_path / "none"), F.col("c"), F.col("r"))
    with pytest.raises(ValueError, match="overwrite"):
        jsonl.guard("file:///d/in/x", "/d/in")


def test_linkage_rules(spark):
    cur = spark.createDataFrame([(1, "a b"), (2, "m"), (3, "dup"), (4, "none"), (5, "")], "line_num bigint, q string")
    raw = spark.createDataFrame([(1, "ab"), (9, "m"), (7, "dup"), (8, "dup"), (5, "")], "line_num bigint, q string")
    got = {r.line_num: (r.mapping_status, r.raw_line) for r in linkage.link_records(cur, raw).collect()}
    assert got == {1: ("SAME_LINE_Q_MATCH", 1), 2: ("MAPPED_BY_Q", 9), 3: ("AMBIGUOUS_Q", None), 4: ("NO_RAW_MATCH", None), 5: ("SAME_LINE_Q_MATCH", 5)}


def test_row_outcomes_and_cursor(spark):
    rows = spark.createDataFrame([(1, "success"), (1, "failed"), (1, "success"), (2, "success"), (2, "pruned"), (3, "pruned"), (4, "unchanged")], "line int, s string")
    assert {r.line: r.run_status for r in rollup.row_outcomes(rows, "line", "s").collect()} == {1: "rollback", 2: "success", 3: "rollback", 4: "unchanged"}
    lines = spark.createDataFrame([(5, "success"), (6, "success"), (7, "success"), (6, "rollback")], "l int, s string")
    assert rollup.next_start(lines, "l", "s").first().next_start == 6
    assert rollup.next_start(lines.where("s = 'success'"), "l", "s").first().next_start == 8
    assert rollup.next_start(lines.where("l > 99"), "l", "s", 3).first().next_start == 3


def test_facet_plan(spark):
    def plan(valid, reduced=None, expanded=None):
        row = spark.createDataFrame([(valid, reduced, expanded)], "v array<string>, r array<string>, e array<string>")
        return row.select(gates.plan_facets(F.col("v"), F.col("r"), F.col("e"))).first()[0]

    nine = [str(i) for i in range(9)]
    nine = [f"视角{k}" for k in range(9)]
    assert plan(nine[:1]) == [] and plan(["x", "y" * 20]) == [] and plan(nine[:3], None, ["短", "新的视角"]) == [*nine[:3], "新的视角"]
    assert plan(nine) == nine[:8] and plan(nine, nine[1:]) == nine[1:] and plan(nine, nine[:3]) == nine[:8]
    assert plan(["aa", "bb"], None, ["cc"]) == ["aa", "bb"] and plan(["aa", "bb", "cc"], None, ["cc", "dd"]) == ["aa", "bb", "cc", "dd"] and plan(nine[:8], None, ["xx"]) == nine[:8]


def test_registry(spark):
    v = spark.createDataFrame([("p", 1, "V1", "", None)], "prompt_name string, version int, content string, description string, created_at timestamp")
    a = spark.createDataFrame([("p", 1, 1)], "prompt_name string, version int, seq bigint")
    r = boundary.PromptRegistry(v, a)
    assert r.get("p") == "V1"
    r = r.save("p", "V2", "", None)
    assert r.get("p") == "V2"
    r, ok = r.rollback("p", 1)
    assert ok and r.get("p") == "V1"
    r, ok = r.rollback("p", 999)
    assert not ok and r.listing().first().total_versions == 2
    with pytest.raises(KeyError):
        r.get("q")


def test_provider_retries(spark):
    def call(pool, system, prompt):
        if prompt == "bad":
            raise RuntimeError("no")
        return prompt.upper()

    rows = boundary.requests(spark.createDataFrame([("a",), ("bad",)], "x string"), "s", "premium", F.lit("sys"), F.col("x"))
    got = {r.content or r.error for r in boundary.PooledProvider(call, 2, 2).answer(rows).collect()}
    assert got == {"A", "no"}


def test_purify_replay(spark, tmp_path):
    long = "药物通过受体起效，因此血压下降。" * 3
    raw = [record("q1", [f"<think>{long}</think>body"], refs=[{"source": "s", "context": "c"}], kept=7), record("q2", ["<think>x</think>y"], refs=[]), record("q3", ["<think>x</think>y"])]
    (tmp_path / "r.jsonl").write_text("\n".join(raw))
    records = jsonl.read_records(spark, str(tmp_path / "r.jsonl"))
    responses = spark.createDataFrame([], "req_id string, content string, reasoning string, prompt_tokens int, completion_tokens int, error string")
    answers = {"compatibility": "COMPATIBLE", "facet_validity": "VALID", "summary": "new", "judge": '```json\n{"semantic_purity_score": 95, "medical_rigor_score": 95, "logical_depth_score": 90}\n```'}
    rounds = 0
    while True:
        out = purify.purify(records, records, responses)
        waiting = out["pending"].collect()
        if rounds == 1:
            assert {r.run_status for r in out["rows"].collect()} == {"pending"} and {r.line_num: r.raw for r in out["lines"].collect()} == {k + 1: x for k, x in enumerate(raw)}
        if not waiting:
            break
        rows = [(r.req_id, answers.get(r.stage) or ("好的推理。" if long[:20] in r.prompt else "{broken"), None, 1, 1, None) for r in waiting]
        responses = responses.unionByName(spark.createDataFrame(rows, responses.schema))
        rounds += 1
        assert rounds < 12
    assert {r.line_num: r.run_status for r in out["rows"].collect()} == {1: "success", 2: "rollback"}
    lines = {r.line_num: r.raw for r in out["lines"].collect()}
    assert lines[2] == raw[1] and lines[3] == raw[2]
    new = json.loads(lines[1])
    assert "refs" not in new and "好的推理。" in new["planners"][0]["answer"] and new["summary"] == "new" and new["kept"] == 7
    assert out["cursor"].first().next_start == 2 and out["diffs"].count() == 1
    assert {r.line_number: r.planner_count_after for r in out["audit"].collect()} == {1: 1, 2: 1}


def test_planner_outcomes(spark):
    """Prune, rename, signature, second attempt with feedback, second purge, and calls that fail."""
    from pyspark.sql.types import _parse_datatype_string

    def planner(k, name, think, n=2):
        return (k, 0, name, "药物如何代谢", f"<think>{think}</think>body", n, "")

    rows = [planner(1, "强套视角", "x"), planner(2, "示例视角", "x", 1), planner(3, "a", "触发物理格式崩溃"), planner(4, "b", "retry"), planner(5, "c", "purge"), planner(6, "d", "dead")]
    df = spark.createDataFrame(rows, "line_num bigint, planner_index int, planner string, q string, answer string, n int, evidence string")
    schema = _parse_datatype_string("req_id string, content string, error string")
    responses = spark.createDataFrame([], schema)

    def answer(r):
        if r.stage == "facet_validity":
            return ("INVALID" if r.prompt == "示例视角" else "VALID"), None
        if r.stage == "compatibility":
            return ("FORCED_SKIP" if "强套" in r.prompt else "COMPATIBLE"), None
        if r.stage == "rewrite":
            if "dead" in r.prompt:
                return None, "gone"
            return ("good " if "反馈" in r.prompt else "first ") + r.prompt.split("\n")[2], None
        if r.stage == "second_purge":
            return "clean", None
        low = 50 if "first retry" in r.prompt or "first purge" in r.prompt else 95
        return json.dumps({"semantic_purity_score": low, "medical_rigor_score": 95 if "first retry" not in r.prompt else 10, "logical_depth_score": 95}), None

    for _ in range(10):
        out = purify.planner_outcomes(df, responses, allow_prune=True)
        waiting = out.where("ask is not null").select("ask.*").distinct().collect()
        if not waiting:
            break
        responses = responses.unionByName(spark.createDataFrame([(r.req_id, *answer(r)) for r in waiting], schema))
    got = {r.line_num: (r.status, r.new_name, r.purified) for r in out.collect()}
    assert got == {
        1: ("pruned", "强套视角", None), 2: ("success", "药代动力学", "first x"), 3: ("failed", "a", None), 4: ("success", "b", "good retry"), 5: ("success", "c", "clean"), 6: ("failed", "d", "dead"),
    }


def test_export_and_cleanup(spark, corpus):
    rows = jsonl.read_records(spark, corpus).where("parse_status = 'ok'")
    got = pipelines.sft_rows(rows).orderBy("line_num", "place").collect()
    assert [(r.line_num, r.output) for r in got] == [(1, "<think>\na\n</think>\nb"), (1, "s"), (4, "s"), (5, "<think>\nc\n</think>\nd"), (5, "e"), (5, "s")]
    planners = jsonl.exploded(rows).where("planner is not null")
    assert pipelines.cleanup(planners).count() == 3 and pipelines.removed(planners).count() == 2


def test_plan_run(spark, corpus):
    got = {r.line_num: (r.chosen, r.skip_reason) for r in pipelines.plan_run(jsonl.read_records(spark, corpus), 1, 1).collect()}
    assert got == {1: (True, None), 2: (False, "unreadable"), 3: (False, "unreadable"), 4: (False, "no_think"), 5: (False, "already_purified")}
    got = {r.line_num: r.skip_reason for r in pipelines.plan_run(jsonl.read_records(spark, corpus), 4, 9, [1, 4]).collect()}
    assert got == {1: "before_start", 2: "not_listed", 3: "not_listed", 4: "no_think", 5: "not_listed"}


def test_structural_and_mock(spark):
    refs = [("在线公开检索系统抓取异常", ""), ("s", "药物【Rx】目前主要在临床上用于辅助治疗")]
    df = spark.createDataFrame([(refs,)], "refs array<struct<source:string,context:string>>")
    assert [tuple(x) for x in df.select(scan.mock_refs(F.col("refs"))).first()[0]] == [(0, "网络异常兜底Mock"), (1, "Rx")]


def test_reports(spark):
    lines = [(1, "## b"), (2, "数据集第 7 行"), (3, "## a"), (4, "数据集第 2 行"), (5, "## c")]
    df = spark.createDataFrame([("d", *x) for x in lines], "doc string, line_num int, raw string")
    assert [(r.line, r.number) for r in reports.report_blocks(df).orderBy("number").collect()] == [(2, 1), (7, 2), (9999, 3)]
    xml = "<ArticleTitle>T</ArticleTitle><Year>2020</Year><LastName>A</LastName><LastName>B</LastName><AbstractText Label=\"X\">u</AbstractText><AbstractText>v</AbstractText>"
    r = reports.articles(spark.createDataFrame([(xml,)], "xml string")).first()
    assert (r.title, r.date, r.authors, r.abstract) == ("T", "2020", ["A", "B"], "X: u\nv")


def test_versions_and_sections(spark):
    df = spark.createDataFrame([("d", 1, "x"), ("d", 2, "# h"), ("d", 3, "y"), ("d", 4, "# h")], "doc string, n int, t string")
    got = ordering.sections(df, "doc", "n", F.col("t").startswith("#")).orderBy("section").collect()
    assert [(r.first_line, r.last_line) for r in got] == [(2, 3), (4, 4)]


def test_stream_commits_and_resumes(spark, tmp_path):
    src, state = tmp_path / "in", str(tmp_path / "state")
    src.mkdir()

    def process(lines, batch):
        return lines.select(F.get_json_object("value", "$.n").cast("bigint").alias("line_num"), F.get_json_object("value", "$.s").alias("run_status"))

    def run():
        cursor.run_incrementally(spark, str(src), str(tmp_path / "ck"), process, state).awaitTermination(60)
        return cursor.cursor_of(spark, state).first().next_start

    (src / "a.jsonl").write_text('{"n": 1, "s": "success"}\n{"n": 2, "s": "success"}\n')
    assert run() == 3
    (src / "b.jsonl").write_text('{"n": 3, "s": "rollback"}\n{"n": 4, "s": "success"}\n')
    assert run() == 3


def test_lines_that_several_rows_share(spark):
    cur = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "line_num bigint, q string")
    raw = spark.createDataFrame([(1, "a"), (1, "x"), (1, "y"), (2, "z"), (7, "b")], "line_num bigint, q string")
    got = sorted((r.line_num, r.q, r.mapping_status, r.raw_line) for r in linkage.link_records(cur, raw).collect())
    assert got == [(1, "a", "SAME_LINE_Q_MATCH", 1), (1, "b", "MAPPED_BY_Q", 7), (2, "c", "NO_RAW_MATCH", None)]


def test_mapping_counts_by_hand(spark, tmp_path):
    from corpusmill.plans.table_queries import QUERIES

    # turn 100 of conversation 1 has the line of turn 0 of conversation 2
    rows = [(1, 100, "user", "u"), (2, 0, "user", "v"), (2, 1, "user", "w")]
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.key, r.value): r.n for r in QUERIES["mapping_counts"](spark, str(tmp_path)).collect()}
    assert got[("mapping_status", "SAME_LINE_Q_MATCH")] == 3 and sum(n for (k, _), n in got.items() if k == "raw_line") == 3


def test_lines_that_read_alike_are_audited_apart(spark, tmp_path):
    from corpusmill.plans.rule_queries import QUERIES

    # line 7 waits though line 8, which reads alike, is answered
    rows = [(7, 0, "user", "same"), (8, 0, "user", "same")]
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.line, r.planner_index): r.audit_status for r in QUERIES["mapped_audit"](spark, str(tmp_path)).collect()}
    assert got == {(7, 0): "PENDING", (7, 1): "PENDING", (8, 0): "OK", (8, 1): "OK"}
