"""A generation run, replayed answer by answer; shapes and the requests that heal them."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusmill.functions import fixed, shape
from corpusmill.operators import boundary
from corpusmill.plans import generate, purify

RESPONSE = boundary.RESPONSE
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def replay(spark, run, answer, most=60):
    """Runs until nothing waits; ``answer`` gives (content, reasoning, error) of a request, None to leave it. Returns the last result and all stages asked."""
    responses, asked = spark.createDataFrame([], RESPONSE), []
    for _ in range(most):
        out = run(responses)
        pending = out["pending"].collect()
        new = [(r.req_id, *a) for r in pending if (a := answer(r)) is not None]
        asked += [r.stage for r in pending]
        if not new:
            return out, asked
        rows = responses.collect() + new
        responses = spark.createDataFrame([tuple(r) for r in rows], RESPONSE)
    raise AssertionError("the run does not end")


# -- shapes -----------------------------------------------------------------

GOOD = {"label": "适应症", "category": "efficacy", "answer_scope": "说明适应范围", "why_relevant": "直接相关的问题", "risk_level": "low"}


def plan(*changes):
    return {"facets": [{**GOOD, "label": f"视角{k}", **c} for k, c in enumerate(changes)]}


BROKEN = [
    (plan({}, {}), []),
    (plan({}), ["facets: too_short"]),
    (plan(*[{}] * 9), ["facets: too_long"]),
    (plan({"label": "x"}, {"label": "很" * 17}), ["facets.0.label: string_too_short", "facets.1.label: string_too_long"]),
    (plan({"category": "other"}, {"risk_level": "LOW"}), ["facets.0.category: literal_error", "facets.1.risk_level: literal_error"]),
    (plan({"label": 5}, {"answer_scope": None}), ["facets.0.label: string_type", "facets.1.answer_scope: string_type"]),
    (plan({"label": "a？b"}, {"why_relevant": "see json here"}), ["facets.0.label: value_error facet contains sentence punctuation", r"facets.1.why_relevant: value_error \bjson\b"]),
    ({"facets": "none"}, ["facets: list_type"]),
    ({"facets": [1, {}]}, ["facets.0: model_type", *(f"facets.1.{n}: missing" for n in GOOD)]),
    ({}, ["facets: missing"]),
    ([], [": model_type"]),
]


def test_a_plans_violations(spark):
    rows = [(k, json.dumps(j, ensure_ascii=False)) for k, (j, _) in enumerate(BROKEN)] + [(100, "{'facets': []}"), (101, '{"facets": []} {}'), (102, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r.k: (r.c.json, r.c.codes) for r in df.select("k", shape.checked(F.col("t"), shape.FACET_PLAN).alias("c")).collect()}
    for k, (j, codes) in enumerate(BROKEN):
        assert got[k] == (None if codes else rows[k][1], codes)
    assert all(got[k] == (None, ["json_invalid"]) for k in (100, 101, 102))


def test_scores_and_leaks(spark):
    five = {n: {"score": 9, "reason": "r"} for n, _ in fixed.METRIC_LABELS}
    cases = [
        (five, []), ({**five, "relevance": {"score": "9.5", "reason": "r"}}, []), ({**five, "grounding": {"score": 11, "reason": 3}}, ["grounding.score: less_than_equal", "grounding.reason: string_type"]),
        ({**five, "isolation": {"score": "x", "reason": "r"}}, ["isolation.score: float_parsing"]), ({**five, "isolation": {"score": None, "reason": "r"}}, ["isolation.score: float_type"]),
        ({**five, "relevance": {"score": -1, "reason": "The requested JSON schema"}}, ["relevance.score: greater_than_equal"]), ({**five, "relevance": {"score": 1, "reason": "The requested JSON schema"}}, [r"prompt_leak $.relevance.reason: requested\s+json\s+schema"]),
    ]
    df = spark.createDataFrame([(k, json.dumps(j)) for k, (j, _) in enumerate(cases)], "k long, t string")
    got = {r.k: r.c for r in df.select("k", shape.checked(F.col("t"), shape.FIVE_SCORES)["codes"].alias("c")).collect()}
    assert got == {k: codes for k, (_, codes) in enumerate(cases)}
    nested = spark.createDataFrame([(json.dumps({"sub_questions": ["a", "pydantic validation"], "evidences": [{"source": "s", "location": "l", "summary": "do not include markdown fences"}], "reasoning_chains": [], "final_conclusion_summary": "f", "answer_body": "b"}),)], "t string")
    assert nested.select(shape.checked(F.col("t"), shape.FACET_ANSWER)["codes"].alias("c")).first().c == [r"prompt_leak $.sub_questions[1]: pydantic\s+validation", r"prompt_leak $.evidences[0].summary: do\s+not\s+include\s+markdown\s+fences"]


def test_broken_answers_are_asked_for_again(spark):
    rows = spark.createDataFrame([(k, f"q{k}") for k in range(5)] + [(9, "q9")], "k long, q string").withColumn("ask", F.lit(None).cast(boundary.ASK))
    good = json.dumps(plan({}, {}), ensure_ascii=False)

    def run(responses):
        out = boundary.structured(rows, responses, "plan", "light", F.col("q"), F.col("k") != 9, ["k"], shape.FACET_PLAN)
        return {"pending": boundary.awaited(out), "rows": out}

    def answer(r):
        k, later = int(r.prompt[1]), r.prompt.count("too_short") + r.prompt.count("json_invalid")
        if k == 1 and not later:
            return "```json\n" + json.dumps(plan({}), ensure_ascii=False) + "\n```", None, None
        if k == 2:
            return "no", None, None
        if k == 3:
            return None, None, "down"
        if k == 4:
            return None
        return "here: " + good + " done", "thinking", None

    out, asked = replay(spark, run, answer)
    got = {r.k: (r.s_json is not None, r.s_codes, r.s_failed, r.s_mused, r.s_tries, r.s_asked, r.ask is not None) for r in out["rows"].collect()}
    assert got == {
        0: (True, [], None, "thinking", 1, True, False), 1: (True, [], None, "thinking", 2, True, False), 2: (False, ["json_invalid"], None, None, 3, True, False),
        3: (False, None, "down", None, 0, True, False), 4: (False, None, None, None, 0, False, True), 9: (False, None, None, None, 0, False, False),
    }
    assert sorted(set(asked)) == ["plan", "plan~1", "plan~2"]


# -- the run ----------------------------------------------------------------

LONG = "依据现有资料逐步推演" * 20
FIVE = {n: {"score": 8, "reason": "fine"} for n, _ in fixed.METRIC_LABELS}


def facet_json(body):
    return json.dumps({"sub_questions": ["s"], "evidences": [{"source": "refs", "location": "p1", "summary": "e"}], "reasoning_chains": [{"step_id": "P1", "logic": "l"}], "final_conclusion_summary": "c", "answer_body": body}, ensure_ascii=False)


def labels_json(names):
    return json.dumps({"facets": [{**GOOD, "label": n} for n in names]}, ensure_ascii=False)


def model(pool, stage, p):
    """Answers by what a prompt holds: each question names its case."""
    case = next((c for c in CASES if f"Q {c}" in p), None)
    if stage == "question":
        return "[]" if p.startswith("none") else json.dumps([f"Q {p.splitlines()[0]}"])
    if stage.startswith("plan"):
        if case == "plan3" and "attempt 2" not in p:
            return labels_json(["同一视角", "同一视角"])
        if case == "noplan":
            return "nothing"
        return labels_json(["视角一", "视角二", "视角三"] if case == "expand" else ["视角一", "视角二"])
    if stage.startswith("expand"):
        return json.dumps(["视角二", "视角四", "bad: label", *[f"更多{k}" for k in range(7)]], ensure_ascii=False)
    if stage.startswith("answer"):
        if case == "drop" and "视角二" in p:
            return facet_json("抱歉，不能回答"), LONG
        if case == "retry" and stage.startswith("answer#1.1") and "视角一" in p:
            return facet_json("好"), "太短"
        if case == "plain":
            raise RuntimeError("down")
        return facet_json("正文 " + p.splitlines()[1]), (LONG if "视角一" in p else None)
    if stage.startswith("plain"):
        return "抱歉" if case == "drop" else f"<think>{LONG}</think>普通正文"
    if stage.startswith("redundancy"):
        return {"redundant": "[1]", "all": "[0, 1]"}.get(case, "keep all")
    if stage.startswith("synthesis"):
        return None if case == "wait" else " 总结 " + p.splitlines()[0]
    if stage.startswith("next"):
        return f' "Q second{"low" if case == "low" else "refuse" if case == "refuse" else "judge" if case == "judge" else ""}" '
    if stage.startswith("judge"):
        if "Q secondjudge" in p:
            return "no json"
        return json.dumps({**FIVE, "isolation": {"score": 5.5, "reason": "polluted"}} if "Q secondlow" in p else FIVE)
    if stage.startswith("diagnose"):
        if "视角二" in p:
            raise RuntimeError("judge down")
        return json.dumps({**FIVE, "isolation": {"score": 3, "reason": "bad"}})
    raise AssertionError(stage)


CASES = ["plain", "plan3", "noplan", "expand", "drop", "retry", "redundant", "all", "low", "judge", "none", "wait"]


def test_a_run_of_two_rounds(spark, tmp_path):
    """Drop, retry, expand, redundancy, rejection, failure and waiting, with a model that answers as it is asked; then the same from what was kept."""
    refs = [("refs:《a》", 'fact "1"')]
    tasks = spark.createDataFrame([(n, refs, refs if n != "drop" else None, "x") for n in CASES], f"task_id string, context {generate.REFS}, refs {generate.REFS}, record string")
    more = tasks.select("task_id", F.lit(1).alias("round"), "context", F.array(F.struct(F.lit("new").alias("source"), F.lit("ref").alias("context"))).alias("refs"))
    live = boundary.Live(spark, str(tmp_path / "kept"), boundary.PooledProvider(model, 1, tries=1, backoff=0))
    out = generate.generate(tasks, live, rounds=2, more=more)
    states = {r.task_id: (r.status, r.error) for r in out["states"].collect()}
    assert states == {n: ("passed", None) for n in CASES} | {
        "noplan": ("failed", "facet planning failed"), "low": ("rejected", None), "judge": ("failed", "json_invalid"), "none": ("failed", "no question"), "wait": ("pending", None),
    }
    assert [r.stage for r in out["pending"].collect()] == ["synthesis#1"]
    records = {r.task_id: json.loads(r.record) for r in out["records"].collect()}
    first = {k: v["history"][0] for k, v in records.items()}
    assert {k: [p["planner"] for p in v["planners"]] for k, v in first.items()} == {
        "plain": ["视角一", "视角二"], "plan3": ["视角一", "视角二"], "expand": ["视角一", "视角二", "视角三", "视角四", *[f"更多{k}" for k in range(7)]], "drop": ["视角一"], "retry": ["视角一", "视角二"],
        "redundant": ["视角一"], "all": ["视角一", "视角二"],
    }
    for k, v in records.items():
        assert list(v) == ["Q", "planners", "history", "summary", "refs"] and v["Q"] == "Q second" and len(v["history"]) == 1 and v["summary"] == "总结 Q second"
        assert list(first[k]) == ["Q", "planners", "history", "summary"] and first[k]["Q"] == f"Q {k}" and first[k]["history"] == []
        assert [r["source"] for r in v["refs"]] == (["new"] if k == "drop" else ["refs:《a》", "new"])
    assert first["retry"]["planners"][0]["answer"] == f"<think><facet = 视角一>\n{LONG}\n</think>\n正文 视角一"
    assert first["retry"]["planners"][1]["answer"].startswith("<think><facet = 视角二>\n问题拆解：\n- s\n证据清单：\n[证据R1")
    assert first["plain"]["planners"][0]["answer"] == f"<think><facet = 视角一>{LONG}</think>普通正文"
    low = out["rejected"].first()
    assert low.task_id == "low" and [d.label for d in low.failed_dimensions] == ["领域隔离度"] and low.avg_score == 7.5 and low.refusal_avoided
    assert [(d["index"], d.facet, d.status, d.avg_score, d.error) for d in low.facet_diagnostics] == [(1, "视角一", "failed", 7.0, None), (2, "视角二", "judge_error", None, "judge down")]
    log = {(r.task_id, r["round"], r.stage, r.attempt, r.facet): r.outcome for r in out["log"].collect()}
    assert log["plan3", 1, "plan", 2, None] == "validated facet count < 2" and log["plan3", 1, "plan", 3, None] == "success" and log["noplan", 1, "plan", 3, None] == "json_invalid"
    assert log["retry", 1, "answer", 1, "视角一"].startswith("lazy reasoning") and log["retry", 1, "answer", 2, "视角一"] == "passed"
    assert log["drop", 1, "plain", 3, "视角二"] == "safety refusal" and log["redundant", 1, "redundancy", 1, None] == "1 removed"
    rows = generate.datasets_rows(out["records"], "2026-01-01").collect()
    assert len(rows) == 7 and all(json.loads(r.full_data_json)["Q"] == r.query and json.loads(r.judge_metrics_json) == FIVE for r in rows)


def test_a_run_over_a_table_waits_and_an_empty_one_ends(spark):
    tasks = spark.createDataFrame([("a", None, None)], f"task_id string, context {generate.REFS}, refs {generate.REFS}")
    none = spark.createDataFrame([], RESPONSE)
    out = generate.generate(tasks, none)
    assert [r.stage for r in out["pending"].collect()] == ["question"] and out["states"].first().status == "pending"
    empty = generate.generate(tasks.limit(0), none)
    assert all(empty[k].count() == 0 for k in ("pending", "records", "rejected", "states", "log"))


def test_live_responses_are_asked_for_once(spark, tmp_path):
    def call(pool, system, prompt):
        with open(tmp_path / "calls", "a") as f:
            f.write(prompt + "\n")
        if prompt == "b":
            raise RuntimeError("down")
        return None if prompt == "c" else "[]" if prompt == "d" else "A " + prompt

    asked = spark.createDataFrame([(x, "s", "p", "s", x) for x in "abcd"], "req_id string, stage string, pool string, system string, prompt string")
    live = boundary.Live(spark, str(tmp_path / "kept"), boundary.PooledProvider(call, 2, tries=1, backoff=0))
    for _ in range(2):
        got = {r.req_id: (r.content, r.error) for r in live.replies(asked).collect()}
        assert got == {"a": ("A a", None), "b": (None, "down"), "d": ("[]", None)}
    calls = sorted((tmp_path / "calls").read_text().split())
    assert calls == ["a", "b", "c", "c", "d", "d"]


def test_calls_of_a_task_run_side_by_side(spark):
    import time

    def call(pool, system, prompt):
        time.sleep(0.1)
        return prompt

    asked = spark.createDataFrame([(str(k), "p", "s", str(k)) for k in range(100)], "req_id string, pool string, system string, prompt string")
    provider = boundary.PooledProvider(call, 2, pool=10)
    provider.answer(asked.limit(2)).collect()
    began = time.time()
    assert provider.answer(asked).count() == 100 and time.time() - began < 5


def test_judged_text(spark):
    planners = [("a", f"<think>x</think> {'y' * 2000}"), ("b", "plain")]
    df = spark.createDataFrame([(" s ", planners)], f"s string, p {generate.PLANNERS}")
    got = df.select(generate.judged_text(F.col("s"), F.col("p")).alias("t")).first().t
    assert got == "【最终 summary】\ns\n\n【各 facet 回答正文】\n\n[1] facet=a\n" + "y" * 1800 + "...\n\n[2] facet=b\nplain"


# -- purification: codes, second verdicts, analyses -------------------------


def test_codes_are_searched_for_and_put_right(spark):
    rows = spark.createDataFrame([(1, 0, "success", "OER-1 then XYZ-9, ABC-7 and OAT-3; GONE-1 too"), (2, 0, "success", "no code"), (3, 0, "failed", "XYZ-9"), (4, 0, "success", "WAIT-1")], "line_num long, planner_index int, status string, purified string")
    rows = rows.withColumn("ask", F.lit(None).cast(boundary.ASK))

    def answer(r):
        if r.prompt.startswith("WAIT"):
            return None
        if r.stage == "search":
            return {"XYZ-9": "[]", "ABC-7": '[{"source": "https://pubmed.ncbi.nlm.nih.gov/1", "context": "c"}]'}.get(r.prompt), None, ("down" if r.prompt == "GONE-1" else None)
        assert r.stage == "repair" and r.prompt.startswith("XYZ-9\nOER-1 then")
        return ' "PBP" ', None, None

    def run(responses):
        out = purify.repaired_entities(rows, responses)
        return {"pending": boundary.awaited(out), "rows": out}

    out, _ = replay(spark, run, answer)
    got = {r.line_num: (r.status, r.purified, r.ask is not None) for r in out["rows"].collect()}
    assert got == {1: ("success", "OAT-1 then PBP, ABC-7 and OAT-3; GONE-1 too", False), 2: ("success", "no code", False), 3: ("failed", "XYZ-9", False), 4: (None, "WAIT-1", True)}


def test_number_list(spark):
    cases = {"[0, 2.0, 3.5, \"1\", null]": [0, 2], "```json\n[1]\n```": [1], "keep": None, '{"a": 1}': None, "[]": []}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.n for r in df.select("t", generate.number_list(F.col("t")).alias("n")).collect()} == cases
    lists = {'["a", "b"]': ["a", "b"], "x": [], 'so ["a"] end': ["a"]}
    df = spark.createDataFrame([(k,) for k in lists], "t string")
    assert {r.t: r.n for r in df.select("t", generate.text_list(F.col("t")).alias("n")).collect()} == lists
