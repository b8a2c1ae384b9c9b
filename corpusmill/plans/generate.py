"""A generation run over a table of responses: questions, facets, answers, a summary, rounds, and the gate at the end.

A run replays: it asks nothing itself, goes on with every row that has its
response, and hands out the requests of those that wait. Run again with more
responses it comes further, and what is done comes out the same. Prompts carry
what a step is about; their wording is the caller's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.shape import ANSWER_SCHEMA, FACET_ANSWER, FACET_PLAN, FIVE_SCORES
from corpusmill.functions.text import json_fenced, let, preview, quoted_json, strict_json, strip
from corpusmill.functions.think import body_after_first, ensure_think, structured_think, synthesis_body
from corpusmill.operators import gates
from corpusmill.operators.boundary import ASK, STRUCTURED, answered, awaited, structured
from corpusmill.operators.linkage import drop_positions
from corpusmill.sources.staging import staged

REFS = "array<struct<source:string,context:string>>"
PLANNERS = "array<struct<planner:string,answer:string>>"
#: How often a plan is asked for, and an answer that a guard turns down, structured and then plain.
PLANS, ANSWERS = 3, 3


class _Log:
    """What every step came to, and who waits."""

    def __init__(self):
        self.rows: list[DataFrame] = []
        self.waits: list[DataFrame] = []

    def note(self, rows: DataFrame, number: int, stage: str, attempt: int, outcome: Column, due: Column) -> None:
        facet = F.col("facet") if "facet" in rows.columns else F.lit(None).cast("string")
        self.rows.append(rows.where(due).select("task_id", F.lit(number).alias("round"), F.lit(stage).alias("stage"), F.lit(attempt).alias("attempt"), facet.alias("facet"), outcome.alias("outcome")))

    def wait(self, rows: DataFrame) -> None:
        self.waits.append(rows.select("ask"))


def text_list(answer: Column) -> Column:
    """the texts of a JSON array in an answer; none if there is no such array."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.from_json(strict_json(json_fenced(F.coalesce(answer, F.lit("")))), "array<string>"), none)


def number_list(answer: Column) -> Column:
    """X11: the whole numbers of a JSON array in an answer; null if it is no array, and anything else in it is left out."""

    def numbers(items: Column) -> Column:
        own = F.transform(items, lambda v: F.when(F.schema_of_variant(v).isin("BIGINT", "DOUBLE") | F.schema_of_variant(v).startswith("DECIMAL"), F.try_variant_get(v, "$", "double")))
        return F.transform(F.filter(own, lambda x: x.isNotNull() & (x == F.floor(x))), lambda x: x.cast("int"))

    return let(F.try_variant_get(F.try_parse_json(strict_json(json_fenced(F.coalesce(answer, F.lit(""))))), "$", "array<variant>"), numbers)


def refs_text(refs: Column) -> Column:
    return F.coalesce(F.to_json(refs), F.lit("[]"))


def _open() -> Column:
    return F.col("error").isNull() & F.col("ask").isNull()


def _stop(rows: DataFrame, when: Column, why: Column | str) -> DataFrame:
    return rows.withColumn("error", F.when(F.col("error").isNull() & F.col("ask").isNull() & when, F.lit(why) if isinstance(why, str) else why).otherwise(F.col("error")))


def first_questions(tasks: DataFrame, responses: DataFrame, seed: int, log: _Log) -> DataFrame:
    """Each task's first question, one of those proposed by a seeded hash of the task."""
    rows = answered(tasks, responses, "question", "lightweight", F.concat_ws("\n", "task_id", refs_text(F.col("context"))), _open(), ["task_id"])
    listed = text_list(F.col("got"))
    chosen = let(listed, lambda q: F.get(q, F.pmod(F.xxhash64(F.lit(seed), F.col("task_id")), F.greatest(F.size(q), F.lit(1))).cast("int")))
    rows = rows.withColumn("q", F.when(F.col("asked"), chosen))
    log.note(rows, 0, "question", 1, F.when(F.col("q").isNotNull(), "chosen").otherwise("none"), F.col("asked"))
    rows = _stop(rows, F.col("asked") & F.col("q").isNull(), F.coalesce(F.col("failed"), F.lit("no question")))
    return staged(rows.drop("got", "failed", "asked"))


def planned_facets(rows: DataFrame, responses: DataFrame, number: int, log: _Log) -> DataFrame:
    """Labels of each question: up to three plans, each carrying why the ones before it failed, then the reducer or the expander."""
    rows = rows.withColumns({"labels": F.lit(None).cast("array<string>"), "notes": F.lit("")})
    due = _open() & F.col("labels").isNull()
    for k in range(1, PLANS + 1):
        rows = structured(rows, responses, f"plan#{number}.{k}", "lightweight", F.concat_ws("\n", "q", "notes"), due, ["task_id"], FACET_PLAN)
        labels = F.transform(F.from_json("s_json", "facets array<struct<label:string>>")["facets"], lambda c: c["label"])
        rows = rows.withColumn("found", F.when(F.col("s_asked"), gates.valid_labels(labels)))
        enough = F.col("s_asked") & (F.size("found") >= 2)
        why = F.coalesce(F.col("s_failed"), F.when(F.col("s_json").isNull(), F.array_join("s_codes", "; ")), F.lit("validated facet count < 2"))
        log.note(rows, number, "plan", k, F.when(enough, "success").otherwise(why), F.col("s_asked"))
        rows = rows.withColumn("labels", F.when(enough, F.col("found")).otherwise(F.col("labels")))
        rows = rows.withColumn("notes", F.when(F.col("s_asked") & ~enough, F.concat("notes", F.lit(f"\n- attempt {k}: "), why)).otherwise(F.col("notes")))
        rows = staged(rows.drop("found", *STRUCTURED))
        if rows.where(due).isEmpty():
            break
    rows = _stop(rows, F.col("labels").isNull(), "facet planning failed")
    n, prompt = F.size("labels"), F.concat_ws("\n", "q", F.array_join("labels", "\n"))
    rows = answered(rows, responses, f"reduce#{number}", "lightweight", prompt, _open() & (n > 8), ["task_id"])
    rows = _stop(rows, F.col("asked") & F.col("failed").isNotNull(), F.col("failed")).withColumn("fewer", F.when(F.col("asked"), text_list(F.col("got"))))
    rows = answered(rows, responses, f"expand#{number}", "lightweight", prompt, _open() & (n > 2) & (n < 8), ["task_id"])
    rows = _stop(rows, F.col("asked") & F.col("failed").isNotNull(), F.col("failed")).withColumn("more", F.when(F.col("asked"), text_list(F.col("got"))))
    rows = rows.withColumn("labels", F.when(_open(), gates.plan_facets(F.col("labels"), F.col("fewer"), F.col("more"))).otherwise(F.col("labels")))
    rows = staged(rows.drop("got", "failed", "asked", "notes", "fewer", "more"))
    log.note(rows, number, "facets", 1, F.array_join("labels", ","), _open())
    return _stop(rows, F.size("labels") < 2, "fewer than 2 valid facets")


def facet_answers(rows: DataFrame, responses: DataFrame, number: int, log: _Log) -> DataFrame:
    """(task_id, facet_no, facet, answer, error, ask) of each facet of each open question; a null answer is a dropped facet.

    A structured answer is asked for until the guard lets one pass, three
    times at most. One that never fits its shape, a call that failed or three
    that the guard turned down lead to plain answers, again three at most.
    """
    keys = ["task_id", "facet_no"]
    facets = rows.where(_open()).select("task_id", "q", "refs", F.posexplode("labels").alias("facet_no", "facet"))
    empty = {"answer": "string", "error": "string", "ask": ASK}
    facets = staged(facets.withColumns({k: F.lit(None).cast(v) for k, v in empty.items()}).withColumns({"plain": F.lit(False), "over": F.lit(False)}))
    prompt = F.concat_ws("\n", "q", "facet", refs_text(F.col("refs")))
    due = F.col("answer").isNull() & ~F.col("plain") & F.col("ask").isNull()
    for k in range(1, ANSWERS + 1):
        facets = structured(facets, responses, f"answer#{number}.{k}", "premium", prompt, due, keys, FACET_ANSWER)
        made = F.from_json("s_json", ANSWER_SCHEMA)
        refused = gates.answer_reason(made["answer_body"], F.coalesce("s_mused", F.lit("")))
        facets = facets.withColumn("why", F.when(F.col("s_asked"), F.coalesce(F.col("s_failed"), F.when(F.col("s_json").isNull(), F.array_join("s_codes", "; ")), refused)))
        log.note(facets, number, "answer", k, F.when(F.col("why") == "", "passed").otherwise(F.col("why")), F.col("s_asked"))
        passed, broken = F.col("s_asked") & (F.col("why") == ""), F.col("s_asked") & F.col("s_json").isNull()
        facets = facets.withColumn("answer", F.when(passed, structured_think(made, F.col("facet"), F.col("s_mused"))).otherwise(F.col("answer")))
        facets = facets.withColumn("plain", F.col("plain") | broken | (F.col("s_asked") & ~passed & F.lit(k == ANSWERS)))
        facets = staged(facets.drop("why", *STRUCTURED))
        if facets.where(due).isEmpty():
            break
    due = F.col("answer").isNull() & F.col("plain") & ~F.col("over") & F.col("ask").isNull() & F.col("error").isNull()
    for k in range(1, ANSWERS + 1):
        if facets.where(due).isEmpty():
            break
        facets = answered(facets, responses, f"plain#{number}.{k}", "premium", prompt, due, keys, reasoning=True)
        raw = strip(F.coalesce("got", F.lit("")))
        closed, inner = F.contains(raw, F.lit("</think>")), F.split(F.split(raw, "</think>")[0], "<think>")
        body = F.when(closed, strip(F.element_at(F.split(raw, "</think>"), -1))).otherwise(raw)
        own = F.when(closed & (F.size(inner) > 1), strip(F.get(inner, F.lit(1)))).otherwise("")
        mused = let(strip(F.coalesce("mused", F.lit(""))), lambda m: F.when(m != "", m).otherwise(own))
        facets = facets.withColumns({"p_raw": raw, "p_mused": mused, "p_body": body})
        facets = facets.withColumn("why", F.when(F.col("asked"), F.coalesce(F.col("failed"), gates.answer_reason(F.col("p_body"), F.col("p_mused")))))
        log.note(facets, number, "plain", k, F.when(F.col("why") == "", "passed").otherwise(F.col("why")), F.col("asked"))
        facets = facets.withColumns({
            "answer": F.when(F.col("why") == "", ensure_think(F.col("p_raw"), F.col("p_mused"), F.col("facet"))).otherwise(F.col("answer")),
            "error": F.when(F.col("asked"), F.col("failed")).otherwise(F.col("error")), "over": F.col("over") | (F.col("asked") & F.lit(k == ANSWERS)),
        })
        facets = staged(facets.drop("got", "failed", "asked", "mused", "p_raw", "p_mused", "p_body", "why"))
    log.wait(facets)
    return facets.select(*keys, "facet", "answer", "error", "ask")


def one_round(rows: DataFrame, responses: DataFrame, number: int, last: bool, log: _Log) -> DataFrame:
    """Q10: rows with q, history and refs after one round: planners, summary, the round in ``record`` and, but for the last one, the next q."""
    rows = planned_facets(rows, responses, number, log)
    facets = facet_answers(rows, responses, number, log)
    kept = F.when(F.col("answer").isNotNull(), F.struct("facet_no", F.struct(F.col("facet").alias("planner"), "answer").alias("p")))
    gathered = facets.groupBy("task_id").agg(
        F.transform(F.sort_array(F.collect_list(kept)), lambda x: x["p"]).alias("planners"), F.first("error", ignorenulls=True).alias("f_error"), F.first("ask", ignorenulls=True).alias("f_ask")
    )
    rows = rows.drop("planners").join(gathered, "task_id", "left")
    rows = rows.withColumn("error", F.coalesce("error", "f_error")).withColumn("ask", F.when(F.col("error").isNull(), F.coalesce("ask", "f_ask")).otherwise(F.col("ask"))).drop("f_error", "f_ask")
    rows = _stop(rows, F.size("planners") < 1, "no valid facet answers")
    listed = F.to_json("planners")
    rows = answered(rows, responses, f"redundancy#{number}", "lightweight", F.concat_ws("\n", "q", listed), _open(), ["task_id"])
    rows = _stop(rows, F.col("asked") & F.col("failed").isNotNull(), F.col("failed"))
    left = drop_positions(F.col("planners"), number_list(F.col("got")))
    rows = rows.withColumn("left", F.when(F.col("asked"), F.when(F.size(left) > 0, left).otherwise(F.col("planners"))))
    log.note(rows, number, "redundancy", 1, F.concat(F.size("planners") - F.size("left"), F.lit(" removed")), F.col("left").isNotNull())
    rows = rows.withColumn("planners", F.coalesce("left", "planners"))
    bodies = F.array_join(F.transform("planners", lambda p: synthesis_body(p["answer"], literal=True)), "\n")
    rows = answered(rows, responses, f"synthesis#{number}", "lightweight", F.concat_ws("\n", "q", bodies), _open(), ["task_id"])
    rows = _stop(rows, F.col("asked") & F.col("failed").isNotNull(), F.col("failed")).withColumn("summary", F.when(F.col("asked"), strip(F.col("got"))))
    rows = staged(rows.drop("left", "got", "failed", "asked"))
    items = F.array_join(F.transform("planners", lambda p: F.concat(F.lit('{"planner": '), quoted_json(p["planner"]), F.lit(', "answer": '), quoted_json(p["answer"]), F.lit("}"))), ", ")
    record = F.concat(F.lit('{"Q": '), quoted_json(F.col("q")), F.lit(', "planners": ['), items, F.lit('], "history": '), F.col("history"), F.lit(', "summary": '), quoted_json(F.col("summary")))
    rows = rows.withColumn("record", F.when(_open() & F.col("summary").isNotNull(), F.concat(record, F.lit("}"))))
    if last:
        return staged(rows)
    rows = rows.withColumn("history", F.when(F.col("record").isNotNull(), F.concat(F.expr("left(history, length(history) - 1)"), F.when(F.col("history") == "[]", "").otherwise(", "), "record", F.lit("]"))).otherwise(F.col("history")))
    rows = answered(rows, responses, f"next#{number}", "lightweight", F.concat_ws("\n", refs_text(F.col("context")), "history", "summary"), _open(), ["task_id"])
    rows = _stop(rows, F.col("asked") & F.col("failed").isNotNull(), F.col("failed"))
    rows = rows.withColumn("q", F.when(F.col("asked"), F.trim(F.trim(strip(F.coalesce("got", F.lit(""))), F.lit('"')), F.lit("'"))).otherwise(F.col("q")))
    log.note(rows, number, "next", 1, F.lit("asked"), F.col("asked"))
    return staged(rows.drop("got", "failed", "asked"))


def judged_text(summary: Column, planners: Column) -> Column:
    """what the judge of a record reads: its summary, then each facet with the first 1,800 characters of its body."""
    each = F.transform(planners, lambda p, i: F.concat(F.lit("\n["), (i + 1).cast("string"), F.lit("] facet="), p["planner"], F.lit("\n"), preview(strip(body_after_first(p["answer"])), 1800)))
    return strip(F.concat_ws("\n", F.lit(fixed.JUDGED_SUMMARY), strip(F.coalesce(summary, F.lit(""))), F.lit(fixed.JUDGED_ANSWERS), F.array_join(each, "\n")))


_SCORE = "struct<score:double,reason:string>"
METRICS = ", ".join(f"{name} {_SCORE}" for name, _ in fixed.METRIC_LABELS)


def _metrics(text: str) -> Column:
    return F.from_json(text, METRICS)


def failed_dimensions(metrics: Column, least: float = 6.0) -> Column:
    """(label, score, reason) of the dimensions below ``least``, in order."""
    each = [F.when(metrics[n]["score"] < least, F.struct(F.lit(label).alias("label"), metrics[n]["score"].alias("score"), metrics[n]["reason"].alias("reason"))) for n, label in fixed.METRIC_LABELS]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def rejections(rows: DataFrame, responses: DataFrame, log: _Log) -> DataFrame:
    """An audit of each rejected record, its facets judged one by one; a facet whose judge failed is ``judge_error``."""
    facets = rows.select("task_id", "q", "refs", "ask", F.posexplode("planners").alias("facet_no", "p")).select("*", F.col("p.planner").alias("facet"))
    prompt = F.concat_ws("\n", "q", "facet", strip(body_after_first(F.col("p.answer"))), refs_text(F.col("refs")))
    facets = structured(facets, responses, "diagnose", "judge", prompt, F.lit(True), ["task_id", "facet_no"], FIVE_SCORES)
    log.wait(facets)
    m = _metrics("s_json")
    scores = [m[n]["score"] for n, _ in fixed.METRIC_LABELS]
    wrong = failed_dimensions(m)
    status = F.when(F.col("s_json").isNull(), "judge_error").when(F.size(wrong) > 0, "failed").otherwise("passed")
    diagnosis = F.struct(
        (F.col("facet_no") + 1).alias("index"), "facet", status.alias("status"), F.when(F.col("s_json").isNotNull(), F.bround(reduce(Column.__add__, scores) / len(scores), 2)).alias("avg_score"),
        F.when(F.col("s_json").isNotNull(), wrong).alias("failed_dimensions"), F.coalesce("s_failed", F.when(F.size("s_codes") > 0, F.array_join("s_codes", "; "))).alias("error"),
    )
    each = facets.groupBy("task_id").agg(F.sort_array(F.collect_list(diagnosis)).alias("facet_diagnostics"), F.first("ask", ignorenulls=True).alias("d_ask"))
    own = rows.join(each, "task_id")
    m = _metrics("metrics")
    scores = [m[n]["score"] for n, _ in fixed.METRIC_LABELS]
    planners = F.transform("planners", lambda p, i: F.struct((i + 1).alias("index"), p["planner"].alias("facet"), (F.contains(p["answer"], F.lit("<think>")) & F.contains(p["answer"], F.lit("</think>"))).alias("has_think"), preview(strip(body_after_first(p["answer"])), 700).alias("answer_preview")))
    return staged(own.select(
        "task_id", F.lit("rejected").alias("status"), F.col("q").alias("query"), F.transform("planners", lambda p: p["planner"]).alias("facets"), planners.alias("planners"),
        preview(F.col("summary"), 1000).alias("summary_preview"), F.size("refs").alias("refs_count"), F.bround(reduce(Column.__add__, scores) / len(scores), 2).alias("avg_score"),
        F.col("refusal_avoided"), failed_dimensions(m).alias("failed_dimensions"), m.alias("metrics"), "facet_diagnostics", F.col("d_ask").isNotNull().alias("pending"),
    ))


def generate(tasks: DataFrame, responses: DataFrame, rounds: int = 1, seed: int = 17, more: DataFrame | None = None) -> dict[str, DataFrame]:
    """Q10: a run of ``tasks`` (task_id, and context and refs as arrays of source and context) over a table of responses.

    Returns ``pending`` requests; ``records`` that passed the gate (task_id,
    q, record as one JSON line, metrics); ``rejected`` audits; ``states`` with
    a status for every task (passed, rejected, failed with its error, pending)
    and ``log``, a row for each step that was answered. ``more`` (task_id,
    round, context, refs) widens what a task knows after a round. Earlier
    rounds are carried whole in ``history``, each with its own. A null
    task_id is a task like others as long as there is one of it; an empty
    table gives empty ones.
    """
    log = _Log()
    none = F.array().cast(REFS)
    rows = tasks.select("task_id", F.coalesce(F.col("context").cast(REFS), none).alias("context"), F.coalesce(F.col("refs").cast(REFS), none).alias("refs"))
    rows = rows.withColumns({"ask": F.lit(None).cast(ASK), "error": F.lit(None).cast("string"), "history": F.lit("[]"), "record": F.lit(None).cast("string"), "summary": F.lit(None).cast("string"), "planners": F.lit(None).cast(PLANNERS)})
    rows = first_questions(staged(rows), responses, seed, log)
    for number in range(1, rounds + 1):
        rows = one_round(rows, responses, number, number == rounds, log)
        if more is not None and number < rounds:
            extra = more.where(F.col("round") == number).select("task_id", F.col("context").cast(REFS).alias("x_context"), F.col("refs").cast(REFS).alias("x_refs"))
            rows = rows.join(extra, "task_id", "left").withColumns({"context": F.concat("context", F.coalesce("x_context", none)), "refs": F.concat("refs", F.coalesce("x_refs", none))})
            rows = staged(rows.drop("x_context", "x_refs"))
    prompt = F.concat_ws("\n", "q", judged_text(F.col("summary"), F.col("planners")), refs_text(F.col("refs")))
    rows = structured(rows, responses, "judge", "judge", prompt, _open(), ["task_id"], FIVE_SCORES)
    rows = _stop(rows, F.col("s_asked") & F.col("s_json").isNull(), F.coalesce("s_failed", F.array_join("s_codes", "; ")))
    m = _metrics("s_json")
    verdict = gates.five_scores([(n, m[n]["score"]) for n, _ in fixed.METRIC_LABELS], gates.refused(F.col("summary")))
    rows = rows.withColumn("metrics", F.col("s_json")).withColumn("refusal_avoided", ~gates.refused(F.col("summary"))).withColumn("verdict", F.when(F.col("s_json").isNotNull(), verdict))
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("ask").isNotNull(), "pending").when(F.col("verdict.passed"), "passed").otherwise("rejected")
    rows = staged(rows.withColumn("status", status).drop(*STRUCTURED))
    log.note(rows, rounds, "gate", 1, F.concat(F.col("status"), F.lit(" "), F.format_string("%.1f", "verdict.mean")), F.col("verdict").isNotNull())
    log.wait(rows)
    whole = F.concat(F.expr("left(record, length(record) - 1)"), F.lit(', "refs": '), _refs_json(F.col("refs")), F.lit("}"))
    rejected = rejections(rows.where("status = 'rejected'"), responses, log)
    return {
        "pending": awaited(*log.waits), "records": rows.where("status = 'passed'").select("task_id", "q", whole.alias("record"), "metrics"), "rejected": rejected,
        "states": rows.select("task_id", "status", "error"), "log": reduce(DataFrame.unionByName, log.rows),
    }


def _refs_json(refs: Column) -> Column:
    each = F.transform(refs, lambda r: F.concat(F.lit('{"source": '), quoted_json(r["source"]), F.lit(', "context": '), quoted_json(r["context"]), F.lit("}")))
    return F.concat(F.lit("["), F.array_join(each, ", "), F.lit("]"))


def datasets_rows(records: DataFrame, run_date: str) -> DataFrame:
    """Rows for the table of records."""
    return records.select(F.lit(run_date).alias("run_date"), F.col("q").alias("query"), F.col("record").alias("full_data_json"), F.col("metrics").alias("judge_metrics_json"), F.current_timestamp().alias("created_at"))
