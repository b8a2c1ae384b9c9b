"""Purification runs over a table of responses: planners step by step, then rows all or nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.clean import academic_codes, clean_lines, code_context, collapsed, drop_unsupported, evidence_text, scrub_leakage, strip_noise
from corpusmill.functions.text import feedback, repeats, similarity, strict_json, strip, unfence
from corpusmill.functions.think import compose, facet_and_rest, split_strict
from corpusmill.operators import gates
from corpusmill.operators.boundary import ASK, answered, awaited
from corpusmill.operators.linkage import link_records
from corpusmill.operators.rollup import mentions, next_start, row_outcomes
from corpusmill.plans.pipelines import plan_run
from corpusmill.sources.jsonl import exploded, with_fields
from corpusmill.sources.staging import staged

KEYS = ["line_num", "planner_index"]


def bare_answer(text: Column) -> Column:
    """What a model wrote, without tags of a block and without a code fence."""
    return unfence(strip(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("<think>"), F.lit("")), F.lit("</think>"), F.lit(""))))


def _scores(values: tuple[int, int, int], reason: str) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(k) for v, k in zip(values, ("purity", "rigor", "depth"), strict=True)], F.lit(reason).alias("reason"))


def _attempt(rows: DataFrame, responses: DataFrame, last: bool) -> DataFrame:
    """One rewrite of rows without a status: rewrite, heal, local gates, judge, second purge.

    A rewrite call that failed leaves the row as it is for the next attempt;
    after the last one the row has failed.
    """
    open_, simple = F.col("status").isNull(), F.col("simplify")
    rows = answered(rows, responses, "rewrite", "premium", F.concat_ws("\n", "name", "q", "ready", "feedback"), open_, KEYS)
    rows = rows.withColumn("live", F.col("asked") & F.col("failed").isNull()).withColumn("text", F.when(F.col("live"), bare_answer(F.col("got"))))
    rows = answered(rows, responses, "heal", "lightweight", F.col("text"), F.col("live") & (F.length(strip(F.col("text"))) >= 50), KEYS)
    rows = rows.withColumn("text", F.when(F.col("asked"), gates.healed_text(F.col("text"), bare_answer(F.col("got")))).otherwise(F.col("text")))
    stopped = F.when(collapsed(F.col("text")), _scores(fixed.COLLAPSED_SCORES, "format collapse")).when(repeats(F.col("text")), _scores(fixed.LOOPING_SCORES, "repetition loop"))
    rows = rows.withColumn("live", F.col("live") & F.col("ask").isNull()).withColumn("scores", F.when(F.col("live"), stopped))
    rows = answered(rows, responses, "judge", "judge", F.concat_ws("\n", "q", "name", "think", "text"), F.col("live") & F.col("scores").isNull(), KEYS)
    rows = rows.withColumn("scores", F.when(F.col("asked"), gates.judge_scores(F.col("got"))).otherwise(F.col("scores"))).withColumn("live", F.col("live") & F.col("ask").isNull())
    # Only purity is low, so the text is purged once more and judged again
    rows = answered(rows, responses, "second_purge", "lightweight", F.col("text"), F.col("live") & gates.needs_second_purge(F.col("scores"), simple), KEYS)
    rows = rows.withColumn("again", F.when(F.col("asked") & F.col("failed").isNull(), bare_answer(F.col("got"))))
    rows = answered(rows, responses, "judge", "judge", F.concat_ws("\n", "q", "name", "think", "again"), F.col("again").isNotNull(), KEYS)
    rows = rows.withColumn("second", F.when(F.col("asked"), gates.judge_scores(F.col("got"))))
    better = F.coalesce(F.col("second.purity") >= fixed.PURITY, F.lit(False))
    # the gate holds the new purity against the first verdict's rigor and depth; what is kept is the whole second verdict
    rows = rows.withColumn("gate", F.when(better, F.col("scores").withField("purity", F.col("second.purity"))).otherwise(F.col("scores")))
    rows = rows.withColumn("text", F.when(better, F.col("again")).otherwise(F.col("text"))).withColumn("scores", F.when(better, F.col("second")).otherwise(F.col("scores")))
    rows = rows.withColumn("live", F.col("live") & F.col("ask").isNull())
    rows = rows.withColumn("passed", F.coalesce(F.col("live") & gates.purified_enough(F.col("gate"), simple), F.lit(False)))
    told = feedback(F.col("gate.purity"), F.col("gate.rigor"), F.col("gate.depth"))
    rows = rows.withColumns(
        {
            "purified": F.when(F.col("passed"), F.col("text")).otherwise(F.col("purified")),
            "last_scores": F.when(F.col("live"), F.col("scores")).otherwise(F.col("last_scores")),
            "feedback": F.when(F.col("live") & ~F.col("passed"), told).otherwise(F.col("feedback")),
            "status": F.when(F.col("passed"), "success").otherwise(F.col("status")),
        }
    )
    if last:
        over = F.col("status").isNull() & F.col("ask").isNull()
        rows = rows.withColumns({
            "reason": F.when(over, "quality gate failure").otherwise(F.col("reason")), "status": F.when(over, "failed").otherwise(F.col("status")),
            # what stands for a rewrite that never passed: the block cleaned line by line, with scores of its own
            "purified": F.when(over, clean_lines(F.col("think"))).otherwise(F.col("purified")),
            "last_scores": F.when(over, _scores(fixed.FALLBACK_SCORES, fixed.FALLBACK_REASON)).otherwise(F.col("last_scores")),
        })
    return rows.drop("live", "text", "scores", "gate", "again", "second", "passed", "got", "failed", "asked")


def repaired_entities(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """The texts of planners that succeeded with codes of entities put right, each in its order.

    Known codes stay, those with a known correction get it. Any other is
    searched for; one that no reference of the literature's site names is
    asked about with the text around it, and the answer takes its place if it
    is a short word. A call that failed leaves its code. A planner that waits
    for one of its codes is not done yet.
    """
    fixes = F.create_map(*[F.lit(x) for pair in fixed.CODE_REPAIRS for x in pair])
    done = rows.where((F.col("status") == "success") & F.col("ask").isNull())
    each = done.select(*KEYS, "purified", F.explode(academic_codes(F.col("purified"))).alias("code")).withColumn("ask", F.lit(None).cast(ASK))
    each = staged(each.withColumn("word", F.element_at(fixes, F.col("code"))))
    if each.isEmpty():
        return rows
    keys = [*KEYS, "code"]
    each = answered(each, responses, "search", "search", F.col("code"), F.col("word").isNull(), keys)
    refs = F.from_json(strict_json(F.col("got")), "array<struct<source:string,context:string>>")
    each = each.withColumn("unknown", F.col("asked") & F.col("failed").isNull() & (mentions(refs, "ncbi.nlm.nih.gov") == 0))
    each = answered(each, responses, "repair", "lightweight", F.concat_ws("\n", "code", code_context(F.col("purified"), F.col("code"))), F.col("unknown"), keys)
    said = strip(F.replace(F.replace(F.translate(F.col("got"), "\"'", ""), F.lit("<think>"), F.lit("")), F.lit("</think>"), F.lit("")))
    each = each.withColumn("word", F.coalesce("word", F.when(F.col("asked") & F.col("failed").isNull(), gates.corrected_word(F.col("code"), said))))
    pairs = F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("code", "word"))))
    found = each.groupBy(*KEYS).agg(pairs.alias("e_pairs"), F.first("ask", ignorenulls=True).alias("e_ask"))
    out = rows.join(found, KEYS, "left")
    text = F.aggregate("e_pairs", F.col("purified"), lambda t, p: F.replace(t, p["code"], p["word"]))
    waits = F.col("e_ask").isNotNull()
    out = out.withColumns({"purified": F.when(F.col("e_pairs").isNotNull() & ~waits, text).otherwise(F.col("purified")), "ask": F.coalesce("ask", "e_ask"), "status": F.when(waits, F.lit(None)).otherwise(F.col("status"))})
    return staged(out.drop("e_pairs", "e_ask"))


def planner_outcomes(planners: DataFrame, responses: DataFrame, allow_prune: bool = False, attempts: int = 3) -> DataFrame:
    """Q9 for planners: line_num, planner_index, planner, q, answer, n (planners of the row) and evidence, with status, reason, name, new_answer and ask.

    Signatures fail a planner at once. An invalid name is replaced, a facet
    that does not suit its question is renamed, pruned or fails. Calls that
    failed count as valid and compatible. A planner that waits for a response
    is ``pending``.
    """
    rows = planners.withColumn("s", split_strict(F.col("answer"))).withColumn("ask", F.lit(None).cast(ASK))
    rows = rows.withColumns({"found": F.col("s.found"), "body": F.col("s.body"), "block": F.col("s.think")}).drop("s")
    template, safe = gates.has_signature(F.col("answer"), fixed.TEMPLATE_SIGNATURES), gates.has_signature(F.col("answer"), fixed.SAFE_BODY_SIGNATURES)
    reason = F.when(template, "template signature detected").when(safe, "safety warning signature detected")
    rows = rows.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNotNull(), "failed"))
    open_ = F.col("status").isNull()
    rows = answered(rows, responses, "facet_validity", "lightweight", F.col("planner"), open_, KEYS)
    repaired = gates.safe_facet(F.col("q"), F.col("planner"))
    rows = rows.withColumn("name", F.when(~F.col("asked") | gates.facet_valid(F.col("got")), F.col("planner")).when(repaired != "", repaired).otherwise(fixed.INVALID_FACET))
    rows = answered(rows, responses, "compatibility", "lightweight", F.concat_ws("\n", "q", "name"), open_, KEYS)
    rows = rows.withColumn("verdict", F.when(F.col("asked"), gates.compatibility(F.col("got"))).otherwise("COMPATIBLE")).withColumn("down", gates.downgrade_skip(F.col("q"), F.col("name"), F.col("n")))
    skip = F.col("verdict") == "FORCED_SKIP"
    rows = rows.withColumn("lowered", skip & F.col("down.downgrade")).withColumn("forced", skip & ~F.col("down.downgrade"))
    rows = rows.withColumn("name", F.when(F.col("lowered"), F.col("down.facet")).otherwise(F.col("name"))).withColumn("simplify", F.col("lowered") | (F.col("verdict") == "COMPATIBLE_SIMPLE"))
    told = "semantic compatibility forced skip" + ("" if allow_prune else " without prune permission")
    kept = F.col("status").isNotNull() | F.col("ask").isNotNull()
    rows = rows.withColumn("reason", F.when(kept, F.col("reason")).when(F.col("forced"), told).when(~F.col("found"), "no think block"))
    rows = rows.withColumn("status", F.when(kept, F.col("status")).when(F.col("forced"), "pruned" if allow_prune else "failed").when(~F.col("found"), "unchanged"))
    rows = rows.withColumn("f", facet_and_rest(F.col("block"), F.col("name")))
    tag = F.when(F.col("name") == F.col("planner"), F.col("f.tag")).otherwise(F.concat(F.lit("<facet = "), "name", F.lit(">")))
    rows = rows.withColumn("think", F.col("f.rest")).withColumn("tag", tag).drop("f", "down", "lowered", "forced", "got", "failed", "asked")
    rows = rows.withColumn("ready", drop_unsupported(strip_noise(F.col("think")), F.col("evidence")))
    empty = F.lit(None).cast("struct<purity:bigint,rigor:bigint,depth:bigint,reason:string>")
    rows = rows.withColumns({"feedback": F.lit(""), "purified": F.lit(None).cast("string"), "last_scores": empty})
    # each step is written, so that plans stay short and only rows that are still open are asked about again
    rows, done = staged(rows), []
    open_ = F.col("status").isNull() & F.col("ask").isNull()
    for k in range(attempts):
        done.append(rows.where(~open_))
        rows = rows.where(open_)
        if rows.isEmpty():
            break
        rows = staged(_attempt(rows, responses, k == attempts - 1))
    rows = repaired_entities(reduce(DataFrame.unionByName, done, rows), responses)
    body = drop_unsupported(scrub_leakage(F.col("body")), F.col("evidence"), spaces=r"[ \t]{2,}")
    rows = rows.withColumn("new_body", F.when(F.col("status") == "success", body)).withColumn("status", F.when(F.col("ask").isNotNull(), "pending").otherwise(F.col("status")))
    near = similarity(F.col("think"), F.coalesce("purified", F.lit("")))
    rows = rows.withColumns(
        {
            "new_answer": F.when(F.col("status") == "success", compose(F.col("purified"), F.col("new_body"), F.col("tag"))).otherwise(F.col("answer")),
            "new_name": F.when(F.col("status") == "success", F.col("name")).otherwise(F.col("planner")),
            "purity_bypass": gates.purity_bypass(near, F.coalesce("purified", F.lit(""))),
            "reason": F.when(F.col("status") == "success", "purified").when(F.col("status") == "pending", "waits for a response").otherwise(F.col("reason")),
        }
    )
    return staged(rows)


def diffs(outcome: DataFrame) -> DataFrame:
    """A row of each planner that succeeded, before and after, with what was done to it."""
    done, scrubbed = outcome.where("status = 'success'"), scrub_leakage(F.col("body"))
    steps = F.array(
        F.lit("rewrite_think_with_fact_anchored_purification_engine"),
        F.concat(F.lit("semantic_compatibility="), F.when(F.col("simplify"), "COMPATIBLE_SIMPLE").otherwise(F.col("verdict"))),
        F.when(F.col("name") != F.col("planner"), F.concat(F.lit("repair_planner_name:"), "planner", F.lit("->"), "name")),
        F.when(F.col("simplify"), F.lit("apply_simplified_reasoning_mode")),
        F.when(scrubbed != F.col("body"), F.lit("scrub_engineering_leakage_from_answer_body")),
        F.when(F.col("new_body") != scrubbed, F.lit("scrub_unsupported_official_identifiers_from_answer_body")),
        F.lit("regenerate_summary_after_planner_purification"),
    )
    return done.select(
        F.col("line_num").alias("line_number"), "planner_index", F.col("q").alias("question"), F.col("name").alias("facet"), F.col("block").alias("original"), "purified",
        F.col("body").alias("original_answer_body"), F.col("new_body").alias("purified_answer_body"), F.filter(steps, lambda x: x.isNotNull()).alias("operations"), F.col("last_scores").alias("scores"), "simplify",
    )


def analysed(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """Rows of ``diffs`` with what a model says of the change (the first 1,200 characters of both texts are shown), a fixed notice if the call failed, null while it waits; and ask."""
    shown = [F.substring(c, 1, fixed.SHOWN) for c in ("original", "purified")]
    prompt = F.concat_ws("\n", "question", "facet", F.col("scores.reason"), F.when(F.col("simplify"), F.lit("simple")), *shown)
    rows = answered(rows.withColumn("ask", F.lit(None).cast(ASK)), responses, "diff_analysis", "lightweight", prompt, F.lit(True), ["line_number", "planner_index"])
    told = F.when(F.col("failed").isNotNull(), fixed.FAILED_ANALYSIS).otherwise(strip(F.col("got")))
    return staged(rows.withColumn("analysis", F.when(F.col("asked"), told)).drop("got", "failed", "asked"))


def purify(records: DataFrame, raw: DataFrame, responses: DataFrame, start: int | None = 1, limit: int = 1_000_000, allow_prune: bool = False, attempts: int = 3, lines: list[int] | None = None) -> dict[str, DataFrame]:
    """Q9: a run over a table of responses, which it never makes up.

    Returns ``pending`` requests, ``planners`` with their outcome, ``rows``
    with run_status, ``audit`` events, ``diffs`` of rows that succeeded,
    ``lines`` to write and the ``cursor``. Diffs carry an analysis, which no
    row waits for. A row succeeds only if all its
    planners do (pruned ones leave) and its summary is made anew; then history
    and refs go and all other fields stay. A row that rolls back or is pending
    keeps its raw text. The cursor is null after a run with an explicit list
    or one that purified nothing.
    """
    chosen = plan_run(records, start, limit, lines).where("chosen")
    linked = link_records(chosen, raw)
    refs = raw.select(F.col("line_num").alias("raw_line"), F.col("refs").alias("raw_refs"))
    planners = exploded(linked.join(refs, "raw_line", "left")).where("planner_index is not null").select(
        "line_num", "planner_index", "planner", "q", "answer", F.size("planners").alias("n"), evidence_text(F.coalesce("refs", "raw_refs")).alias("evidence")
    )
    outcome = planner_outcomes(planners, responses, allow_prune, attempts)
    event = F.struct("planner_index", F.col("name").alias("planner"), "status", "reason")
    kept = F.when(F.col("status") != "pruned", F.struct("planner_index", F.col("new_name").alias("planner"), F.col("new_answer").alias("answer"), F.coalesce("new_body", "body").alias("body")))
    gathered = outcome.groupBy("line_num").agg(F.sort_array(F.collect_list(event)).alias("events"), F.sort_array(F.collect_list(kept)).alias("kept"), F.first("q").alias("q"))
    counted = row_outcomes(outcome, "line_num", "status").select("line_num", F.col("planners").alias("before"), F.col("pruned").alias("pruned_count"), F.col("success").alias("purified_facets"), F.col("run_status").alias("decided"))
    rows = counted.join(gathered, "line_num").withColumn("ask", F.lit(None).cast(ASK))
    shown = F.array_join(F.transform("kept", lambda p: F.concat(F.lit("["), p["planner"], F.lit("] "), F.substring(p["body"], 1, fixed.SUMMARY_BODY))), "\n")
    rows = answered(rows, responses, "summary", "premium", F.concat_ws("\n", "q", F.substring(shown, 1, fixed.SUMMARY_ALL)), F.col("decided") == "success", ["line_num"])
    rows = rows.withColumn("new_summary", strip(F.coalesce("got", F.lit(""))))
    lost, waits = F.col("asked") & (F.col("new_summary") == ""), F.col("ask").isNotNull() | (F.col("decided") == "pending")
    status = F.when(waits, "pending").when(lost, "rollback").otherwise(F.col("decided"))
    reason = (
        F.when(waits, "waits for a response").when(lost, F.concat(F.lit("summary regeneration failed: "), F.coalesce("failed", F.lit("empty summary")))).when(F.col("decided") == "success", "purified")
        .when(F.col("decided") == "unchanged", "no local diff logs and no pruned planners").otherwise("planner purification failed or planner count changed")
    )
    rows = staged(rows.withColumn("run_status", status).withColumn("reason", reason))
    changes = F.to_json(F.struct(F.transform("kept", lambda p: F.struct(p["planner"].alias("planner"), p["answer"].alias("answer"))).alias("planners"), F.col("new_summary").alias("summary")))
    done = rows.where("run_status = 'success'")
    new = records.select("line_num", "raw").join(done.select("line_num", changes.alias("changes")), "line_num").select("line_num", with_fields(F.col("raw"), F.col("changes"), ("history", "refs")).alias("new_raw"))
    mapped = linked.select("line_num", "raw_line", F.col("mapping_status").alias("raw_mapping_status"))
    audit = rows.join(mapped, "line_num").select(
        F.col("line_num").alias("line_number"), "run_status", "reason", F.col("q").alias("question"), "raw_line", "raw_mapping_status", F.col("before").alias("planner_count_before"),
        F.size("kept").alias("planner_count_after"), "pruned_count", F.when(F.col("run_status") == "success", F.col("purified_facets")).alias("purified_facets"), F.col("events").alias("planners"),
    )
    changed = analysed(diffs(outcome).join(done.select(F.col("line_num").alias("line_number")), "line_number", "left_semi"), responses)
    waiting = outcome.select("ask").unionByName(rows.select("ask")).unionByName(changed.select("ask"))
    wrote = F.count_if(F.col("run_status") == "success") > 0
    cursor = next_start(rows, "line_num", "run_status", purified=wrote if not lines else F.lit(False))
    return {
        "pending": awaited(waiting), "planners": outcome, "rows": rows.select("line_num", "run_status", "reason"), "audit": audit,
        "diffs": changed.drop("ask"),
        "lines": records.select("line_num", "raw").join(new, "line_num", "left").select("line_num", F.coalesce("new_raw", "raw").alias("raw")), "cursor": cursor,
    }
