"""The audit of planners against the raw corpus, over a table of responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import python_json, short_hash, strip
from corpusmill.functions.think import body_without_thinks, first_think
from corpusmill.operators.boundary import ASK, answered, awaited
from corpusmill.operators.gates import audit_result, audit_status
from corpusmill.operators.linkage import link_records
from corpusmill.operators.ordering import shortened_refs
from corpusmill.operators.rollup import counts_by
from corpusmill.sources.jsonl import exploded

#: What the roll-up of an audit counts.
COUNTED = ("raw_mapping_status", "audit_status", "verdict", "recommended_action")


class UnmappedRefs(RuntimeError):
    """Rows without a raw line, where the audit may not go on without their references."""


def audit(records: DataFrame, raw: DataFrame, responses: DataFrame, start: int = 1, limit: int = 1_000_000, allow_unmapped: bool = False) -> dict[str, DataFrame]:
    """``pending`` requests, ``rows`` (a verdict for each planner) and ``summary`` (four roll-ups).

    Lines ``start`` to ``start + limit - 1`` that parse are linked to the raw
    corpus; a line that cannot be stops the run unless ``allow_unmapped``.
    Mapping errors and missing blocks are not asked about. A call that failed
    is reviewed by hand; a planner that waits has the status PENDING.
    """
    chosen = records.where(F.col("line_num").between(start, start + limit - 1) & (F.col("parse_status") == "ok"))
    linked = link_records(chosen, raw, same_line="SAME_LINE")
    if not allow_unmapped and not linked.where("raw_line is null").isEmpty():
        raise UnmappedRefs("some lines have no raw line")
    known = raw.select(F.col("line_num").alias("raw_line"), F.col("refs").alias("r_refs"), F.col("summary").alias("raw_summary"), F.col("has_history_key").alias("r_history"))
    rows = exploded(linked.join(known, "raw_line", "left")).where("planner_index is not null")
    rows = rows.withColumns({"original_think": strip(first_think(F.col("answer"))), "answer_body": body_without_thinks(F.col("answer")), "ask": F.lit(None).cast(ASK)})
    rows = rows.withColumn("before", audit_status(F.col("mapping_status"), F.col("original_think")))
    # each planner is judged by itself: two lines that read alike are two requests, as their lines and places are named
    place = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("line_num", "raw_line", "planner_index")])
    prompt = F.concat_ws("\n", "q", place, "planner", shortened_refs(F.col("r_refs")), "original_think", "answer_body")
    rows = answered(rows, responses, "audit", "judge", prompt, F.col("before.status") == "AUDIT", ["line_num", "planner_index"])
    rows = rows.withColumn("result", audit_result(F.col("got")))
    stopped, broken = F.col("before.status") != "AUDIT", F.col("failed").isNotNull()
    status = F.when(stopped, F.col("before.status")).when(F.col("ask").isNotNull(), "PENDING").when(broken, "LLM_ERROR").otherwise(F.col("result.audit_status"))
    told = F.when(F.col("before.status") == "MISSING_THINK", fixed.THINK_ERROR).when(broken, F.col("failed")).otherwise("")
    fine = F.col("asked") & ~broken
    planner = python_json({"planner": F.col("planner"), "answer": F.col("answer")})
    out = rows.select(
        F.col("line_num").alias("line"), "raw_line", F.col("mapping_status").alias("raw_mapping_status"), F.col("q").alias("Q"), "planner_index", F.col("planner").alias("facet"), short_hash(planner).alias("input_hash"),
        F.greatest(F.coalesce(F.size("r_refs"), F.lit(0)), F.lit(0)).alias("raw_refs_count"), F.coalesce("r_history", F.lit(False)).alias("raw_has_history"), "original_think", "answer_body",
        F.coalesce("raw_summary", F.lit("")).alias("raw_summary"), status.alias("audit_status"), told.alias("error_message"),
        F.when(fine, F.col("result.verdict")).otherwise("REVIEW").alias("verdict"),
        F.when(fine, F.col("result.recommended_action")).otherwise(F.coalesce("before.recommended_action", F.lit("MANUAL_REVIEW"))).alias("recommended_action"),
        F.when(fine, F.col("result.cot_quality_score")).otherwise(0).alias("cot_quality_score"),
        F.when(fine, F.col("result.cot_quality_issues")).otherwise(F.filter(F.array("before.issue"), lambda x: x.isNotNull())).alias("cot_quality_issues"),
        (fine & F.col("result.is_forced_facet")).alias("is_forced_facet"), (fine & F.col("result.hallucinations_detected")).alias("hallucinations_detected"),
    )
    return {"pending": awaited(rows), "rows": out, "summary": counts_by(out, *COUNTED)}
