"""Composite pipelines over records, planners and request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.clean import clean_for_export, clean_lines, heal_facets, removed_lines
from corpusmill.functions.text import strip
from corpusmill.functions.think import browser_split, compose, split_strict, split_tight
from corpusmill.operators.ordering import first_eligible, first_of_each
from corpusmill.sources.jsonl import exploded, with_healed_facet


def cleanup(planners: DataFrame, **rules) -> DataFrame:
    """Q6: planners with their blocks cleaned line by line; other answers as they are."""
    answer = F.col("answer")
    parts = split_strict(answer)
    return planners.withColumn("answer", F.when(parts["found"], compose(clean_lines(parts["think"], **rules), parts["body"])).otherwise(answer))


def removed(planners: DataFrame, **rules) -> DataFrame:
    """Q15: the lines that cleaning takes out of each block."""
    parts = split_strict(F.col("answer"))
    return planners.where(parts["found"]).select("line_num", "planner", removed_lines(parts["think"], clean_lines(parts["think"], **rules)).alias("removed"))


def sft_rows(records: DataFrame, patterns=fixed.EXPORT_REMOVALS, facet_instruction: str = fixed.FACET_INSTRUCTION, summary_instruction: str = fixed.SUMMARY_INSTRUCTION) -> DataFrame:
    """Q7: facet rows of each record in order, then its summary row; an answer without a leading block stays raw.

    ``line_num`` and ``place`` give the order of the export.
    """
    answer = F.col("answer")
    parts = split_tight(answer)
    output = F.when(parts["found"], compose(clean_for_export(parts["think"], patterns), parts["body"])).otherwise(answer)
    facets = exploded(records).where("planner_index is not null").select(
        "line_num", F.col("planner_index").alias("place"), F.format_string(facet_instruction, F.coalesce("planner", F.lit(""))).alias("instruction"), F.col("q").alias("input"), output.alias("output")
    )
    summaries = records.select("line_num", F.size("planners").alias("place"), F.lit(summary_instruction).alias("instruction"), F.col("q").alias("input"), F.col("summary").alias("output"))
    return facets.unionByName(summaries)


def healed(records: DataFrame, dirty: str, clean: str) -> DataFrame:
    """Q8: records with a facet renamed; ``healed`` tells lines that hold the term anywhere, broken ones changed by text."""
    here = F.contains("raw", F.lit(dirty))
    planners = F.when(F.col("parse_status") == "ok", heal_facets(F.col("planners"), dirty, clean))
    return records.withColumn("healed", here).withColumn("planners", planners).withColumn("raw", with_healed_facet(F.col("raw"), dirty, clean))


def plan_run(records: DataFrame, start: int | None, limit: int, lines: list[int] | None = None, force: bool = False) -> DataFrame:
    """Records with ``chosen`` and the first skip reason that holds. List and start line both apply."""
    done = ~F.col("has_refs_key") & ~F.col("has_history_key")
    thinks = F.exists("planners", lambda p: split_strict(p["answer"])["found"])
    reason = F.when(~F.col("line_num").isin(lines), "not_listed") if lines else F
    if start is not None:
        reason = reason.when(F.col("line_num") < start, "before_start")
    reason = reason.when(F.col("parse_status") != "ok", "unreadable")
    if not force:
        reason = reason.when(done, "already_purified")
    reason = reason.when(~F.coalesce(thinks, F.lit(False)), "no_think")
    marked = first_eligible(records.withColumn("skip_reason", reason), "line_num", F.col("skip_reason").isNull(), limit)
    return marked.withColumn("skip_reason", F.when(F.col("skip_reason").isNull() & ~F.col("chosen"), "over_limit").otherwise(F.col("skip_reason")))


def graph_context(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Context and reference (each text and source) of every entity and relation, missing fields by default; a missing strength is 10."""

    def given(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    name, kind, told = (given(c, d) for c, d in zip(("name", "type", "description"), fixed.ENTITY_DEFAULTS, strict=True))
    told = strip(told)
    source, target, relation, strength = given("sourceName"), given("targetName"), given("relationship"), given("relationshipStrength", "10")
    nodes = entities.select(
        F.format_string(fixed.ENTITY_CONTEXT, name, kind, told).alias("context"), F.format_string(fixed.ENTITY_SOURCE, name).alias("context_source"),
        F.format_string(fixed.ENTITY_REF, name, kind, told).alias("ref"), F.format_string(fixed.ENTITY_REF_SOURCE, name).alias("ref_source"),
    )
    edges = relations.select(
        F.format_string(fixed.RELATION_CONTEXT, source, target, relation, strength).alias("context"), F.format_string(fixed.RELATION_SOURCE, source, target).alias("context_source"),
        F.format_string(fixed.RELATION_REF, source, relation, target).alias("ref"), F.format_string(fixed.RELATION_REF_SOURCE, source, target).alias("ref_source"),
    )
    return nodes.unionByName(edges)


def distinct_refs(refs: DataFrame, record: str, position: str) -> DataFrame:
    """References of each record, the first of each context."""
    return first_of_each(refs, [record, "context"], [position])


def rounds(records: DataFrame) -> DataFrame:
    """History rounds of a record and then the record itself, numbered from 1; ``history`` is an array of (q, answer)."""
    own = F.array_append(F.coalesce("history", F.array().cast("array<struct<q:string,answer:string>>")), F.struct("q", "answer"))
    return records.select("line_num", F.posexplode(own).alias("k", "r")).select("line_num", (F.col("k") + 1).alias("round"), F.col("r.q").alias("q"), browser_split(F.col("r.answer")).alias("parts"))


def repaired_row(planners: Column, drop: str, facet: str, tail: str) -> Column:
    """Without one facet, and another one's answer cut at a draft's beginning."""
    kept = F.filter(planners, lambda p: p["planner"] != drop)
    cut = lambda a: F.when(F.contains(a, F.lit(tail)), F.substring(a, F.lit(1), F.instr(a, tail) - 1)).otherwise(a)
    return F.transform(kept, lambda p: F.struct(p["planner"].alias("planner"), F.when(p["planner"] == facet, cut(p["answer"])).otherwise(p["answer"]).alias("answer")))
