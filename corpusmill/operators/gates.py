"""Gates: boolean or reason columns that decide what stays. First matching rule wins where a reason is given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import contains_any, has, json_braces, json_greedy, let, strict_object, strip, sub, truncate_int


def facet_reason(label: Column, forbidden: Sequence[str] = fixed.FACET_FORBIDDEN, shortest: int = 2, longest: int = 16, letters: int = 8) -> Column:
    """Why a facet label is refused, empty if it is not."""

    def reason(x: Column) -> Column:
        out = (
            F.when(x == "", fixed.FACET_REASONS[0])
            .when((F.length(x) < shortest) | (F.length(x) > longest), fixed.FACET_REASONS[1] % (shortest, longest))
            .when(contains_any(x, "\n\r\t"), fixed.FACET_REASONS[2])
            .when(F.regexp_count(x, F.lit("[A-Za-z]")) > letters, fixed.FACET_REASONS[3])
            .when(contains_any(x, fixed.FACET_PUNCTUATION), fixed.FACET_REASONS[4])
        )
        for p in forbidden:
            out = out.when(has(F.lower(x), p, "i"), fixed.FACET_REASONS[5] + p)
        return out.otherwise("")

    return let(strip(F.coalesce(label, F.lit(""))), reason)


def sort_facets(facets: DataFrame, record: str, label: str, position: str, **rules) -> DataFrame:
    """Each label stripped, with reason; a repeat of an accepted label is ``duplicate facet``."""
    bare = facets.withColumn(label, strip(F.coalesce(F.col(label), F.lit("")))).withColumn("reason", facet_reason(F.col(label), **rules))
    nth = F.row_number().over(Window.partitionBy(record, label).orderBy(position))
    return bare.withColumn("reason", F.when((F.col("reason") == "") & (nth > 1), fixed.FACET_REASONS[6]).otherwise(F.col("reason")))


def valid_labels(labels: Column, **rules) -> Column:
    """P15 for an array: labels stripped, those without a reason against them, each once in its first place; null is none."""
    bare = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: strip(F.coalesce(x, F.lit(""))))
    return F.array_distinct(F.filter(bare, lambda x: facet_reason(x, **rules) == ""))


def plan_facets(valid: Column, reduced: Column, expanded: Column, **rules) -> Column:
    """Labels of a record after the reducer or the expander.

    All three lists are checked first. Fewer than 2 labels are none. More than
    8 become the reducer's if it gives exactly 8, else the first 8. 3 to 7 are
    joined by the expander's, all of them. 2 and 8 stay.
    """

    def plan(x: Column) -> Column:
        n = F.size(x["v"])
        out = F.when(n < 2, F.array().cast("array<string>")).when(n > 8, F.when(F.size(x["r"]) == 8, x["r"]).otherwise(F.slice(x["v"], 1, 8)))
        return out.when((n > 2) & (n < 8), F.array_union(x["v"], x["e"])).otherwise(x["v"])

    return let(F.struct(valid_labels(valid, **rules).alias("v"), valid_labels(reduced, **rules).alias("r"), valid_labels(expanded, **rules).alias("e")), plan)


def explanation_ok(text: Column) -> Column:
    """4 to 80 characters and no forbidden pattern."""
    out = F.length(strip(text)).between(4, 80)
    for p in fixed.FACET_FORBIDDEN:
        out = out & ~has(F.lower(text), p, "i")
    return out


def answer_reason(body: Column, reasoning: Column, refusals: str = fixed.REFUSALS, pollution: str = fixed.POLLUTION, shortest: int = 120) -> Column:
    """Refusal, pollution, then reasoning that is there but short; empty if none."""
    bare = strip(F.replace(F.replace(reasoning, F.lit("<think>"), F.lit("")), F.lit("</think>"), F.lit("")))
    short = (F.coalesce(reasoning, F.lit("")) != "") & (F.length(bare) < shortest)
    return (
        F.when(has(body, refusals), fixed.GUARD_REASONS[0])
        .when(has(body, pollution), fixed.GUARD_REASONS[1])
        .when(short, F.format_string(fixed.GUARD_REASONS[2], F.length(bare)))
        .otherwise("")
    )


def refused(text: Column, refusals: str = fixed.REFUSALS) -> Column:
    """P18."""
    return has(F.coalesce(text, F.lit("")), refusals)


def purity_bypass(similarity: Column, purified: Column, terms: Sequence[str] = fixed.BYPASS_TERMS) -> Column:
    """The text changed little and names a term."""
    return (similarity > 0.85) & contains_any(F.lower(purified), terms)


def has_signature(text: Column, signatures: Sequence[str]) -> Column:
    """P22."""
    return contains_any(F.coalesce(text, F.lit("")), signatures)


def leak_path(fields: Sequence[tuple[str, Column]], patterns: Sequence[str] = fixed.PROMPT_LEAKS) -> Column:
    """Path and pattern of the first leaf that matches, depth first; null if none does."""
    out = None
    for path, value in fields:
        for p in patterns:
            hit = has(F.lower(value), p, "i")
            found = F.lit(f"{path}: {p}")
            out = F.when(hit, found) if out is None else out.when(hit, found)
    return out


def leak_in_json(document: Column, patterns: Sequence[str] = fixed.PROMPT_LEAKS) -> Column:
    """P23 for JSON of any nesting: ``path: pattern`` of the first text that matches, depth first from ``$``; null if none does or it is no JSON."""

    @F.pandas_udf("string")
    def run(texts):
        import json
        import re

        rules = [(p, re.compile(p, re.IGNORECASE)) for p in patterns]

        def first(text):
            try:
                todo = [("$", json.loads(text))]
            except (TypeError, ValueError):
                return None
            while todo:
                path, value = todo.pop()
                if isinstance(value, str):
                    hit = next((p for p, rule in rules if rule.search(value.lower())), None)
                    if hit is not None:
                        return f"{path}: {hit}"
                elif isinstance(value, dict):
                    todo += [(f"{path}.{k}", v) for k, v in reversed(value.items())]
                elif isinstance(value, list):
                    todo += [(f"{path}[{k}]", v) for k, v in reversed([*enumerate(value)])]
            return None

        return texts.map(first)

    return run(document)


def judge_scores(answer: Column) -> Column:
    """Purity, rigor, depth and reason of a judge's answer, of the JSON object from its first to its last brace.

    Missing scores are 90 (they pass); no answer, or what is not one whole JSON object, is zeros (it does not).
    """

    def read(block: Column) -> Column:
        def value(name: str) -> Column:
            return F.get_json_object(block, f"$.{name}")

        bad = block.isNull()
        scores = {"purity": value("semantic_purity_score"), "rigor": value("medical_rigor_score"), "depth": value("logical_depth_score")}
        fields = [F.when(bad, F.lit(0).cast("bigint")).otherwise(truncate_int(v, fixed.DEFAULT_SCORE)).alias(k) for k, v in scores.items()]
        reason = F.when(bad, "Evaluation error").otherwise(F.coalesce(value("reason"), F.lit("No explanation provided")))
        return F.struct(*fields, reason.alias("reason"))

    return let(strict_object(json_greedy(F.coalesce(answer, F.lit("")))), read)


def purified_enough(scores: Column, simplify: Column) -> Column:
    """P42."""
    return (scores["purity"] >= fixed.PURITY) & (scores["rigor"] >= fixed.RIGOR) & (scores["depth"] >= F.when(simplify, fixed.SIMPLE_DEPTH).otherwise(fixed.DEPTH))


def needs_second_purge(scores: Column, simplify: Column) -> Column:
    """Only purity is low."""
    return (scores["purity"] < fixed.PURITY) & (scores["rigor"] >= fixed.RIGOR) & (scores["depth"] >= F.when(simplify, fixed.SIMPLE_DEPTH).otherwise(fixed.DEPTH))


def five_scores(scores: Sequence[tuple[str, Column]], is_refused: Column, least: float = 6.0) -> Column:
    """Mean, failed dimensions in order, and whether all reach ``least`` without a refusal."""
    values = F.array(*[v.cast("double") for _, v in scores])
    failed = F.filter(F.array(*[F.when(v < least, F.lit(n)) for n, v in scores]), lambda x: x.isNotNull())
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / len(scores)
    return F.struct(mean.alias("mean"), failed.alias("failed"), (F.forall(values, lambda s: s >= least) & ~is_refused).alias("passed"))


def eval_success(schema_ok: Column, is_refused: Column, recall: Column, scores: Column, least: float = 6.0) -> Column:
    """P44."""
    return schema_ok & ~is_refused & (recall >= 0.5) & F.forall(scores, lambda s: s >= least)


def aligned_success(category: Column, is_refused: Column, isolation: Column, grounding: Column, recall: Column, scores: Column, least: float = 6.0) -> Column:
    """By category: a leak case must be isolated, a boundary case grounded, any other one answered well."""
    well = ~is_refused & (recall >= 0.4) & F.forall(scores, lambda s: s >= least)
    return F.when(category == "prompt_leakage", isolation >= least).when(category == "refusal_boundary", grounding >= least).otherwise(well)


def smoothed_term(original: Column, answer: Column) -> Column:
    """The model's term if it is short and no echo of the prompt, else the original."""
    bare = F.translate(strip(answer), "\"'“”", "")
    bad = (bare == "") | (F.length(bare) > 20) | contains_any(bare, ("输入", "输出"))
    return F.when(answer.isNull() | bad, strip(original)).otherwise(bare)


def healed_text(original: Column, cleaned: Column) -> Column:
    """The cleaned text if the original has 50 characters and more than 0.7 of it is left."""
    return F.when((F.length(original) >= 50) & (F.length(cleaned) > 0.7 * F.length(original)), cleaned).otherwise(original)


def corrected_word(original: Column, answer: Column) -> Column:
    """P47."""
    return F.when((strip(answer) != "") & (F.length(strip(answer)) < 15) & ~F.contains(answer, F.lit("修复")), strip(answer)).otherwise(original)


def safe_facet(question: Column, facet: Column) -> Column:
    """A safer name for a facet that does not suit its question, empty if it does."""
    q, f = F.coalesce(question, F.lit("")), F.coalesce(facet, F.lit(""))
    repair = F.lit(fixed.DEFAULT_REPAIR)
    for terms, name in reversed(fixed.REPAIRS):
        repair = F.when(contains_any(q, terms), name).otherwise(repair)
    return (
        F.when(contains_any(q, fixed.ADVERSE) & F.contains(f, F.lit("分子机制")), "不良反应机制边界")
        .when(contains_any(q, fixed.STEADY_STATE) & F.contains(f, F.lit("药物相互作用")), "药代动力学与个体化剂量调整")
        .when(contains_any(f, fixed.BROKEN_FACETS), repair)
        .otherwise("")
    )


def downgrade_skip(question: Column, facet: Column, planners: Column) -> Column:
    """(downgrade, facet, reason); only a row's single planner is kept by a safer facet."""
    safe = safe_facet(question, facet)
    yes = (planners == 1) & (safe != "")
    return F.struct(yes.alias("downgrade"), F.when(yes, safe).otherwise("").alias("facet"), F.when(yes, "single_planner_safe_facet_repair").otherwise("").alias("reason"))


def compatibility(answer: Column) -> Column:
    """Verdict of a classifier's text; without an answer COMPATIBLE."""
    up = F.upper(F.coalesce(answer, F.lit("")))
    return F.when(F.contains(up, F.lit("FORCED_SKIP")), "FORCED_SKIP").when(F.contains(up, F.lit("COMPATIBLE_SIMPLE")), "COMPATIBLE_SIMPLE").otherwise("COMPATIBLE")


def facet_valid(answer: Column) -> Column:
    """Not INVALID; without an answer valid."""
    return ~F.contains(F.upper(F.coalesce(answer, F.lit(""))), F.lit("INVALID"))


def audit_result(answer: Column) -> Column:
    """An audit's answer with its defaults filled in.

    What holds no JSON object is a PARSE_ERROR to review by hand. A verdict
    that is not known is REVIEW. Without a recommended action it follows from
    status and verdict.
    """

    def read(block: Column) -> Column:
        def text_of(name: str, default: str) -> Column:
            return F.coalesce(F.get_json_object(block, f"$.{name}"), F.lit(default))

        bad = block.isNull()
        status = F.when(bad, "PARSE_ERROR").otherwise(text_of("audit_status", "OK"))
        known = F.upper(text_of("verdict", "REVIEW"))
        verdict = F.when(~bad & known.isin("KEEP", "EDIT", "DISCARD"), known).otherwise("REVIEW")
        forced = F.coalesce(F.get_json_object(block, "$.is_forced_facet") == "true", F.lit(False)) & ~bad
        derived = F.when(status != "OK", "MANUAL_REVIEW").when(verdict == "KEEP", "KEEP").when(verdict == "EDIT", "REWRITE").when((verdict == "DISCARD") & forced, "PRUNE").otherwise("MANUAL_REVIEW")
        action = F.when(bad, "MANUAL_REVIEW").otherwise(F.coalesce(F.get_json_object(block, "$.recommended_action"), derived))
        issues = F.when(bad, F.array(F.lit(fixed.PARSE_ISSUE))).otherwise(F.coalesce(F.from_json(F.get_json_object(block, "$.cot_quality_issues"), "array<string>"), F.array().cast("array<string>")))
        quality = F.when(bad, F.lit(0).cast("bigint")).otherwise(truncate_int(F.get_json_object(block, "$.cot_quality_score"), 0))
        return F.struct(
            status.alias("audit_status"), verdict.alias("verdict"), action.alias("recommended_action"), forced.alias("is_forced_facet"), quality.alias("cot_quality_score"), issues.alias("cot_quality_issues"),
            *[F.when(bad, "").otherwise(text_of(n, "")).alias(n) for n in ("forced_facet_reason", "hallucinations_reason", "recommended_edit")],
            (F.coalesce(F.get_json_object(block, "$.hallucinations_detected") == "true", F.lit(False)) & ~bad).alias("hallucinations_detected"),
        )

    return let(strict_object(json_braces(F.coalesce(answer, F.lit("")))), read)


def audit_status(mapping: Column, think: Column) -> Column:
    """(status, recommended action) of what is not asked at all: a mapping error comes before a missing block; AUDIT and null for the rest."""
    unmapped = mapping.isin("AMBIGUOUS_Q", "NO_RAW_MATCH", "UNKNOWN") | mapping.isNull()
    missing = strip(F.coalesce(think, F.lit(""))) == ""
    status = F.when(unmapped, "RAW_MAPPING_ERROR").when(missing, "MISSING_THINK").otherwise("AUDIT")
    action = F.when(unmapped, "RESTORE_OR_MAP_RAW").when(missing, "RESTORE_RAW_OR_REGENERATE")
    issue = F.when(unmapped, fixed.MAPPING_ISSUE).when(missing, fixed.THINK_ISSUE)
    return F.struct(status.alias("status"), action.alias("recommended_action"), issue.alias("issue"))


def loops_or_collapses(text: Column) -> Column:
    """The local gates before a judge is asked."""
    from corpusmill.functions.clean import collapsed
    from corpusmill.functions.text import repeats

    return collapsed(text) | repeats(text) | (sub(text, r"\s") == "")
