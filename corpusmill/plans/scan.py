"""Static scans of a planner table: what is wrong with which row.

Rows are planners: line_num, q, planner, answer, and for whole records their
parse_status. Term lists are parameters; the fixed values are the defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.clean import evidence_text
from corpusmill.functions.text import contains_any, find_all, group, has, let, logged_fallbacks, strip, terms_in
from corpusmill.functions.think import all_thinks, body_after_last, count_thinks, first_think, split_strict, without_facet_tag
from corpusmill.operators.ordering import placed, severity_rank
from corpusmill.schema import free


def planner_issues(answer: Column, fallbacks=fixed.FALLBACKS, refusals=fixed.SAFE_REFUSALS, noise=fixed.ENGINEERING_NOISE, shortest: int = 80) -> Column:
    """An array of (issue_type, severity, detail) in rule order."""

    def issue(kind: str, severity: str, detail: Column) -> Column:
        return F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), detail.alias("detail"))

    def found(a: Column) -> Column:
        thinks, body = all_thinks(a), body_after_last(a)
        return F.flatten(
            F.array(
                F.transform(terms_in(a, fallbacks), lambda s: issue("FALLBACK_TEMPLATE", "CRITICAL", s)),
                F.transform(terms_in(body, refusals), lambda s: issue("SAFE_REFUSAL_TEMPLATE", "HIGH", s)),
                F.transform(
                    F.filter(F.transform(thinks, lambda t: F.array_join(terms_in(t, noise), ",")), lambda s: s != ""),
                    lambda s: issue("ENGINEERING_NOISE", "MEDIUM", s),
                ),
                F.transform(
                    F.filter(F.transform(thinks, lambda t: F.length(strip(without_facet_tag(t)))), lambda n: n < shortest),
                    lambda n: issue("EMPTY_THINK", "HIGH", n.cast("string")),
                ),
                F.when(~F.contains(a, F.lit("<think>")), F.array(issue("NO_THINK_BLOCK", "MEDIUM", F.lit("")))).otherwise(F.array().cast("array<struct<issue_type:string,severity:string,detail:string>>")),
            )
        )

    return let(answer, found)


def scan(planners: DataFrame, **terms) -> DataFrame:
    """Q1: one row for each issue, with its rank."""
    issues = planners.withColumn("issue", F.explode(planner_issues(F.col("answer"), **terms)))
    return issues.select("line_num", "planner", F.col("issue.issue_type"), F.col("issue.severity"), F.col("issue.detail"), severity_rank(F.col("issue.severity")).alias("rank"))


def scan_report(current: DataFrame, raw: DataFrame) -> dict[str, DataFrame]:
    """Q1: the issues of both corpora (tables of ``scan`` with ``parse_issues``) side by side.

    ``counts``: issues of each corpus by type; ``listed``: all issues of the
    current one, the critical and high ones of the raw one, with the place in
    their corpus by severity and line. Ties go by planner, type and detail.
    """
    both = current.withColumn("corpus", F.lit("current")).unionByName(raw.withColumn("corpus", F.lit("raw")))
    counts = both.groupBy("corpus", "issue_type").agg(F.count(F.lit(1)).alias("n"))
    shown = both.where("corpus = 'current' or severity in ('CRITICAL', 'HIGH')")
    return {"counts": counts, "listed": placed(shown, ["corpus"], ["rank", "line_num", "planner", "issue_type", "detail"], "place")}


def parse_issues(records: DataFrame) -> DataFrame:
    """Lines that are no JSON."""
    return records.where("parse_status = 'error'").select("line_num", F.lit("").alias("planner"), F.lit("JSON_PARSE_ERROR").alias("issue_type"), F.lit("HIGH").alias("severity"), F.lit("").alias("detail"), F.lit(1).alias("rank"))


def issue_counts(issues: DataFrame) -> DataFrame:
    """A2, O1."""
    out = issues.groupBy("issue_type", "severity").agg(F.count(F.lit(1)).alias("n"), F.min("line_num").alias("first_line"))
    return out.orderBy(severity_rank(F.col("severity")), "issue_type")


def think_noise(think: Column) -> Column:
    """Labels of the traces that a block shows."""
    traces = [
        contains_any(think, fixed.TRACE_WORDS[0]), contains_any(think, fixed.TRACE_WORDS[1]), contains_any(think, fixed.TRACE_WORDS[2]),
        has(think, r"\b[Pp]\d+\b"), F.contains(think, F.lit(fixed.TRACE_WORDS[4][0])) & F.contains(think, F.lit(fixed.TRACE_WORDS[4][1])),
    ]
    traces = [F.when(hit, F.lit(label)) for hit, label in zip(traces, fixed.TRACES, strict=True)]
    return F.filter(F.array(*traces), lambda t: t.isNotNull())


def mock_refs(refs: Column, names=fixed.MOCK_NAMES, with_context: bool = True) -> Column:
    """(ref_index, mark) of references, from 0: the name that a made-up one calls a drug, and a label for a crawler's failure."""

    def marks(r: Column, i: Column) -> Column:
        source, context = F.coalesce(r["source"], F.lit("")), F.coalesce(r["context"], F.lit(""))
        name = group(context, fixed.MOCK_NAME, 1)
        failed = F.contains(source, F.lit(fixed.CRAWL_SOURCE))
        if with_context:
            failed = failed | F.contains(context, F.lit(fixed.CRAWL_CONTEXT))
        named = F.when(F.contains(context, F.lit(fixed.MOCK_MARK)) & name.isin(*names), F.struct(i.alias("ref_index"), name.alias("mark")))
        crawled = F.when(failed, F.struct(i.alias("ref_index"), F.lit(fixed.MOCK_FAILURE).alias("mark")))
        return F.filter(F.array(named, crawled), lambda x: x.isNotNull())

    return F.flatten(F.transform(F.coalesce(refs, F.array().cast("array<struct<source:string,context:string>>")), marks))


def corrupted_planner(name: Column, marks=("rigorous data", "Schema")) -> Column:
    """P31."""
    return contains_any(name, marks)


def regressions(joined: DataFrame) -> DataFrame:
    """Rows of ``linkage.by_position`` (planners, refs, has_refs_key, has_history_key and their raw_ twins) with the array ``structural``."""
    empty = F.array().cast("array<struct<planner:string,answer:string>>")
    now, old = count_thinks(F.coalesce("planners", empty)), count_thinks(F.coalesce("raw_planners", empty))
    n, m = F.size(F.coalesce("planners", empty)), F.size(F.coalesce("raw_planners", empty))
    raw_refs = F.coalesce(F.size("raw_refs") > 0, F.lit(False))
    has_refs, had_history = F.coalesce("has_refs_key", F.lit(False)), F.coalesce("raw_has_history_key", F.lit(False))
    rules = [
        F.when(raw_refs & ~has_refs & (now == 0) & (old > 0), F.lit(fixed.STRUCTURAL[0])),
        F.when(raw_refs & ~has_refs & (old > now), F.format_string(fixed.STRUCTURAL[1], old, now)),
        F.when(had_history & ~F.coalesce("has_history_key", F.lit(False)) & (old > now), F.lit(fixed.STRUCTURAL[2])),
        F.when((m > 0) & (n == 0), F.format_string(fixed.STRUCTURAL[3], m)).when(m > n, F.format_string(fixed.STRUCTURAL[4], m, n)),
        F.when(has_refs & (now == 0), F.lit(fixed.STRUCTURAL[5])),
    ]
    return joined.withColumn("structural", F.filter(F.array(*rules), lambda x: x.isNotNull()))


def structural_audit(joined: DataFrame) -> DataFrame:
    """Line, structural findings, corrupted planners, mock references, the number of noisy blocks and, of each, place from 0, planner and labels."""
    out = regressions(joined)
    traced = F.transform("planners", lambda p, i: F.struct(i.alias("planner_index"), p["planner"].alias("planner"), think_noise(split_strict(p["answer"])["think"]).alias("traces")))
    noisy = F.filter(F.transform("planners", lambda p: think_noise(split_strict(p["answer"])["think"])), lambda t: F.size(t) > 0)
    return out.select(
        "line_num", "structural",
        F.transform(F.filter("planners", lambda p: corrupted_planner(p["planner"])), lambda p: F.substring(p["planner"], 1, 80)).alias("corrupted"),
        mock_refs(F.col("refs")).alias("mock_refs"), F.size(noisy).alias("noisy_planners"), F.filter(traced, lambda t: F.size(t["traces"]) > 0).alias("noise"),
    )


def forced_facet(question: Column, facet: Column, think: Column, patterns=fixed.STRUGGLES, simple=fixed.SIMPLE_QUESTIONS, complex_=fixed.COMPLEX_FACETS) -> Column:
    """Marks of a facet that does not suit the question."""
    struggles = F.filter(F.array(*[F.when(has(think, p), F.lit(p)) for p in patterns]), lambda x: x.isNotNull())
    clash = contains_any(question, simple) & facet.isin(*complex_)
    return let(struggles, lambda s: F.when(clash & ((F.size(s) > 0) | (facet == fixed.PRIVACY_FACET)), F.array_append(s, F.lit("semantic clash"))).otherwise(s))


def reasoning_quality(think: Column, connectives: str = fixed.CONNECTIVES) -> Column:
    """(short, leaks, density), density with four places."""
    leaks = [
        contains_any(think, fixed.LEAK_WORDS[0]), contains_any(think, fixed.LEAK_WORDS[1]) & has(think, r"\brefs\b|refs中|根据refs"),
        has(think, r"\b[P|p]\d+\b"), contains_any(think, fixed.LEAK_WORDS[3]),
    ]
    leaks = [F.when(hit, F.lit(label)) for hit, label in zip(leaks, fixed.LEAK_LABELS, strict=True)]
    density = F.regexp_count(think, F.lit("(?Ud)" + connectives)) / F.greatest(F.length(think), F.lit(1))
    return F.struct((F.length(think) < 150).alias("short"), F.filter(F.array(*leaks), lambda x: x.isNotNull()).alias("leaks"), F.format_string("%.4f", density).alias("density"))


def unsupported_numbers(answer: Column, refs_text: Column) -> Column:
    """Sorted numbers of an answer that the references lack and that look like figures."""
    numbers = F.filter(F.array_distinct(find_all(answer, r"\b\d+(?:\.\d+)?%?\b")), lambda n: (F.length(n) > 1) & ~n.startswith("202"))

    def beyond(n: Column) -> Column:
        # by length first, so numbers of any length compare
        digits = F.ltrim(F.regexp_replace(n, r"\D", ""), F.lit("0"))
        return (F.length(digits) > 3) | ((F.length(digits) == 3) & (digits > "500"))

    figures = F.filter(numbers, lambda n: F.contains(n, F.lit("%")) | F.contains(n, F.lit(".")) | beyond(n))
    return F.array_sort(let(refs_text, lambda known: F.filter(figures, lambda n: ~F.contains(known, n))))


def heuristic_audit(planners: DataFrame) -> DataFrame:
    """Q3: planners with line_num, q, planner, answer and refs."""
    # the block is a column of its own: inside arrays an expression is computed for each of its uses
    own = free(planners.columns, "h_think")
    think = F.col(own)
    out = planners.withColumn(own, first_think(F.col("answer"))).select(
        "line_num", "planner", forced_facet(F.col("q"), F.col("planner"), think).alias("forced"), reasoning_quality(think).alias("quality"),
        mock_refs(F.col("refs"), fixed.MOCK_NAMES_V2, with_context=False).alias("mock_refs"), unsupported_numbers(F.col("answer"), evidence_text(F.col("refs"), False, " ")).alias("numbers"),
    )
    wrong = (F.size("forced") > 0) | F.col("quality.short") | (F.size("quality.leaks") > 0) | (F.size("mock_refs") > 0) | (F.size("numbers") > 0)
    return out.where(wrong)


def verification(planners: DataFrame, banned=fixed.BANNED, indicators=None) -> DataFrame:
    """Banned words and missing indicators of planners that begin with a block."""
    indicators = fixed.INDICATORS if indicators is None else indicators
    missing = [F.when(F.contains("q", F.lit(t)), F.filter(F.array(*map(F.lit, terms)), lambda i: ~F.contains("v_think", i) & ~F.contains("v_body", i))).otherwise(F.array().cast("array<string>")) for t, terms in indicators.items()]
    out = planners.withColumn("v", split_strict(F.col("answer"))).where("v.found").withColumn("v_think", F.col("v.think")).withColumn("v_body", F.col("v.body"))
    return out.select("line_num", "planner", terms_in(F.col("v_think"), banned).alias("banned"), F.flatten(F.array(*missing)).alias("missing"))


def audit_subtotals(audited: DataFrame) -> DataFrame:
    """A10, Q2: lines of ``structural_audit`` with a finding of each kind."""
    kinds = {"structural": F.size("structural") > 0, "corrupted": F.size("corrupted") > 0, "mock_refs": F.size("mock_refs") > 0, "noisy": F.col("noisy_planners") > 0}
    return audited.agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])


def family_counts(audited: DataFrame) -> DataFrame:
    """A10, Q3: planners of ``heuristic_audit`` in each family of issues."""
    quality = F.col("quality.short") | (F.size("quality.leaks") > 0)
    kinds = {"forced": F.size("forced") > 0, "quality": quality, "hallucinations": (F.size("mock_refs") > 0) | (F.size("numbers") > 0)}
    return audited.agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])


def logged(logs: DataFrame, signatures=fixed.LOG_FALLBACKS) -> DataFrame:
    """fallback signatures of run logs (file, value), one row for each that a log holds."""
    return logs.select("file", F.inline(logged_fallbacks(F.col("value"), signatures)))


def verification_totals(rows: DataFrame) -> DataFrame:
    """Checks, leaks, failures and the leak rate in percent."""
    n = F.count(F.lit(1))
    return rows.agg(n.alias("checks"), F.count_if(F.size("banned") > 0).alias("leaks"), F.count_if(F.size("missing") > 0).alias("failures"), (F.coalesce(F.count_if(F.size("banned") > 0) / n, F.lit(0.0)) * 100).alias("leak_rate"))


def suspicious(question: Column, answer: Column, terms=fixed.SUSPICIOUS) -> Column:
    """Terms of another trade in an answer whose question does not ask for it."""
    return contains_any(answer, terms) & ~F.contains(question, F.lit("企业"))
