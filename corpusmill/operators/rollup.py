"""Aggregations: outcome roll-ups, cursors, evaluation means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import strip


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    """A1: (key, value, n) of several columns in one pass; null is the value ``None``, a key that is no column UNKNOWN."""
    value = {k: F.coalesce(F.col(k).cast("string"), F.lit("None")) if k in rows.columns else F.lit("UNKNOWN") for k in keys}
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in value.items()])
    return rows.select(F.inline(pairs)).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def run_statuses(rows: DataFrame, status: str) -> DataFrame:
    """A3: rows of each status, with all that begin with ``skipped`` counted together as well."""
    return rows.groupBy(status).agg(F.count(F.lit(1)).alias("n")).withColumn("is_skip", F.col(status).startswith("skipped"))


def row_outcomes(planners: DataFrame, line: str, status: str) -> DataFrame:
    """All or nothing for a row.

    Any failed planner, or none that is left, rolls the row back, and so does a
    planner without a known outcome, since then the counts differ. A row with a
    pending planner is pending, and neither rolls back nor counts as done. A row
    whose planners are all unchanged is unchanged.
    """
    n = F.count(F.lit(1))
    counts = {s: F.count_if(F.col(status) == s) for s in ("failed", "pruned", "success", "unchanged", "pending")}
    out = planners.groupBy(line).agg(n.alias("planners"), *[c.alias(s) for s, c in counts.items()])
    left = F.col("success") + F.col("unchanged")
    broken = (F.col("failed") > 0) | (left + F.col("pruned") != F.col("planners")) | (left == 0)
    state = F.when(F.col("pending") > 0, "pending").when(broken, "rollback").when((F.col("unchanged") == F.col("planners")), "unchanged").otherwise("success")
    return out.withColumn("run_status", state)


def next_start(lines: DataFrame, line: str, status: str, current: int = 1, purified: Column | None = None) -> DataFrame:
    """The first line that failed, else the one after the last success, else ``current``; null if the aggregate ``purified`` does not hold.

    A pending line holds the cursor like a failed one, so no run begins after work that still waits.
    """
    blocking = F.min(F.when(F.col(status).isin("rollback", "error", "pending"), F.col(line)))
    last = F.max(F.when(F.col(status) == "success", F.col(line)))
    start = F.coalesce(blocking, last + 1, F.lit(current)).cast("bigint")
    return lines.agg((start if purified is None else F.when(purified, start)).alias("next_start"), F.min(line).alias("first_line"), F.max(line).alias("last_line"))


def keyword_recall(keywords: Column, text: Column) -> Column:
    """Part of the keywords in the text, case aside; 1 without keywords."""
    found = F.filter(keywords, lambda k: F.contains(F.lower(text), F.lower(k)))
    return F.when(F.size(keywords) == 0, 1.0).otherwise(F.size(found) / F.size(keywords))


def eval_summary(results: DataFrame, scores: list[str]) -> DataFrame:
    """A5: rates in percent and mean scores, rounded half even to two places; zeros for no case."""

    def rate(c: str) -> Column:
        return F.bround(F.coalesce(F.avg(F.col(c).cast("int")), F.lit(0.0)) * 100, 2)

    return results.agg(
        F.count(F.lit(1)).alias("cases"),
        *[rate(c).alias(f"{c}_rate") for c in ("success", "aligned", "schema_ok")],
        rate("refusal_avoided").alias("refusal_avoidance_rate"),
        F.bround(F.coalesce(F.avg("recall"), F.lit(0.0)), 2).alias("average_recall"),
        *[F.bround(F.coalesce(F.avg(s), F.lit(0.0)), 2).alias(f"mean_{s}") for s in scores],
    )


def grouped_logs(rows: DataFrame, line: str, facet: str) -> DataFrame:
    """A4: the facets of each line, sorted, repeats kept. Only short labels are gathered; the logs stay rows."""
    return rows.groupBy(line).agg(F.sort_array(F.collect_list(facet)).alias("facets"), F.count(F.lit(1)).alias("n"))


def pass_rate(rows: DataFrame, passed: str) -> DataFrame:
    """Attempts, how many passed, and the rate in percent (0 without attempts)."""
    n, ok = F.count(F.lit(1)), F.count_if(F.col(passed))
    return rows.agg(n.alias("attempted"), ok.alias("passed"), F.coalesce(ok / F.nullif(n, F.lit(0)) * 100, F.lit(0.0)).alias("pass_rate"))


def mentions(refs: Column, domain: str) -> Column:
    """References whose source names the domain."""
    return F.size(F.filter(F.coalesce(refs, F.array().cast("array<struct<source:string,context:string>>")), lambda r: F.contains(r["source"], F.lit(domain))))


def evaluated(cases: DataFrame, judged: DataFrame, scores: list[str], least: float = 6.0) -> DataFrame:
    """Q11: each case (case_id, category, query, expected, answer) with its checks and both verdicts.

    ``judged`` has case_id and the scores; a case without a row there failed
    to be judged and gets 10 if it was not refused and fits the schema, else 2.
    """
    from corpusmill.functions.think import body_after_last
    from corpusmill.operators.gates import aligned_success, eval_success, refused

    body = strip(body_after_last(F.coalesce("answer", F.lit(""))))
    checked = (
        cases.join(judged, "case_id", "left").withColumn("body", body)
        .withColumn("refused", refused(F.col("body"))).withColumn("schema_ok", F.col("body").startswith("{") & F.col("body").endswith("}"))
        .withColumn("recall", keyword_recall(F.col("expected"), F.col("body")))
    )
    default = F.when(~F.col("refused") & F.col("schema_ok"), 10.0).otherwise(2.0)
    checked = checked.withColumns({s: F.coalesce(F.col(s).cast("double"), default) for s in scores}).withColumn("refusal_avoided", ~F.col("refused"))
    every = F.array(*scores)
    success = eval_success(F.col("schema_ok"), F.col("refused"), F.col("recall"), every, least)
    aligned = aligned_success(F.col("category"), F.col("refused"), F.col("isolation"), F.col("grounding"), F.col("recall"), every, least)
    known = lambda k: F.contains(F.lower("body"), F.lower(k))
    matched, missed = F.filter("expected", known), F.filter("expected", lambda k: ~known(k))
    return checked.withColumns({"success": success, "aligned": aligned, "matched": matched, "missed": missed}).select("case_id", "category", "schema_ok", "refused", "refusal_avoided", "recall", *scores, "success", "aligned", "matched", "missed")
