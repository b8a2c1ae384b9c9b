"""Reports and logs: Markdown in and out, key-value stores."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import find_all, group, logged_line
from corpusmill.sources.ordered import write_one_file
from corpusmill.sources.staging import staged


def logged_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """Line numbers named in run logs, one row each."""
    # Spark gives the name as it stands in a URI
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    text = spark.read.text(pattern, wholetext=True).select(name.alias("file"), "value")
    return text.select("file", F.explode(logged_line(F.col("value"))).alias("line_num"))


def logged_ranges(logged: DataFrame) -> DataFrame:
    """First and last line of each file of ``logged_lines``, and the file's name with both in it, before its time if it has one."""
    ranges = logged.groupBy("file").agg(F.min("line_num").alias("first_line"), F.max("line_num").alias("last_line"))
    stem = F.regexp_replace("file", r"(_\[\d+-\d+\])?(_\d{8}_\d{6})?\.md$", "")
    time = group(F.col("file"), r"(_\d{8}_\d{6})\.md$", 1)
    return ranges.withColumn("new_name", F.concat(stem, F.format_string("_[%d-%d]", "first_line", "last_line"), time, F.lit(".md")))


def report_blocks(lines: DataFrame) -> DataFrame:
    """Blocks of a report that begin with ``## ``, sorted by line and facet and numbered again.

    ``lines`` has doc, line_num and raw. Blocks without a line number come last (9999).
    """
    at = Window.partitionBy("doc").orderBy("line_num").rowsBetween(Window.unboundedPreceding, 0)
    cut = lines.withColumn("block", F.sum(F.col("raw").startswith("## ").cast("int")).over(at)).where("block > 0")
    blocks = cut.groupBy("doc", "block").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_num", "raw"))), lambda x: x["raw"]), "\n").alias("text"))
    line = F.coalesce(F.get(find_all(F.col("text"), r"数据集第 (\d+) 行", 1), F.lit(0)).try_cast("bigint"), F.lit(9999))
    keyed = blocks.withColumn("line", line).withColumn("facet", group(F.col("text"), r"切面[:：]\s*([^\n]*)", 1))
    return keyed.withColumn("number", F.row_number().over(Window.partitionBy("doc").orderBy("line", "facet", "block")))


def diff_report(diffs: DataFrame) -> DataFrame:
    """A Markdown section for each line, facets sorted, one row a line."""
    part = F.format_string("### %s\n\n- before: %s\n- after: %s\n", "facet", "original", "purified")
    return diffs.withColumn("part", part).groupBy("line_number").agg(
        F.concat(F.format_string("## line %d\n\n", F.first("line_number")), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("facet", "part"))), lambda x: x["part"]), "\n")).alias("markdown")
    )


def run_report(diffs: DataFrame, rows: DataFrame) -> DataFrame:
    """The whole report of a run as (place, markdown): counts and rows by status, rows that rolled back or failed, then a section for each line.

    ``rows`` has line_num, run_status and reason. ``write_report`` makes one
    file of it. A run that did nothing has its counts only.
    """
    done = diffs.agg(F.count_distinct("line_number").alias("n"), F.count(F.lit(1)).alias("m")).select(
        F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("line"), F.format_string("# Purification run\n\n- lines purified: %d\n- facets purified: %d", "n", "m").alias("markdown")
    )
    status = F.when(F.col("run_status").startswith("skipped"), "skipped").otherwise(F.col("run_status"))
    statuses = rows.groupBy(status.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("line_num").alias("first"))
    counted = statuses.select(F.lit(1).alias("part"), F.col("first").cast("bigint").alias("line"), F.format_string("- %s: %d", "s", "n").alias("markdown"))
    failed = rows.where("run_status in ('rollback', 'error')").select(F.lit(2).alias("part"), F.col("line_num").cast("bigint").alias("line"), F.format_string("- line %d, %s: %s", "line_num", "run_status", F.coalesce("reason", F.lit("N/A"))).alias("markdown"))
    sections_ = diff_report(diffs).select(F.lit(3).alias("part"), F.col("line_number").cast("bigint").alias("line"), F.concat(F.lit("\n"), "markdown").alias("markdown"))
    return done.unionByName(counted).unionByName(failed).unionByName(sections_)


def write_report(report: DataFrame, path: str) -> str:
    """``run_report`` as one file."""
    return write_one_file(report, path, "part", "line", "markdown", text="markdown")


def append_rejections(audits: DataFrame, folder: str) -> None:
    """Rejected records (rows of ``generate``'s audits) added to a table of JSON lines and to one of Markdown below ``folder``."""
    failed = F.array_join(F.transform("failed_dimensions", lambda d: F.format_string("- %s: %.1f, %s", d["label"], d["score"], d["reason"])), "\n")
    facets = F.array_join(F.transform("facet_diagnostics", lambda d: F.format_string("- [%d] %s: %s", d["index"], d["facet"], d["status"])), "\n")
    told = F.concat_ws("\n", F.format_string("## %s | %s\n\n- query: %s\n- average: %.1f\n- refusal avoided: %s\n- refs: %d\n", "task_id", "status", "query", "avg_score", F.col("refusal_avoided").cast("string"), "refs_count"), failed, F.lit(""), facets, F.lit(""))
    held = staged(audits.select(F.to_json(F.struct(*audits.columns)).alias("json"), told.alias("markdown")))
    held.select("json").write.mode("append").text(f"{folder.rstrip('/')}/generation_rejections.jsonl")
    held.select("markdown").write.mode("append").text(f"{folder.rstrip('/')}/generation_rejections.md")


def append_events(log: DataFrame, path: str) -> bool:
    """A run's steps added to a table of JSON lines; a failure is told and not raised, since a run does not depend on its log."""
    try:
        log.select(F.to_json(F.struct(*log.columns, F.current_timestamp().alias("time"))).alias("value")).write.mode("append").text(path)
        return True
    except Exception as e:  # noqa: BLE001
        warnings.warn(f"the log at {path} was not written: {e}", stacklevel=2)
        return False


def issue_report(issues: DataFrame) -> DataFrame:
    """A2: one Markdown line for each type of issue."""
    return issues.groupBy("severity", "issue_type").agg(F.count(F.lit(1)).alias("n")).select("severity", "issue_type", F.format_string("- [%s] %s: %d", "severity", "issue_type", "n").alias("markdown"))


def latest_cache(cache: DataFrame) -> DataFrame:
    """The last row of each key."""
    last = Window.partitionBy("cache_key").orderBy(F.desc("created_at"), F.desc("response_json"))
    return cache.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n")


def purged_cache(cache: DataFrame, query: str, text: str) -> DataFrame:
    """Rows that neither answer the query nor hold the text."""
    return cache.where(~((F.col("query") == query) | F.contains("response_json", F.lit(text))))


def articles(xml: DataFrame) -> DataFrame:
    """Title, date, authors and abstract of article XML in the column ``xml``; empty abstract parts are left out."""

    def tag(name: str):
        return group(F.col("xml"), rf"<{name}[^>]*>(.*?)</{name}>", 1, "s")

    year, medline = tag("Year"), tag("MedlineDate")
    names = find_all(F.col("xml"), r"<LastName>(.*?)</LastName>", 1)
    # each part with its own tag, so labels and texts stay together
    parts = find_all(F.col("xml"), r"<AbstractText(?:\s[^>]*)?(?<!/)>.*?</AbstractText>", 0, "s")

    def told(part):
        label, body = group(part, r'^<AbstractText[^>]*?\bLabel="([^"]*)"', 1), group(part, r"^<AbstractText[^>]*>(.*)</AbstractText>$", 1, "s")
        return F.when(label != "", F.concat(label, F.lit(": "), body)).otherwise(body)

    abstract = F.array_join(F.filter(F.transform(parts, told), lambda x: x != ""), "\n")
    return xml.select("*", tag("ArticleTitle").alias("title"), F.when(year != "", year).otherwise(medline).alias("date"), names.alias("authors"), abstract.alias("abstract"))


def domain_hits(results: DataFrame, url: str, domains: DataFrame | None = None, most: int | None = None, key: str | None = None) -> DataFrame:
    """Results whose host is a listed domain (by default the six fixed ones) or below one.

    With ``most`` the first so many by ``key``. Hosts meet domains by equality of their suffixes, so no row is compared with every domain.
    """
    if domains is None:
        domains = results.sparkSession.createDataFrame([(d,) for d in fixed.DOMAINS], "domain string")
    named = results.withColumn("host", F.try_parse_url(F.col(url), F.lit("HOST")))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = named.select("host").where("host is not null").distinct().select("host", F.explode(suffixes).alias("domain"))
    fits = hosts.join(domains.select("domain").distinct(), "domain", "left_semi").select("host").distinct()
    out = named.join(fits, "host", "left_semi").select(*results.columns, "host")
    return out if most is None else out.orderBy(key).limit(most)


def rejections(gated: DataFrame) -> DataFrame:
    """Of rows with a gate's result (task, query, status, avg_score, failed) those rejected, as a JSON line and as Markdown."""
    bad = gated.where(F.col("status") == "rejected")
    line = F.to_json(F.struct("task", "query", "status", "avg_score", "failed"))
    told = F.concat(F.lit("## "), "task", F.lit("\n\n- query: "), "query", F.format_string("\n- average: %.2f\n- failed: ", "avg_score"), F.array_join("failed", ", "), F.lit("\n"))
    return bad.select("task", line.alias("json"), told.alias("markdown"))
