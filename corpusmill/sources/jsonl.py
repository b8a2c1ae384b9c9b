"""Line-addressed JSONL: reading that keeps positions, and guarded writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import quoted_json, strict_object, strip
from corpusmill.schema import RECORD, free, has_key
from corpusmill.sources.ordered import write_one_file
from corpusmill.sources.staging import staged


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_num, raw) of every line of the files, blank ones too; numbers from 1 in each file.

    The reader knows each line's place in its split. Counts of the splits
    before it give the number, so a large file is read by many tasks.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))
    sizes = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("path", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return lines.join(starts, ["path", "block"]).select("path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_num"), "raw")


def parsed(lines: DataFrame) -> DataFrame:
    """Records with parse_status ok, blank or error; bad lines keep their place with null fields.

    A line is ok if it is one JSON object as Python reads it, and nothing else;
    blank are lines of Unicode blanks only.
    """
    whole = free(lines.columns, "s_whole")
    out = lines.withColumn(whole, strict_object(F.col("raw")))
    text = F.col(whole)
    blank = strip(F.coalesce("raw", F.lit(""))) == ""
    record = F.from_json(text, RECORD)
    fields = {"q": F.coalesce(record["Q"], F.lit("")), "planners": F.coalesce(record["planners"], F.array().cast("array<struct<planner:string,answer:string>>")), "refs": record["refs"], "history_json": F.get_json_object(text, "$.history"), "summary": F.coalesce(record["summary"], F.lit(""))}
    out = out.withColumn("parse_status", F.when(blank, "blank").when(text.isNull(), "error").otherwise("ok"))
    good = F.col("parse_status") == "ok"
    out = out.withColumns({k: F.when(good, v) for k, v in fields.items()})
    return out.withColumn("has_refs_key", good & has_key(text, "refs")).withColumn("has_history_key", good & has_key(text, "history")).drop(whole)


def read_records(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Records of one file, of a line range if given."""
    rows = parsed(numbered_lines(spark, path))
    if first is not None:
        rows = rows.where(F.col("line_num") >= first)
    return rows if last is None else rows.where(F.col("line_num") <= last)


def read_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files that are one JSON array or object."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def count_lines(spark: SparkSession, path: str) -> int:
    """0 for a missing file."""
    return spark.read.text(path).count() if exists(spark, path) else 0


def with_fields(raw: Column, changes: Column, drop: tuple[str, ...] = ()) -> Column:
    """A JSON object with the fields of the object ``changes`` put in and some taken out; all others stay, in their order.

    Written as Python's json.dumps does it without escaping. Null if either is no object.
    """

    @F.pandas_udf("string")
    def run(texts, news):
        import json

        def one(text, new):
            try:
                own, more = json.loads(text), json.loads(new)
                own.update(more)
            except (TypeError, ValueError, AttributeError):
                return None
            for k in drop:
                own.pop(k, None)
            return json.dumps(own, ensure_ascii=False)

        return texts.combine(news, one)

    return run(raw, changes)


def with_healed_facet(raw: Column, dirty: str, clean: str) -> Column:
    """A line with a facet renamed in its planners; one that is no record by plain replacement, one without the term as it is."""

    @F.pandas_udf("string")
    def run(texts):
        import json

        def one(text):
            if text is None or dirty not in text:
                return text
            try:
                own = json.loads(text)
                for p in own.get("planners", []):
                    if p.get("planner") == dirty:
                        p["planner"] = clean
                    answer = p.get("answer", "")
                    if dirty in answer:
                        for old in (f"<facet = {dirty}>", f"<facet={dirty}>"):
                            answer = answer.replace(old, f"<facet = {clean}>")
                        p["answer"] = answer
                return json.dumps(own, ensure_ascii=False)
            except (TypeError, ValueError, AttributeError):
                return text.replace(dirty, clean)

        return texts.map(one)

    return run(raw)


def exploded(records: DataFrame) -> DataFrame:
    """A row for each planner with its place from 0; records without one keep a row."""
    return records.select("*", F.posexplode_outer("planners").alias("planner_index", "p")).select("*", F.col("p.planner").alias("planner"), F.col("p.answer").alias("answer")).drop("p")


def guard(output: str, *protected: str) -> str:
    """Refuses an output that is a protected input, lies in one or holds one."""
    from posixpath import normpath

    def plain(p: str) -> str:
        return normpath(p.split(":", 1)[-1] if ":" in p.split("/", 1)[0] else p).rstrip("/")

    own = plain(output)
    for p in map(plain, protected):
        if own == p or own.startswith(p + "/") or p.startswith(own + "/"):
            raise ValueError(f"{output} would overwrite the input {p}")
    return output


def write_lines(rows: DataFrame, path: str, *order: str, text: Column | str = "raw") -> None:
    """One text line a row in the given order, bytes as they are."""
    rows.orderBy(*order).select(F.col(text) if isinstance(text, str) else text).write.text(path)


def write_json(rows: DataFrame, path: str, *order: str) -> None:
    """Newline-delimited JSON in the given order."""
    rows.orderBy(*order).write.json(path)


def indented(rows: DataFrame, columns: list[str]) -> Column:
    """An object as Python's json.dump(indent=2, ensure_ascii=False) writes it inside an array; nested values in one line."""
    kinds = dict(rows.dtypes)

    def value(c: str) -> Column:
        simple = kinds[c] in ("string", "tinyint", "smallint", "int", "bigint")
        return quoted_json(F.col(c)) if simple else F.coalesce(F.to_json(c) if kinds[c].startswith(("struct", "array", "map")) else F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit("null"))

    return F.concat(F.lit("  {\n"), F.concat_ws(",\n", *[F.concat(F.lit(f'    "{c}": '), value(c)) for c in columns]), F.lit("\n  }"))


def write_json_array(rows: DataFrame, path: str, *order: str) -> None:
    """One JSON array of the columns that are not in ``order``, in that order; a folder of parts that join to the array.

    Rows are numbered once they are sorted, so keys may be equal, null or of
    any type that sorts. ``write_array_file`` makes a single file of it.
    """
    columns = [c for c in rows.columns if c not in order]
    held = staged(rows.orderBy(*order).select(indented(rows, columns).alias("value"), F.monotonically_increasing_id().alias("place")))
    first, last = held.agg(F.min("place"), F.max("place")).first()
    if first is None:
        rows.sparkSession.createDataFrame([("[]",)], "value string").write.text(path)
        return
    place = F.col("place")
    text = F.concat(F.when(place == first, "[\n").otherwise(""), "value", F.when(place == last, "\n]").otherwise(","))
    held.orderBy("place").select(text.alias("value")).write.text(path)


def write_array_file(rows: DataFrame, path: str, *order: str) -> str:
    """The array of ``write_json_array`` as one file, byte for byte what json.dump(indent=2, ensure_ascii=False) writes for texts and integers."""
    columns = [c for c in rows.columns if c not in order]
    return write_one_file(rows, path, *order, text=indented(rows, columns), header="[\n", separator=",\n", footer="\n]", empty="[]")


def rewritten(processed: DataFrame, latest: DataFrame) -> DataFrame:
    """Processed lines, and lines that came in since, by number."""
    last = processed.agg(F.max("line_num").alias("n"))
    late = latest.join(F.broadcast(last), F.col("line_num") > F.coalesce("n", F.lit(0))).select(*processed.columns)
    return processed.unionByName(late)


def missing_tail(dataset: DataFrame, backup_lines: int) -> DataFrame:
    """What a backup lacks."""
    return dataset.where(F.col("line_num") > backup_lines)


def append_both(spark: SparkSession, rows: DataFrame, current: str, raw: str, clean: Column, original: Column) -> int:
    """Appends each row to both tables, or to neither.

    Both must hold the same number of lines before. Rows are written once to a
    folder beside ``current`` and both appends read that, so the two parts agree
    even if an executor is lost between them; if the second append fails the
    first one's new files are deleted.
    """
    n, m = count_lines(spark, current), count_lines(spark, raw)
    if n and not exists(spark, raw):
        raise ValueError(f"{raw} is missing while {current} has {n} lines")
    if n != m:
        raise ValueError(f"{current} has {n} lines and {raw} has {m}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(current).getFileSystem(conf)

    def files() -> set[str]:
        return {str(s.getPath()) for s in fs.listStatus(hadoop(current))} if fs.exists(hadoop(current)) else set()

    import uuid

    folder, before = f"{current.rstrip('/')}-staged-{uuid.uuid4().hex}", files()
    try:
        rows.select(clean.alias("c"), original.alias("r")).write.parquet(folder)
        held = spark.read.schema("c string, r string").parquet(folder)
        added = held.count()
        held.select("c").write.mode("append").text(current)
        try:
            held.select("r").write.mode("append").text(raw)
        except Exception:
            for f in files() - before:
                fs.delete(hadoop(f), False)
            raise
        return added
    finally:
        fs.delete(hadoop(folder), True)


def restored(current: DataFrame, backup: DataFrame, first: int, last: int) -> DataFrame:
    """Lines of a range from the backup, also where the current file is too short."""
    old = backup.where(F.col("line_num").between(first, last)).select("line_num", F.col("raw").alias("old"))
    return current.join(old, "line_num", "full_outer").select("line_num", F.coalesce("old", "raw").alias("raw"))
