"""Model and web calls behind a table of requests and a table of responses.

A request's id is the hash of what is asked, so equal questions are asked once
and a run can be replayed. What has no response stays pending; nothing is made up.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.shape import Shape, checked
from corpusmill.functions.text import has, json_fenced, strip
from corpusmill.sources.jsonl import exists
from corpusmill.sources.staging import staged


class Provider(Protocol):
    """Anything that answers a table of requests."""

    def answer(self, requests: DataFrame) -> DataFrame: ...


def requests(rows: DataFrame, stage: str, pool: Column | str, system: Column, prompt: Column) -> DataFrame:
    """``rows`` with req_id, stage, pool, system and prompt."""
    pool = F.lit(pool) if isinstance(pool, str) else pool
    key = F.sha2(F.concat_ws("\u0001", pool, system, prompt), 256)
    return rows.withColumns({"req_id": key, "stage": F.lit(stage), "pool": pool, "system": system, "prompt": prompt})


def replayed(asked: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with content, reasoning and error; distinct requests still pending)."""
    known = responses.groupBy("req_id").agg(F.first("content").alias("content"), F.first("reasoning").alias("reasoning"), F.first("error").alias("error"))
    done = asked.join(known, "req_id", "left").withColumn("pending", F.col("content").isNull() & F.col("error").isNull())
    waiting = asked.join(known, "req_id", "left_anti").select("req_id", "stage", "pool", "system", "prompt").dropDuplicates(["req_id"])
    return done, waiting


class Live:
    """Responses that are kept below ``path``, and a provider for those that are not there.

    Only requests without a kept response reach the provider, each once. An
    error is kept, so a call that failed is not made again; an empty answer
    (nothing, or an empty JSON array) is handed on and asked for again by the
    next run. What the provider leaves out stays pending.
    """

    def __init__(self, spark: SparkSession, path: str, provider: Provider):
        self.spark, self.path, self.provider = spark, path, provider

    def kept(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], RESPONSE)
        return self.spark.read.schema(RESPONSE).parquet(self.path)

    def replies(self, asked: DataFrame) -> DataFrame:
        known = self.kept()
        missing = staged(asked.join(known, "req_id", "left_anti"))
        held = known.join(asked, "req_id", "left_semi")
        if missing.isEmpty():
            return held
        columns = ["req_id", "content", "reasoning", "error"]
        new = staged(self.provider.answer(missing).where("content is not null or error is not null").select(*columns))
        new.where(F.col("error").isNotNull() | ~strip(F.col("content")).isin("", "[]")).write.mode("append").parquet(self.path)
        # the files kept before this call are listed already
        return staged(held.unionByName(new))


#: Type of a table of responses.
RESPONSE = "req_id string, content string, reasoning string, error string"


def answered(rows: DataFrame, responses: DataFrame | Live, stage: str, pool: str, prompt: Column, due: Column, keys: list[str], reasoning: bool = False) -> DataFrame:
    """``rows`` with got, failed and asked after one step of a run, for rows where ``due`` holds and nothing is awaited; and with mused, if ``reasoning``.

    A row whose request has no response keeps the request in the struct
    ``ask`` and takes no further step; equal requests have one id. ``keys``
    name a row. Rows that ask nothing join by a key of their own, so they do
    not gather in one task. ``responses`` is a table, or a ``Live`` one that
    gets what it lacks.
    """
    key = F.sha2(F.concat_ws("\u0001", F.lit(pool), F.lit(stage), prompt), 256)
    active = F.coalesce(due, F.lit(False)) & F.col("ask").isNull()
    own = rows.withColumn("asked", active).withColumn("a_key", F.when(F.col("asked"), key).otherwise(F.concat_ws("-", F.lit("none"), *[F.col(k).cast("string") for k in keys])))
    request = F.struct(F.col("a_key").alias("req_id"), F.lit(stage).alias("stage"), F.lit(pool).alias("pool"), F.lit(stage).alias("system"), prompt.alias("prompt"))
    if isinstance(responses, Live):
        own = staged(own)
        responses = responses.replies(own.where("asked").select(request.alias("r")).select("r.*").dropDuplicates(["req_id"]))
    thought = [F.first("reasoning").alias("mused")] if reasoning else []
    known = responses.groupBy(F.col("req_id").alias("a_key")).agg(F.first("content").alias("got"), F.first("error").alias("failed"), *thought)
    out = own.drop("got", "failed", *(["mused"] if reasoning else [])).join(known, "a_key", "left")
    waits = F.col("asked") & F.col("got").isNull() & F.col("failed").isNull()
    return out.withColumn("ask", F.when(waits, request).otherwise(F.col("ask"))).withColumn("asked", F.col("asked") & ~waits).drop("a_key")


#: Type of the column ``ask``.
ASK = "struct<req_id:string,stage:string,pool:string,system:string,prompt:string>"


def awaited(*tables: DataFrame) -> DataFrame:
    """The distinct requests that rows of ``answered`` wait for."""
    everything = None
    for t in tables:
        own = t.where(F.col("ask").isNotNull()).select("ask.*")
        everything = own if everything is None else everything.unionByName(own)
    return everything.dropDuplicates(["req_id"])


#: What ``structured`` adds to rows.
STRUCTURED = ("s_json", "s_codes", "s_failed", "s_mused", "s_tries", "s_asked")


def structured(rows: DataFrame, responses: DataFrame | Live, stage: str, pool: str, prompt: Column, due: Column, keys: list[str], shape: Shape, tries: int = 3) -> DataFrame:
    """A step whose answer must fit a shape, asked again with what was wrong, ``tries`` times at most.

    ``rows`` with s_json (the answer that fits, else null), s_codes (what is
    wrong with the last one), s_failed (a call's error, after which nothing
    is asked again), s_mused (reasoning), s_tries (answers heard) and s_asked
    (false also for a row that waits). A later request carries the prompt, the
    answers before it and their codes.
    """
    empty = {"s_json": "string", "s_codes": "array<string>", "s_failed": "string", "s_mused": "string"}
    rows = rows.drop(*STRUCTURED).withColumns({k: F.lit(None).cast(v) for k, v in empty.items()})
    rows = rows.withColumns({"s_tries": F.lit(0), "s_told": prompt, "s_due": F.coalesce(due, F.lit(False)) & F.col("ask").isNull()})
    live = F.col("s_due") & F.col("s_json").isNull() & F.col("s_failed").isNull() & F.col("ask").isNull()
    for k in range(tries):
        rows = answered(rows, responses, f"{stage}~{k}" if k else stage, pool, F.col("s_told"), live, keys, reasoning=True)
        heard = F.col("asked") & F.col("failed").isNull()
        rows = rows.withColumn("s_look", F.when(heard, checked(json_fenced(F.coalesce("got", F.lit(""))), shape)))
        wrong = heard & F.col("s_look.json").isNull()
        rows = rows.withColumns({
            "s_json": F.coalesce("s_look.json", "s_json"), "s_codes": F.coalesce("s_look.codes", "s_codes"), "s_tries": F.col("s_tries") + heard.cast("int"),
            "s_failed": F.when(F.col("asked"), F.col("failed")).otherwise(F.col("s_failed")), "s_mused": F.when(heard, F.col("mused")).otherwise(F.col("s_mused")),
            "s_told": F.when(wrong, F.concat_ws("\n", "s_told", "got", F.array_join("s_look.codes", "\n"))).otherwise(F.col("s_told")),
        })
        rows = staged(rows.drop("s_look", "got", "failed", "mused", "asked"))
        if k + 1 == tries or rows.where(live).isEmpty():
            break
    return rows.withColumn("s_asked", F.col("s_due") & F.col("ask").isNull()).drop("s_told", "s_due")


class PooledProvider:
    """Live calls, ``pool`` at a time in each of at most ``partitions`` tasks (the cluster's own number of tasks if not given).

    A call that fails is tried again after 2^n and a random part of half a
    second, as the limit of tries allows; ``per_second`` bounds the calls of
    all tasks together. A call gives its text, or text and reasoning, or
    None where it has no answer yet; a failure is a value of the error column.
    """

    def __init__(self, call: Callable[[str, str, str], str | tuple[str, str] | None], partitions: int | None = None, tries: int = 3, per_second: float | None = None, pool: int = 6, backoff: float = 2.0):
        self.call, self.partitions, self.tries, self.per_second, self.pool, self.backoff = call, partitions, tries, per_second, pool, backoff

    def answer(self, asked: DataFrame) -> DataFrame:
        call, tries, pool, backoff = self.call, self.tries, self.pool, self.backoff
        spread = self.partitions or asked.sparkSession.sparkContext.defaultParallelism
        gap = spread / self.per_second if self.per_second else 0.0

        def run(frames):
            import random
            import threading
            import time
            from concurrent.futures import ThreadPoolExecutor

            import pandas as pd

            turn, due = threading.Lock(), [0.0]

            def wait() -> None:
                with turn:
                    now = time.monotonic()
                    at = max(now, due[0])
                    due[0] = at + gap
                time.sleep(max(0.0, at - now))

            def one(req_id, kind, system, prompt):
                error = None
                for k in range(1, tries + 1):
                    wait()
                    try:
                        said = call(kind, system, prompt)
                        return (req_id, *said, None) if isinstance(said, tuple) else (req_id, said, None, None)
                    except Exception as e:  # a provider's failure is a value of the error column
                        error = str(e)
                        if k < tries:
                            time.sleep(backoff**k + random.uniform(0.1, 0.5) if backoff else 0.0)
                return req_id, None, None, error

            with ThreadPoolExecutor(pool) as workers:
                for pdf in frames:
                    out = list(workers.map(lambda args: one(*args), pdf[["req_id", "pool", "system", "prompt"]].itertuples(index=False, name=None)))
                    yield pd.DataFrame(out, columns=["req_id", "content", "reasoning", "error"])

        return asked.select("req_id", "pool", "system", "prompt").repartition(spread).mapInPandas(run, "req_id string, content string, reasoning string, error string")


def staged_attempts(rows: DataFrame, attempts: list[DataFrame], key: str, accept: Column) -> DataFrame:
    """The first accepted attempt of each row, in order; ``accepted`` is false without one.

    ``attempts`` are answer tables with the key, one for each try.
    """
    everything = None
    for k, a in enumerate(attempts, 1):
        own = a.withColumn("attempt", F.lit(k))
        everything = own if everything is None else everything.unionByName(own)
    judged = everything.where(accept)
    first = judged.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("attempt"))).where("n = 1").drop("n")
    return rows.join(first, key, "left").withColumn("accepted", F.col("attempt").isNotNull())


def render(template: str, values: dict[str, Column]) -> Column:
    """a template with {{ name }} places."""
    import re

    parts = re.split(r"\{\{\s*(\w+)\s*\}\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(values[p].cast("string"), F.lit("")) for i, p in enumerate(parts)])


def leaks_prompt(content: Column, patterns: list[str]) -> Column:
    """P23 for one text: whether the answer repeats its instructions."""
    out = F.lit(False)
    for p in patterns:
        out = out | has(content, p, "i")
    return out


class PromptRegistry:
    """Append-only versions, and activations of which the last one counts.

    ``versions``: prompt_name, version, content, description, created_at;
    ``activations``: prompt_name, version, seq.
    """

    def __init__(self, versions: DataFrame, activations: DataFrame):
        self.versions, self.activations = versions, activations

    def active(self) -> DataFrame:
        last = self.activations.groupBy("prompt_name").agg(F.max_by("version", "seq").alias("version"))
        return self.versions.join(last, ["prompt_name", "version"])

    def get(self, name: str) -> str:
        rows = self.active().where(F.col("prompt_name") == name).select("content").take(1)
        if not rows:
            raise KeyError(name)
        return rows[0][0]

    def _with(self, version: DataFrame | None, name: str, number: int) -> PromptRegistry:
        seq = self.activations.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
        spark = self.versions.sparkSession
        act = self.activations.unionByName(spark.createDataFrame([(name, number, int(seq))], self.activations.schema))
        return PromptRegistry(self.versions if version is None else self.versions.unionByName(version), act)

    def save(self, name: str, content: str, description: str, created_at) -> PromptRegistry:
        number = self.versions.where(F.col("prompt_name") == name).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
        row = self.versions.sparkSession.createDataFrame([(name, int(number), content, description, created_at)], self.versions.schema)
        return self._with(row, name, int(number))

    def rollback(self, name: str, version: int) -> tuple[PromptRegistry, bool]:
        known = not self.versions.where((F.col("prompt_name") == name) & (F.col("version") == version)).isEmpty()
        return (self._with(None, name, version), True) if known else (self, False)

    def listing(self) -> DataFrame:
        total = self.versions.groupBy("prompt_name").agg(F.count(F.lit(1)).alias("total_versions"))
        return self.active().select("prompt_name", F.col("version").alias("active_version")).join(total, "prompt_name", "right")
