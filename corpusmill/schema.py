"""Row types of the corpus and of its audit tables."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PLANNERS = "array<struct<planner:string,answer:string>>"
REFS = "array<struct<source:string,context:string>>"
RECORD = f"Q string, planners {PLANNERS}, refs {REFS}, history string, summary string"
SFT = "instruction string, input string, output string"
VERSIONS = "prompt_name string, version int, content string, description string, created_at timestamp"
REQUESTS = "req_id string, stage string, pool string, system string, prompt string, line_num bigint, planner_index int"
RESPONSES = "req_id string, content string, reasoning string, prompt_tokens int, completion_tokens int, error string"
JUDGE_5D = ("grounding", "isolation", "explainability", "professionalism", "relevance")


def has_key(raw: Column, key: str) -> Column:
    """Whether the object names the key, null value or not."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))


def free(taken: Iterable[str], name: str) -> str:
    """``name``, or with the first number that makes it differ from all of ``taken``; upper and lower case are one."""
    used = {c.lower() for c in taken}
    return next(x for x in (name, *(f"{name}{k}" for k in range(len(used) + 1))) if x.lower() not in used)
