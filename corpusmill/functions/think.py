"""Answers with a reasoning block: splitting and putting together.

The rules for what counts as the answer's body differ on purpose; each has its
own function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.fixed import ANYWHERE, FACET_TAG
from corpusmill.functions.text import BLANKS, find_all, group, has, let, strip, sub


def split_strict(answer: Column) -> Column:
    """(think, body, found), blanks before the block allowed. The tags are found by plain search, once."""
    return _leading_block(F.ltrim(answer, F.lit(BLANKS)))


def _leading_block(answer: Column) -> Column:
    def cut(a: Column) -> Column:
        end = F.when(a.startswith("<think>"), F.instr(a, "</think>")).otherwise(0)
        return let(F.struct(a.alias("a"), end.alias("end")), parts)

    def parts(p: Column) -> Column:
        found = p["end"] > 0
        think = F.when(found, strip(F.substring(p["a"], F.lit(8), p["end"] - 8))).otherwise("")
        body = F.when(found, strip(F.substring(p["a"], p["end"] + 8, F.length(p["a"])))).otherwise("")
        return F.struct(think.alias("think"), body.alias("body"), F.coalesce(found, F.lit(False)).alias("found"))

    return let(answer, cut)


def split_tight(answer: Column) -> Column:
    """(think, body, found), the block must come first."""
    return _leading_block(answer)


def first_think(answer: Column) -> Column:
    """The first block anywhere, empty without one."""
    return group(answer, ANYWHERE, 1)


def all_thinks(answer: Column) -> Column:
    """P5."""
    return find_all(answer, ANYWHERE, 1)


def body_after_first(answer: Column) -> Column:
    """What follows a leading closed block, else the whole answer."""
    return let(split_strict(answer), lambda p: F.when(p["found"], p["body"]).otherwise(strip(answer)))


def body_after_last(answer: Column) -> Column:
    """What follows the last closing tag."""
    return F.element_at(F.split(answer, "</think>"), -1)


def body_without_thinks(answer: Column) -> Column:
    """P8."""
    return strip(sub(answer, ANYWHERE))


def browser_split(answer: Column) -> Column:
    """By plain search, wherever the block stands: from the answer's first > to its first closing tag, and what follows that tag.

    Without an opening or a closing tag the whole answer is the body. If no > comes before the closing tag, the two ends change places.
    """

    def cut(a: Column) -> Column:
        start, end = F.instr(a, ">") + 1, F.instr(a, "</think>")
        found = F.contains(a, F.lit("<think")) & (end > 0)
        first, last = F.least(start, end), F.greatest(start, end)
        think = F.when(found, strip(F.substring(a, first, last - first))).otherwise("")
        body = F.when(found, strip(F.substring(a, end + 8, F.length(a)))).otherwise(a)
        return F.struct(think.alias("think"), body.alias("body"))

    return let(answer, cut)


def facet_and_rest(think: Column, planner: Column) -> Column:
    """P10: the facet tag, made from the planner's name if there is none, and the rest."""
    found = has(think, FACET_TAG)
    tag = F.when(found, group(think, FACET_TAG, 1)).otherwise(F.concat(F.lit("<facet = "), planner, F.lit(">")))
    return F.struct(tag.alias("tag"), F.when(found, strip(group(think, FACET_TAG, 2))).otherwise(strip(think)).alias("rest"))


def compose(think: Column, body: Column, tag: Column | None = None) -> Column:
    """P11."""
    inner = think if tag is None else F.concat(tag, F.lit("\n"), think)
    return F.concat(F.lit("<think>\n"), inner, F.lit("\n</think>\n"), body)


def _tagged(facet: Column) -> Column:
    return F.concat(F.lit("<think><facet = "), facet, F.lit(">\n"))


def _bare(reasoning: Column) -> Column:
    return strip(F.replace(F.replace(F.coalesce(reasoning, F.lit("")), F.lit("<think>"), F.lit("")), F.lit("</think>"), F.lit("")))


def structured_think(output: Column, facet: Column, reasoning: Column | None = None) -> Column:
    """The reasoning in a block if there is any, else one from the parts of a structured answer, evidence numbered from R1; then the answer's body."""

    def lines(items: Column, one) -> Column:
        return F.array_join(F.transform(items, one), "\n")

    evidence = lines(output["evidences"], lambda e, i: F.format_string(fixed.EVIDENCE_ITEM, i + 1, e["source"], e["location"], e["summary"]))
    steps = lines(output["reasoning_chains"], lambda s: F.format_string("- %s: %s", s["step_id"], s["logic"]))
    questions = lines(output["sub_questions"], lambda q: F.concat(F.lit("- "), q))
    parts = [questions, evidence, steps, F.concat(F.lit("- "), output["final_conclusion_summary"])]
    built = F.concat(*[F.concat(F.lit(name + "\n"), part, F.lit("\n")) for name, part in zip(fixed.THINK_PARTS, parts, strict=True)])
    given = F.lit("") if reasoning is None else F.coalesce(reasoning, F.lit(""))
    inner = F.when(given != "", F.concat(_bare(given), F.lit("\n"))).otherwise(built)
    return F.concat(_tagged(facet), inner, F.lit("</think>\n"), output["answer_body"])


def ensure_think(answer: Column, reasoning: Column, facet: Column) -> Column:
    """Blocks without any facet tag get one; an answer that begins with no block gets one of its reasoning, or a stand-in."""
    given = F.coalesce(reasoning, F.lit(""))
    inner = F.when(given != "", _bare(given)).otherwise(F.concat(facet, F.lit(fixed.MOCK_REASONING)))
    return (
        F.when(F.contains(answer, F.lit("<think>")) & ~F.contains(answer, F.lit("facet =")), F.replace(answer, F.lit("<think>"), F.concat(F.lit("<think><facet = "), facet, F.lit(">"))))
        .when(~answer.startswith("<think"), F.concat(_tagged(facet), inner, F.lit("\n</think>\n"), answer))
        .otherwise(answer)
    )


def synthesis_body(answer: Column, literal: bool = False) -> Column:
    """the body after the last closing tag; ``literal`` looks for the misspelt tag instead, so reasoning stays."""
    return strip(F.element_at(F.split(answer, "usse"), -1)) if literal else strip(body_after_last(answer))


def without_facet_tag(think: Column) -> Column:
    return strip(sub(think, r"<facet\s*=\s*[^>]+>"))


def count_thinks(planners: Column) -> Column:
    """Planners whose answer begins with a closed block."""
    return F.size(F.filter(planners, lambda p: has(p["answer"], r"^\s*<think>([\s\S]*?)</think>")))
