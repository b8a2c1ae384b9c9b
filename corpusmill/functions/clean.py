"""Ordered rewrites of reasoning and answers. The default lists are the fixed values; tests and queries pass their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import contains_any, find_all, has, let, needed, strip, sub

#: Where Python's splitlines() cuts.
LINES = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def rewrite(text: Column, rules) -> Column:
    """(pattern, flags, replacement) one after the other."""

    def step(t: Column, rule) -> Column:
        pattern, flags, new = rule
        word = needed(pattern)
        # a text without a word that every match holds is handed on as it is
        return sub(t, pattern, new, flags) if word is None else let(t, lambda x: F.when(F.contains(x, F.lit(word)), sub(x, pattern, new, flags)).otherwise(x))

    return reduce(step, rules, text)


def strip_noise(text: Column, rules=fixed.PRE_STRIP) -> Column:
    """F7."""
    return strip(rewrite(text, rules))


def strip_openings(text: Column, openings=fixed.META_OPENINGS, phrase: str = fixed.FACET_PHRASE, tail: str = fixed.DRAFT_TAIL, marks: str = fixed.OPENING_PUNCTUATION) -> Column:
    """F8: draft tails, each opening once, facet phrases anywhere, one leading mark."""
    out = sub(strip(text), tail)
    for p in openings:
        out = strip(sub(out, p))
    out = strip(sub(out, phrase, "", "i"))
    return strip(F.regexp_replace(out, f"^[{marks}]", ""))


def smooth_transitions(text: Column, rules=fixed.TRANSITIONS) -> Column:
    """all rules in order, case ignored."""
    return strip(rewrite(text, [(p, "i", r) for p, r in rules]))


def collapsed(text: Column, literals=fixed.COLLAPSE_LITERALS, patterns=fixed.COLLAPSE_PATTERNS) -> Column:
    """Remains of JSON or of prompts."""
    out = contains_any(text, literals)
    for p in patterns:
        out = out | has(text, p)
    return out


def collapsed_strictly(text: Column) -> Column:
    """The gate of the earlier editions, which also turns down what names its sources."""
    return collapsed(text, patterns=fixed.STRICT_COLLAPSE_PATTERNS)


def _collapse_lines(lines: Column) -> Column:
    return strip(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def clean_lines(text: Column, patterns=fixed.GARBAGE_LINES, tokens=fixed.RESIDUAL_TOKENS, template: str = fixed.JSON_TEMPLATE) -> Column:
    """without lines that match a pattern or are a left-over token; blank lines stay, three or more newlines become two."""
    # one alternation: only whether a line matches counts
    joined = "|".join(f"(?:{p})" for p in patterns)

    def kept(line: Column) -> Column:
        bare = strip(line)
        return (bare == "") | ~(bare.isin(*tokens) | has(bare, joined, "i"))

    lines = F.filter(F.split(sub(text, template, "", "i"), LINES), kept)
    return _collapse_lines(F.transform(lines, lambda x: F.when(strip(x) == "", "").otherwise(x)))


def clean_for_export(text: Column, patterns=fixed.EXPORT_REMOVALS) -> Column:
    """patterns removed in order, then stripped lines that are not blank."""
    out = rewrite(text, [(p, "i", "") for p in patterns])
    return F.array_join(F.filter(F.transform(F.split(out, LINES), strip), lambda x: x != ""), "\n")


def drop_unsupported(text: Column, evidence: Column, pattern: str = fixed.IDENTIFIER, spaces: str = r"\s{2,}") -> Column:
    """identifiers that the evidence does not hold go; without evidence nothing does.

    The text is cut at its matches, so a dropped match that is part of a kept
    one leaves that one alone. ``spaces`` is what collapses to one blank.
    """
    # the k-th piece between matches is followed by the k-th match
    def filtered(m: Column) -> Column:
        pieces = F.split(text, "(?Ud)" + pattern, -1)
        codes = m["codes"]
        kept = F.transform(m["all"], lambda x, i: F.when(F.contains(evidence, F.get(codes, i)), x).otherwise(""))
        joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(kept, i), F.lit("")))), "")
        return strip(sub(sub(joined, r"[，,；;]\s*[，,；;]+", "，"), spaces, " "))

    matches = F.struct(find_all(text, pattern, 0).alias("all"), find_all(text, pattern, 1).alias("codes"))
    return F.when(strip(F.coalesce(evidence, F.lit(""))) == "", text).otherwise(let(matches, filtered))


def scrub_leakage(text: Column, patterns=fixed.LEAKAGE) -> Column:
    """F15."""
    out = rewrite(text, [(p, "i", "") for p in patterns])
    return strip(F.regexp_replace(sub(out, r"[ \t]{2,}", " "), "\n{3,}", "\n\n"))


def wash(text: Column, table=fixed.WASH) -> Column:
    """F16: literal replacements in order."""
    return reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), table, text)


def academic_codes(text: Column, known=fixed.KNOWN_CODES) -> Column:
    """distinct codes that are not known, sorted."""
    return F.array_sort(F.filter(F.array_distinct(find_all(text, r"\b[A-Z]+-\d+\b")), lambda c: ~c.isin(*known)))


def repair_codes(text: Column, repairs=fixed.CODE_REPAIRS) -> Column:
    """Codes with a known correction, in sorted order; a code that holds another one changes with it."""
    found = academic_codes(text, known=())
    pairs = F.create_map(*[F.lit(x) for pair in repairs for x in pair])
    return F.aggregate(found, text, lambda t, c: F.coalesce(F.replace(t, c, F.element_at(pairs, c)), t))


def code_context(text: Column, code: Column, around: int = 150) -> Column:
    """the text around a code's first place, the text's beginning without one."""
    at = F.instr(text, code)
    first = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.substring(text, first, at + F.length(code) + around - first)).otherwise(F.substring(text, 1, 2 * around))


def evidence_text(refs: Column, with_source: bool = True, separator: str = "\n") -> Column:
    """Sources and contexts of all references in one text."""
    blank = F.lit("")
    parts = F.transform(refs, lambda r: F.concat_ws(separator, F.coalesce(r["source"], blank), F.coalesce(r["context"], blank)) if with_source else F.coalesce(r["context"], blank))
    return F.coalesce(F.array_join(parts, separator), blank)


def removed_lines(before: Column, after: Column) -> Column:
    """Lines that are not blank and not in the other text, in order, repeats kept.

    Lines of both texts are sorted together, those of the other text first, and
    cut where the line changes; a group that begins with a line of ``before``
    has none of the other text. So many lines take little more than a sort.
    """

    def lines(text: Column) -> Column:
        return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")

    def marked(own: bool, items: Column) -> Column:
        return F.transform(items, lambda x, i: F.struct(x.alias("line"), F.lit(own).alias("own"), (i if own else F.lit(0)).alias("at")))

    def groups(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda k: (k == 0) | (F.get(rows, k - 1)["line"] != F.get(rows, k)["line"]))
        cut = lambda at: F.transform(at, lambda k, g: F.slice(rows, k + 1, F.coalesce(F.get(at, g + 1), F.size(rows)) - k))
        return let(starts, lambda at: F.flatten(F.filter(cut(at), lambda group: F.get(group, F.lit(0))["own"])))

    both = F.sort_array(F.concat(marked(False, F.array_distinct(lines(F.coalesce(after, F.lit(""))))), marked(True, lines(before))))
    kept = let(both, lambda rows: F.when(F.size(rows) > 0, groups(rows)).otherwise(rows))
    return F.transform(F.sort_array(F.transform(kept, lambda r: F.struct(r["at"], r["line"]))), lambda r: r["line"])


def heal_facets(planners: Column, dirty: str, clean: str) -> Column:
    """A planner's name and both spellings of its tag, which become ``<facet = clean>``."""

    def fix(p: Column) -> Column:
        answer = p["answer"]
        for old in (f"<facet = {dirty}>", f"<facet={dirty}>"):
            answer = F.replace(answer, F.lit(old), F.lit(f"<facet = {clean}>"))
        return F.struct(F.when(p["planner"] == dirty, F.lit(clean)).otherwise(p["planner"]).alias("planner"), answer.alias("answer"))

    return F.transform(planners, fix)
