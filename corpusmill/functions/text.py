"""Text functions as Column expressions.

Patterns follow one policy (``rx``): Unicode classes and ``.`` that stops at a
newline only, so a pattern means in the JVM what it means in Python. Where a
value is used more than once it is bound with ``let``, since the optimiser
would write it out again for each use inside a lambda.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import fixed

#: What Python's ``\s`` matches beyond Java's Unicode ``\s``.
BLANK = r"[\s\x1c-\x1f]"


def rx(pattern: str, flags: str = "") -> str:
    """A pattern for the JVM; flags are i and s as in Python."""
    return f"(?Ud{flags})" + pattern


def lean(pattern: str, flags: str = "") -> str:
    """``rx`` of a pattern that matches the same: case counts where no letter has one, and a first word is looked at before the border in front of it."""
    if not any(c.lower() != c.upper() for c in re.sub(r"\\.", "", pattern)):
        flags = flags.replace("i", "")
    first = re.match(r"\(\?:\\b\|\^\)([\u4e00-\u9fff]+)(?![?*{])|\\b([a-zA-Z])[a-zA-Z]", pattern)
    return rx((f"(?={first[1] or first[2]})" if first else "") + pattern, flags)


def needed(pattern: str) -> str | None:
    """The longest run of CJK letters that every match of a pattern holds; None if it is not plain to see."""
    bare = re.sub(r"\[[^\]]*\]", "\x00", re.sub(r"\\.", "\x00", pattern))
    while (inner := re.sub(r"\([^()]*\)", "\x00", bare)) != bare:
        bare = inner
    runs = [] if "|" in bare else re.findall(r"[\u4e00-\u9fff]+(?![?*{\u4e00-\u9fff])", re.sub(r"[\u4e00-\u9fff][?*{]", "\x00", bare))
    return max(runs, key=len, default=None)


def replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def sub(text: Column, pattern: str, new: str = "", flags: str = "") -> Column:
    return F.regexp_replace(text, lean(pattern, flags), replacement(new))


def has(text: Column, pattern: str, flags: str = "") -> Column:
    """Whether the pattern matches somewhere; a text without a word that every match holds is not read by it."""
    found, word = text.rlike(lean(pattern, flags)), needed(pattern)
    return found if word is None else F.contains(text, F.lit(word)) & found


def group(text: Column, pattern: str, k: int = 1, flags: str = "") -> Column:
    """Group ``k`` of the first match; empty without a match."""
    return F.regexp_extract(text, rx(pattern, flags), k)


def find_all(text: Column, pattern: str, k: int = 0, flags: str = "") -> Column:
    return F.regexp_extract_all(text, F.lit(rx(pattern, flags)), F.lit(k))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: What Python's strip() takes away.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without blanks at both ends, all Unicode blanks; linear in the length of any run of blanks."""
    # trim lays out the whole text, so only texts with a blank at an end get it
    ends = lambda t: F.contains(F.lit(BLANKS), F.substring(t, 1, 1)) | F.contains(F.lit(BLANKS), F.substring(t, -1, 1))
    return let(text, lambda t: F.when(ends(t), F.trim(t, F.lit(BLANKS))).otherwise(t))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else, as LIKE compares."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


def terms_in(text: Column, terms: Iterable[str]) -> Column:
    """The terms that the text contains, in the given order."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t))


def truncate_int(text: Column, default: int = 90) -> Column:
    """the number in the text cut to a bigint, ``default`` if there is none or it is infinite; beyond bigint its nearest end."""

    def cut(x: Column) -> Column:
        fine = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        bound = F.when(x > 9.2e18, F.lit(9223372036854775807)).when(x < -9.2e18, F.lit(-9223372036854775807 - 1))
        return F.when(fine, F.coalesce(bound, x.try_cast("bigint"))).otherwise(F.lit(default).cast("bigint"))

    return let(strip(text.cast("string")).try_cast("double"), cut)


def json_greedy(text: Column) -> Column:
    """from the first opening to the last closing brace, else the text."""
    return let(text, lambda t: let(group(t, r"(\{.*\})", 1, "s"), lambda found: F.when(found != "", found).otherwise(t)))


def json_fenced(text: Column) -> Column:
    """the content of a code fence if any, from its first bracket to the last one of that kind."""

    def cut(body: Column) -> Column:
        brace, square = F.instr(body, "{"), F.instr(body, "[")
        as_object = (brace > 0) & ((square == 0) | (brace < square))

        def span(start: Column, close: str) -> Column:
            end = F.length(body) - F.instr(F.reverse(body), close) + 1
            found = F.instr(F.reverse(body), close) > 0
            return F.when(found & (end >= start), F.substring(body, start, end - start + 1)).otherwise(body)

        return F.when(as_object, span(brace, "}")).when(square > 0, span(square, "]")).otherwise(body)

    fenced = group(text, r"```(?:json)?\s*(.*?)\s*```", 1, "si")
    return let(strip(F.when(fenced != "", fenced).otherwise(text)), cut)


def strict_json(text: Column) -> Column:
    """The text if Python's json.loads reads it, with null for NaN and the infinities; null if it does not.

    Spark's own readers stop behind the first value and take single quotes. A
    second element, the digest of the text, is put behind it: it is found
    there only if the text is one value and no more. Quotes and names of
    numbers matter outside strings alone; where one occurs the text is cut at
    its double quotes, escaped ones apart, and every other piece is outside.
    """
    double, quote = "\x02\x02", "\x02\x03"

    def outside(x: Column) -> Column:
        pieces = F.split(F.replace(F.replace(x, F.lit("\\\\"), F.lit(double)), F.lit('\\"'), F.lit(quote)), '"')
        plain = F.transform(pieces, lambda s, i: F.when(i % 2 == 0, F.regexp_replace(s, r"(?<![\w.+-])(?:NaN|-?Infinity)(?!\w)", "null")).otherwise(s))

        def joined(p: Column) -> Column:
            bad = F.exists(F.transform(p, lambda s, i: F.when(i % 2 == 0, F.contains(s, F.lit("'"))).otherwise(s.rlike(r"[\x00\x01\x04-\x1f]"))), lambda b: b)
            whole = F.replace(F.replace(F.array_join(p, '"'), F.lit(quote), F.lit('\\"')), F.lit(double), F.lit("\\\\"))
            return F.when(~bad, whole)

        return F.when(~contains_any(x, ("\x02", "\x03")), let(plain, joined))

    def checked(x: Column) -> Column:
        mark = F.md5(x)
        return F.when(F.get_json_object(F.concat(F.lit("["), x, F.lit(',"'), mark, F.lit('"]')), "$[1]") == mark, x)

    return let(text, lambda t: let(F.when(t.rlike(r"['\x00-\x1f]|NaN|Infinity"), outside(t)).otherwise(t), checked))


def strict_object(text: Column) -> Column:
    """``strict_json`` of a text that is one JSON object; null of any other."""
    return let(strict_json(text), lambda x: F.when(F.startswith(F.ltrim(x, F.lit(" \t\n\r")), F.lit("{")), x))


def json_braces(text: Column) -> Column:
    """The content of a code fence if any, from its first opening to its last closing brace."""
    fenced = group(text, r"```(?:json)?\s*(.*?)\s*```", 1, "si")
    return json_greedy(strip(F.when(fenced != "", fenced).otherwise(text)))


def json_object(text: Column) -> Column:
    """the JSON object in the text, null if there is none or more than that."""
    return strict_object(json_fenced(text))


def json_or(text: Column, default: str) -> Column:
    """the text if it is JSON, else ``default``."""
    return F.when(strict_json(text).isNotNull(), text).otherwise(F.lit(default))


def word_set(text: Column) -> Column:
    bare = strip(F.lower(sub(text, r"[^\w\s]")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(bare, "(?U)" + BLANK + "+")))


def similarity(a: Column, b: Column) -> Column:
    """common distinct words over the larger number of distinct words."""

    def ratio(x: Column) -> Column:
        u, v = x["a"], x["b"]
        empty = (F.size(u) == 0) | (F.size(v) == 0)
        return F.when(empty, F.lit(0.0)).otherwise(F.size(F.array_intersect(u, v)) / F.greatest(F.size(u), F.size(v)))

    return let(F.struct(word_set(a).alias("a"), word_set(b).alias("b")), ratio)


def repeats(text: Column, chunk: int = 50, threshold: float = 0.8) -> Column:
    """P20: most pieces of the first half, one each half ``chunk``, occur in the second half. A null text does not repeat.

    Pieces are looked up among all windows of the second half, so a long text takes time in proportion.
    """

    @F.pandas_udf("boolean")
    def run(texts):
        def loop(t) -> bool:
            if t is None or len(t) < 150:
                return False
            a, b = t[: len(t) // 2], t[len(t) // 2 :]
            pieces = [a[i : i + chunk] for i in range(0, len(a) - chunk, chunk // 2)]
            if len(pieces) < 8:
                found = sum(p in b for p in pieces)
            else:
                windows = {b[i : i + chunk] for i in range(len(b) - chunk + 1)}
                found = sum(p in windows for p in pieces)
            return bool(pieces) and found / len(pieces) > threshold

        return texts.map(loop)

    return run(text)


def mapping_key(text: Column) -> Column:
    """the text without blanks."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"(?U){BLANK}+", "")


def short_hash(text: Column) -> Column:
    """the first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


#: The control characters that JSON names by one letter.
_NAMED_CONTROLS = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}


def quoted_json(value: Column) -> Column:
    """Text or an integer as Python's json.dumps(ensure_ascii=False) writes it, null as ``null``.

    Spark's writer has capitals in the numbers of control characters, so texts
    with such a character are escaped one kind after the other.
    """

    def plain(c: Column) -> Column:
        return let(F.to_json(F.array(c)), lambda j: j.substr(F.lit(2), F.length(j) - 2))

    def escaped(c: Column) -> Column:
        out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        for k in range(32):
            out = F.replace(out, F.lit(chr(k)), F.lit("\\" + _NAMED_CONTROLS[k] if k in _NAMED_CONTROLS else f"\\u{k:04x}"))
        return F.concat(F.lit('"'), out, F.lit('"'))

    # numbers hold no such character
    odd = value.cast("string").rlike(r"[\x00-\x07\x0b\x0e-\x1f]")
    return F.when(odd, escaped(value.cast("string"))).otherwise(F.coalesce(plain(value), F.lit("null")))


def python_json(fields: dict[str, Column]) -> Column:
    """an object as Python's json.dumps(sort_keys=True, ensure_ascii=False) writes it; values are text, integers or null."""
    parts = [F.concat(F.lit(f'"{k}": '), quoted_json(v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def cache_key(service: Column, query: Column) -> Column:
    """SHA-256 of service:query, both stripped and the query in lower case."""
    return F.sha2(F.concat(strip(service), F.lit(":"), F.lower(strip(query))), 256)


def preview(text: Column, limit: int) -> Column:
    """without carriage returns and outer blanks, cut at ``limit`` with three dots."""
    bare = strip(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")))
    return let(bare, lambda x: F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit("..."))).otherwise(x))


def search_terms(query: Column) -> Column:
    """words of two letters and more, signs removed."""
    bare = strip(sub(query, r"[^\w\s]", " "))
    return F.filter(F.split(bare, "(?U)" + BLANK + "+"), lambda w: F.length(w) > 1)


def reference_category(source: Column) -> Column:
    """the category that a source's name tells."""
    label = F.contains(source, F.lit("说明书"))
    return (
        F.when(label & contains_any(source, ("适应症", "主治")), "药理机制")
        .when(label & contains_any(source, ("用药剂量", "用法用量")), "用药方案")
        .when(label & contains_any(source, ("不良反应", "禁忌")), "安全禁忌")
        .when(~label & F.contains(source, F.lit("指南")), "指南推荐")
        .otherwise("通用")
    )


def restrict_domains(query: Column, domains: Column) -> Column:
    """the query with a choice of sites."""
    return F.concat(query, F.lit(" ("), F.array_join(F.transform(domains, lambda d: F.concat(F.lit("site:"), d)), " OR "), F.lit(")"))


def network_location(url: Column) -> Column:
    """host with port and user, empty if there is none."""
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))


def strip_html(html: Column) -> Column:
    """visible text; scripts and styles go, tags become blanks, blanks collapse."""
    bare = sub(html, r"<(script|style)\b[^>]*>.*?</\1>", "", "si")
    return strip(F.regexp_replace(sub(bare, r"<[^>]+>", " "), f"(?U){BLANK}+", " "))


def snippet(html: Column, keyword: Column, window: int = 150) -> Column:
    """F32: ``window`` characters before the keyword's first place in the visible text and ``window`` from there on; empty without it."""

    def around(text: Column) -> Column:
        at = F.instr(text, keyword)
        first = F.greatest(F.lit(1), at - window)
        return F.when(at > 0, F.substring(text, first, at + window - first)).otherwise("")

    bare = sub(sub(html, r"<script.*?>.*?</script>", " ", "si"), r"<style.*?>.*?</style>", " ", "si")
    return let(strip(F.regexp_replace(sub(bare, r"<[^>]+>", " "), f"(?U){BLANK}+", " ")), around)


def page_reference(html: Column, name: Column, window: int = 250) -> Column:
    """(source, context) from a page: its description if that has the name, else the text around the name, else a title that has it, else a note of failure."""
    description = strip(group(html, r'<meta name="description" content="(.*?)">', 1, "i"))
    heading = strip(group(html, r"<title>(.*?)</title>", 1, "i"))
    failed = F.format_string(fixed.PAGE_TEXTS[3], name)

    def chosen(p: Column) -> Column:
        described = (p["d"] != "") & F.contains(p["d"], name)
        titled = F.contains(p["h"], name)
        source = F.when(described, fixed.PAGE_SOURCES[0]).when((p["s"] != "") | titled, fixed.PAGE_SOURCES[1]).otherwise(fixed.PAGE_SOURCES[2])
        context = F.when(described, F.format_string(fixed.PAGE_TEXTS[0], p["d"])).when(p["s"] != "", F.format_string(fixed.PAGE_TEXTS[1], name, p["s"]))
        context = context.when(titled, F.format_string(fixed.PAGE_TEXTS[2], p["h"])).otherwise(failed)
        return F.struct(source.alias("source"), context.alias("context"))

    return let(F.struct(description.alias("d"), snippet(html, name, window).alias("s"), heading.alias("h")), chosen)


def meta_description(html: Column) -> Column:
    """the content of the description meta tag; empty without one."""
    return strip(group(html, r'<meta\s+name=["\']description["\']\s+content=["\'](.*?)["\']', 1, "si"))


def title(html: Column) -> Column:
    """the page's title; empty without one."""
    return strip(group(html, r"<title[^>]*>(.*?)</title>", 1, "si"))


def unfence(text: Column) -> Column:
    """without a first and a last line of code fences."""
    bare = F.regexp_replace(strip(text), r"^```[^\n]*\n?", "")
    return strip(F.when(strip(text).startswith("```"), F.regexp_replace(bare, r"\n?```[^\n]*\z", "")).otherwise(strip(text)))


def unquote(text: Column) -> Column:
    """without straight and curved quotes."""
    return F.translate(strip(text), "\"'“”", "")


def feedback(purity: Column, rigor: Column, depth: Column, least: tuple[int, int, int] = (fixed.PURITY, fixed.RIGOR, fixed.DEPTH)) -> Column:
    """the scores and a clause for each one below its threshold, square brackets widened."""
    scores = (purity, rigor, depth)
    clauses = [F.when(s < k, F.lit(c)).otherwise("") for s, k, c in zip(scores, least, fixed.FEEDBACK_CLAUSES, strict=True)]
    return F.translate(F.concat(F.format_string(fixed.FEEDBACK, *[s.cast("bigint") for s in scores]), *clauses), "[]", "【】")


def escape_html(text: Column) -> Column:
    """F38."""
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def model_match(name: Column, available: Column, default: Column | None = None) -> Column:
    """the first listed model that is the name or holds it between separators (before it - or /, after it the same one or the end).

    Else the default if it is listed, else the first listed one, else the name.
    """

    def fits(m: Column) -> Column:
        out = m == name
        for sign in "-/":
            lead = F.concat(F.lit(sign), name)
            out = out | m.endswith(lead) | F.contains(m, F.concat(lead, F.lit(sign)))
        return out

    listed = F.lit(None) if default is None else F.when(F.array_contains(available, default), default)
    return F.coalesce(F.get(F.filter(available, fits), F.lit(0)), listed, F.get(available, F.lit(0)), name)


def int_list(text: Column) -> Column:
    """the integers of a comma list; anything else in it is dropped, as are numbers beyond bigint."""
    numbers = F.transform(F.split(F.regexp_replace(text, r"[^\d,]", ""), ","), lambda x: x.try_cast("bigint"))
    return F.filter(numbers, lambda x: x.isNotNull())


def occurrences(text: Column, literal: str) -> Column:
    """How often a literal occurs without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def chat_template(text: Column, tags: dict[str, str]) -> Column:
    """Role marks replaced by a template's own."""
    for old, new in tags.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape_quotes(text: Column) -> Column:
    """F43."""
    return F.replace(F.replace(F.replace(text, F.lit('"'), F.lit('\\"')), F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))


def logged_line(text: Column) -> Column:
    """The line numbers that a run log mentions."""
    return F.filter(F.transform(find_all(text, r"数据集第 (\d+) 行", 1), lambda x: x.try_cast("bigint")), lambda x: x.isNotNull())


def logged_fallbacks(text: Column, signatures: Iterable[str]) -> Column:
    """for each signature in a log, (signature, dataset line, facet) from 500 characters before its first place to 100 after; ``unknown`` if not there."""

    def found(sign: Column) -> Column:
        at = F.instr(text, sign)
        first = F.greatest(F.lit(1), at - 500)

        def read(near: Column) -> Column:
            line, facet = group(near, r"数据集第\s*(\d+)\s*行"), group(near, r"临床视角:\s*\*\*(.+?)\*\*")
            named = [F.when(x != "", x).otherwise("unknown") for x in (line, facet)]
            return F.struct(sign.alias("signature"), named[0].alias("dataset_line"), named[1].alias("facet"))

        return let(F.substring(text, first, at + 100 - first), read)

    return F.transform(terms_in(text, signatures), found)


def repaired_encoding(text: Column, wrong: str = "cp950", right: str = "utf-8") -> Column:
    """a text that was read in the wrong encoding, written back and read again; what fits neither is dropped."""

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: None if t is None else t.encode(wrong, "ignore").decode(right, "ignore"))

    return run(text)
