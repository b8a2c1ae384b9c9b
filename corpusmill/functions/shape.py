"""What a structured answer must look like, and what is wrong with one that does not.

A shape is declared with ``Text``, ``Number``, ``Many`` and ``Fields`` and
compiled to one column: an array of ``path: code`` over a VARIANT, in the
order of declaration. Array items stand in the path by their place from 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import fixed
from corpusmill.functions.text import has, let, strict_json, strip

_NONE = "array<string>"


@dataclass(frozen=True)
class Text:
    """A string with a length in characters, one of some choices, and patterns that it must not hold once it is stripped."""

    least: int = 0
    most: int | None = None
    choices: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()
    refused: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Number:
    """A number, or a string that is one, within bounds."""

    least: float | None = None
    most: float | None = None


@dataclass(frozen=True)
class Many:
    """An array of one shape with a number of items."""

    of: Shape
    least: int = 0
    most: int | None = None


@dataclass(frozen=True)
class Fields:
    """An object that has all of these; what else it has does not matter."""

    of: dict[str, Shape] = field(default_factory=dict)


Shape = Text | Number | Many | Fields


def _code(path: Column, code: str | Column) -> Column:
    return F.concat(path, F.lit(": "), F.lit(code) if isinstance(code, str) else code)


def _some(*codes: Column) -> Column:
    return F.filter(F.array(*codes), lambda c: c.isNotNull())


def _text(value: Column, shape: Text, path: Column) -> Column:
    def read(x: Column) -> Column:
        tests = [F.when(F.length(x) < shape.least, _code(path, "string_too_short"))]
        if shape.most is not None:
            tests.append(F.when(F.length(x) > shape.most, _code(path, "string_too_long")))
        if shape.choices:
            tests.append(F.when(~x.isin(*shape.choices), _code(path, "literal_error")))
        late = []
        if shape.forbidden:
            late.append(let(F.lower(strip(x)), lambda bare: F.coalesce(*[F.when(has(bare, p, "i"), _code(path, "value_error " + p)) for p in shape.forbidden])))
        if shape.refused is not None:
            late.append(let(shape.refused(x), lambda why: F.when(why != "", _code(path, F.concat(F.lit("value_error "), why)))))
        # what depends on the content is looked at once the form is right, and the first finding counts
        first = F.coalesce(*late) if late else F.lit(None).cast("string")
        return let(_some(*tests), lambda t: F.when(F.size(t) > 0, t).otherwise(_some(first)))

    return F.when(F.schema_of_variant(value) != "STRING", F.array(_code(path, "string_type"))).otherwise(let(F.try_variant_get(value, "$", "string"), read))


def _number(value: Column, shape: Number, path: Column) -> Column:
    kind = F.schema_of_variant(value)
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT", "STRING") | kind.startswith("DECIMAL")

    def read(x: Column) -> Column:
        tests = []
        if shape.least is not None:
            tests.append(F.when(x < shape.least, _code(path, "greater_than_equal")))
        if shape.most is not None:
            tests.append(F.when((x > shape.most) | F.isnan(x), _code(path, "less_than_equal")))
        return F.when(x.isNull(), F.array(_code(path, "float_parsing"))).otherwise(_some(*tests) if tests else F.array().cast(_NONE))

    return F.when(~numeric, F.array(_code(path, "float_type"))).otherwise(let(strip(F.try_variant_get(value, "$", "string")).try_cast("double"), read))


def _many(value: Column, shape: Many, path: Column, look: Callable) -> Column:
    def read(items: Column) -> Column:
        counts = [F.when(F.size(items) < shape.least, _code(path, "too_short"))]
        if shape.most is not None:
            counts.append(F.when(F.size(items) > shape.most, _code(path, "too_long")))
        each = F.transform(items, lambda x, i: look(x, shape.of, F.concat(path, F.lit("."), i.cast("string"))))
        return F.when(items.isNull(), F.array(_code(path, "list_type"))).otherwise(F.concat(F.flatten(each), _some(*counts)))

    return let(F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")), read)


def _fields(value: Column, shape: Fields, path: Column, look: Callable) -> Column:
    def child(name: str) -> Column:
        at = F.concat(path, F.when(path == "", "").otherwise("."), F.lit(name))
        return let(F.try_variant_get(value, f"$.{name}", "variant"), lambda v: look(v, shape.of[name], at))

    return F.when(~F.schema_of_variant(value).startswith("OBJECT"), F.array(_code(path, "model_type"))).otherwise(F.concat(*[child(n) for n in shape.of]))


def violations(value: Column, shape: Shape, path: Column | None = None) -> Column:
    """What is wrong with a VARIANT, ``path: code`` each; empty if nothing is. An absent value is ``missing``."""
    path = F.lit("") if path is None else path
    if isinstance(shape, Text):
        found = _text(value, shape, path)
    elif isinstance(shape, Number):
        found = _number(value, shape, path)
    elif isinstance(shape, Many):
        found = _many(value, shape, path, violations)
    else:
        found = _fields(value, shape, path, violations)
    return F.when(value.isNull(), F.array(_code(path, "missing"))).otherwise(found)


def leaks(value: Column, shape: Shape, path: Column | None = None, patterns: tuple[str, ...] = fixed.PROMPT_LEAKS) -> Column:
    """``path: pattern`` of the texts of a value that repeat instructions, for a value that fits the shape."""
    path = F.lit("$") if path is None else path
    if isinstance(shape, Text):
        return _some(let(F.lower(F.try_variant_get(value, "$", "string")), lambda low: F.coalesce(*[F.when(has(low, p, "i"), F.concat(path, F.lit(": " + p))) for p in patterns])))
    if isinstance(shape, Number):
        return F.array().cast(_NONE)
    if isinstance(shape, Many):
        items = F.try_variant_get(value, "$", "array<variant>")
        return F.flatten(F.transform(items, lambda x, i: leaks(x, shape.of, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), patterns)))
    return F.concat(*[leaks(F.try_variant_get(value, f"$.{n}", "variant"), s, F.concat(path, F.lit(f".{n}")), patterns) for n, s in shape.of.items()])


def checked(text: Column, shape: Shape) -> Column:
    """(json, codes) of an answer's JSON: the text if it fits the shape, else null and what is wrong.

    What is not one whole JSON value is ``json_invalid``; where the shape fits,
    texts that repeat instructions are ``prompt_leak``.
    """

    def judged(j: Column) -> Column:
        value = F.try_parse_json(j)

        def found(v: Column) -> Column:
            wrong = violations(v, shape)
            told = let(wrong, lambda w: F.when(F.size(w) > 0, w).otherwise(F.transform(leaks(v, shape), lambda x: F.concat(F.lit("prompt_leak "), x))))
            return F.when(v.isNull(), F.array(F.lit("json_invalid"))).otherwise(told)

        return let(let(value, found), lambda codes: F.struct(F.when(F.size(codes) == 0, j).alias("json"), codes.alias("codes")))

    return let(strict_json(text), judged)


# -- the shapes that the steps of a run ask for (D7, D8, D11) --

_EXPLAINED = Text(4, 80, forbidden=tuple(fixed.FACET_FORBIDDEN))


def _label_reason(label: Column) -> Column:
    from corpusmill.operators.gates import facet_reason

    # the length was looked at before the label was stripped
    return let(facet_reason(label), lambda r: F.when(r.startswith(fixed.FACET_REASONS[1][:12]) | (r == fixed.FACET_REASONS[0]), "").otherwise(r))


FACET_PLAN = Fields({
    "facets": Many(Fields({
        "label": Text(2, 16, refused=_label_reason),
        "category": Text(choices=fixed.FACET_CATEGORIES),
        "answer_scope": _EXPLAINED,
        "why_relevant": _EXPLAINED,
        "risk_level": Text(choices=fixed.RISK_LEVELS),
    }), 2, 8),
})

FACET_ANSWER = Fields({
    "sub_questions": Many(Text()),
    "evidences": Many(Fields({"source": Text(), "location": Text(), "summary": Text()})),
    "reasoning_chains": Many(Fields({"step_id": Text(), "logic": Text()})),
    "final_conclusion_summary": Text(),
    "answer_body": Text(),
})

ANSWER_SCHEMA = (
    "sub_questions array<string>, evidences array<struct<source:string,location:string,summary:string>>, "
    "reasoning_chains array<struct<step_id:string,logic:string>>, final_conclusion_summary string, answer_body string"
)

FIVE_SCORES = Fields({name: Fields({"score": Number(0, 10), "reason": Text()}) for name, _ in fixed.METRIC_LABELS})
