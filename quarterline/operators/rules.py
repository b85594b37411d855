"""Shape rules for untrusted nested documents, compiled to column expressions.

A document shape is declared once as nested ``Record`` / ``Listed`` / ``Text``
/ ``Whole`` / ``Amount`` nodes.  ``violations`` compiles it to one SQL
expression of higher-order functions over a parsed VARIANT that returns every broken rule with its path
(``insights[2].title``); ``typed`` compiles the same shape to the trimmed,
typed struct.  Types are strict: a number is no text, a boolean no number, and
fields outside the shape are violations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Text:
    """Trimmed text of 1..``most`` characters, one of ``one_of`` if given."""

    most: int | None = None
    one_of: tuple[str, ...] | None = None
    required: bool = True
    nullable: bool = False
    default: str | None = None


@dataclass(frozen=True)
class Whole:
    """An integer number within bounds."""

    low: int
    high: int
    required: bool = True
    nullable: bool = False


@dataclass(frozen=True)
class Amount:
    """A finite decimal, as a number or as numeric text."""

    required: bool = True
    nullable: bool = False


@dataclass(frozen=True)
class Listed:
    """A list of ``least``..``most`` items."""

    item: object
    least: int = 0
    most: int | None = None
    required: bool = True
    nullable: bool = False


@dataclass(frozen=True)
class Record:
    """An object with exactly these fields, and checks: (rule, SQL condition that breaks it, over the typed value's name)."""

    fields: dict[str, object]
    checks: tuple[tuple[str, Callable[[str], str]], ...] = field(default=())
    required: bool = True
    nullable: bool = False


_KIND = "array<struct<path:string,rule:string>>"
_NONE = f"cast(array() as {_KIND})"


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _broken(path: str, rule: str, condition: str) -> str:
    return f"if(coalesce({condition}, false), array(named_struct('path', {path}, 'rule', {_quote(rule)})), {_NONE})"


def _field(v: str, name: str) -> str:
    return f"try_variant_get({v}, '$.{name}', 'variant')"


def _stripped(v: str) -> str:
    return rf"regexp_replace(try_variant_get({v}, '$', 'string'), '^\\s+|\\s+$', '')"


def _items(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def _within(path: str, name: str) -> str:
    return f"if({path} = '', {_quote(name)}, concat({path}, {_quote('.' + name)}))"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for the value, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _violations(shape: object, value: str, path: str, depth: int) -> str:
    v, p = f"v{depth}", f"p{depth}"
    kind = f"schema_of_variant({v})"
    whens = [f"WHEN {v} IS NULL THEN {_broken(p, 'missing', 'true' if shape.required else 'false')}"]
    if shape.nullable:
        whens.append(f"WHEN is_variant_null({v}) THEN {_NONE}")
    if isinstance(shape, Text):
        size = f"length({_stripped(v)})"
        if shape.one_of is not None:
            found = [_broken(p, "domain", f"{_stripped(v)} NOT IN ({', '.join(map(_quote, shape.one_of))})")]
        else:
            found = [_broken(p, "length", f"{size} < 1" + (f" OR {size} > {shape.most}" if shape.most else ""))]
        fits = f"{kind} = 'STRING'"
    elif isinstance(shape, Whole):
        found = [_broken(p, "range", f"try_variant_get({v}, '$', 'bigint') NOT BETWEEN {shape.low} AND {shape.high}")]
        fits = f"{kind} = 'BIGINT'"
    elif isinstance(shape, Amount):
        found = [_broken(p, "value", f"try_variant_get({v}, '$', 'decimal(38,6)') IS NULL")]
        fits = f"{kind} IN ('BIGINT', 'DOUBLE', 'FLOAT', 'STRING') OR {kind} LIKE 'DECIMAL%'"
    elif isinstance(shape, Listed):
        items = _items(v)
        found = [_broken(p, "too_few", f"size({items}) < {shape.least}")]
        if shape.most is not None:
            found.append(_broken(p, "too_many", f"size({items}) > {shape.most}"))
        inner = _violations(shape.item, f"x{depth}", f"concat({p}, '[', cast(i{depth} as string), ']')", depth + 1)
        found.append(f"flatten(transform({items}, (x{depth}, i{depth}) -> {inner}))")
        fits = f"{kind} LIKE 'ARRAY%'"
    else:
        known = f"array({', '.join(map(_quote, shape.fields))})"
        at = f"if({p} = '', k, concat({p}, '.', k))"
        found = [f"transform(array_sort(array_except(json_object_keys(to_json({v})), {known})), "
                 f"k -> named_struct('path', {at}, 'rule', 'unknown'))"]
        found += [_violations(s, _field(v, n), _within(p, n), depth + 1) for n, s in shape.fields.items()]
        if shape.checks:
            t = f"t{depth}"
            checks = f"concat({', '.join(_broken(p, rule, broken(t)) for rule, broken in shape.checks)})"
            found.append(_let(t, _typed(shape, v, depth + 1), checks))
        fits = f"{kind} LIKE 'OBJECT%'"
    whens.append(f"WHEN NOT coalesce({fits}, false) THEN {_broken(p, 'type', 'true')}")
    return _let(v, value, _let(p, path, f"CASE {' '.join(whens)} ELSE concat({', '.join(found)}) END"))


def _typed(shape: object, value: str, depth: int) -> str:
    if isinstance(shape, Text):
        return _stripped(value) if shape.default is None else f"coalesce({_stripped(value)}, {_quote(shape.default)})"
    if isinstance(shape, Whole):
        return f"try_variant_get({value}, '$', 'int')"
    if isinstance(shape, Amount):
        return f"try_variant_get({value}, '$', 'decimal(38,6)')"
    if isinstance(shape, Listed):
        x = f"y{depth}"
        return f"transform(coalesce({_items(value)}, cast(array() as array<variant>)), {x} -> {_typed(shape.item, x, depth + 1)})"
    w = f"w{depth}"
    fields = ", ".join(f"{_quote(n)}, {_typed(s, _field(w, n), depth + 1)}" for n, s in shape.fields.items())
    return _let(w, value, f"named_struct({fields})")


def violations(shape: object, value: str) -> Column:
    """Every broken rule of a VARIANT column as an array of (path, rule): fields in order, then cross-field checks."""
    return F.expr(_violations(shape, value, "''", 0))


def typed(shape: object, value: str) -> Column:
    """The column in the shape's types; parts that do not fit are NULL (``violations`` names them), absent lists empty."""
    return F.expr(_typed(shape, value, 0))


def as_texts(found: Column) -> Column:
    """Violations as sorted ``path: rule`` texts; the document itself is ``$``."""
    return F.array_sort(F.transform(found, lambda x: F.concat(
        F.when(x["path"] == "", F.lit("$")).otherwise(x["path"]), F.lit(": "), x["rule"])))


def json_schema(shape: object) -> dict:
    """The shape as a JSON schema, for prompts that ask for it."""
    if isinstance(shape, Text):
        out: dict = {"type": "string", "minLength": 1}
        if shape.most:
            out["maxLength"] = shape.most
        if shape.one_of is not None:
            out = {"type": "string", "enum": list(shape.one_of)}
    elif isinstance(shape, Whole):
        out = {"type": "integer", "minimum": shape.low, "maximum": shape.high}
    elif isinstance(shape, Amount):
        out = {"anyOf": [{"type": "number"}, {"type": "string"}]}
    elif isinstance(shape, Listed):
        out = {"type": "array", "items": json_schema(shape.item)}
        if shape.least:
            out["minItems"] = shape.least
        if shape.most is not None:
            out["maxItems"] = shape.most
    else:
        out = {"type": "object", "additionalProperties": False,
               "properties": {n: json_schema(s) for n, s in shape.fields.items()},
               "required": [n for n, s in shape.fields.items() if s.required]}
    return {"anyOf": [out, {"type": "null"}]} if shape.nullable else out
