"""Message contracts as Column rules.

A contract states the required keys, the allowed types, nested arrays of objects and whether unknown
keys are allowed. It is compiled to expressions over a parsed VARIANT, so that checking a message stays
in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import parse_compact_ts

# contract type -> the types that a scalar VARIANT value of it may report
_REPORTED = {
    "string": "STRING",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "integer": "BIGINT|DECIMAL\\([0-9]+,0\\)",
    "boolean": "BOOLEAN",
    "null": "VOID",
}
# nested contract type -> the type its values can be read as, and no others
_READ_AS = {"array": "array<variant>", "object": "map<string,variant>"}
STAMP = "datetime"  # a 14-digit text stamp


@dataclass(frozen=True)
class Rule:
    """Allowed types of one key.

    ``inside`` is the contract of a nested object; ``items`` is the rule of an array's elements (a contract there stands
    for objects under it).
    """

    types: tuple[str, ...]
    items: Contract | Rule | None = None
    inside: Contract | None = None

    @property
    def element(self) -> Rule | None:
        return Rule(("object",), inside=self.items) if isinstance(self.items, Contract) else self.items


@dataclass(frozen=True)
class Contract:
    properties: dict[str, Rule] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    closed: bool = False


def optional(kind: str) -> Rule:
    return Rule((kind, "null"))


def array_of(items: Contract | Rule) -> Rule:
    return Rule(("array",), items)


def object_of(inside: Contract) -> Rule:
    return Rule(("object",), inside=inside)


def _type_of(v: Column) -> Column:
    return F.when(F.is_variant_null(v), "VOID").otherwise(F.schema_of_variant(v))


def _fits(v: Column, rule: Rule) -> Column:
    """Nested types are tested by reading the value as such: naming the type of a nested value would
    walk through all of it."""
    plain = "|".join(_REPORTED[t] for t in rule.types if t in _REPORTED)
    tests = [F.try_variant_get(v, "$", _READ_AS[t]).isNotNull() for t in rule.types if t in _READ_AS]
    if plain:
        tests.append(_type_of(v).rlike(f"^({plain})$"))
    if STAMP in rule.types:
        text = F.try_variant_get(v, "$", "string")
        tests.append((_type_of(v) == "STRING") & parse_compact_ts(text).isNotNull())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _no_text() -> Column:
    return F.array().cast("array<string>")


def _errors(v: Column, contract: Contract, path: str = "") -> Column:
    """Array of the error texts of one object; ``path`` names the object or array it lies in."""
    where = f" in {path}" if path else ""

    def member(name: str, kind: str = "variant") -> Column:
        for quote in "'\"":
            if quote not in name and "?" not in name:
                return F.try_variant_get(v, f"$[{quote}{name}{quote}]", kind)
        return F.try_variant_get(F.try_variant_get(v, "$", _READ_AS["object"])[name], "$", kind)

    found = [
        F.when(member(name).isNull(), F.lit(f"'{name}' is a required property{where}")) for name in contract.required
    ]
    for name, rule in contract.properties.items():
        allowed = ", ".join(f"'{t}'" for t in rule.types)
        wrong = member(name).isNotNull() & ~_fits(member(name), rule)
        found.append(F.when(wrong, F.lit(f"'{name}' is not of type {allowed}{where}")))
    out = F.filter(F.array(*found), lambda e: e.isNotNull()) if found else _no_text()
    if contract.closed:
        known = F.array(*[F.lit(n) for n in contract.properties]) if contract.properties else _no_text()
        keys = F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), _no_text())
        extra = F.array_sort(F.array_except(keys, known))
        text = F.concat(F.lit("Additional properties are not allowed: "), F.array_join(extra, ", "), F.lit(where))
        out = F.concat(out, F.when(F.size(extra) > 0, F.array(text)).otherwise(_no_text()))
    for name, rule in contract.properties.items():
        at = f"{path}.{name}" if path else name
        if rule.inside is not None:
            out = F.concat(out, _inner(member(name), rule.inside, at))
        if rule.element is not None:
            inside = partial(_element_errors, rule=rule.element, path=f"{at}[]")
            elements = F.coalesce(member(name, "array<variant>"), F.array().cast("array<variant>"))
            out = F.concat(out, F.array_distinct(F.flatten(F.transform(elements, lambda e: inside(e)))))
    return out


def _inner(v: Column, contract: Contract, path: str) -> Column:
    """Errors of a nested object; another type than object is its rule's business."""
    is_object = F.try_variant_get(v, "$", _READ_AS["object"]).isNotNull()
    return F.when(is_object, _errors(v, contract, path)).otherwise(_no_text())


def _element_errors(v: Column, rule: Rule, path: str) -> Column:
    """Errors of an array's element: its type, then what is inside it."""
    allowed = ", ".join(f"'{t}'" for t in rule.types)
    wrong = F.when(_fits(v, rule), _no_text()).otherwise(F.array(F.lit(f"element is not of type {allowed} in {path}")))
    if rule.inside is not None:
        wrong = F.concat(wrong, _inner(v, rule.inside, path))
    if rule.element is not None:
        inside = partial(_element_errors, rule=rule.element, path=f"{path}[]")
        elements = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))
        wrong = F.concat(wrong, F.array_distinct(F.flatten(F.transform(elements, lambda e: inside(e)))))
    return wrong


def _verdict(v: Column, contract: Contract) -> Column:
    errors = F.array_join(_errors(v, contract), " | ")
    text = (
        F.when(v.isNull(), "malformed JSON")
        .when(F.try_variant_get(v, "$", _READ_AS["object"]).isNull(), "message is not an object")
        .otherwise(F.nullif(errors, F.lit("")))
    )
    return F.struct(text.isNull().alias("is_valid"), text.alias("error"))


def check(json: Column, contract: Contract) -> Column:
    """``struct<is_valid, error>`` of a JSON message; all findings are listed, joined by `` | ``.

    The message is parsed once: the parsed value is bound as the element of a one-element array.
    """
    return F.transform(F.array(F.try_parse_json(json)), lambda v: _verdict(v, contract))[0]


def check_by_hub(hub: Column, json: Column, contracts: dict[str, Contract]) -> Column:
    """The hub decides the contract; a message of an unknown hub is invalid."""
    unknown = F.struct(F.lit(False).alias("is_valid"), F.concat(F.lit("unknown hub: "), F.coalesce(hub, F.lit("none"))).alias("error"))
    out = None
    for name, contract in contracts.items():
        checked = check(json, contract)
        out = F.when(hub == name, checked) if out is None else out.when(hub == name, checked)
    return unknown if out is None else out.otherwise(unknown)


def validated(messages: DataFrame, contracts: dict[str, Contract], hub: str = "hub", json: str = "json_str") -> DataFrame:
    """Messages with ``is_valid`` and ``error``.

    The result is generated from a one-element array: a later filter on it then stays above the check
    instead of being pushed below, which would evaluate the check twice.
    """
    return messages.select("*", F.inline(F.array(check_by_hub(F.col(hub), F.col(json), contracts))))


def contract_from_schema(schema: dict, definitions: dict | None = None) -> Contract:
    """Contract from a JSON-Schema-like dictionary.

    Understood are ``type`` (name or list), ``properties``, ``required``, ``additionalProperties: False``,
    ``items`` and ``$ref`` to ``#/definitions/..``; the type ``datetime`` is the 14-digit stamp.
    """
    definitions = schema.get("definitions", {}) if definitions is None else definitions

    def resolve(part: dict) -> dict:
        ref = part.get("$ref")
        return definitions[ref.rsplit("/", 1)[-1]] if ref else part

    def rule(part: dict) -> Rule:
        part = resolve(part)
        kind = part.get("type", [*_REPORTED, *_READ_AS])
        types = (kind,) if isinstance(kind, str) else tuple(kind)
        inner = contract_from_schema(part, definitions)
        items = part.get("items")
        return Rule(types, rule(items) if items else None, inner if inner != Contract() else None)

    return Contract(
        {name: rule(part) for name, part in schema.get("properties", {}).items()},
        tuple(schema.get("required", ())),
        schema.get("additionalProperties") is False,
    )
