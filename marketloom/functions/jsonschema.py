"""JSON-Schema documents as column expressions over VARIANT values.

``compiled`` turns a document into its leaf properties with the rules each must keep. Keywords
that say nothing about values are skipped; a keyword that is not known raises, so that no rule
of a contract is silently left unchecked.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords that describe without a rule.
ANNOTATIONS = {
    "$schema", "$id", "$comment", "$defs", "title", "description", "examples", "default", "deprecated", "readOnly", "writeOnly",
}
#: The JSON types, by how Spark names them inside a VARIANT.
TYPES: dict[str, Callable[[Column], Column]] = {
    "string": lambda kind: kind == "STRING",
    "boolean": lambda kind: kind == "BOOLEAN",
    "number": lambda kind: kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"),
    "integer": lambda kind: kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"),
    "object": lambda kind: kind.startswith("OBJECT"),
    "array": lambda kind: kind.startswith("ARRAY"),
    "null": lambda kind: kind == "VOID",
}
# Date and time of the format keyword, with seconds and a zone; dates alone.
DATE_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})\z"
)
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


class UnknownKeyword(ValueError):
    """A document uses a keyword that is not checked here."""


@dataclass(frozen=True)
class Node:
    """A value of the event: its node, JSON type and text, null where it is missing."""

    value: Column
    kind: Column
    text: Column

    @property
    def number(self) -> Column:
        return self.text.try_cast("double")

    def is_a(self, kind: str) -> Column:
        good = TYPES[kind](self.kind)
        return good & (self.number == F.floor(self.number)) if kind == "integer" else good


def _kinds(given) -> list[str]:
    return [given] if isinstance(given, str) else list(given)


def _type(given, node: Node) -> Column:
    kinds = _kinds(given)
    good = node.is_a(kinds[0])
    for kind in kinds[1:]:
        good = good | node.is_a(kind)
    return good


def _equals(given, node: Node) -> Column:
    """Whether the node is this JSON scalar."""
    if given is None:
        return node.is_a("null")
    if isinstance(given, bool):
        return node.is_a("boolean") & (node.text == str(given).lower())
    if isinstance(given, int | float):
        return node.is_a("number") & (node.number == float(given))
    return node.is_a("string") & (node.text == given)


def _enum(given, node: Node) -> Column:
    if given and all(isinstance(one, str) for one in given):
        return node.is_a("string") & node.text.isin(*given)
    found = F.lit(False)
    for one in given:
        found = found | _equals(one, node)
    return found


def _pattern(given: str, node: Node) -> Column:
    """``$`` of a contract is the text's end, not also the place before a last line feed."""
    at_end = given.endswith("$") and not given.endswith("\\$")
    return ~node.is_a("string") | node.text.rlike(given[:-1] + r"\z" if at_end else given)


def _format(given: str, node: Node) -> Column:
    if given == "date-time":
        # The pattern leaves no other letters, and mapping two is far cheaper than upper case.
        good = node.text.rlike(DATE_TIME) & F.try_to_timestamp(F.translate(node.text, "tz", "TZ")).isNotNull()
    else:
        good = node.text.rlike(DATE) & node.text.try_cast("date").isNotNull()
    return ~node.is_a("string") | good


def _of_number(compare: Callable[[Column, float], Column]):
    return lambda given, node: ~node.is_a("number") | compare(node.number, float(given))


def _of_length(compare: Callable[[Column, int], Column]):
    return lambda given, node: ~node.is_a("string") | compare(F.length(node.text), int(given))


#: Whether a present value keeps a keyword's rule, in the order in which rules are reported.
KEYWORDS: dict[str, Callable[[object, Node], Column]] = {
    "type": _type,
    "const": _equals,
    "enum": _enum,
    "pattern": _pattern,
    "minimum": _of_number(lambda x, n: x >= n),
    "exclusiveMinimum": _of_number(lambda x, n: x > n),
    "maximum": _of_number(lambda x, n: x <= n),
    "exclusiveMaximum": _of_number(lambda x, n: x < n),
    "minLength": _of_length(lambda x, n: x >= n),
    "maxLength": _of_length(lambda x, n: x <= n),
    "format": _format,
}
#: What a keyword may say so that it can be checked.
_SUPPORTED: dict[str, Callable[[object], bool]] = {
    "type": lambda given: bool(_kinds(given)) and set(_kinds(given)) <= set(TYPES),
    "const": lambda given: given is None or isinstance(given, str | int | float),
    "enum": lambda given: bool(given) and all(one is None or isinstance(one, str | int | float) for one in given),
    "format": lambda given: given in ("date-time", "date"),
}
_OBJECT = {"properties", "required", "additionalProperties"}


@dataclass(frozen=True)
class Property:
    """One property of a document: where it is, its rules, and what its parent is."""

    path: tuple[str, ...]
    rules: Mapping[str, object]
    required: bool

    @property
    def name(self) -> str:
        return ".".join(self.path)


@dataclass(frozen=True)
class Closed:
    """An object that has no other properties than these."""

    path: tuple[str, ...]
    names: tuple[str, ...]


def resolved(schema: Mapping, document: Mapping, read: Callable[[str], Mapping]) -> Mapping:
    """``schema`` with a ``$ref`` replaced by what it names, in the document or in a file next to it."""
    seen = set()
    while "$ref" in schema:
        ref = schema["$ref"]
        if ref in seen or set(schema) - ANNOTATIONS - {"$ref"}:
            raise UnknownKeyword(f"$ref {ref} in a circle or beside other rules")
        seen.add(ref)
        file, _, pointer = ref.partition("#")
        if file:
            document = read(file)
        schema = document
        for step in pointer.strip("/").split("/") if pointer.strip("/") else []:
            schema = schema[step.replace("~1", "/").replace("~0", "~")]
    return schema


def compiled(document: Mapping, read: Callable[[str], Mapping]) -> Iterator[Property | Closed]:
    """Every property of an object document, parents first, and the objects closed to others."""
    yield from _object(document, document, read, ())


def _object(schema: Mapping, document: Mapping, read, path: tuple[str, ...]) -> Iterator[Property | Closed]:
    unknown = set(schema) - ANNOTATIONS - _OBJECT - {"type"}
    if unknown or schema.get("type", "object") != "object":
        raise UnknownKeyword(f"{'.'.join(path) or 'document'}: {sorted(unknown) or schema['type']}")
    properties, required = schema.get("properties", {}), set(schema.get("required", ()))
    if required - set(properties):
        raise UnknownKeyword(f"required without a rule: {sorted(required - set(properties))}")
    for name, given in properties.items():
        inner, place = resolved(given, document, read), (*path, name)
        if set(inner) & _OBJECT or inner.get("type") == "object":
            yield Property(place, {"type": "object"}, name in required)
            yield from _object(inner, document, read, place)
            continue
        unknown = set(inner) - ANNOTATIONS - set(KEYWORDS)
        if unknown:
            raise UnknownKeyword(f"{'.'.join(place)}: {sorted(unknown)}")
        rules = {word: inner[word] for word in KEYWORDS if word in inner}
        for word, given in rules.items():
            if not _SUPPORTED.get(word, lambda _: True)(given):
                raise UnknownKeyword(f"{'.'.join(place)}: {word} {given}")
        yield Property(place, rules, name in required)
    closed = schema.get("additionalProperties", True)
    if closed is False:
        yield Closed(path, tuple(properties))
    elif closed is not True:
        raise UnknownKeyword(f"{'.'.join(path) or 'document'}: additionalProperties with a schema")


def _variant_path(path: tuple[str, ...]) -> str:
    return "$" + "".join("[" + json.dumps(step) + "]" for step in path)


def node_at(event: Column, path: tuple[str, ...]) -> Node:
    where = _variant_path(path)
    value = F.try_variant_get(event, where, "variant")
    return Node(value, F.schema_of_variant(value), F.try_variant_get(event, where, "string"))


def keys_of(event: Column, path: tuple[str, ...] = ()) -> Column:
    """Names of an object's properties, null where there is no object."""
    return F.map_keys(F.try_variant_get(event, _variant_path(path), "map<string,variant>"))


def broken_rule(
    rule: Property | Closed, event: Column, keys: Column, document: str, node: Node | None = None
) -> Column:
    """``property: keyword`` of the first rule that the property breaks, null if it breaks none.

    ``keys`` are the names of the event's own properties, ``node`` the property where it was read before.
    """
    node = node or node_at(event, rule.path)
    if isinstance(rule, Closed):
        present = keys_of(event, rule.path) if rule.path else keys
        others = F.size(F.array_except(present, F.array(*map(F.lit, rule.names)).cast("array<string>"))) > 0
        return F.when(others, f"{'.'.join((document, *rule.path))}: additionalProperties")
    missing = F.lit(f"{rule.name}: required" if rule.required else None).cast("string")
    found = F.when(node.value.isNull(), missing)
    if len(rule.path) > 1:
        # A property of an object that is not there is not reported again.
        there = F.coalesce(node_at(event, rule.path[:-1]).is_a("object"), F.lit(False))
        found = F.when(~there, F.lit(None).cast("string")).when(node.value.isNull(), missing)
    for word, given in rule.rules.items():
        found = found.when(~KEYWORDS[word](given, node), f"{rule.name}: {word}")
    return found
