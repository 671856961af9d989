"""Schema contracts: a JSON Schema compiled to one Spark expression over a VARIANT that yields every violation.

A contract is data (the dialect of 2020-12 without remote references); :func:`violations` turns it into an array of
(path, rule) for a value, so a table of documents is checked in one pass, in the JVM, without a row leaving it.  ``path`` is the
place in the document, a missing or unwanted field included; ``rule`` is the keyword that is broken.

Keywords: type, const, enum, the bounds of numbers, strings, arrays and objects, pattern, format (date, date-time, uri), required, properties,
patternProperties, additionalProperties, propertyNames, dependentRequired, items, prefixItems, contains, uniqueItems, allOf, anyOf,
oneOf, not, if/then/else, and ``$ref`` into the document itself, if it is not recursive.  Another keyword is an error when the
contract is compiled.  Patterns are those of Java with Unicode classes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FOUND = "array<struct<path:string,rule:string>>"
_REMARKS = {"$id", "$schema", "$defs", "$comment", "title", "description", "default", "examples", "deprecated"}
_NUMBERS = {
    "minimum": lambda x, n: x >= n, "maximum": lambda x, n: x <= n, "exclusiveMinimum": lambda x, n: x > n, "exclusiveMaximum": lambda x, n: x < n,
    "multipleOf": lambda x, n: x % n == 0,
}
_PLAIN_TYPES = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID", "integer": "BIGINT"}
_SIZES = {"Length": F.char_length, "Items": F.size, "Properties": F.size}
_FORMATS = {
    "date": lambda s: s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & s.try_cast("date").isNotNull(),
    "date-time": lambda s: s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$") & F.upper(s).try_cast("timestamp").isNotNull(),
    "uri": lambda s: s.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$"),
}


class ContractError(ValueError):
    """A contract that is not well-formed, or is not known."""


@dataclass(frozen=True)
class _One:
    """A violation that is there if ``broken`` is true."""

    broken: Column
    path: Column
    rule: str

    def found(self) -> Column:
        return F.struct(self.path.alias("path"), F.lit(self.rule).alias("rule"))


def _none() -> Column:
    return F.array().cast(_FOUND)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """The array of violations ``f`` of a value that is computed once.

    An aggregate, whose result needs no taking out of an array: for that Spark derives the type of all of ``f`` again in every row."""
    return F.aggregate(F.array(value), _none(), lambda _, x: f(x))


def _all(parts: list[_One | Column]) -> Column:
    """Single violations and arrays of them as one array."""
    ones, arrays = [p for p in parts if isinstance(p, _One)], [p for p in parts if not isinstance(p, _One)]
    if len(ones) == 1:
        arrays = [F.when(ones[0].broken, F.array(ones[0].found())).otherwise(_none()), *arrays]
    elif ones:
        arrays = [F.array_compact(F.array(*[F.when(x.broken, x.found()) for x in ones])), *arrays]
    return F.concat(*arrays) if len(arrays) > 1 else arrays[0] if arrays else _none()


def _each(array: Column, f: Callable[[Column, Column], list[_One | Column]]) -> Column:
    return F.coalesce(F.flatten(F.transform(array, lambda x, i: _all(f(x, i)))), _none())


class _Value:
    """A value that is there: its SQL type, from which JSON types are read, and members and elements if they are known.

    Conditions begin with what is false of most values, so the SQL type is read for few."""

    def __init__(self, value: Column, sql: Column, members: Column | None = None, elements: Column | None = None):
        self.value, self.sql, self.members, self.elements = value, sql, members, elements

    def number(self) -> Column:
        return self.sql.rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")

    def is_a(self, *names: str) -> Column:
        fits = F.lit(False)
        for name, known, prefix in (("object", self.members, "OBJECT"), ("array", self.elements, "ARRAY")):
            if name in names:
                fits = fits | (self.sql.startswith(prefix) if known is None else known.isNotNull())
        if plain := [_PLAIN_TYPES[n] for n in names if n in _PLAIN_TYPES]:
            fits = fits | self.sql.isin(plain)
        if "number" in names:
            fits = fits | self.number()
        elif "integer" in names:
            fits = fits | self.number() & F.coalesce(F.try_variant_get(self.value, "$", "double") % 1 == 0, F.lit(False))
        return fits

    def equals(self, *stated) -> Column:
        fits = F.lit(False)
        texts = [x for x in stated if isinstance(x, str)]
        if texts and all(re.fullmatch(r"[ !#-\[\]-~]*", x) for x in texts):
            fits = fits | F.to_json(self.value).isin([f'"{x}"' for x in texts]) & self.is_a("string")
        elif texts:
            fits = fits | self.text().isin(texts) & self.is_a("string")
        for x in stated:
            if x is None:
                fits = fits | self.is_a("null")
            elif isinstance(x, bool):
                fits = fits | self.is_a("boolean") & (F.try_variant_get(self.value, "$", "boolean") == x)
            elif isinstance(x, int | float):
                fits = fits | (self.amount(x) == x) & self.number()
            elif not isinstance(x, str):
                fits = fits | (F.to_json(self.value) == json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)) & self.is_a("object" if isinstance(x, dict) else "array")
        return F.coalesce(fits, F.lit(False))

    def amount(self, like: int | float) -> Column:
        """A number as decimal or double; of a whole bound from its text, because a VARIANT's own cast is planned again for every value."""
        return F.try_variant_get(self.value, "$", "double") if isinstance(like, float) else F.to_json(self.value).try_cast("decimal(38,9)")

    def text(self) -> Column:
        return F.try_variant_get(self.value, "$", "string")


def _types(schema: dict) -> list[str]:
    names = schema.get("type", [])
    return names if isinstance(names, list) else [names]


class _Compiler:
    def __init__(self, root: dict):
        self.root = root

    def check(self, schema, value: Column, path: Column, refs: tuple[str, ...] = ()) -> list[_One | Column]:
        """Violations of ``value``, which is there (not a missing field), and cheap: it is asked many times.

        The SQL type of an object or array is that of all in it: these are known by their members and elements, which are taken out once."""
        asked = self.asks(schema, refs)
        sql = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        if not asked:
            return self.parts(schema, _Value(value, sql), path, refs)
        inner = lambda m, a: _all(self.parts(schema, _Value(value, sql, m, a), path, refs))
        members, elements = F.try_variant_get(value, "$", "map<string,variant>"), F.try_variant_get(value, "$", "array<variant>")
        if "object" not in asked:
            return [_let(elements, lambda a: inner(None, a))]
        return [_let(members, lambda m: _let(elements, lambda a: inner(m, a)) if "array" in asked else inner(m, None))]

    def asks(self, schema, refs: tuple[str, ...] = ()) -> set[str]:
        """Whether a schema, with those that it applies to the same value, asks for members (object) or elements (array)."""
        if isinstance(schema, bool):
            return set()
        out = {"object"} if _OBJECTS & set(schema) else set()
        out |= {"array"} if _ARRAYS & set(schema) else set()
        out |= {"object", "array"} & {*_types(schema)}
        for s in [*schema.get("allOf", []), *schema.get("anyOf", []), *schema.get("oneOf", []), *[schema[k] for k in ("not", "if", "then", "else") if k in schema]]:
            out |= self.asks(s, refs)
        if "$ref" in schema:
            out |= self.asks(*self.referred(schema["$ref"], refs))
        return out

    def referred(self, ref: str, refs: tuple[str, ...]):
        if ref in refs:
            raise ContractError(f"recursive reference: {ref}")
        return self.resolve(ref), (*refs, ref)

    def parts(self, schema, v: _Value, path: Column, refs) -> list[_One | Column]:
        if isinstance(schema, bool):
            return [] if schema else [_One(F.lit(True), path, "false")]
        if unknown := set(schema) - _KNOWN:
            raise ContractError(f"unknown keywords: {sorted(unknown)}")
        out = []
        if "$ref" in schema:
            to, seen = self.referred(schema["$ref"], refs)
            out += self.parts(to, v, path, seen)
        out += self.plain(schema, v, path)
        out += self.combined(schema, v, path, refs)
        for kind, keywords, known, of in (("object", _OBJECTS, v.members, self.object_parts), ("array", _ARRAYS, v.elements, self.array_parts)):
            if keywords & set(schema):
                other = F.array(_One(F.lit(True), path, "type").found()) if _types(schema) == [kind] else _none()
                out.append(F.when(known.isNotNull(), _all(of(schema, known, path, refs))).otherwise(other))
        return out

    def plain(self, schema, v: _Value, path: Column) -> list[_One]:
        """What needs no look into members and elements."""
        names = _types(schema)
        told = names == ["object"] and _OBJECTS & set(schema) or names == ["array"] and _ARRAYS & set(schema)  # parts() says it
        out = [_One(~v.is_a(*names), path, "type")] if "type" in schema and not told else []
        out += [_One(~v.equals(*(schema[rule] if rule == "enum" else [schema[rule]])), path, rule) for rule in ("const", "enum") if rule in schema]
        for rule, fits in _NUMBERS.items():
            if rule in schema:
                out.append(_One(~fits(v.amount(schema[rule]), F.lit(schema[rule])) & v.number(), path, rule))
        out += self.sized(schema, v.is_a("string"), path, "Length", v.text())
        if "pattern" in schema:
            out.append(_One(~v.text().rlike("(?U)" + schema["pattern"]) & v.is_a("string"), path, "pattern"))
        if schema.get("format") in _FORMATS:
            out.append(_One(~_FORMATS[schema["format"]](v.text()) & v.is_a("string"), path, "format"))
        return out

    def sized(self, schema, kind: Column, path, what: str, of: Column) -> list[_One]:
        size = _SIZES[what](of)
        out = [_One((size < schema[f"min{what}"]) & kind, path, f"min{what}")] if f"min{what}" in schema else []
        return out + ([_One((size > schema[f"max{what}"]) & kind, path, f"max{what}")] if f"max{what}" in schema else [])

    def holds(self, parts: list[_One | Column]) -> Column:
        broken = F.lit(False)
        for part in parts:
            broken = broken | (F.coalesce(part.broken, F.lit(False)) if isinstance(part, _One) else F.size(part) > 0)
        return ~broken

    def combined(self, schema, v: _Value, path, refs) -> list[_One | Column]:
        parts = lambda s: self.parts(s, v, path, refs)
        out = [part for s in schema.get("allOf", []) for part in parts(s)]
        for rule, fits in (("anyOf", lambda n: n >= 1), ("oneOf", lambda n: n == 1)):
            if rule in schema:
                n = F.lit(0)
                for s in schema[rule]:
                    n = n + self.holds(parts(s)).cast("int")
                out.append(_One(~fits(n), path, rule))
        if "not" in schema:
            out.append(_One(self.holds(parts(schema["not"])), path, "not"))
        if "if" in schema:
            then, other = (_all(parts(schema.get(k, True))) for k in ("then", "else"))
            out.append(F.when(self.holds(parts(schema["if"])), then).otherwise(other))
        return out

    def object_parts(self, schema, members: Column, path, refs) -> list[_One | Column]:
        at = lambda name: F.concat(path, F.lit("/"), name)
        has = lambda name: F.try_element_at(members, F.lit(name)).isNotNull()
        out = [_One(~has(name), at(F.lit(name)), "required") for name in schema.get("required", [])]
        for name, others in schema.get("dependentRequired", {}).items():
            out += [_One(has(name) & ~has(x), at(F.lit(x)), "dependentRequired") for x in others]
        for name, s in schema.get("properties", {}).items():
            out += self.part(s, F.try_element_at(members, F.lit(name)), at(F.lit(name)), refs)
        keys, stated = F.map_keys(members), [*schema.get("properties", {})]
        for pattern, s in schema.get("patternProperties", {}).items():
            out.append(_each(F.filter(keys, _rlike(pattern)), self.member(s, members, at, refs)))
        if schema.get("additionalProperties", True) is not True:
            rest = F.filter(keys, lambda k: ~k.isin(stated)) if stated else keys
            for pattern in schema.get("patternProperties", {}):
                rest = F.filter(rest, _unlike(pattern))
            s = schema["additionalProperties"]
            if s is False:
                out.append(F.transform(rest, lambda k: _One(F.lit(True), at(k), "additionalProperties").found()))
            else:
                out.append(_each(rest, self.member(s, members, at, refs)))
        if "propertyNames" in schema:
            out.append(_each(F.transform(keys, lambda k: F.struct(k.alias("k"), k.cast("variant").alias("v"))), lambda x, _: self.check(schema["propertyNames"], x["v"], at(x["k"]), refs)))
        return out + self.sized(schema, members.isNotNull(), path, "Properties", members)

    def part(self, s, value: Column, path: Column, refs) -> list[_One | Column]:
        """Violations of a member or element that may be missing; what is taken out is cheap enough to be taken out again for a simple schema."""
        if not self.asks(s, refs) and (isinstance(s, bool) or not _COMBINED & set(s)):
            return [_One(x.broken & value.isNotNull(), x.path, x.rule) for x in self.check(s, value, path, refs)]
        return [_let(value, lambda x: F.when(x.isNotNull(), _all(self.check(s, x, path, refs))).otherwise(_none()))]

    def member(self, s, members: Column, at, refs):
        return lambda k, _: [_let(F.try_element_at(members, k), lambda x: _all(self.check(s, x, at(k), refs)))]

    def array_parts(self, schema, elements: Column, path, refs) -> list[_One | Column]:
        at = lambda i: F.concat(path, F.lit("/"), i.cast("string"))
        first = schema.get("prefixItems", [])
        out = []
        for n, s in enumerate(first):
            out += self.part(s, F.try_element_at(elements, F.lit(n + 1)), at(F.lit(n)), refs)
        if "items" in schema:
            rest = F.slice(elements, len(first) + 1, F.greatest(F.size(elements) - len(first), F.lit(0))) if first else elements
            out.append(_each(rest, lambda x, i: self.check(schema["items"], x, at(i + len(first)), refs)))
        if schema.get("uniqueItems"):
            texts = F.transform(elements, lambda x: F.to_json(x))
            out.append(_One(F.size(F.array_distinct(texts)) < F.size(texts), path, "uniqueItems"))
        if "contains" in schema:
            n = F.size(F.filter(elements, lambda x: self.holds(self.check(schema["contains"], x, path, refs))))
            out.append(_One(n < schema.get("minContains", 1), path, "contains"))
            if "maxContains" in schema:
                out.append(_One(n > schema["maxContains"], path, "maxContains"))
        return out + self.sized(schema, elements.isNotNull(), path, "Items", elements)

    def resolve(self, ref: str):
        if not ref.startswith("#"):
            raise ContractError(f"a remote reference: {ref}")
        found = self.root
        for name in ref.lstrip("#").split("/")[1:]:
            found = found.get(name.replace("~1", "/").replace("~0", "~")) if isinstance(found, dict) else None
        if found is None:
            raise ContractError(f"no such reference: {ref}")
        return found


def _rlike(pattern: str):
    return lambda k: k.rlike("(?U)" + pattern)


def _unlike(pattern: str):
    return lambda k: ~k.rlike("(?U)" + pattern)


_OBJECTS = {"required", "dependentRequired", "properties", "patternProperties", "additionalProperties", "propertyNames", "minProperties", "maxProperties"}
_ARRAYS = {"items", "prefixItems", "uniqueItems", "contains", "minContains", "maxContains", "minItems", "maxItems"}
_COMBINED = {"$ref", "allOf", "anyOf", "oneOf", "not", "if", "then", "else"}
_KNOWN = _OBJECTS | _ARRAYS | set(_NUMBERS) | _REMARKS | {"type", "const", "enum", "minLength", "maxLength", "pattern", "format"} | _COMBINED


def violations(schema: dict, value: Column) -> Column:
    """Array of (path, rule), by path; empty for a value that fits, null for no value."""
    found = _let(value, lambda v: _all(_Compiler(schema).check(schema, v, F.lit(""))))
    return F.when(value.isNotNull(), F.sort_array(F.array_distinct(found)))


@dataclass(frozen=True)
class Contract:
    """A schema with its version, and rules that a schema cannot say: name and expression of the VARIANT that must be true."""

    name: str
    version: str
    schema: dict
    rules: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def __post_init__(self):
        stated = self.schema.get("properties", {}).get("schema_version", {}).get("const")
        if stated != self.version:
            raise ContractError(f"{self.name}: the schema says version {stated}, the registry {self.version}")

    def violations(self, value: Column) -> Column:
        """Of the schema; where there are none, of the further rules (path empty)."""
        broken = [_One(~F.coalesce(rule(value), F.lit(False)), F.lit(""), name) for name, rule in self.rules.items()]
        return _let(violations(self.schema, value), lambda found: F.when(F.size(found) == 0, _all(broken)).otherwise(found))


class Registry:
    """Contracts by name, each name once."""

    def __init__(self, contracts: list[Contract]):
        self.contracts = {c.name: c for c in contracts}
        if len(self.contracts) < len(contracts):
            raise ContractError("a contract is registered twice")

    def contract(self, name: str) -> Contract:
        if name not in self.contracts:
            raise ContractError(f"no such contract: {name}")
        return self.contracts[name]

    def validated(self, frame: DataFrame, name: str, value: str, found: str = "violations") -> DataFrame:
        """``frame`` with the violations of the VARIANT column ``value``."""
        return frame.withColumn(found, self.contract(name).violations(F.col(value)))

    def broken(self, frame: DataFrame, name: str, value: str) -> DataFrame:
        """A row of ``frame`` with path and rule for each violation of the VARIANT column ``value``.

        The outer form of explode keeps Spark from asking the whole expression a second time as a filter below; a column of its own
        keeps explode from deriving the expression's type again for every row."""
        others = [c for c in frame.columns if c != value]
        found = frame.select(*others, self.contract(name).violations(F.col(value)).alias("_found"))
        return found.select(*others, F.explode_outer("_found").alias("_v")).where("_v IS NOT NULL").select(*others, "_v.path", "_v.rule")


def sorted_list(name: str) -> Callable[[Column], Column]:
    """A rule: the list in field ``name`` is in order."""
    items = lambda v: F.try_variant_get(v, f"$.{name}", "array<string>")
    return lambda v: items(v) == F.array_sort(items(v))
