"""JSON Schema conformance: a schema becomes rule columns over variants, judged without leaving the JVM."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .expect import expect

Schema = Mapping | bool
#: A check: where it looks, its keyword, and its verdict on a variant (never NULL for a value that is there).
Check = tuple[str, str, Callable[[Column], Column]]
#: Keywords that say nothing about validity.
NOTES = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "default", "examples",
         "deprecated", "readOnly", "writeOnly", "format"}
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"


# ---------------------------------------------------------------- values

def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _members(v: Column) -> Column:
    """The members of an object, NULL for anything else."""
    return _as(v, "map<string,variant>")


def _elements(v: Column) -> Column:
    """The elements of an array, NULL for anything else."""
    return _as(v, "array<variant>")


def _child(v: Column, name: str) -> Column:
    """A member of an object; NULL where it is absent, a variant null where it is null."""
    if re.fullmatch(r"[\w $-]+", name):
        return F.try_variant_get(v, f"$['{name}']", "variant")
    return F.try_element_at(_members(v), F.lit(name))


def _is(v: Column, kind: str) -> Column:
    if kind == "object":
        return _members(v).isNotNull()
    if kind == "array":
        return _elements(v).isNotNull()
    told = F.schema_of_variant(v)
    number = told.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    if kind == "integer":
        # a number without a fraction, however it is written
        return (told == "BIGINT") | (number & (_as(v, "double") % 1 == 0))
    if kind == "number":
        return number
    named = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
    if kind not in named:
        raise ValueError(f"unknown type: {kind}")
    return told == named[kind]


def _equals(v: Column, value: object) -> Column:
    """Equality of JSON values: numbers by value, objects without regard to the order of members."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return _is(v, "number") & (_as(v, "double") == float(value))
    # variants sort members and drop trailing zeros, so equal values have equal text
    return F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(value))))


def _where(applies: Column, ok: Column) -> Column:
    """Holds where the keyword does not apply."""
    return F.when(applies, F.coalesce(ok, F.lit(False))).otherwise(True)


# ---------------------------------------------------------------- keywords

def _string(key: str, value):
    text = lambda v: _as(v, "string")
    verdicts = {
        "pattern": lambda v: text(v).rlike(value), "minLength": lambda v: F.length(text(v)) >= value,
        "maxLength": lambda v: F.length(text(v)) <= value,
        "format": lambda v: (text(v).rlike(DATE) & text(v).try_cast("date").isNotNull()) if value == "date" else (
            text(v).rlike(DATE_TIME) & text(v).try_cast("timestamp").isNotNull())}
    return lambda v: _where(_is(v, "string"), verdicts[key](v))


def _number(key: str, value):
    n = lambda v: _as(v, "double")
    verdicts = {
        "minimum": lambda v: n(v) >= value, "maximum": lambda v: n(v) <= value, "exclusiveMinimum": lambda v: n(v) > value,
        "exclusiveMaximum": lambda v: n(v) < value, "multipleOf": lambda v: n(v) / value == F.rint(n(v) / value)}
    return lambda v: _where(_is(v, "number"), verdicts[key](v))


def _array(key: str, value):
    size = lambda v: F.size(_elements(v))
    texts = lambda v: F.transform(_elements(v), lambda x: F.to_json(x))
    verdicts = {"minItems": lambda v: size(v) >= value, "maxItems": lambda v: size(v) <= value,
                "uniqueItems": lambda v: F.size(F.array_distinct(texts(v))) == size(v) if value else F.lit(True)}
    return lambda v: _where(_is(v, "array"), verdicts[key](v))


def _object(key: str, value):
    verdicts = {"minProperties": lambda v: F.size(_members(v)) >= value, "maxProperties": lambda v: F.size(_members(v)) <= value}
    return lambda v: _where(_is(v, "object"), verdicts[key](v))


PLAIN = {**dict.fromkeys(("pattern", "minLength", "maxLength"), _string),
         **dict.fromkeys(("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"), _number),
         **dict.fromkeys(("minItems", "maxItems", "uniqueItems"), _array),
         **dict.fromkeys(("minProperties", "maxProperties"), _object)}


class _Compiler:
    """Turns the parts of one schema into checks; ``root`` is what references look into."""

    def __init__(self, root: Schema):
        self.root = root

    def referred(self, ref: str) -> Schema:
        if not ref.startswith("#"):
            raise ValueError(f"reference to another document: {ref}")
        part = self.root
        for step in ref[1:].split("/")[1:]:
            part = part[step.replace("~1", "/").replace("~0", "~")]
        return part

    def holds(self, schema: Schema, above: tuple[str, ...]) -> Callable[[Column], Column]:
        """Whether a value is valid, as one verdict."""
        checks = self.checks(schema, "", above)
        return lambda v: reduce(lambda a, b: a & b, [fn(v) for _, _, fn in checks], F.lit(True))

    def checks(self, schema: Schema, at: str, above: tuple[str, ...] = ()) -> list[Check]:
        if isinstance(schema, bool):
            return [] if schema else [(at, "never", lambda v: F.lit(False))]
        out: list[Check] = []
        for key, value in schema.items():
            if key == "$ref":
                if value in above:
                    raise ValueError(f"reference to itself: {value}")
                out += self.checks(self.referred(value), at, (*above, value))
            elif key == "format" and value in ("date", "date-time"):
                out.append((at, key, _string(key, value)))
            elif key in PLAIN:
                out.append((at, key, PLAIN[key](key, value)))
            elif key in NOTES or key in ("then", "else"):
                continue
            elif hasattr(self, f"on_{key}"):
                out += getattr(self, f"on_{key}")(value, at, above, schema)
            else:
                raise ValueError(f"unsupported keyword: {key}")
        return out

    # any value

    def on_type(self, value, at, above, schema):
        kinds = [value] if isinstance(value, str) else list(value)
        return [(at, "type", lambda v: reduce(lambda a, b: a | b, [_is(v, k) for k in kinds]))]

    def on_const(self, value, at, above, schema):
        return [(at, "const", lambda v: _equals(v, value))]

    def on_enum(self, value, at, above, schema):
        return [(at, "enum", lambda v: reduce(lambda a, b: a | b, [_equals(v, e) for e in value]))]

    # members of objects

    def on_required(self, value, at, above, schema):
        return [(f"{at}.{name}", "required", lambda v, name=name: _where(_is(v, "object"), _child(v, name).isNotNull())) for name in value]

    def on_properties(self, value, at, above, schema):
        def member(name, fn):
            return lambda v: _where(_child(v, name).isNotNull(), fn(_child(v, name)))
        return [(where, key, member(name, fn)) for name, part in value.items()
                for where, key, fn in self.checks(part, f"{at}.{name}", above)]

    def on_patternProperties(self, value, at, above, schema):
        def members(pattern, fn):
            return lambda v: _where(_is(v, "object"), F.forall(F.map_entries(_members(v)), lambda e: ~e["key"].rlike(pattern) | fn(e["value"])))
        return [(where, key, members(pattern, fn)) for pattern, part in value.items()
                for where, key, fn in self.checks(part, f"{at}./{pattern}/", above)]

    def on_additionalProperties(self, value, at, above, schema):
        known, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
        named = lambda k: reduce(lambda a, b: a | b, [k.rlike(p) for p in patterns], k.isin(known) if known else F.lit(False))
        if value is False:
            return [(at, "extra", lambda v: _where(_is(v, "object"), F.forall(F.map_keys(_members(v)), named)))]
        def others(fn):
            return lambda v: _where(_is(v, "object"), F.forall(F.map_entries(_members(v)), lambda e: named(e["key"]) | fn(e["value"])))
        return [(where, key, others(fn)) for where, key, fn in self.checks(value, f"{at}.*", above)]

    def on_propertyNames(self, value, at, above, schema):
        fn = self.holds(value, above)
        return [(at, "propertyNames", lambda v: _where(_is(v, "object"), F.forall(F.map_keys(_members(v)), lambda k: fn(k.cast("variant")))))]

    def on_dependentRequired(self, value, at, above, schema):
        def needed(name, other):
            return lambda v: _child(v, name).isNull() | _child(v, other).isNotNull()
        return [(f"{at}.{other}", "dependent", needed(name, other)) for name, others in value.items() for other in others]

    # elements of arrays

    def on_items(self, value, at, above, schema):
        first = len(schema.get("prefixItems", []))
        rest = lambda v: F.slice(_elements(v), first + 1, F.greatest(F.size(_elements(v)), F.lit(1))) if first else _elements(v)
        def every(fn):
            return lambda v: _where(_is(v, "array"), F.forall(rest(v), lambda x: fn(F.coalesce(x, F.parse_json(F.lit("null"))))))
        return [(where, key, every(fn)) for where, key, fn in self.checks(value, f"{at}[]", above)]

    def on_prefixItems(self, value, at, above, schema):
        def one(i, fn):
            return lambda v: _where(F.size(_elements(v)) > i, fn(F.coalesce(F.get(_elements(v), F.lit(i)), F.parse_json(F.lit("null")))))
        return [(where, key, one(i, fn)) for i, part in enumerate(value) for where, key, fn in self.checks(part, f"{at}[{i}]", above)]

    def on_contains(self, value, at, above, schema):
        fn = self.holds(value, above)
        return [(at, "contains", lambda v: _where(_is(v, "array"), F.exists(_elements(v), lambda x: fn(F.coalesce(x, F.parse_json(F.lit("null")))))))]

    # combinations

    def on_allOf(self, value, at, above, schema):
        return [check for part in value for check in self.checks(part, at, above)]

    def on_anyOf(self, value, at, above, schema):
        parts = [self.holds(part, above) for part in value]
        return [(at, "anyOf", lambda v: reduce(lambda a, b: a | b, [fn(v) for fn in parts]))]

    def on_oneOf(self, value, at, above, schema):
        parts = [self.holds(part, above) for part in value]
        return [(at, "oneOf", lambda v: reduce(lambda a, b: a + b, [fn(v).cast("int") for fn in parts]) == 1)]

    def on_not(self, value, at, above, schema):
        fn = self.holds(value, above)
        return [(at, "not", lambda v: ~fn(v))]

    def on_if(self, value, at, above, schema):
        test = self.holds(value, above)
        def when(fn, met):
            return lambda v: (~test(v) if met else test(v)) | fn(v)
        named = lambda key: "conditional" if key == "required" else f"conditional-{key}"
        return [(where, named(key), when(fn, met)) for branch, met in (("then", True), ("else", False))
                for where, key, fn in self.checks(schema.get(branch, True), at, above)]


# ---------------------------------------------------------------- reports

def schema_rules(doc: str, schema: Schema, prefix: str = "$") -> dict[str, Column]:
    """Rule columns ``path:keyword`` of a JSON Schema for the documents in text column ``doc``.

    Values keep their JSON types (``"5"`` is no number, ``5.0`` is an integer and equals ``5``), and a
    keyword holds for values it does not speak of, absent ones included. One rule speaks for all elements of
    an array (``[]``) or all further members of an object (``*``). Rules of one name, as from
    ``allOf``, are one rule. ``then`` and ``else`` give ``conditional`` rules; ``additionalProperties:
    false`` is ``extra``. References stay within the schema and must not lead back to themselves; ``format`` is
    checked for dates and times only, which must name their zone. Patterns are those of Java. Any
    other keyword is an error, so no part of a schema is left out silently. The verdict is NULL, which
    reports count as failed, where the text is NULL or no JSON, repeated member names and more than a variant
    can hold included.
    """
    return _rules(F.try_parse_json(F.col(doc)), schema, prefix)


def _rules(value: Column, schema: Schema, prefix: str = "$") -> dict[str, Column]:
    rules: dict[str, Column] = {}
    for at, key, fn in _Compiler(schema).checks(schema, prefix):
        name, ok = f"{at}:{key}", F.when(value.isNotNull(), fn(value))
        rules[name] = rules[name] & ok if name in rules else ok
    return rules


def _judged(docs: DataFrame, doc: str, schema: Schema) -> tuple[DataFrame, list[str]]:
    """(documents with ``__ok``, one verdict a rule, rule names): each text is parsed once, each rule judged once."""
    rules = _rules(F.col("__value"), schema)
    verdicts = [F.coalesce(ok, F.lit(False)) for ok in rules.values()]
    ok = F.array(*verdicts) if verdicts else F.array().cast("array<boolean>")
    return docs.withColumn("__value", F.try_parse_json(F.col(doc))).withColumn("__ok", ok).drop("__value"), list(rules)


def schema_report(docs: DataFrame, doc: str, schema: Schema, id: str | None = None) -> DataFrame:
    """(rule, checked, failed, example) of all documents, in one pass."""
    judged, names = _judged(docs, doc, schema)
    return expect(judged, {name: F.get("__ok", F.lit(i)) for i, name in enumerate(names)}, id)


def with_broken_rules(docs: DataFrame, doc: str, schema: Schema, out: str = "broken") -> DataFrame:
    """Documents with the sorted names of the rules they break; all rules for text that is no JSON."""
    judged, names = _judged(docs, doc, schema)
    broken = [F.when(~F.get("__ok", F.lit(names.index(name))), F.lit(name)) for name in sorted(names)]
    return judged.withColumn(out, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")).drop("__ok")
