"""Linking tool calls with their results (operator 4). DataFrame functions only.

Calls and results are joined by conversation and identifier. Calls may depend on other calls of their conversation; a
topological level puts each call after all it depends on. Arguments are checked against the schema of the called tool,
and every call is serialised as canonical JSON: keys sorted, no white space, and one form for each number, however it was
written: ``1``, ``1.0`` and ``1e0`` are the integer 1 (up to 20 digits before and 18 behind the point; beyond that, the
shortest form of a double). Schemas compare numbers by value in the same way.

Levels are longest paths, found in rounds: a dependency on a call whose own level is known is settled; a dependency on
a call that waits for one other call only is handed on to that call, adding up the distance. So a chain of any length
takes rounds by the logarithm of its length. A dependency that comes back to its own call, or runs longer than there
are calls, lies on a cycle; so do those that are left when a round settles nothing. Calls on a cycle, or after one, have
no level. Each round is written to the shared folder.

Defined results: rows with a null conversation or identifier are left out. Of several calls (or results) with one
identifier the first counts, by turn (nulls last), then content; the numbers of calls and results are given. A
result without a call is a row of its own. Status is, in this order of precedence, ``orphan result``, ``cycle``,
``invalid`` (see ``errors``), ``no result`` or ``ok``. Null or unreadable arguments are the error ``not a JSON object``, arguments that
name a key twice the error ``repeated keys`` with the keys (or ``not a JSON object``, if only an inner object does), and
canonical JSON then holds null for them. Very long arguments and contents are read whole. A schema word that is not supported raises an error. Empty tables give an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.session import cut

BLOCKED = 1 << 40  # level of what lies on or after a cycle

# What the types of JSON schemas are called in a parsed value's own schema.
TYPES = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<", "null": "^VOID$"}
# Schema words that are checked, and those that say nothing about a value.
WORDS = (
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "minItems", "maxItems", "items", "required", "properties",
    "additionalProperties", "anyOf", "oneOf", "allOf",
)
NOTES = ("title", "description", "default", "examples", "deprecated", "$schema", "$id", "$comment")


def first_rows(rows: DataFrame, order: list[str], count: str) -> DataFrame:
    """The first row of each (``conv_id``, ``call_id``), nulls last, and how many there are; equal rows count as often.

    Smallest rows and counts are gathered before the shuffle, so an identifier that holds many rows costs no more there.
    """
    key = ["conv_id", "call_id"]
    known = rows.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    rest = [c for c in rows.columns if c not in (*key, *order)]
    ranked = F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(c) for c in order], *rest)
    found = known.groupBy(*key).agg(F.min(ranked).alias("_first"), F.count(F.lit(1)).alias(count))
    return found.select(*key, *[F.col(f"_first.{c}.value").alias(c) for c in order], *[F.col(f"_first.{c}").alias(c) for c in rest], count)


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(``node``, ``level``) for the ``node`` of calls; ``edges`` are (``node``, ``dep``) between them."""
    edges = cut(edges.distinct().select("node", "dep", F.lit(1).cast("long").alias("w")), "call-edges")
    nodes = cut(calls.select("node", F.lit(0).cast("long").alias("base")), "call-levels")
    most = nodes.count()
    while not edges.isEmpty():
        waits = edges.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("next"), F.min("w").alias("next_w"))
        state = nodes.join(waits, "node", "left").select(F.col("node").alias("dep"), F.col("base").alias("dep_base"), F.coalesce("n", F.lit(0)).alias("n"), "next", "next_w")
        seen = edges.join(state, "dep")
        cycle = (F.col("n") == 1) & ((F.col("next") == F.col("node")) | (F.col("w") + F.col("next_w") > most))
        known = F.when((F.col("n") == 0) | (F.col("n") == 1), F.least(F.col("dep_base") + F.col("w"), F.lit(BLOCKED)))
        seen = cut(seen.select("node", "dep", "w", "n", "next", "next_w", F.when(cycle, F.lit(BLOCKED)).otherwise(known).alias("known"), cycle.alias("cycle")), "call-round")
        if seen.filter("n <= 1").isEmpty():
            stuck = edges.select("node").distinct().withColumn("gain", F.lit(BLOCKED))
            nodes = cut(nodes.join(stuck, "node", "left").select("node", F.greatest("base", F.coalesce("gain", "base")).alias("base")), "call-levels")
            break
        gains = seen.groupBy("node").agg(F.max("known").alias("gain"))
        nodes = cut(nodes.join(gains, "node", "left").select("node", F.greatest("base", F.coalesce("gain", "base")).alias("base")), "call-levels")
        left = seen.filter("n > 1").select("node", "dep", "w").unionByName(seen.filter("n = 1 AND NOT cycle").select("node", F.col("next").alias("dep"), (F.col("w") + F.col("next_w")).alias("w")))
        edges = cut(left.groupBy("node", "dep").agg(F.max("w").alias("w")), "call-edges")
    return nodes.select("node", F.when(F.col("base") < BLOCKED, F.col("base")).alias("level"))


# A JSON text falls into strings, numbers, and what stands between them.
TOKENS = r'"(?:[^"\\]|\\.)*+"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[^"0-9-]++|-'


def one_form(json_text: Column) -> Column:
    """JSON text with each number in its one form; null if it is no JSON."""

    def number(token: Column) -> Column:
        exact = token.try_cast("decimal(38,18)")
        double = token.try_cast("double")
        digits = F.length(F.regexp_extract(token, r"\.([0-9]+)", 1))
        plain = (digits <= 18) & (F.abs(double) < 1e20) & ((double == 0) | (F.abs(double) >= 1e-6)) & exact.isNotNull() & ~token.rlike("[eE]-")
        short = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"\.?0+$", ""), "^-0$", "0")
        return F.when(token.rlike("^-?[0-9]+$"), F.regexp_replace(token, "^-0$", "0")).when(plain | (double == F.floor(double)) & (F.abs(double) < 1e18), short).otherwise(double.cast("string"))

    tokens = F.regexp_extract_all(json_text, F.lit(TOKENS), F.lit(0))
    written = F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), number(t)).otherwise(t)), "")
    return F.when(F.try_parse_json(json_text).isNotNull(), F.when(json_text.rlike(r"[0-9][.eE]|-0"), written).otherwise(json_text))


def step_to(name: str) -> str:
    """Path of a property, whatever characters its name holds."""
    if "'" in name and '"' in name:
        raise ValueError(f"property name with both kinds of quotes: {name}")
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def checked(value: Column, rule: Mapping | bool, path: str = "") -> Column:
    """Errors of a variant by a schema, at all depths; none for an absent value. Raises ``ValueError`` on schema words
    that are not in ``WORDS`` or ``NOTES``."""
    if rule is True:
        return F.array().cast("array<string>")
    if not isinstance(rule, Mapping):
        raise ValueError(f"schema not supported at {path or 'top'}: {rule}")
    strange = [w for w in rule if w not in WORDS and w not in NOTES]
    if strange or not isinstance(rule.get("additionalProperties", True), bool):
        raise ValueError(f"schema words not supported at {path or 'top'}: {', '.join(strange) or 'additionalProperties with a schema'}")
    label, inner = path or "arguments", f"{path}." if path else ""
    kind = F.schema_of_variant(value)
    types = rule.get("type", [])
    types = [types] if isinstance(types, str) else list(types)
    fits = kind.rlike("|".join(TYPES[t] for t in types)) if types else kind.isNotNull()
    is_object, is_array = kind.startswith("OBJECT<"), kind.startswith("ARRAY<")
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    number = F.when(kind.rlike(TYPES["number"]), F.try_variant_get(value, "$", "double"))
    members = F.when(is_array, F.try_variant_get(value, "$", "array<variant>"))
    same = lambda v: F.to_json(value) == F.to_json(F.parse_json(one_form(F.lit(json.dumps(v)))))
    bad = {
        "enum": lambda x: ~reduce(Column.__or__, [same(v) for v in x], F.lit(False)), "const": lambda x: ~same(x), "minimum": lambda x: number < x, "maximum": lambda x: number > x,
        "exclusiveMinimum": lambda x: number <= x, "exclusiveMaximum": lambda x: number >= x, "minLength": lambda x: F.length(text) < x, "maxLength": lambda x: F.length(text) > x,
        "pattern": lambda x: ~text.rlike(x), "minItems": lambda x: F.size(members) < x, "maxItems": lambda x: F.size(members) > x,
        "anyOf": lambda x: reduce(Column.__and__, [F.size(checked(value, r, path)) > 0 for r in x]),
        "oneOf": lambda x: reduce(Column.__add__, [(F.size(checked(value, r, path)) == 0).cast("int") for r in x]) != 1,
    }
    found = [F.when(kind.isNotNull() & ~fits, F.lit(f"type of {label}"))]
    found += [F.when(fits & test(rule[w]), F.lit(f"value of {label}")) for w, test in bad.items() if w in rule]
    at = {f: F.when(is_object, F.try_variant_get(value, step_to(f), "variant")) for f in (*rule.get("required", []), *rule.get("properties", {}))}
    found += [F.when(is_object & at[f].isNull(), F.lit(f"missing {inner}{f}")) for f in rule.get("required", [])]
    more = [checked(at[f], r, f"{inner}{f}") for f, r in rule.get("properties", {}).items()]
    more += [checked(value, r, path) for r in rule.get("allOf", [])]
    if "items" in rule:
        each = F.flatten(F.transform(members, lambda x: checked(x, rule["items"], f"{label}[]")))
        more.append(F.coalesce(F.array_distinct(each), F.array().cast("array<string>")))
    if rule.get("additionalProperties") is False:
        keys = F.when(is_object, F.json_object_keys(F.to_json(value)))
        extra = F.array_except(keys, F.array(*[F.lit(f) for f in rule.get("properties", {})]).cast("array<string>"))
        said = F.concat(F.lit(f"unknown keys of {path} " if path else "unknown keys "), F.array_join(F.array_sort(extra), " "))
        more.append(F.array_compact(F.array(F.when(F.size(extra) > 0, said))))
    return F.concat(F.array_compact(F.array(*found)), *more)


def schema_errors(name: Column, arguments: Column, plain: Column, schemas: Mapping[str, Mapping]) -> Column:
    """Errors of a call's arguments by the schema of its tool, at all depths (``checked``); ``plain`` are the arguments in one form."""
    value = F.try_parse_json(plain)
    readable = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    chosen = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        chosen = F.when(name == tool, checked(value, schema)).otherwise(chosen)
    keys = F.json_object_keys(arguments)
    repeated = F.array_sort(F.array_distinct(F.filter(keys, lambda k: F.size(F.filter(keys, lambda other: other == k)) > 1)))
    named = F.array(F.concat(F.lit("repeated keys "), F.array_join(repeated, " ")))
    return F.when(readable, chosen).when(F.size(repeated) > 0, named).otherwise(F.array(F.lit("not a JSON object")))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per call, and per result without a call.

    ``calls``: ``conv_id``, ``call_id`` (string), ``turn``, ``name``, ``arguments`` (JSON text), ``depends_on``
    (array of call ids, may be null). ``results``: ``conv_id``, ``call_id``, ``turn``, ``content``. Other columns are
    left out. Returns ``conv_id``, ``call_id``, ``turn``, ``name``, ``status``, ``level``, ``errors``, ``n_calls``, ``n_results`` and
    ``json``; ``level``, then ``turn``, then ``call_id`` is a topological order of each conversation.
    """
    node = F.concat_ws("\x1f", F.col("conv_id").cast("string"), "call_id")
    calls = calls.select("conv_id", F.col("call_id").cast("string").alias("call_id"), "turn", "name", "arguments", F.array_distinct(F.array_compact("depends_on")).alias("depends_on"))
    results = results.select("conv_id", F.col("call_id").cast("string").alias("call_id"), F.col("turn").alias("result_turn"), "content")
    ordered = calls.withColumn("_deps", F.array_join("depends_on", "\x1f"))
    calls = cut(first_rows(ordered, ["turn", "name", "arguments", "_deps"], "n_calls").drop("_deps").withColumn("node", node).withColumn("plain", one_form(F.col("arguments"))), "calls")
    results = first_rows(results, ["result_turn", "content"], "n_results")
    wanted = calls.select("conv_id", "node", F.explode("depends_on").alias("call_id"))
    deps = wanted.select("node", F.concat_ws("\x1f", F.col("conv_id").cast("string"), "call_id").alias("dep"))
    known = deps.join(calls.select(F.col("node").alias("dep")), "dep", "left_semi")
    unknown = deps.join(calls.select(F.col("node").alias("dep")), "dep", "left_anti").groupBy("node").agg(F.count(F.lit(1)).alias("n_unknown"))
    called = calls.join(levels(calls, known), "node").join(unknown, "node", "left").drop("node")
    both = called.withColumn("is_call", F.lit(True)).join(results, ["conv_id", "call_id"], "full")
    is_call = F.col("is_call").isNotNull()
    lost = F.when(F.col("n_unknown") > 0, F.array(F.lit("unknown dependency"))).otherwise(F.array().cast("array<string>"))
    errors = F.when(is_call, F.concat(schema_errors(F.col("name"), F.col("arguments"), F.col("plain"), schemas), lost)).otherwise(F.array().cast("array<string>"))
    out = both.withColumn("_errors", errors).withColumn("is_call", is_call)
    status = (
        F.when(~F.col("is_call"), "orphan result").when(F.col("level").isNull(), "cycle").when(F.size("_errors") > 0, "invalid").when(F.col("n_results").isNull(), "no result").otherwise("ok")
    )
    canonical = F.to_json(
        F.struct(F.try_parse_json("plain").alias("arguments"), "call_id", F.col("_errors").alias("errors"), "level", "name", F.col("content").alias("result"), status.alias("status")),
        {"ignoreNullFields": "false"},
    )
    return out.select(
        "conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "name", status.alias("status"), "level", F.array_join("_errors", ", ").alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"), canonical.alias("json"),
    )
