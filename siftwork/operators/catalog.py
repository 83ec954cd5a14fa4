"""Tool catalogue: schema gate, gate funnel, curation and offline policy."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions.jsons import canonical_json, strict_json, tool_arguments, variant_type
from siftwork.functions.text import bind, normalise_name, truncate
from siftwork.session import spread

GATES = ["schema", "parse", "sandbox", "fuzz", "trajectory"]

# Identifiers and member accesses a tool body must not use.
BANNED_IDENTIFIERS = [
    "fetch",
    "require",
    "import",
    "process",
    "globalThis",
    "eval",
    "Function",
    "crypto",
    "performance",
]
BANNED_MEMBERS = [("Math", "random"), ("Date", "now"), ("constructor", "constructor")]
# Errors that mean an execution hit a resource limit.
RESOURCE_FAILURE = "(?i)timeout|timed out|exit|memory|resource|killed|terminated"
OFFLINE_ERROR = "This tool requires network. Device is offline."
# JSON-Schema types and the keywords the gate understands.
SCHEMA_TYPES = ["string", "number", "integer", "boolean", "object", "array", "null"]
SCHEMA_KEYWORDS = ["type", "properties", "required", "enum", "items", "additionalProperties", "description"]

# Keywords the call gate checks, and those that check nothing.
GATE_KEYWORDS = [
    "type", "properties", "required", "enum", "const", "items", "additionalProperties",
    "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "minItems", "maxItems",
]
ANNOTATIONS = ["description", "title", "default", "examples", "$schema", "$id", "$comment", "readOnly", "writeOnly", "deprecated"]

# What a value beyond a limit is told.
LIMIT_MESSAGES = {
    "minimum": "must be >= {}",
    "maximum": "must be <= {}",
    "exclusiveMinimum": "must be > {}",
    "exclusiveMaximum": "must be < {}",
    "minLength": "must NOT have fewer than {} characters",
    "maxLength": "must NOT have more than {} characters",
    "pattern": 'must match pattern "{}"',
    "minItems": "must NOT have fewer than {} items",
    "maxItems": "must NOT have more than {} items",
}


# --- schema gate ------------------------------------------------------------


def check_schema(schema: dict, at: str = "") -> None:
    """Refuse a schema with a keyword or form the gate would have to ignore."""
    if not isinstance(schema, dict):
        raise ValueError(f"schema{at}: {schema!r} is not an object")
    unknown = sorted(set(schema) - {*GATE_KEYWORDS, *ANNOTATIONS})
    if unknown:
        raise ValueError(f"schema{at}: keywords that cannot be checked: {', '.join(unknown)}")
    types = schema.get("type", [])
    if set([types] if isinstance(types, str) else types) - set(SCHEMA_TYPES):
        raise ValueError(f"schema{at}: unknown type {types!r}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"schema{at}: additionalProperties can only be true or false")
    for key, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}/{key}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}/items")


def _limits(schema: dict) -> list[dict]:
    """Rules of one schema node, in the order in which their faults are told."""
    found = []

    def add(keyword: str, message: str, texts: list[str] = [], number: float | None = None) -> None:  # noqa: B006
        found.append({"keyword": keyword, "texts": texts, "number": number, "message": message})

    if "type" in schema:
        options = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        add("type", f" must be {','.join(options)}", options)
    if "enum" in schema:
        add("enum", " must be equal to one of the allowed values", [json.dumps(v) for v in schema["enum"]])
    if "const" in schema:
        add("enum", " must be equal to constant", [json.dumps(schema["const"])])
    for keyword, message in LIMIT_MESSAGES.items():
        if keyword in schema:
            limit = schema[keyword]
            texts, number = ([limit], None) if keyword == "pattern" else ([], float(limit))
            add(keyword, " " + message.format(limit), texts, number)
    for key in schema.get("required", []):
        add("required", f" must have required property '{key}'", [key])
    if schema.get("additionalProperties") is False:
        add("additional", " must NOT have additional properties", list(schema.get("properties", {})))
    return found


def _step(key: str) -> str:
    """A property as a step of a path; ``[]`` is the step to the items of an array."""
    return "/" + key.replace("~", "~0").replace("/", "~1").replace("[", "~2")


def compiled_rules(schema: dict, path: str = "", place: int = 0) -> dict[str, dict]:
    """The nodes of a schema by path, each with its place among its siblings and its rules."""
    nodes = {path: {"place": place, "rules": _limits(schema)}}
    for number, (key, inner) in enumerate(schema.get("properties", {}).items()):
        nodes |= compiled_rules(inner, path + _step(key), number)
    if schema.get("items"):
        nodes |= compiled_rules(schema["items"], path + "[]")
    return nodes


_RULES = "array<struct<keyword:string,texts:array<string>,number:double,message:string>>"
_NODES = f"map<string,struct<place:int,rules:{_RULES}>>"
RULE_BYTES = 8 << 20  # compiled rules up to this size are broadcast


def rule_table(spark: SparkSession, tools: list[dict]) -> tuple[DataFrame, int, int]:
    """``(tool, nodes)`` of all tools, the depth of the deepest schema, and the size of the rules.

    Of several tools with one name the first counts.
    """
    rows: dict[str, dict] = {}
    for tool in tools:
        spec = tool["function"]
        check_schema(spec["parameters"], f" of {spec['name']}")
        rows.setdefault(spec["name"], compiled_rules(spec["parameters"]))
    depth = max((path.count("/") + path.count("[]") for nodes in rows.values() for path in nodes), default=0)
    table = spark.createDataFrame(list(rows.items()), f"tool string, nodes {_NODES}")
    sorted_texts = F.transform_values(
        "nodes",
        lambda _, node: F.struct(
            node["place"].alias("place"),
            F.transform(
                node["rules"],
                lambda r: F.struct(
                    r["keyword"].alias("keyword"),
                    F.when(r["keyword"] == "enum", F.transform(r["texts"], canonical_json)).otherwise(r["texts"]).alias("texts"),
                    r["number"].alias("number"),
                    r["message"].alias("message"),
                ),
            ).alias("rules"),
        ),
    )
    return table.withColumn("nodes", sorted_texts), depth, sum(len(repr(nodes)) for nodes in rows.values())


def _children(node: Column, nodes: Column) -> Column:
    """The parts of a value that its schema has rules for."""
    value, at, path, place = node["value"], node["at"], node["path"], node["place"]
    escaped = lambda k: F.replace(F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.lit("["), F.lit("~2"))

    def child(at: Column, path: Column, number: Column, value: Column) -> Column:
        value = F.coalesce(value, F.parse_json(F.lit("null")))
        places = F.concat(place, F.array(number))
        return F.struct(at.alias("at"), path.alias("path"), places.alias("place"), value.alias("value"))

    def of_key(entry: Column) -> Column:
        step = F.concat(path, F.lit("/"), escaped(entry["key"]))
        return F.when(
            F.map_contains_key(nodes, step),
            child(F.concat(at, F.lit("/"), entry["key"]), step, F.element_at(nodes, step)["place"], entry["value"]),
        )

    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    step = F.concat(path, F.lit("[]"))
    items = F.transform(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda v, i: child(F.concat(at, F.lit("/"), i.cast("string")), step, i, v),
    )
    return F.when(variant_type(value) == "object", F.array_compact(F.transform(entries, of_key))).when(
        F.map_contains_key(nodes, step), items
    )


def _broken(rule: Column, value: Column, kind: Column) -> Column:
    """How many faults a value has against one rule."""
    number, text = F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$", "string")
    size = F.size(F.try_variant_get(value, "$", "array<variant>"))
    keys = F.coalesce(F.json_object_keys(F.to_json(value)), F.array().cast("array<string>"))
    texts, limit = rule["texts"], rule["number"]
    whole = F.array_contains(texts, F.lit("integer")) & (kind == "number") & (number == F.floor(number))
    holds = {
        "type": F.array_contains(texts, kind) | whole,
        "enum": F.array_contains(texts, F.to_json(value)),
        "minimum": (kind != "number") | (number >= limit),
        "maximum": (kind != "number") | (number <= limit),
        "exclusiveMinimum": (kind != "number") | (number > limit),
        "exclusiveMaximum": (kind != "number") | (number < limit),
        "minLength": (kind != "string") | (F.length(text) >= limit),
        "maxLength": (kind != "string") | (F.length(text) <= limit),
        "pattern": (kind != "string") | F.regexp_like(text, F.get(texts, F.lit(0))),
        "minItems": (kind != "array") | (size >= limit),
        "maxItems": (kind != "array") | (size <= limit),
        "required": (kind != "object") | F.array_contains(keys, F.get(texts, F.lit(0))),
    }
    strange = F.when(kind == "object", F.size(F.array_except(keys, texts))).otherwise(0)
    count = F.when(rule["keyword"] == "additional", strange)
    for keyword, good in holds.items():
        count = count.when(rule["keyword"] == keyword, F.when(good, 0).otherwise(1))
    return count.otherwise(0)


def rule_faults(nodes: Column, arguments: Column, depth: int) -> Column:
    """All faults of a variant against the compiled nodes of its schema, in the schema's order."""
    root = F.array(
        F.struct(
            F.lit("").alias("at"), F.lit("").alias("path"), F.array().cast("array<int>").alias("place"), arguments.alias("value")
        )
    )

    def node_faults(node: Column) -> Column:
        shown = F.when(node["at"] == "", F.lit("/")).otherwise(node["at"])

        def of_kind(kind: Column) -> Column:
            told = F.transform(
                F.element_at(nodes, node["path"])["rules"],
                lambda r, i: F.array_repeat(
                    F.struct(node["place"].alias("place"), i.alias("rule"), F.concat(shown, r["message"]).alias("fault")),
                    _broken(r, node["value"], kind),
                ),
            )
            return F.flatten(told)

        return bind(variant_type(node["value"]), of_kind)

    def levels(level: Column, left: int) -> Column:
        own = F.flatten(F.transform(level, node_faults))
        if not left:
            return own
        below = F.flatten(F.array_compact(F.transform(level, lambda n: _children(n, nodes))))
        return F.concat(own, bind(below, lambda deeper: levels(deeper, left - 1)))

    return F.transform(F.array_sort(levels(root, depth)), lambda f: f["fault"])


def gate_calls(
    calls: DataFrame, tools: list[dict], name: str = "name", arguments: str = "arguments"
) -> DataFrame:
    """Add ``faults`` and ``valid`` to a table of calls with JSON arguments.

    Schemas become a table of rules by path, joined to the calls by tool: one scan and
    one parse of the arguments, whatever the number of schemas. Rules up to
    ``RULE_BYTES`` are broadcast; beyond that the join is an ordinary one, whose skewed keys
    adaptive execution splits. A schema with a keyword that cannot be checked is refused.
    Anything but a JSON object counts as ``{}``.
    """
    rules, depth, size = rule_table(calls.sparkSession, tools)
    rules = rules.select(F.col("tool").alias("_tool"), F.col("nodes").alias("_nodes"))
    met = spread(calls).join(F.broadcast(rules) if size <= RULE_BYTES else rules, F.col(name) == F.col("_tool"), "left")
    unknown = F.array(F.concat(F.lit("unknown tool: "), F.col(name)))
    found = bind(tool_arguments(F.col(arguments)), lambda value: rule_faults(F.col("_nodes"), value, depth))
    faults = F.when(F.col("_nodes").isNull(), unknown).otherwise(found)
    return met.withColumn("faults", faults).withColumn("valid", F.size("faults") == 0).drop("_tool", "_nodes")


def passing_examples(gated_calls: DataFrame, example: str) -> DataFrame:
    """Examples all of whose calls are valid: one bad call rejects the example."""
    return gated_calls.groupBy(example).agg(F.bool_and("valid").alias("valid")).filter("valid").select(example)


# --- gates on candidate tools ------------------------------------------------


def declared_schema_fault(parameters: Column) -> Column:
    """Why a parameter schema is not well formed, or null.

    The schema must be a JSON object; types and keywords must be known, for the
    schema itself, its properties and their items.
    """
    parsed = strict_json(parameters)
    keywords = F.array(*[F.lit(k) for k in SCHEMA_KEYWORDS])
    types = F.array(*[F.lit(t) for t in SCHEMA_TYPES])

    def fault_of(node: Column) -> Column:
        keys = F.coalesce(F.json_object_keys(F.to_json(node)), F.array().cast("array<string>"))
        strange = F.array_except(keys, keywords)
        kind = F.try_variant_get(node, "$.type", "variant")
        named = F.try_variant_get(node, "$.type", "string")
        return (
            F.when(variant_type(node) != "object", F.lit("schema must be object"))
            .when(F.size(strange) > 0, F.concat(F.lit("unknown keyword: "), F.get(strange, F.lit(0))))
            .when(kind.isNotNull() & ~F.coalesce(F.array_contains(types, named), F.lit(False)), F.lit("type must be known"))
        )

    properties = F.coalesce(
        F.map_values(F.try_variant_get(parsed, "$.properties", "map<string,variant>")),
        F.array().cast("array<variant>"),
    )
    inner = F.concat(
        F.transform(properties, fault_of),
        F.transform(
            properties,
            lambda p: F.when(
                F.try_variant_get(p, "$.items", "variant").isNotNull(),
                fault_of(F.try_variant_get(p, "$.items", "variant")),
            ),
        ),
    )
    return F.when(parsed.isNull(), F.lit("not JSON")).otherwise(
        F.coalesce(fault_of(parsed), F.get(F.array_compact(inner), F.lit(0)))
    )


def deny_reason(
    body: Column,
    identifiers: list[str] = BANNED_IDENTIFIERS,
    members: list[tuple[str, str]] = BANNED_MEMBERS,
) -> Column:
    """The first banned identifier or member access in the order of the text, or null.

    A text scan, not a syntax check: names inside strings and comments count too.
    """
    accesses = [rf"{owner}\s*\.\s*{member}(?![A-Za-z0-9_$])" for owner, member in members]
    name = r"[A-Za-z_$][A-Za-z0-9_$]*"
    found = F.regexp_extract_all(body, F.lit("((?<![A-Za-z0-9_$])(?:" + "|".join([*accesses, name]) + "))"), 1)
    banned = F.array(*[F.lit(i) for i in identifiers])
    first = F.get(F.filter(found, lambda n: n.contains(".") | F.array_contains(banned, n)), F.lit(0))
    access = F.concat(F.lit("banned access: "), F.regexp_replace(first, r"\s", ""))
    return F.when(first.contains("."), access).when(first.isNotNull(), F.concat(F.lit("banned identifier: "), first))


def resource_failure(ok: Column, error: Column) -> Column:
    """A smoke run that failed on a resource limit; other failures are tolerated."""
    return ~ok & F.coalesce(error.rlike(RESOURCE_FAILURE), F.lit(False))


def execution_gate(
    runs: DataFrame, tool: str, ok: str, wanted: int = 10, max_throws: int = 0, min_good: int = 8
) -> DataFrame:
    """Verdict per tool over its execution log: ``(tool, runs, threw, good, reason)``."""
    counted = runs.groupBy(tool).agg(
        F.count("*").alias("runs"),
        F.count_if(~F.col(ok)).alias("threw"),
        F.count_if(F.col(ok)).alias("good"),
    )
    total = F.lit(f"/{wanted}")
    return counted.withColumn(
        "reason",
        F.when(F.col("threw") > max_throws, F.concat(F.col("threw").cast("string"), total, F.lit(" threw"))).when(
            F.col("good") < min_good,
            F.concat(F.col("good").cast("string"), total, F.lit(f" serializable (need >={min_good})")),
        ),
    )


def trajectory_gate(
    recorded: DataFrame, observed: DataFrame, tool: str = "tool", run: str = "run_no", minimum: int = 3
) -> DataFrame:
    """Compare recorded with observed results: ``(tool, runs, first_mismatch, reason)``.

    Both sides have ``(tool, run_no, result)``; ``run_no`` counts from 0 within
    a tool. Results are equal when their canonical JSON is.
    """
    left = recorded.select(tool, run, canonical_json(F.col("result")).alias("_want"))
    right = observed.select(tool, run, canonical_json(F.col("result")).alias("_got"))
    joined = left.join(right, [tool, run], "left")
    verdict = joined.groupBy(tool).agg(
        F.count("*").alias("runs"),
        F.min(F.when(~F.col("_want").eqNullSafe(F.col("_got")), F.col(run))).alias("first_mismatch"),
    )
    return verdict.withColumn(
        "reason",
        F.when(F.col("runs") < minimum, F.concat(F.lit(f"<{minimum} trajectories (have "), F.col("runs").cast("string"), F.lit(")"))).when(
            F.col("first_mismatch").isNotNull(),
            F.concat(F.lit("trajectory["), F.col("first_mismatch").cast("string"), F.lit("] mismatch")),
        ),
    )


def gate_result(reasons: dict[str, Column]) -> Column:
    """``struct(pass, failed_gate, reason)``: the first gate with a reason fails the tool."""
    failed, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for gate in reversed(GATES):
        if gate in reasons:
            hit = reasons[gate].isNotNull()
            failed = F.when(hit, gate).otherwise(failed)
            reason = F.when(hit, truncate(reasons[gate])).otherwise(reason)
    return F.struct(
        failed.isNull().alias("pass"), failed.alias("failed_gate"), reason.alias("reason")
    )


def failures_per_gate(gated: DataFrame, gate: str = "failed_gate", group: str | None = None) -> DataFrame:
    """Failures per gate with every gate present, per ``group`` (a round) if given."""
    counts = [F.count_if(F.col(gate) == g).alias(g) for g in GATES]
    totals = gated.groupBy(group).agg(*counts) if group else gated.agg(*counts)
    return totals.unpivot([group] if group else [], GATES, "gate", "failures")


# --- curation ----------------------------------------------------------------


def keep_first_by_name(rows: DataFrame, name: str, order: str) -> DataFrame:
    """First row of every normalised name.

    A combinable min-by aggregate: each map task sends one row per name, so a
    name shared by a third of all rows is no hot spot.
    """
    whole = F.struct(*rows.columns)
    firsts = rows.groupBy(normalise_name(F.col(name)).alias("_norm")).agg(
        F.min_by(whole, F.col(order)).alias("_row")
    )
    return firsts.select("_row.*")


def merge_retry(first: DataFrame, retry: DataFrame, survivors: DataFrame, name: str, order: str) -> DataFrame:
    """Retry candidates to validate: both rounds merged, deduplicated, survivors left out."""
    merged = keep_first_by_name(first.unionByName(retry), name, order)
    return merged.join(survivors.select(name).distinct(), name, "left_anti")


class TooFewTools(RuntimeError):
    """Raised after the fallback catalogue was chosen."""


def threshold_branch(survivors: int, floor_min: int = 8, kill_min: int = 4) -> str:
    """``fallback`` below ``kill_min``, ``retry`` below ``floor_min``, else ``straight``."""
    if survivors < kill_min:
        return "fallback"
    return "retry" if survivors < floor_min else "straight"


def final_catalogue(survivors: DataFrame, order: str, cap: int = 12) -> DataFrame:
    """First ``cap`` survivors in order."""
    return survivors.orderBy(order).limit(cap)


# --- contracts and policy ----------------------------------------------------


def length_between(value: Column, low: int, high: int | None = None) -> Column:
    size = F.length(value)
    return size >= low if high is None else size.between(low, high)


def size_between(value: Column, low: int, high: int | None = None) -> Column:
    size = F.size(value)
    return size >= low if high is None else size.between(low, high)


# Length and cardinality bounds of every record type.
def tool_contract(name: Column, description: Column, body: Column, runs: Column) -> dict[str, Column]:
    return {
        "name": name.rlike("^[a-z][a-z0-9_]*$"),
        "description": length_between(description, 10, 400),
        "body": length_between(body, 20, 4000),
        "trajectories": size_between(runs, 3, 6),
    }


def qa_contract(question: Column, answer: Column) -> dict[str, Column]:
    return {
        "question": length_between(question, 10, 500),
        "answer": length_between(answer, 20, 2000),
    }


def single_contract(query: Column, answer: Column) -> dict[str, Column]:
    return {"userQuery": length_between(query, 10), "assistantAnswer": length_between(answer, 20)}


def multi_contract(turns: Column) -> dict[str, Column]:
    roles = F.forall(turns, lambda t: t["role"].isin("user", "assistant", "tool"))
    return {"turns": size_between(turns, 4, 12), "role": roles}


def parallel_contract(
    query: Column, calls: Column, results: Column, answer: Column, dependency: Column
) -> dict[str, Column]:
    return {
        "userQuery": length_between(query, 10),
        "toolCalls": size_between(calls, 2, 4),
        "toolResults": size_between(results, 2),
        "assistantAnswer": length_between(answer, 20),
        "dependency": dependency.isin("parallel", "dependent"),
    }


def refusal_contract(query: Column, response: Column) -> dict[str, Column]:
    return {"userQuery": length_between(query, 10), "refusalResponse": length_between(response, 20)}


def eval_contract(prompt: Column, expected: Column) -> dict[str, Column]:
    return {"prompt": length_between(prompt, 10), "expected": length_between(expected, 10)}


def score_contract(*scores: Column) -> dict[str, Column]:
    return {f"score_{i}": s.between(1, 5) for i, s in enumerate(scores)}


def violations(contract: dict[str, Column]) -> Column:
    """Names of the broken rules; a missing value breaks its rule."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in contract.items()]
    return F.array_compact(F.array(*broken))


def call_policy(
    calls: DataFrame, catalogue: DataFrame, online: Column, tool: str = "tool", limit: int = 10_000
) -> DataFrame:
    """Add ``decision`` (run, not_found, offline_blocked) and ``payload`` to calls.

    The catalogue ``(tool, requires_network)`` is broadcast only when it is
    small; otherwise the join is an ordinary equi-join.
    """
    known = catalogue.select(tool, "requires_network").distinct()
    if known.limit(limit + 1).count() <= limit:
        known = F.broadcast(known)
    joined = calls.join(known.withColumn("_known", F.lit(True)), tool, "left")
    decision = (
        F.when(F.col("_known").isNull(), "not_found")
        .when(F.col("requires_network") & ~online, "offline_blocked")
        .otherwise("run")
    )
    payload = F.when(F.col("decision") == "offline_blocked", F.to_json(F.struct(F.lit(OFFLINE_ERROR).alias("error"))))
    return joined.withColumn("decision", decision).withColumn("payload", payload).drop("_known")


class Catalogue:
    """Registered tools by name; registering a name again replaces it."""

    def __init__(self, tools: list[dict] = ()):
        self._tools = {t["function"]["name"]: t for t in tools}

    def register(self, tool: dict) -> None:
        self._tools[tool["function"]["name"]] = tool

    def unregister(self, name: str) -> None:
        self._tools.pop(name, None)

    def tools(self) -> list[dict]:
        return list(self._tools.values())

    def frame(self, spark) -> DataFrame:
        rows = [
            (n, t["function"].get("description"), json.dumps(t["function"].get("parameters", {})), bool(t.get("meta", {}).get("requiresNetwork", False)))
            for n, t in self._tools.items()
        ]
        return spark.createDataFrame(rows, "tool string, description string, parameters string, requires_network boolean")
