"""Generation plans: seeded persona, difficulty, tool and chunk-window choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.draws import pick, with_draws
from siftwork.functions.jsons import strict_json
from siftwork.functions.text import bind
from siftwork.operators.ordering import dense_ordinal
from siftwork.session import spread

# Persona ids in drawing order, with label and voice. ``{product}``
# is filled in by the caller.
PERSONAS = [
    ("junior-dev", "Junior Developer", "You are a junior developer new to {product}, asking basic questions about setup, auth flows, and simple CRUD operations."),
    ("senior-backend", "Senior Backend Engineer", "You are a senior backend engineer evaluating Postgres for production. Ask precise, schema-aware questions."),
    ("security-auditor", "Security Auditor", "You are a security auditor probing for RLS misconfigurations, JWT weaknesses, and privilege-escalation vectors."),
    ("devops", "DevOps Engineer", "You are a DevOps engineer focused on CI/CD pipelines, edge function deployments, and connection-pool tuning."),
    ("mobile-dev", "Mobile Developer", "You are a mobile developer integrating {product} into a React Native app, concerned with offline sync and auth tokens."),
    ("data-engineer", "Data Engineer", "You are a data engineer designing ETL pipelines, asking about Postgres functions, triggers, and bulk-insert performance."),
    ("indie-hacker", "Indie Hacker", "You are an indie hacker building fast with {product}, asking about storage buckets, realtime subscriptions, and quick-start patterns."),
    ("dba", "Database Administrator", "You are a DBA focused on index optimization, query plans, vacuum tuning, and Postgres extension management."),
]
# Difficulties in drawing order with their chunk-window sizes.
DIFFICULTIES = ["easy", "medium", "hard"]
WINDOW = {"easy": 1, "medium": 2, "hard": 3}
# Rows, chunks and tools per trajectory kind.
TRAJECTORY_COUNTS = {"singleTurn": 800, "multiTurn": 200, "parallelDep": 100, "refusal": 50}
TRAJECTORY_CHUNKS = {"singleTurn": 3, "multiTurn": 4, "parallelDep": 3, "refusal": 2}
# Rows per evaluation kind, chunk-window sizes and start strides.
EVAL_COUNTS = {"factual": 40, "reasoning": 10, "single-turn-tool": 15, "multi-turn-tool": 5}
EVAL_CHUNKS = {"factual": 1, "reasoning": 3, "single-turn-tool": 1, "multi-turn-tool": 2}
EVAL_STRIDE = {"factual": 1, "reasoning": 3, "single-turn-tool": 1, "multi-turn-tool": 1}

PERSONA_IDS = [p[0] for p in PERSONAS]


def draw_persona(draw: Column) -> Column:
    return pick(draw, PERSONA_IDS)


def draw_difficulty(draw: Column) -> Column:
    return pick(draw, DIFFICULTIES)


def window_size(difficulty: Column) -> Column:
    return F.element_at(
        F.create_map(*[F.lit(v) for kv in WINDOW.items() for v in kv]), difficulty
    )


def ring_join(
    plan: DataFrame, chunks: DataFrame, chunk_id: str, total: int, start: str, size: str
) -> DataFrame:
    """Add ``chunk_ids``: ``size`` chunks from position ``start``, wrapping around.

    ``chunks`` has ``chunk_id`` and a dense ``ordinal``; ``plan`` a unique
    ``index``. The join is an equi-join on the position, and a plan row gathers
    no more ids than its window is long.
    """
    slots = plan.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col(size) - 1)))
    wanted = slots.withColumn("ordinal", F.pmod(F.col(start) + F.col("slot"), F.lit(total)))
    ids = chunks.select("ordinal", F.col(chunk_id).cast("string").alias("_id"))
    gathered = F.array_sort(F.collect_list(F.struct("slot", "_id")))
    return (
        wanted.join(ids, "ordinal")
        .groupBy(*plan.columns)
        .agg(F.transform(gathered, lambda s: s["_id"]).alias("chunk_ids"))
    )


def qa_plan(
    rows: DataFrame, chunks: DataFrame, chunk_id: str, seed: str = "qa-gen-v1"
) -> DataFrame:
    """One question plan per row of ``rows`` (column ``index`` from 0).

    Three draws per row: persona, difficulty and start chunk. Returns
    ``(index, persona, difficulty, start, size, chunk_ids)``.
    """
    numbered = dense_ordinal(chunks.select(chunk_id), chunk_id)
    total = numbered.count()
    base = F.col("index") * 3
    drawn = with_draws(rows.select("index"), seed, _p=base + 1, _d=base + 2, _c=base + 3)
    plan = drawn.select(
        "index",
        draw_persona(F.col("_p")).alias("persona"),
        draw_difficulty(F.col("_d")).alias("difficulty"),
        F.floor(F.col("_c") * total).alias("start"),
    ).withColumn("size", window_size(F.col("difficulty")))
    return ring_join(plan, numbered, chunk_id, total, "start", "size")


def balanced_tool(index: Column, tools: list[str]) -> Column:
    """Tool of a plan row under exact balancing: equal counts, in turn."""
    return F.element_at(F.array(*[F.lit(t) for t in tools]), F.pmod(index, F.lit(len(tools))).cast("int") + 1)


def inverse_frequency_sample(
    items: DataFrame, key: str, count: str, seed: str, size: int
) -> DataFrame:
    """``size`` distinct items, weighted by 1 / (count + 1), without replacement.

    Every item races with -ln(u) / weight and the smallest win, so one
    top-``size`` pass replaces the sequential reweighting.
    """
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    race = -F.log((number + 1) / F.lit(4294967297.0)) * (F.col(count) + 1)
    return items.withColumn("race", race).orderBy("race", key).limit(size)


def distinct_picks(index: Column, options: list[str], size: Column | int, seed: str) -> Column:
    """``size`` distinct options per row, ranked by a seeded hash of row and option."""
    ranked = F.array_sort(
        F.array(
            *[
                F.struct(
                    F.sha2(F.concat(F.lit(f"{seed}:"), index.cast("string"), F.lit(f":{o}")), 256),
                    F.lit(o).alias("option"),
                )
                for o in options
            ]
        )
    )
    wanted = F.lit(size) if isinstance(size, int) else size
    return F.slice(F.transform(ranked, lambda s: s["option"]), F.lit(1), wanted.cast("int"))


_DRAWS = 8  # draws set aside per trajectory row


def trajectory_plan(
    rows: DataFrame, chunks: DataFrame, chunk_id: str, tools: list[str], seed: str = "traj-v1"
) -> DataFrame:
    """Plan of tool-use conversations.

    ``rows`` has ``index`` (unique, from 0) and ``kind``. Single-turn rows get
    one tool under exact balancing, multi-turn two or three, parallel or
    dependent rows two, refusals none. Chunks are distinct: a seeded start in
    the ring of chunks, as many as the kind asks for (all, when there are fewer).
    """
    numbered = dense_ordinal(chunks.select(chunk_id), chunk_id)
    total = numbered.count()
    base = F.col("index") * _DRAWS
    sizes = F.create_map(*[F.lit(v) for kv in TRAJECTORY_CHUNKS.items() for v in kv])
    kind = F.col("kind")
    tool_count = F.when(kind == "multiTurn", 2 + F.floor(F.col("_n") * 2)).otherwise(2)
    picked = distinct_picks(F.col("index"), tools, F.least(tool_count, F.lit(len(tools))), seed)
    drawn = with_draws(
        rows.select("index", "kind"), seed, _p=base + 1, _d=base + 2, _c=base + 3, _t=base + 4, _n=base + 5
    )
    plan = drawn.select(
        "index",
        "kind",
        draw_persona(F.col("_p")).alias("persona"),
        draw_difficulty(F.col("_d")).alias("difficulty"),
        F.floor(F.col("_c") * total).alias("start"),
        F.least(F.element_at(sizes, kind), F.lit(total)).alias("size"),
        F.when(kind == "singleTurn", F.array(balanced_tool(F.col("index"), tools)))
        .when(kind == "refusal", F.array().cast("array<string>"))
        .otherwise(picked)
        .alias("tools"),
        F.when(
            kind == "parallelDep",
            F.when(F.col("_t") < 0.5, "parallel").otherwise("dependent"),
        ).alias("dependency"),
    )
    return ring_join(plan, numbered, chunk_id, total, "start", "size")


def kinds_in_order(counts: dict[str, int], index: Column) -> tuple[Column, Column]:
    """``(kind, position within kind)`` of row ``index`` when kinds follow one another."""
    kind, local = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    end = sum(counts.values())
    for name, size in reversed(counts.items()):
        start = end - size
        inside = (index >= start) & (index < end)
        kind = F.when(inside, name).otherwise(kind)
        local = F.when(inside, index - start).otherwise(local)
        end = start
    return kind, local


def eval_plan(
    rows: DataFrame,
    chunks: DataFrame,
    chunk_id: str,
    tools: list[str],
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Evaluation plan: the item number runs across all kinds.

    Returns ``(index, item_id, kind, start, size, tools, chunk_ids)``.
    """
    numbered = dense_ordinal(chunks.select(chunk_id), chunk_id)
    total = numbered.count()
    kind, local = kinds_in_order(counts or EVAL_COUNTS, F.col("index"))
    sizes = F.create_map(*[F.lit(v) for kv in EVAL_CHUNKS.items() for v in kv])
    strides = F.create_map(*[F.lit(v) for kv in EVAL_STRIDE.items() for v in kv])
    plan = (
        rows.select("index", kind.alias("kind"), local.alias("local"))
        .filter("kind is not null")
        .select(
            "index",
            F.concat_ws("-", F.lit("eval"), "kind", F.col("index").cast("string")).alias("item_id"),
            "kind",
            F.pmod(F.col("local") * F.element_at(strides, F.col("kind")), F.lit(total)).alias("start"),
            F.element_at(sizes, F.col("kind")).alias("size"),
            F.when(F.col("kind") == "single-turn-tool", F.array(balanced_tool(F.col("local"), tools)))
            .when(
                F.col("kind") == "multi-turn-tool",
                F.array(balanced_tool(F.col("local"), tools), balanced_tool(F.col("local") + 1, tools)),
            )
            .otherwise(F.array().cast("array<string>"))
            .alias("tools"),
        )
    )
    return ring_join(plan, numbered, chunk_id, total, "start", "size")


# Boundary inputs by declared type, as JSON, in use order.
BOUNDARY = {
    "string": ['""', '"a"', '"0"', '"' + "x" * 1000 + '"', '"\U0001F984\U0001F680"', '"null"', '"undefined"', '"true"', '"  "', '"\\n"'],
    "number": ["0", "1", "-1", "1.5", "-1.5", "1e308", "-1e308", "9007199254740991", "0.30000000000000004", "2.220446049250313e-16"],
    "integer": ["0", "1", "-1", "100", "-100", "2147483647", "-2147483648", "42", "7", "13"],
    "array": ["[]", "[1]", "[1,2,3]", "[" + ",".join(["0"] * 100) + "]", '[""]', "[null]", "[[]]", "[{}]", '[1,"x"]', "[0,1,2,3,4,5,6,7,8,9]"],
    "boolean": ["true", "false"] * 5,
    "object": ["{}"] * 10,
}
BOUNDARY_INPUTS = 10


def _boundary_table() -> Column:
    return F.create_map(
        *[part for name, values in BOUNDARY.items() for part in (F.lit(name), F.array(*[F.lit(v) for v in values]))]
    )


def nested_boundary_inputs(tools: DataFrame, depth: int = 8) -> DataFrame:
    """Ten JSON argument objects per tool from ``(tool, parameters)``, a JSON schema.

    The schema is walked: a property that is itself an object takes the i-th input of its
    own properties. Keys come in sorted order; an unknown type gives null, and a schema that
    does not parse, or has no properties, the empty object. Objects below ``depth`` levels fail the job.
    Returns ``(tool, input_no, arguments)``. A schema is walked once for its ten inputs; rows
    are dealt out, as a small file of tools may hold many.
    """
    table = _boundary_table()
    numbers = F.sequence(F.lit(0), F.lit(BOUNDARY_INPUTS - 1))
    unknown = F.array_repeat(F.lit("null"), BOUNDARY_INPUTS)

    # Either gives an array of the text in every input.
    def values_of(schema: Column, left: int) -> Column:
        kind = F.try_variant_get(schema, "$.type", "string")
        return F.when(kind == "object", objects_of(schema, left)).otherwise(F.coalesce(F.try_element_at(table, kind), unknown))

    def objects_of(schema: Column, left: int) -> Column:
        if not left:
            return F.raise_error(F.lit(f"objects are nested deeper than {depth}")).cast("array<string>")
        properties = F.try_variant_get(schema, "$.properties", "map<string,variant>")
        return bind(properties, lambda found: bind(members_of(found, left), joined))

    def members_of(found: Column, left: int) -> Column:
        return F.transform(
            F.array_sort(F.map_keys(found)),
            lambda k: F.struct(
                F.concat(F.to_json(k.cast("variant")), F.lit(":")).alias("k"),
                values_of(F.element_at(found, k), left - 1).alias("v"),
            ),
        )

    def joined(members: Column) -> Column:
        def one(number: Column) -> Column:
            texts = F.transform(members, lambda m: F.concat(m["k"], F.get(m["v"], number)))
            return F.concat(F.lit("{"), F.coalesce(F.array_join(texts, ","), F.lit("")), F.lit("}"))

        return F.transform(numbers, one)

    arguments = bind(strict_json(F.col("parameters")), lambda schema: objects_of(schema, depth))
    return spread(tools.select("tool", "parameters")).select("tool", F.posexplode(arguments).alias("input_no", "arguments"))


def boundary_inputs(params: DataFrame) -> DataFrame:
    """Ten JSON argument objects per tool from ``(tool, param, type)``.

    Input i takes the i-th fixed value of each declared type; an unknown type
    gives null. Returns ``(tool, input_no, arguments)``.
    """
    table = _boundary_table()
    rows = params.withColumn("input_no", F.explode(F.sequence(F.lit(0), F.lit(BOUNDARY_INPUTS - 1))))
    value = F.coalesce(F.get(F.try_element_at(table, F.col("type")), F.col("input_no")), F.lit("null"))
    member = F.concat(F.to_json(F.col("param").cast("variant")), F.lit(":"), value)
    return rows.groupBy("tool", "input_no").agg(
        F.concat(
            F.lit("{"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct(F.col("param"), member.alias("m")))),
                    lambda s: s["m"],
                ),
                ",",
            ),
            F.lit("}"),
        ).alias("arguments")
    )
