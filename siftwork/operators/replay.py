"""Replay of recorded tool calls: every catalogue function as a Column expression.

A call table is evaluated in one projection, and the results are compared with
the recorded ones (``catalog.trajectory_gate``). Users add tools by passing
their own factories.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.jsons import strict_json, tool_arguments, variant_type
from siftwork.functions.text import bind

Factory = Callable[[Column], Column]

# Column types by SQL type, operators by name, and the messages.
COLUMN_TYPES = {
    "string": ["text", "varchar", "char", "uuid", "timestamp", "timestamptz", "date", "time", "bytea"],
    "number": ["int2", "int4", "int8", "float4", "float8", "numeric", "integer", "bigint", "smallint", "real", "double precision"],
    "boolean": ["bool", "boolean"],
    "Record<string, unknown>": ["json", "jsonb"],
}
FILTER_OPERATORS = {"eq": "=", "neq": "!=", "gt": ">", "lt": "<"}
CONNECTION = r"^postgres(?:ql)?://([^:@]+)(?::([^@]*))?@([^:/]+)(?::(\d+))?/(.+)$"
DEFAULT_PORT = 5432
NAME_EMPTY = "name must not be empty"
NAME_LONG = "name must be at most 64 characters"
NAME_SHAPE = "name must start with lowercase letter and contain only a-z, 0-9, hyphens, underscores"


def _text(args: Column, key: str, default: str = "") -> Column:
    """Argument as text; missing, null and empty values take the default."""
    got = F.try_variant_get(args, f"$.{key}", "string")
    return F.coalesce(F.nullif(got, F.lit("")), F.lit(default))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def policy_template(args: Column) -> Column:
    table, role, op = _text(args, "tableName"), _text(args, "role", "authenticated"), _text(args, "operation")
    policy = F.concat(
        F.lit('CREATE POLICY "'), table, F.lit("_"), F.lower(op), F.lit("_"), role,
        F.lit('" ON public.'), table, F.lit(" FOR "), F.upper(op), F.lit(" TO "), role,
        F.lit(" USING (auth.uid() = user_id);"),
    )
    return _json(policy=policy)


def select_builder(args: Column) -> Column:
    columns = F.try_variant_get(args, "$.columns", "array<string>")
    listed = F.when(F.size(columns) > 0, F.array_join(columns, ", ")).otherwise(F.lit("*"))
    filters = F.coalesce(
        F.try_variant_get(args, "$.filters", "array<variant>"), F.array().cast("array<variant>")
    )
    operators = F.create_map(*[F.lit(v) for kv in FILTER_OPERATORS.items() for v in kv])

    def clause(f: Column, i: Column) -> Column:
        op = F.coalesce(F.try_element_at(operators, _text(f, "op", "eq")), F.lit("="))
        return F.concat(_text(f, "column"), F.lit(" "), op, F.lit(" $"), (i + 1).cast("string"))

    objects = F.filter(filters, lambda f: variant_type(f) == "object")
    where = F.array_join(F.transform(objects, clause), " AND ")
    tail = F.when(where != "", F.concat(F.lit(" WHERE "), where)).otherwise(F.lit(""))
    sql = F.concat(F.lit("SELECT "), listed, F.lit(" FROM "), _text(args, "table"), tail, F.lit(";"))
    return _json(sql=sql)


def storage_path(args: Column) -> Column:
    return _json(path=F.concat_ws("/", _text(args, "bucket"), _text(args, "userId"), _text(args, "filename")))


def name_validator(args: Column) -> Column:
    name = _text(args, "name")
    reason = (
        F.when(name == "", NAME_EMPTY)
        .when(F.length(name) > 64, NAME_LONG)
        .when(~name.rlike("^[a-z][a-z0-9_-]*$"), NAME_SHAPE)
    )
    return _json(valid=reason.isNull(), reason=reason)


def type_mapper(args: Column) -> Column:
    pairs = [F.lit(v) for target, names in COLUMN_TYPES.items() for n in names for v in (n, target)]
    found = F.try_element_at(F.create_map(*pairs), F.lower(_text(args, "postgresType")))
    return _json(tsType=F.coalesce(found, F.lit("unknown")))


def connection_parser(args: Column) -> Column:
    url = _text(args, "url")
    port = F.nullif(F.regexp_extract(url, CONNECTION, 4), F.lit("")).cast("bigint")
    return _json(
        host=F.regexp_extract(url, CONNECTION, 3),
        port=F.coalesce(port, F.lit(DEFAULT_PORT)),
        database=F.regexp_extract(url, CONNECTION, 5),
        user=F.regexp_extract(url, CONNECTION, 1),
    )


def claims_extractor(args: Column) -> Column:
    parts = F.split(_text(args, "jwt"), r"\.", -1)
    body = F.translate(F.get(parts, F.lit(1)), "-_", "+/")
    padded = F.rpad(body, F.ceil(F.length(body) / 4).cast("int") * 4, F.lit("="))
    decoded = F.try_to_binary(padded, F.lit("base64")).cast("string")
    claims = F.when(F.size(parts) >= 3, strict_json(decoded))

    def claim(key: str, kind: str) -> Column:
        value = F.try_variant_get(claims, f"$.{key}", "variant")
        return F.coalesce(F.when(variant_type(value) == kind, F.to_json(value)), F.lit("null"))

    return F.concat(
        F.lit('{"exp":'), claim("exp", "number"),
        F.lit(',"role":'), claim("role", "string"),
        F.lit(',"sub":'), claim("sub", "string"), F.lit("}"),
    )


def migration_filename(args: Column) -> Column:
    ms = F.coalesce(F.try_variant_get(args, "$.timestampMs", "double"), F.lit(0.0))
    whole = F.floor(ms / 1000).cast("bigint")
    days = F.floor(whole / 86400).cast("int")
    clock = whole - days.cast("bigint") * 86400
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyyMMdd")
    time = F.format_string("%02d%02d%02d", F.floor(clock / 3600), F.floor(clock / 60) % 60, clock % 60)
    snake = F.regexp_replace(F.lower(_text(args, "description")), "[^a-z0-9]+", "_")
    snake = F.coalesce(F.nullif(F.regexp_replace(snake, "^_|_$", ""), F.lit("")), F.lit("migration"))
    return _json(filename=F.concat(date, time, F.lit("_"), snake, F.lit(".sql")))


def catalogue_functions(prefix: str = "") -> dict[str, Factory]:
    """The eight catalogue tools; ``prefix`` is the product's name prefix."""
    return {
        f"{prefix}rls_policy_template": policy_template,
        f"{prefix}select_query_builder": select_builder,
        f"{prefix}storage_path_builder": storage_path,
        f"{prefix}edge_function_name_validator": name_validator,
        f"{prefix}column_type_mapper": type_mapper,
        f"{prefix}connection_string_parser": connection_parser,
        f"{prefix}jwt_claims_extractor": claims_extractor,
        f"{prefix}migration_filename": migration_filename,
    }


def replay_calls(
    calls: DataFrame, functions: dict[str, Factory], tool: str = "tool", arguments: str = "arguments"
) -> DataFrame:
    """Add ``result`` (JSON text); null for a tool without a function."""
    result = F.lit(None).cast("string")
    for name, factory in functions.items():
        value = bind(tool_arguments(F.col(arguments)), factory)
        result = F.when(F.col(tool) == name, value).otherwise(result)
    return calls.withColumn("result", result)
