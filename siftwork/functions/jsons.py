"""JSON expressions over VARIANT. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_type(value: Column) -> Column:
    """JSON type of a variant: object, array, string, number, boolean or null."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "VOID", "null")
        .when(name.isNotNull(), "number")
    )


_END = "end of the one value"


def _strict_in_two(raw: Column) -> Column:
    in_array = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    return F.when(in_array.isNotNull() & in_object.isNotNull(), F.try_parse_json(raw))


def strict_json(raw: Column) -> Column:
    """Variant of a text that is one JSON value and nothing else, or null.

    ``try_parse_json`` reads the first value and ignores what follows. So the text
    is parsed as the first of an array's two values, the second being a mark:
    a rest, or a bracket closed early, leaves another array. Only a text that holds
    the mark itself is parsed between two kinds of brackets: what closes one early
    is an error in the other.
    """
    # Written without a lambda, so that generated code parses once for all columns that ask.
    pair = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(f',"{_END}"]')))
    alone = (F.try_variant_get(pair, "$[1]", "string") == _END) & F.try_variant_get(pair, "$[2]", "variant").isNull()
    held = raw.contains(_END)
    return F.when(alone & ~held, F.try_variant_get(pair, "$[0]", "variant")).when(held, _strict_in_two(raw))


def tool_arguments(raw: Column) -> Column:
    """A JSON object as a variant; bad JSON, arrays, scalars and nulls become ``{}``."""
    parsed = strict_json(raw)
    empty = F.parse_json(F.lit("{}"))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).otherwise(empty)


def recorded_result(raw: Column) -> Column:
    """Parsed JSON, or the raw string itself as a variant when it does not parse."""
    return F.coalesce(strict_json(raw), raw.cast("variant"))


def result_text(value: Column) -> Column:
    """Message text of a tool result: a string verbatim, anything else as JSON."""
    is_string = F.schema_of_variant(value) == "STRING"
    return F.when(is_string, F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def canonical_json(raw: Column) -> Column:
    """Equal text for equal JSON: keys sorted at every depth, arrays in order.

    Unparsable input is compared as the string it is. ``1e0`` prints as ``1.0``
    and objects with a repeated key do not parse; both stay as they are.
    """
    return F.coalesce(F.to_json(strict_json(raw)), raw)
