"""Cutting model output into text, call and malformed frames.

All in one projection: a regular expression finds the closed frames, what lies
between them is text, and an opening tag without a closing one turns the rest
into one malformed frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.jsons import variant_type
from siftwork.functions.text import bind, trim_all

# The frame tags.
OPEN_TAG = "<|tool_call|>"
CLOSE_TAG = "<|tool_response|>"

_OPEN = r"<\|tool_call\|>"
_CLOSED = r"(?s)<\|tool_call\|>(.*?)<\|tool_response\|>"
_TOKEN = r'(?s)("(?:[^"\\]++|\\.)*+"|[{}]|[^{}"]++|".*+)'


def _frame(kind: str, text: Column, name: Column | None = None, args: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("kind"),
        text.alias("text"),
        (null if name is None else name).alias("name"),
        (null if args is None else args).alias("args"),
    )


def balanced_object(text: Column) -> Column:
    """First balanced ``{...}`` of the text; braces inside strings do not count. Else null."""

    def state(depth: Column, out: Column, done: Column) -> Column:
        return F.struct(depth.cast("int").alias("depth"), out.alias("out"), done.alias("done"))

    def step(s: Column, token: Column) -> Column:
        depth = s["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        grown = F.concat(s["out"], F.array(token))
        return F.when(s["done"], s).otherwise(state(depth, grown, depth == 0))

    rest = F.substring(text, F.instr(text, "{"), F.length(text))
    tokens = F.regexp_extract_all(rest, F.lit(_TOKEN), 1)
    start = state(F.lit(0), F.array().cast("array<string>"), F.lit(False))
    whole = F.aggregate(tokens, start, step, lambda s: F.when(s["done"], F.array_join(s["out"], "")))
    return F.when(F.instr(text, "{") > 0, whole)


def call_frame(inner: Column) -> Column:
    """Call frame of a closed frame's body, or a malformed one.

    Either ``{"name": ..., "args": {...}}`` or a name token before a bare
    argument object.
    """

    def read(body: Column) -> Column:
        value = F.try_parse_json(body)
        lead = trim_all(F.substring(inner, 1, F.instr(inner, "{") - 1))
        named = F.try_variant_get(value, "$.name", "variant")
        args = F.try_variant_get(value, "$.args", "variant")
        own_args = F.when(variant_type(args) == "object", F.to_json(args)).otherwise(F.lit("{}"))
        own_name = F.try_variant_get(value, "$.name", "string")
        return (
            F.when(variant_type(value) != "object", _frame("malformed", inner))
            .when(variant_type(named) == "string", _frame("call", inner, own_name, own_args))
            .when(lead != "", _frame("call", inner, lead, F.to_json(value)))
            .otherwise(_frame("malformed", inner))
        )

    return bind(balanced_object(inner), lambda b: F.when(b.isNull(), _frame("malformed", inner)).otherwise(read(b)))


def frames_of(output: Column) -> Column:
    """Ordered array of ``struct(kind, text, name, args)``; args is canonical JSON."""
    pieces = F.split(output, _CLOSED, -1)
    bodies = F.regexp_extract_all(output, F.lit(_CLOSED), 1)

    def interleave(texts: Column, calls: Column) -> Column:
        last = F.size(texts) - 1
        cut = F.instr(F.element_at(texts, -1), OPEN_TAG)

        def at(text: Column, i: Column) -> Column:
            before = F.when((i == last) & (cut > 0), F.substring(text, F.lit(1), cut - 1)).otherwise(text)
            after = F.substring(text, cut + len(OPEN_TAG), F.length(text))
            return F.concat(
                F.when(before != "", F.array(_frame("text", before))).otherwise(_none()),
                F.when(i < last, F.array(call_frame(F.get(calls, i)))).otherwise(_none()),
                F.when((i == last) & (cut > 0), F.array(_frame("malformed", after))).otherwise(_none()),
            )

        return F.flatten(F.transform(texts, at))

    return bind(F.struct(pieces.alias("t"), bodies.alias("b")), lambda s: interleave(s["t"], s["b"]))


def _none() -> Column:
    return F.array().cast("array<struct<kind:string,text:string,name:string,args:string>>")


def tool_frames(outputs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, frame_no, kind, text, name, args)``: one row per frame."""
    return outputs.select(key, F.posexplode(frames_of(F.col(text))).alias("frame_no", "frame")).select(
        key, "frame_no", "frame.*"
    )
