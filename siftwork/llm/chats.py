"""Chat formatting with a template that is only called, never read.

A template takes the turns of a conversation so far, as (role, text) pairs, and returns
a text. Successive prefixes of the turns are rendered: what an output has beyond the
output before it is the span of its turn. An output that does not begin with the one
before rewrites history, and its turn is flagged. Where the text of a turn stands
inside its span is found the same way, from two renderings that differ in that
text alone. The loss mask covers the texts of chosen roles.

Every prefix is rendered from the conversation's first turn, so a rewrite is seen however old
the turns are that it changes. That costs the square of a conversation, as it must for a template
that is only called. The output comes in blocks of ``block`` turns; what a later turn rewrites is cut from the
blocks before. Conversations with more than 1/1024 of all rows (and more than ``FEW``), at most
1024 of them, are numbered by a range partition and dealt out in strips of equal cost, at least ``STRIP`` turns a
strip in the mean and at most three a core; a strip is read after all turns before it. All others are read in
order by one task. A task holds one conversation up to where it is, and a few renderings of it.

Turns are taken in order of turn (null first), role, and a hash of the text; repeated rows are
turns of their own. Null keys make one conversation. A null role or text is empty.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import FEW, HEAVY_KEYS, Scratch, slices
from siftwork.operators.ordering import dense_ordinal

BLOCK = 16  # turns whose output is a row
STRIP = 1024  # turns of a heavy conversation for each task that renders it
BATCH_CHARS = 1 << 20

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_ESCAPE_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ESCAPE_ROLE = re.compile(r"[\\:\n#<]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARKED = re.compile(r"### ((?:[^\\:]|\\.)*+):\n((?:[^\\<#]++|\\.|<(?!/turn>)|#(?!##))*+)</turn>\n", re.DOTALL)


def marked_turns(turns: Iterable[Turn]) -> str:
    """The built-in template: ``### role:``, the text, ``</turn>``, control strings escaped."""
    return "".join(f"### {_escaped_role(role)}:\n{_escaped_text(text)}</turn>\n" for role, text in turns)


def _escaped_role(role: str) -> str:
    return role if role.isalnum() else _ESCAPE_ROLE.sub(r"\\\g<0>", role)


def _escaped_text(text: str) -> str:
    if "\\" in text or "###" in text or "</turn>" in text:
        return _ESCAPE_TEXT.sub(r"\\\g<0>", text)
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a text that :func:`marked_turns` wrote."""
    out, at = [], 0
    while at < len(formatted):
        found = _MARKED.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn begins at character {at}")
        out.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return out


def _shared(a: str, b: str, likely: int = 0) -> int:
    """Length of the common beginning, found sooner if it is ``likely`` or more."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    if likely <= high and a.startswith(b[:likely]):
        low = likely
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[:half] == b[:half] else (low, half - 1)
    return low


def _body(template: Template, known: list[Turn], turn: Turn, begin: int, output: str) -> tuple[int, int] | None:
    """Where the text of the last turn stands in ``output``; None if it is not there as given to the template."""
    role, _ = turn
    one, other = (template([*known, (role, probe)]) for probe in ("a", "b"))
    head = _shared(one, other, begin)
    tail = _shared(one[head:][::-1], other[head:][::-1])
    end = len(output) - tail
    if head < begin or end < head or output[:head] != one[:head] or output[end:] != one[len(one) - tail :]:
        return None
    return head, end


def render_block(template: Template, before: list[Turn], turns: list[Turn]) -> tuple[str, list[dict]]:
    """Formatted ``turns`` after ``before``, and of each turn its span and text as character offsets.

    A turn that rewrites history is flagged; the spans found before it are gone, as what they pointed
    at has changed.
    """
    return _render(template, before, turns)[:2]


def _render(
    template: Template, before: list[Turn], turns: list[Turn], output: str | None = None
) -> tuple[str, list[dict], int, int | None, str]:
    """What :func:`render_block` gives; where that text begins in the output of the conversation; the first character
    that a turn rewrote, if any; and all output so far. ``output`` is that of ``before``, if it is known."""
    known = list(before)
    if output is None:
        output = template(known) if known else ""
    skip, low = len(output), None
    spans: list[dict] = []
    for turn in turns:
        after = template([*known, turn])
        rewrites = not after.startswith(output)
        begin = _shared(output, after) if rewrites else len(output)
        if rewrites:
            skip, low = min(skip, begin), begin if low is None else min(low, begin)
            for s in spans:
                _forget(s)
        body = _body(template, known, turn, begin, after)
        spans.append(
            {"role": turn[0], "begin": begin, "end": len(after), "rewrites": rewrites}
            | {"text_begin": body and body[0], "text_end": body and body[1]}
        )
        output = after
        known.append(turn)
    for s in spans:
        s.update({k: s[k] - skip for k in ("begin", "end", "text_begin", "text_end") if s[k] is not None})
    return output[skip:], spans, skip, low, output


def _forget(span: dict) -> None:
    span.update(begin=None, end=None, text_begin=None, text_end=None)


def _render_turns(
    template: Template, before: list[Turn], turns: list[Turn], block: int
) -> list[tuple[str, list[dict], int, int | None]]:
    """Text, spans, begin in the conversation's output and first rewritten character of each block of ``turns``.

    What a later block rewrote is cut from the text of those before, and their spans are gone.
    """
    done, known, output = [], list(before), None
    for at in range(0, len(turns), block):
        own = turns[at : at + block]
        *found, output = _render(template, known, own, output)
        done.append(found)
        known += own
    low = None
    for found in reversed(done):
        if low is not None:
            found[0] = found[0][: max(0, low - found[2])]
            for s in found[1]:
                _forget(s)
        low = min((x for x in (low, found[3]) if x is not None), default=None)
    return [tuple(x) for x in done]


SPANS = T.ArrayType(
    T.StructType()
    .add("role", "string")
    .add("begin", "long")
    .add("end", "long")
    .add("text_begin", "long")
    .add("text_end", "long")
    .add("rewrites", "boolean")
)
_SPAN_KIND = pa.list_(
    pa.struct(
        [("role", pa.string())]
        + [(name, pa.int64()) for name in ("begin", "end", "text_begin", "text_end")]
        + [("rewrites", pa.bool_())]
    )
)


def _python_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _typed(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the first column, and all batches."""
    for batch in batches:
        return batch.schema.field(0).type, chain([batch], batches)
    return None, iter(())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size_of: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row) + 200
        if size > BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rendered(ordered: DataFrame, template: Template, block: int) -> DataFrame:
    """Blocks of rows (conv, first, context, role, text) that come in order, no (conv, first) in two partitions.

    Context is all turns of the conversation before block ``first``, up to which a task renders nothing of its own.
    """
    conv = ordered.schema["conv"].dataType
    schema = T.StructType().add("conv", conv).add("block", "long").add("formatted", "string").add("spans", SPANS)
    schema.add("first", "long").add("begin", "long").add("low", "long")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, first), rows in groupby(_python_rows(batches), key=lambda row: row[:2]):
            past, own = [], []
            for _, _, context, role, text in rows:
                (past if context else own).append((role or "", text or ""))
            for number, (text, spans, begin, low) in enumerate(_render_turns(template, past, own, block), first):
                yield conv, number, text, spans, first, begin, low

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, batches = _typed(batches)
        whole = pa.int64()
        kinds = [kind, whole, pa.string(), _SPAN_KIND, whole, whole, whole]
        yield from _in_batches(blocks(batches), pa.schema(list(zip(schema.names, kinds))), lambda row: len(row[2]))

    return ordered.select("conv", "first", "context", "role", "text").mapInArrow(render, schema)


def _mended(strips: DataFrame) -> DataFrame:
    """Stored blocks (conv, block, formatted, spans, first, begin, low) without what a later strip rewrote."""
    strips = strips.withColumn("key", _null_safe("conv"))
    lows = strips.filter("low is not null").groupBy("key", "first").agg(F.min("low").alias("low"))
    lows = lows.groupBy("key").agg(F.collect_list(F.struct("first", "low")).alias("lows"))  # a row per heavy conversation
    met = strips.drop("low").join(F.broadcast(lows), "key", "left")
    later = F.expr("array_min(transform(filter(lows, x -> x.first > first), x -> x.low))")
    left = F.expr("substring(formatted, 1, cast(greatest(0, later - begin) as int))")
    none = F.lit(None).cast("long")
    gone = F.transform("spans", lambda s: s.withField("begin", none).withField("end", none).withField("text_begin", none).withField("text_end", none))
    rewritten = F.col("later").isNotNull()
    return met.withColumn("later", later).select(
        "conv",
        "block",
        F.when(rewritten, left).otherwise(F.col("formatted")).alias("formatted"),
        F.when(rewritten, gone).otherwise(F.col("spans")).alias("spans"),
    )


def _null_safe(conv: str):
    """A text that tells conversations apart, null among them."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def format_conversations(
    df: DataFrame,
    template: Template = marked_turns,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``(conv, block, formatted, spans)``: each conversation's output is its blocks' texts in order.

    ``spans`` has per turn its role, its place in the block's text, the place of its own
    text (the loss mask, for the roles one trains on), and whether it rewrote history.
    """
    rows = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    rows = rows.withColumn("key", _null_safe("conv")).withColumn("tie", F.xxhash64("text"))
    counts = rows.groupBy("key").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    heavy = counts.filter(F.col("count") > max(FEW, total // HEAVY_KEYS)).select("key")  # 1024 at most
    usual = rows.join(F.broadcast(heavy), "key", "left_anti")
    usual = usual.repartition("conv").sortWithinPartitions("conv", "turn", "role", "tie")
    usual = usual.withColumn("first", F.lit(0).cast("long")).withColumn("context", F.lit(False))
    names = ["conv", "block", "formatted", "spans"]
    out = _rendered(usual, template, block).select(*names)
    if heavy.isEmpty():
        return out
    large = rows.join(F.broadcast(heavy), "key").withColumn("row", F.monotonically_increasing_id())
    large = dense_ordinal(large, "key", "turn", "role", "tie", "row")
    scratch = Scratch(df.sparkSession)
    groups = large.groupBy("key").agg(F.min("ordinal").alias("least"), F.count("*").alias("n"))
    most = 3 * df.sparkSession.sparkContext.defaultParallelism
    strips = F.least(F.ceil(F.col("n") / STRIP), F.lit(most)).cast("int")
    begin = F.expr(f"transform(sequence(0, strips - 1), i -> cast(floor(n * sqrt(i / strips) / {block}) as long))")
    groups = groups.withColumn("strips", strips).withColumn("begins", begin)  # in blocks
    groups = scratch.store(groups.select("key", "least", "begins"), keep=True)  # a row per heavy conversation
    large = large.join(F.broadcast(groups), "key").withColumn("at", F.col("ordinal") - F.col("least"))
    large = large.withColumn("own", F.floor(F.col("at") / block))
    needed = F.expr(
        """filter(transform(begins, (b, i) -> struct(b AS first, b > own AS context, get(begins, i + 1) AS until)),
        x -> x.until IS NULL OR (x.until > own AND x.until > x.first))"""
    )
    large = large.select("conv", "key", "at", "role", "text", F.inline(needed))
    large = large.repartition("key", "first").sortWithinPartitions("key", "first", "at")
    found = _rendered(large, template, block)
    if groups.filter(F.size("begins") > 1).isEmpty():
        return out.unionByName(found.select(*names))
    return out.unionByName(_mended(scratch.store(found, keep=True)))


def read_back(formatted: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv, block, turns, text, loss, chars)`` of blocks the built-in template wrote.

    ``text`` is role, line feed, text, line feed per turn, as parsed from the output;
    ``loss`` the text under the loss mask, unescaped.
    """
    conv = formatted.schema["conv"].dataType
    schema = T.StructType().add("conv", conv).add("block", "long").add("turns", "long")
    schema.add("text", "string").add("loss", "string").add("chars", "long")

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, number, text, spans in rows:
            turns = read_turns(text)
            masked = [text[s["text_begin"] : s["text_end"]] for s in spans if s["role"] in loss_roles]
            plain = "".join(f"{role}\n{own}\n" for role, own in turns)
            yield conv, number, len(turns), plain, "".join(map(unescaped, masked)), len(text)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, batches = _typed(batches)
        whole, words = pa.int64(), pa.string()
        out = pa.schema({"conv": kind, "block": whole, "turns": whole, "text": words, "loss": words, "chars": whole})
        yield from _in_batches(read(_python_rows(batches)), out, lambda row: 2 * len(row[3]))

    return formatted.select("conv", "block", "formatted", "spans").mapInArrow(parse, schema)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Digests of whole conversations from the blocks of :func:`read_back`.

    SHA-256 goes through a text in order, so one task hashes a conversation, however
    long; it holds a batch of blocks and nothing else is done there.
    """
    conv = pieces.schema["conv"].dataType
    schema = T.StructType().add("conv", conv).add("n_turns", "long").add("turns_sha256", "string")
    schema.add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(rows, key=lambda row: row[0]):
            turns, chars, loss_chars = 0, 0, 0
            whole, loss = hashlib.sha256(), hashlib.sha256()
            for _, n, text, masked, size in own:
                whole.update(text.encode())
                loss.update(masked.encode())
                turns, chars, loss_chars = turns + n, chars + size, loss_chars + len(masked)
            yield conv, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, batches = _typed(batches)
        whole, words = pa.int64(), pa.string()
        kinds = [kind, whole, words, whole, words, whole]
        yield from _in_batches(fold(_python_rows(batches)), pa.schema(list(zip(schema.names, kinds))), lambda row: 0)

    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "block")
    return ordered.select("conv", "turns", "text", "loss", "chars").mapInArrow(digest, schema)
