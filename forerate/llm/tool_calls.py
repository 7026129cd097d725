"""Operator 7: chat formatting with linked tool calls.

Calls and results are joined by identifier within their conversation, each call is checked against
its tool's schema, calls are ordered after the calls whose results they use, and call and result are
written as one canonical JSON object: keys sorted, no white space.

The order is given as ``level``: the longest chain of calls below a call. It is found for all
conversations at once, one join per level, so a long conversation isn't one task's work. Calls of a
level don't depend on each other and may be taken in order of turn. A need that no call of the
conversation has is named in ``error`` as a missing need, behind a fault of the arguments if there is
one; the level then tells the order among the calls that exist.

Only DataFrame functions are used. Results for odd input: of calls with one identifier in one
conversation the earliest counts, ties by name and arguments, and the other ones are rows of ``status``
repeated; of several results the earliest is used, ``n_results`` tells their number, and other contents
are rows of status later result. A result without a call has status orphan, a call without a result
open. Calls on a circle have no level and status cycle. Arguments that aren't JSON stay in the message
as text. A null text is empty, a very long one is written whole, a null conversation is a conversation
of its own (not one that is named null), and a call without identifier can't be linked and is left out. Turns that are no call or result are written by ``plain``. Empty tables give no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.sources.staging import staged

KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}


class Param(NamedTuple):
    name: str
    kind: str
    required: bool = True
    low: int | None = None
    high: int | None = None


class Tool(NamedTuple):
    name: str
    params: Sequence[Param]


def argument_error(name: Column, arguments: Column, tools: Sequence[Tool]) -> Column:
    """What is wrong with the JSON arguments of a call, null if nothing is; the first fault counts."""
    parsed = F.try_parse_json(arguments)
    checks: list[tuple[Column, str]] = [
        (~F.coalesce(name.isin([t.name for t in tools]), F.lit(False)), "unknown tool"),
        (parsed.isNull(), "not JSON"),
        (~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), "not an object"),
    ]
    for tool in tools:
        mine = name == tool.name
        known = F.array(*[F.lit(p.name) for p in tool.params])
        checks.append((mine & (F.size(F.array_except(F.json_object_keys(arguments), known)) > 0), "unknown argument"))
        for p in tool.params:
            value = F.try_variant_get(parsed, f"$.{p.name}", "variant")
            kind = F.schema_of_variant(value)
            if p.required:
                checks.append((mine & (value.isNull() | (kind == "VOID")), f"{p.name} is missing"))
            checks.append((mine & value.isNotNull() & (kind != KINDS[p.kind]), f"{p.name} is not {p.kind}"))
            size = F.try_variant_get(parsed, f"$.{p.name}", "long" if p.kind == "integer" else "string")
            if p.kind == "string":
                size = F.char_length(size)
            if p.low is not None:
                checks.append((mine & (size < p.low), f"{p.name} is too small"))
            if p.high is not None:
                checks.append((mine & (size > p.high), f"{p.name} is too large"))
    out = F.lit(None).cast("string")
    for wrong, message in reversed(checks):
        out = F.when(wrong, F.lit(message)).otherwise(out)
    return out


def key_of(conv: str, call: str) -> Column:
    """Conversation and identifier as one text that no other pair has; a null conversation is one of its own."""
    return F.to_json(F.array(F.col(conv).cast("string"), F.col(call).cast("string")))


def call_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``key, level`` of every node that isn't on or behind a circle; edges are ``(key, need)``."""
    waiting = staged(edges, "needs")
    done = staged(nodes.join(waiting.select("key").distinct(), "key", "left_anti").select("key", F.lit(0).alias("level")), "levels")
    parts, level = [done], 0
    while True:
        level += 1
        last = parts[-1].select(F.col("key").alias("need"))
        waiting = staged(
            waiting.join(last.withColumn("met", F.lit(level)), "need", "left")
            .select("key", "need", F.coalesce("met", "met_at").alias("met_at"))
            if "met_at" in waiting.columns
            else waiting.join(last.withColumn("met_at", F.lit(level)), "need", "left").select("key", "need", "met_at"),
            "needs",
        )
        ready = waiting.groupBy("key").agg(F.count("*").alias("n"), F.count("met_at").alias("m"), F.max("met_at").alias("level"))
        fresh = staged(ready.where(F.expr(f"n = m and level = {level}")).select("key", "level"), "levels")
        if fresh.isEmpty():
            break
        parts.append(fresh)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def linked(calls: DataFrame, results: DataFrame, tools: Sequence[Tool]) -> DataFrame:
    """One row per call, and per identifier of results without a call.

    ``calls`` has ``conv_id, turn, call_id, name, arguments, needs`` (JSON text and an array of
    identifiers), ``results`` has ``conv_id, turn, call_id, content``. Returned are ``conv_id, turn,
    call_id, name, level, n_results, status, error, message``. Different calls of one identifier in a
    conversation: the first (by turn, then content) is linked, the others are rows of status repeated; so
    are further, different results of a call, of status later result. Equal rows are one.
    """
    called = F.struct("turn", "name", "arguments", "needs")
    every = calls.where("call_id is not null").select(key_of("conv_id", "call_id").alias("key"), "conv_id", "call_id", called.alias("c"))
    every = staged(every.distinct(), "calls")
    firsts = staged(every.groupBy("key").agg(F.min("c").alias("first")), "first-calls")
    marked = every.join(firsts, "key").withColumn("is_first", F.col("c") == F.col("first"))
    calls = marked.where("is_first").select("key", "conv_id", "call_id", "c.*")
    again = marked.where("NOT is_first").select("conv_id", "call_id", "c.*")
    answers = results.where("call_id is not null").select(
        key_of("conv_id", "call_id").alias("key"),
        F.col("conv_id").alias("rc"),
        F.col("call_id").alias("ri"),
        F.struct("turn", F.coalesce("content", F.lit("")).alias("content")).alias("r"),
    )
    answers = staged(answers, "answers")
    found = answers.groupBy("key").agg(
        F.first("rc").alias("rc"), F.first("ri").alias("ri"), F.count("*").alias("n_results"), F.min("r").alias("r")
    )
    later = answers.distinct().join(found.select("key", F.col("r").alias("first")), "key").where("r <> first")
    names = calls.select("key")
    needs = calls.select("key", "conv_id", F.explode("needs").alias("id")).where("id is not null")
    needs = needs.select("key", "id", key_of("conv_id", "id").alias("need"))
    known = needs.distinct().join(names.select(F.col("key").alias("need"), F.lit(True).alias("met")), "need", "left")
    known = staged(known, "known")
    unmet = known.where("met is null").groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("unmet"))
    levels = call_levels(names, known.where("met").select("key", "need"))
    rows = calls.join(levels, "key", "left").join(unmet, "key", "left").join(found, "key", "full")
    missing = F.concat(F.lit("missing need: "), F.array_join("unmet", ", "))
    error = argument_error(F.col("name"), F.col("arguments"), tools)
    error = F.nullif(F.concat_ws("; ", error, missing), F.lit(""))
    status = (
        F.when(F.col("call_id").isNull(), "orphan")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("n_results").isNull(), "open")
        .otherwise("linked")
    )
    called = F.col("call_id").isNotNull()
    linked_rows = rows.select(
        F.coalesce("conv_id", "rc").alias("conv_id"),
        F.coalesce("turn", "r.turn").alias("turn"),
        F.coalesce("call_id", "ri").alias("call_id"),
        "name",
        "level",
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        status.alias("status"),
        F.when(called, error).alias("error"),
        call_message(F.when(called, call_arguments()), F.coalesce("call_id", "ri"), F.col("name"), F.col("r.content")).alias("message"),
    )
    null = F.lit(None).cast("string")
    counts = [F.lit(None).cast("int").alias("level"), F.lit(0).cast("long").alias("n_results")]
    error = argument_error(F.col("name"), F.col("arguments"), tools)
    message = call_message(call_arguments(), F.col("call_id"), F.col("name"), null)
    again = again.select("conv_id", "turn", "call_id", "name", *counts, F.lit("repeated").alias("status"), error.alias("error"), message.alias("message"))
    message = call_message(F.lit(None).cast("variant"), F.col("ri"), null, F.col("r.content"))
    later = later.select(
        *(F.col("rc").alias("conv_id"), F.col("r.turn").alias("turn"), F.col("ri").alias("call_id"), null.alias("name"), *counts),
        *(F.lit("later result").alias("status"), null.alias("error"), message.alias("message")),
    )
    return linked_rows.unionByName(again).unionByName(later)


def call_arguments() -> Column:
    """The arguments as a variant: an object's keys come sorted, and text that isn't JSON stays as text."""
    nothing = F.to_variant_object(F.struct())
    return F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant"), nothing)


def call_message(arguments: Column, ident: Column, name: Column, result: Column) -> Column:
    """Canonical JSON of a call and its result."""
    return F.to_json(F.struct(arguments.alias("arguments"), ident.alias("id"), name.alias("name"), result.alias("result")))


def plain(turns: DataFrame) -> DataFrame:
    """Turns ``conv_id, turn, role, text`` that are no call or result, as rows like those of ``linked``.

    Their status is message, and the message is a JSON object of ``content`` and ``role``.
    """
    message = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content"), "role"))
    null = F.lit(None)
    return turns.select(
        "conv_id",
        "turn",
        null.cast("string").alias("call_id"),
        null.cast("string").alias("name"),
        null.cast("int").alias("level"),
        F.lit(0).cast("long").alias("n_results"),
        F.lit("message").alias("status"),
        null.cast("string").alias("error"),
        message.alias("message"),
    )
