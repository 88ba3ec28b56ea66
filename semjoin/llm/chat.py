"""Chat formatting with linked tool calls.

Messages (conv_id, turn, role, text) become events: a message whose text is a JSON object with ``tool_calls`` (a list of
{id, name, arguments, after}) gives one call each; a ``tool`` message whose text is an object with ``tool_call_id``
gives a result; every other message stays a message. Calls and results meet in a hash join on (conv_id, identifier).
Events are put in topological order: a result comes after its call, a call after the call that ``after`` names, all
else by turn. Chains of ``after`` are followed by pointer doubling, so a chain of n calls takes log2(n) joins and no
conversation is gathered anywhere; order is given by sort columns (order_turn, order_depth, turn, idx), not by a number.
Arguments are checked against the tool's schema, and each event is written as canonical JSON (sorted keys, no spaces).

Statuses: call ``ok``, ``missing_id``, ``duplicate_id`` (an earlier call has the identifier), ``unknown_tool``,
``invalid_arguments: <where>``, ``unknown_after``, ``cycle``; result ``ok``, ``missing_id``, ``orphan``, ``duplicate_result``;
message ``ok``. Broken events stay, with their status, at their own turn.

Defined cases: null conv_id is a conversation of its own; a null turn sorts first; null text is empty content; of
repeated rows (or equal identifiers) the first in turn, then in row order, is the one linked; text that is not such JSON
is plain content, whatever its length (numbers beyond a double's range and nesting too deep to read make it such); a conversation may hold any share of the rows; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "integer": int, "number": (int, float)}


def violation(value, schema: dict, at: str = "$") -> str | None:
    """Where ``value`` breaks the schema (type, enum, required, properties, additionalProperties, items, minimum, maximum, minLength)."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        return f"{at} type"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at} enum"
    if isinstance(value, (int, float)) and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return f"{at} range"
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        return f"{at} minLength"
    parts = []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for k in schema.get("required", []):
            if k not in value:
                return f"{at}.{k} required"
        if schema.get("additionalProperties", True) is False:
            for k in sorted(value.keys() - known.keys()):
                return f"{at}.{k} additional"
        parts = [(value[k], known[k], f"{at}.{k}") for k in sorted(value.keys() & known.keys())]
    elif isinstance(value, list) and "items" in schema:
        parts = [(v, schema["items"], f"{at}[{i}]") for i, v in enumerate(value)]
    return next((bad for part in parts if (bad := violation(*part))), None)


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """Sorted keys, no spaces, characters as they are; halves of surrogate pairs, which no encoding has, are escaped."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda c: f"\\u{ord(c.group()):04x}", text)


def _loads(text: str | None):
    """The JSON value of a text; ValueError for text that isn't JSON, or holds NaN, infinity or a number beyond a double."""
    def refuse(x):
        raise ValueError(x)

    def number(x):
        return value if math.isfinite(value := float(x)) else refuse(x)
    value = json.loads(text or "", parse_constant=refuse, parse_float=number)
    canonical(value)                     # what cannot be written again (nested too deep) counts as no JSON, too
    return value


def _events(messages: DataFrame) -> DataFrame:
    """rid, conv_id, turn, idx, kind, role, name, call_id, after, arguments (JSON text), content (text or JSON text)."""
    body = F.coalesce(F.col("text"), F.lit(""))
    looks = F.ltrim(body).startswith("{")
    calls = F.when(looks, F.from_json(body, "content string, tool_calls array<struct<id: string, name: string, arguments: string, after: string>>"))
    result = F.when(looks & (F.col("role") == "tool"), F.from_json(body, "tool_call_id string, content string"))
    is_call = F.coalesce(F.size("c.tool_calls"), F.lit(-1)) > 0
    is_result = F.col("role").eqNullSafe("tool") & F.col("r").isNotNull() & (F.get_json_object(body, "$.tool_call_id").isNotNull() | F.get_json_object(body, "$.content").isNotNull())
    rows = messages.select("conv_id", "turn", "role", body.alias("text"), calls.alias("c"), result.alias("r"), F.monotonically_increasing_id().alias("row"))
    none = F.lit(None).cast("string")
    def event(kind: str, idx: Column, name: Column, call_id: Column, after: Column, arguments: Column, content: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), idx.cast("long").alias("idx"), name.alias("name"), call_id.alias("call_id"),
                        after.alias("after"), arguments.alias("arguments"), content.alias("content"))
    note = event("message", F.lit(0), none, none, none, none, F.when(is_call, F.coalesce("c.content", F.lit(""))).otherwise(F.col("text")))
    each = F.transform("c.tool_calls", lambda x, i: event("call", i + 1, x["name"], x["id"], x["after"], x["arguments"], none))
    answer = F.array(event("result", F.lit(0), none, F.col("r.tool_call_id"), none, none, F.col("r.content")))
    made = F.when(is_call, F.concat(F.array(note), each)).when(is_result, answer).otherwise(F.array(note))
    out = rows.select("conv_id", "turn", "role", "row", F.explode(made).alias("e")).select("conv_id", "turn", "role", "row", "e.*")
    return out.withColumn("key", F.when(F.col("call_id").isNotNull(), F.to_json(F.struct("conv_id", "call_id"))))


def _first_of(events: DataFrame) -> DataFrame:
    """For each key the first event (turn, row, idx) as struct ``lead``, and the number of events ``n``."""
    return events.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("turn", "row", "idx", "conv_id", "after")).alias("lead"), F.count(F.lit(1)).alias("n"))


def _positions(calls: DataFrame) -> DataFrame:
    """key, order_turn, order_depth, trouble (unknown_after, cycle or null) of the linked calls, by pointer doubling."""
    up = F.when(F.col("lead.after").isNotNull(), F.to_json(F.struct(F.col("lead.conv_id").alias("conv_id"), F.col("lead.after").alias("call_id"))))
    now = stage(calls.select("key", up.alias("up"), F.col("lead.turn").alias("turn"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("lost")), "chat_chain")
    total = now.count()
    for _ in range(total.bit_length() + 1):
        waiting = now.filter("up IS NOT NULL")
        n = waiting.count()
        if not n:
            break
        asked = waiting.groupBy("up").agg(F.count(F.lit(1)).alias("n"))
        # of a target: where it points itself, the latest turn on the way there, and the number of steps
        target = stage(asked.join(now.select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("turn").alias("t"), F.col("depth").alias("d"),
                                             F.col("lost").alias("l"), F.lit(True).alias("known")), "up", "left"), "chat_target")
        met = join_counted(waiting, target, ["up"], "n", n)
        step = met.select("key", F.col("next").alias("up"), F.when(F.col("known"), F.greatest("turn", "t")).otherwise(F.col("turn")).alias("turn"),
                          F.when(F.col("known"), F.col("depth") + F.col("d") + 1).otherwise(F.col("depth")).alias("depth"),
                          (F.col("known").isNull() | F.coalesce("l", F.lit(False))).alias("lost"))
        now = stage(now.filter("up IS NULL").unionByName(step), "chat_chain")
    trouble = F.when(F.col("up").isNotNull(), "cycle").when(F.col("lost"), "unknown_after")
    own = now.withColumn("trouble", trouble)
    return own.select("key", F.when(F.col("trouble").isNull(), F.col("turn")).alias("order_turn"),
                      F.when(F.col("trouble").isNull(), F.col("depth")).alias("order_depth"), "trouble")


def link_and_format(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per event: conv_id, order_turn, order_depth, turn, idx, kind, call_id, status, json."""
    events = stage(_events(messages), "chat_events")
    calls, results = events.filter("kind = 'call'"), events.filter("kind = 'result'")
    first = stage(_first_of(calls), "chat_calls")
    place = stage(_positions(first).join(first, "key"), "chat_places")
    call_rows = join_counted(calls.filter("key IS NOT NULL"), place.hint("shuffle_hash"), ["key"], "n", calls.count())
    linked = F.struct("turn", "row", "idx").eqNullSafe(F.struct("lead.turn", "lead.row", "lead.idx"))
    call_rows = call_rows.select(*events.columns, F.when(linked, F.col("order_turn")).alias("order_turn"), F.when(linked, F.col("order_depth")).alias("order_depth"),
                                 F.when(~linked, "duplicate_id").otherwise(F.col("trouble")).alias("status"))
    answers = stage(_first_of(results), "chat_answers").join(
        place.select("key", F.col("order_turn").alias("call_turn"), F.col("order_depth").alias("call_depth"), F.col("lead.turn").alias("own_turn"),
                     F.lit(True).alias("called")).hint("shuffle_hash"), "key", "left")
    answers = stage(answers, "chat_linked")
    result_rows = join_counted(results.filter("key IS NOT NULL"), answers, ["key"], "n", results.count())
    turn = F.greatest("turn", F.coalesce("call_turn", "own_turn"))
    found = F.col("called") & linked
    result_rows = result_rows.select(*events.columns, F.when(found, turn).alias("order_turn"), F.when(found, F.coalesce("call_depth", F.lit(0)) + 1).alias("order_depth"),
                                     F.when(F.col("called").isNull(), "orphan").when(~linked, "duplicate_result").alias("status"))
    other = events.filter("key IS NULL").select(*events.columns, F.lit(None).cast("long").alias("order_turn"), F.lit(None).cast("long").alias("order_depth"),
                                                F.when(F.col("kind") != "message", "missing_id").alias("status"))
    rows = call_rows.unionByName(result_rows).unionByName(other)
    rows = rows.withColumn("order_turn", F.coalesce("order_turn", "turn")).withColumn("order_depth", F.coalesce("order_depth", F.lit(0)))

    @F.pandas_udf("status string, json string")
    def formatted(kind: pd.Series, role: pd.Series, name: pd.Series, call_id: pd.Series, after: pd.Series, arguments: pd.Series,
                  content: pd.Series, status: pd.Series) -> pd.DataFrame:
        out = [_format(*x, schemas) for x in zip(kind, role, name, call_id, after, arguments, content, status)]
        return pd.DataFrame(out, columns=["status", "json"])

    made = formatted("kind", "role", "name", "call_id", "after", "arguments", "content", "status")
    return rows.withColumn("f", made).select("conv_id", "order_turn", "order_depth", "turn", "idx", "kind", "call_id", "f.status", "f.json")


def _format(kind, role, name, call_id, after, arguments, content, status, schemas) -> tuple[str, str]:
    if kind == "message":
        return "ok", canonical({"role": role, "content": content})
    if kind == "result":
        try:
            content = _loads(content)
        except (ValueError, RecursionError):
            pass
        return status or "ok", canonical({"role": "tool", "tool_call_id": call_id, "content": content})
    bad, args = None, arguments
    try:
        args = _loads(arguments)
        if name in schemas:
            bad = violation(args, schemas[name])
    except (ValueError, RecursionError):
        bad = "$ json"
    status = status or (f"invalid_arguments: {bad}" if bad and name in schemas else None if name in schemas else "unknown_tool")
    call = {"id": call_id, "name": name, "arguments": args} | ({"after": after} if after else {})
    return status or "ok", canonical({"role": role, "tool_call": call})


def in_order():
    """The window that lists a conversation's events in topological order."""
    return Window.partitionBy("conv_id").orderBy("order_turn", "order_depth", "turn", "idx")
