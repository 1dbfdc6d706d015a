"""Operator 5: tool calls and their results in conversations.

Messages are rows (conv_id, turn, role, text). A text that is a JSON object
may carry ``tool_calls`` (a list of objects with id, name, arguments) or
``tool_call_id`` (the result of a call, in ``content``). An argument that is an
object ``{"$ref": id}`` stands for the result of another call of the same
conversation. Every message, call and result becomes one row:

- calls and results are joined by (conv_id, id): ``status`` is linked,
  no_result, no_call, or duplicate for all but the first of an id;
- ``level`` orders calls topologically: 0 without references, else one more
  than the highest level referred to; a result has its call's level. Calls on
  a cycle, or behind one, have none. It takes as many rounds as the longest
  chain of references has links; each works on the calls still open (a call that
  refers to no call of its conversation has no level either);
- arguments are validated against the tool's schema (``errors``);
- ``json`` is canonical: sorted keys, no white space, UTF-8 as it is.

Rows are ordered by (conv_id, level, turn, nth) when read; no conversation is
gathered in one task.

A text that starts as JSON but is none, nests too deeply to be walked, or holds NaN, infinity
or half a surrogate pair is a plain message.

Nulls: a null conv_id is a conversation of its own, a null turn comes first,
a null role or text is written as null. Repeated rows are duplicates of the
call or result they repeat. Text that is no JSON object is a plain message.
Extra columns are ignored.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnstream.llm.common import bound_batches, materialize

RECORD = ("conv_id long, turn long, nth int, kind string, call_id string, refs array<string>, "
          "errors string, json string, row long")
KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()),
         pa.string(), pa.string(), pa.int64()]


def canonical(value) -> str:
    """Sorted keys, no spaces. ValueError for what JSON in UTF-8 cannot hold: NaN,
    infinity, half a surrogate pair."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text.encode()
    return text


def type_of(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int) or isinstance(value, float) and math.isfinite(value) and value == int(value):
        return "integer"
    return {float: "number", str: "string", list: "array", dict: "object"}.get(type(value), "null")


def is_ref(value) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str)


def refs(value) -> set[str]:
    if is_ref(value):
        return {value["$ref"]}
    parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return {r for part in parts for r in refs(part)}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value departs from a schema: type, required, properties,
    additionalProperties, items, enum, minimum, maximum, maxLength. A
    reference fits any schema: its value is not known yet."""
    if is_ref(value):
        return []
    kind, want = type_of(value), schema.get("type")
    if want and kind != want and not (want == "number" and kind == "integer"):
        return [f"{at}: {kind} is not {want}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if kind in ("integer", "number"):
        out += [f"{at}: below {schema['minimum']}"] if value < schema.get("minimum", value) else []
        out += [f"{at}: above {schema['maximum']}"] if value > schema.get("maximum", value) else []
    if kind == "string" and len(value) > schema.get("maxLength", len(value)):
        out.append(f"{at}: longer than {schema['maxLength']}")
    if kind == "array" and "items" in schema:
        out += [e for k, v in enumerate(value) for e in violations(v, schema["items"], f"{at}[{k}]")]
    if kind == "object":
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: not allowed")
    return out


def records_of(conv_id, turn, role, text, tools: dict[str, dict]) -> list[tuple]:
    """The rows of one message; a text whose JSON cannot be read, walked or written again is a
    plain message."""
    if text and text.lstrip()[:1] == "{":
        try:
            rows = _records_of(conv_id, turn, role, text, json.loads(text), tools)
            for row in rows:
                "".join(x for x in (row[4], row[6], *row[5]) if x).encode()
            return rows
        except (ValueError, RecursionError, OverflowError):
            pass
    return _records_of(conv_id, turn, role, text, None, tools)


def _records_of(conv_id, turn, role, text, body, tools: dict[str, dict]) -> list[tuple]:
    rows = []
    if isinstance(body, dict) and isinstance(body.get("tool_calls"), list):
        for n, call in enumerate(c for c in body["tool_calls"] if isinstance(c, dict)):
            args = call.get("arguments")
            if isinstance(args, str):
                try:
                    args = json.loads(args)
                except (ValueError, RecursionError):
                    pass
            name, call_id = call.get("name"), call.get("id")
            schema = tools.get(name) if isinstance(name, str) else None
            found = [f"unknown tool {name}"] if schema is None else violations(args, schema)
            rows.append((conv_id, turn, n, "call", None if call_id is None else str(call_id),
                         sorted(refs(args)), ";".join(found),
                         canonical({"arguments": args, "id": call_id, "name": name})))
        text = body.get("content")
    elif isinstance(body, dict) and "tool_call_id" in body:
        call_id = body["tool_call_id"]
        return [(conv_id, turn, 0, "result", None if call_id is None else str(call_id), [], "",
                 canonical({"content": body.get("content"), "tool_call_id": call_id}))]
    if not rows or text is not None:
        rows.append((conv_id, turn, len(rows), "message", None, [], "", canonical({"content": text, "role": role})))
    return rows


def records(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """``tools``: a tool's name -> the schema of its arguments."""
    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = [r for m in zip(*(b.column(k).to_pylist() for k in range(4))) for r in records_of(*m, tools)]
            if rows:
                columns = [*zip(*rows), range(at, at + len(rows))]
                at += len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)],
                                                 [c.split()[0] for c in RECORD.split(", ")])

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(
        run, RECORD)


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level of every call that no cycle holds back."""
    open_ = materialize(calls.select("conv_id", "call_id", "refs"), "calls")
    done = materialize(open_.where(F.size("refs") == 0).select("conv_id", "call_id", F.lit(0).alias("level")), "level")
    out, level = done, 0
    # left to wait for: one row a reference
    waits = materialize(open_.select("conv_id", "call_id", F.explode("refs").alias("ref")), "waits")
    while waits.limit(1).count():
        level += 1
        ready = done.select(F.col("conv_id").alias("c"), F.col("call_id").alias("r")).distinct()
        met = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("ref") == F.col("r"))
        rest = materialize(waits.join(ready, met, "left_anti"), "waits")
        still = rest.select("conv_id", "call_id").distinct().withColumnsRenamed({"conv_id": "c", "call_id": "r"})
        own = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("r"))
        done = materialize(waits.select("conv_id", "call_id").distinct().join(still, own, "left_anti")
                           .withColumn("level", F.lit(level)), "level")
        if not done.limit(1).count():
            break
        out, waits = out.union(done), rest
    return out


def link(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """conv_id, turn, nth, kind, call_id, status, level, errors, json."""
    bound_batches(messages.sparkSession)
    rows = materialize(records(messages, tools), "records")
    is_tied = "kind != 'message' AND call_id IS NOT NULL"
    tied = rows.where(is_tied)
    # repeated rows differ by their number alone
    place = F.struct("turn", "nth", F.xxhash64("json").alias("hash"), "row")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    slim = tied.select("conv_id", "call_id", "kind", "refs", place.alias("place"))
    by_id = materialize(slim.groupBy(F.col("conv_id").alias("c"), F.col("call_id").alias("i")).agg(
        F.min(F.when(call, F.col("place"))).alias("call"), F.min(F.when(result, F.col("place"))).alias("result"),
        F.min(F.when(call, F.struct("place", "refs"))).alias("full")), "by-id")
    calls = by_id.where("call IS NOT NULL").select(F.col("c").alias("conv_id"), F.col("i").alias("call_id"),
                                                   F.col("full.refs").alias("refs"))
    rank = levels(calls).withColumnsRenamed({"conv_id": "lc", "call_id": "li"})
    by_id = by_id.drop("full").join(rank, F.col("c").eqNullSafe(F.col("lc")) & (F.col("i") == F.col("li")), "left")
    own = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i"))
    first = F.when(call, F.col("call")).otherwise(F.col("result"))
    status = (F.when(F.col("call").isNull(), "no_call")
              .when(F.col("row") != first["row"], "duplicate")
              .when(F.col("result").isNull(), "no_result").otherwise("linked"))
    linked = tied.join(by_id, own, "left").select(
        "conv_id", "turn", "nth", "kind", "call_id", status.alias("status"), "level", "errors", "json")
    # a call or result without an id is tied to nothing
    alone = F.when(call, "no_result").when(result, "no_call")
    rest = rows.where(f"NOT ({is_tied})").select(
        "conv_id", "turn", "nth", "kind", "call_id", alone.alias("status"), F.lit(None).cast("int").alias("level"),
        "errors", "json")
    return linked.unionByName(rest)


# ---- the query's messages -----------------------------------------------------

#: Tools of the derived conversations.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 40},
                              "after": {"type": "string"}}},
    "rank": {"type": "object", "required": ["query", "after"], "additionalProperties": False,
             "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}, "after": {"type": "string"}}},
}


def derived(conversations: DataFrame) -> DataFrame:
    """The conversations with every assistant turn written as a tool call and
    the user turn behind it as its result. A call of w words is a search, a
    rank (w % 3 = 1) or an unknown tool (w % 11 = 5), has the limit w, and
    refers to the call before (w % 3 = 0) or behind it (w % 7 = 1)."""
    text = F.coalesce("text", F.lit(""))
    w = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    name = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    ref = F.when(w % 3 == 0, name(F.col("turn") - 2)).when(w % 7 == 1, name(F.col("turn") + 2))
    arguments = F.struct(text.alias("query"), w.alias("limit"),
                         F.when(ref.isNotNull(), F.struct(ref.alias("$ref"))).alias("after"))
    tool = F.when(w % 11 == 5, "draw").when(w % 3 == 1, "rank").otherwise("search")
    call = F.to_json(F.struct(F.array(F.struct(name(F.col("turn")).alias("id"), tool.alias("name"),
                                               arguments.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(name(F.col("turn") - 1).alias("tool_call_id"), text.alias("content")))
    return conversations.select(
        "conv_id", "turn", "role",
        F.when(F.col("role") == "assistant", call)
        .when((F.col("role") == "user") & (F.col("turn") > 0), result).otherwise(F.col("text")).alias("text"))
