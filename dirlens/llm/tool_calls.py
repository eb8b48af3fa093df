"""Chat formatting: tool calls linked with their results, ordered, validated, in canonical JSON.

Method. A message whose text is a JSON object with `tool_calls` holds calls (id, name, arguments;
also nested under `function`, with arguments as an object or as JSON text); a message of role `tool`
whose text is an object with `tool_call_id` holds a result. Results meet calls by a hash join on
(conversation, identifier); of calls with one identifier the first stands. Arguments are validated
against schemas by tool name: those given, and those that a conversation's system messages declare as
`tools` (name and parameters, also nested under `function`), which meet the calls by a hash join on
(conversation, name). Where a conversation or the caller declares tools, a call of any other is at
fault; where neither does, a call is valid if its arguments are JSON. An argument {"$result": id} is a dependency on that call's
result. Order is topological: a result follows its call's message, and a message that depends on
a call of its own turn or a later one follows that; what is in order already keeps its turn.
Messages are serialised with sorted keys, no white space and no escaped letters.

A row is a message, and texts are never gathered by conversation; the dependencies alone (three numbers
each) of a conversation with one on a later message are ordered in one task, in linear time: a conversation is read in order of
(order_turn, order_level, order_kind, order_index, turn).

Canonical: numbers without a fraction are integers, half surrogates are written as their escapes.

Input cases. Text null: content null. Text with numbers beyond a 64-bit float, NaN, or nested deeper
than MOST_DEPTH is no JSON. Text that is no such object is plain content. A result
without a call, or a call without a result, is kept and counted as unlinked. A null conversation or
turn never links. Messages in a dependency cycle, or between two, keep their turns; those that
depend on them follow. Repeated rows are repeated
messages. Empty tables give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables

TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: Levels of objects and lists in each other.
MOST_DEPTH = 200
HALF = re.compile("[\ud800-\udfff]")


def whole(x: str) -> str:
    """x with half surrogates, which UTF-8 can't hold, as their JSON escapes."""
    return HALF.sub(lambda m: f"\\u{ord(m[0]):04x}", x)


def canonical(x: Any) -> str:
    return whole(json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def _number(x: str) -> int | float:
    value = float(x)
    if math.isinf(value):
        raise ValueError(f"beyond a float: {x}")
    return int(value) if value.is_integer() and abs(value) < 2**53 else value


def _constant(x: str) -> None:
    raise ValueError(f"no JSON: {x}")


def read(x: str) -> Any:
    """The value of a JSON text; ValueError where it is none, or one that could not be written again."""
    try:
        value = json.loads(x, parse_float=_number, parse_constant=_constant)
    except RecursionError as deep:
        raise ValueError("nested too deep") from deep
    level = [value]
    for _ in range(MOST_DEPTH + 1):
        level = [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return value
    raise ValueError("nested too deep")


def is_a(value: Any, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, TYPES.get(kind, object))


def faults(value: Any, schema: Any, at: str = "$") -> list[str]:
    """What in value breaks schema: type (one or several), enum, required, properties, additionalProperties, items.

    A schema that is no object allows all, or nothing if it is false; so does each part of an unknown form.
    """
    if not isinstance(schema, dict):
        return [f"{at}: not allowed"] if schema is False else []
    kinds = schema.get("type")
    kinds = [k for k in (kinds if isinstance(kinds, list) else [kinds]) if isinstance(k, str)]
    if kinds and not any(is_a(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if isinstance(schema.get("enum"), list) and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema["properties"] if isinstance(schema.get("properties"), dict) else {}
        required = schema["required"] if isinstance(schema.get("required"), list) else []
        out += [f"{at}.{k}: missing" for k in required if isinstance(k, str) and k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{i}]")
    return out


def references(value: Any) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$result"} and isinstance(value["$result"], str):
            return [whole(value["$result"])]
        return [r for k in sorted(value) for r in references(value[k])]
    return [r for x in value for r in references(x)] if isinstance(value, list) else []


def _named(x: Any, key: str) -> tuple[str | None, Any, dict[str, Any]]:
    """name, the value of key, and the object that has them: x, or what x holds under `function`."""
    outer = x if isinstance(x, dict) else {}
    inner = outer["function"] if isinstance(outer.get("function"), dict) else outer
    return inner["name"] if isinstance(inner.get("name"), str) else None, inner.get(key, {}), outer


def parse(role: str | None, text: str | None) -> dict[str, Any]:
    """message, calls, result_id and declared tools (name, schema) of one row."""
    plain: dict[str, Any] = {"message": canonical({"role": role, "content": text}), "calls": [], "result_id": None, "tools": []}
    if not text or not text.lstrip().startswith("{"):
        return plain
    try:
        body = read(text)
    except ValueError:
        return plain
    if role == "system" and isinstance(body.get("tools"), list):
        tools = [_named(x, "parameters")[:2] for x in body["tools"]]
        return plain | {"tools": [{"name": whole(n), "schema": canonical(x)} for n, x in tools if n is not None]}
    if role == "tool" and isinstance(body.get("tool_call_id"), str):
        return plain | {"message": canonical({"role": role, "tool_call_id": body["tool_call_id"], "content": body.get("content")}), "result_id": whole(body["tool_call_id"])}
    if not isinstance(body.get("tool_calls"), list):
        return plain
    calls, shown = [], []
    for call in body["tool_calls"]:
        name, arguments, outer = _named(call, "arguments")
        good = True
        if isinstance(arguments, str):
            try:
                arguments = read(arguments)
            except ValueError:
                good = False
        own = outer["id"] if isinstance(outer.get("id"), str) else None
        calls.append({"id": own and whole(own), "name": name and whole(name), "arguments": canonical(arguments) if good else None, "refs": references(arguments)})
        shown.append({"id": own, "name": name, "arguments": arguments})
    return plain | {"message": canonical({"role": role, "content": body.get("content"), "tool_calls": shown}), "calls": calls}


def _fits(arguments: pa.Array, schemas: pa.Array) -> pa.Array:
    """Whether arguments break no schema; both are canonical JSON."""
    pairs = zip(arguments.to_pylist(), schemas.to_pylist(), strict=True)
    return pa.array([a is not None and s is not None and not faults(json.loads(a), json.loads(s)) for a, s in pairs], pa.bool_())


def _valid(calls: DataFrame, tools: DataFrame, schemas: dict[str, Any] | None) -> DataFrame:
    """conv_id, turn, row and n_valid of calls (conv_id, turn, row, call), by tools (conv_id, name, schema) and the schemas given."""
    declared = tools.groupBy("conv_id", "name").agg(F.min("schema").alias("schema"))
    some = declared.select("conv_id").distinct().withColumn("declares", F.lit(True))
    given = calls.sparkSession.createDataFrame([(n, canonical(x)) for n, x in (schemas or {}).items()], "name string, given string")
    rows = calls.select("conv_id", "turn", "row", F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"))
    known = rows.join(declared, ["conv_id", "name"], "left").join(some, "conv_id", "left").join(F.broadcast(given), "name", "left")
    free = F.lit(None).cast("string") if schemas is not None else F.when(F.col("declares").isNull(), "true")
    fits = known.select("conv_id", "turn", "row", F.arrow_udf(_fits, "boolean")("arguments", F.coalesce("schema", "given", free)).alias("fits"))
    return fits.groupBy("conv_id", "turn", "row").agg(F.count_if("fits").cast("int").alias("n_valid"))


def link(messages: DataFrame, schemas: dict[str, Any] | None = None) -> DataFrame:
    """One row for each row of messages (conv_id, turn, role, text): its place, JSON and links.

    conv_id, turn, order_turn, order_level, order_kind (0 message, 1 result), order_index, message,
    n_calls, n_valid calls, n_answered calls, linked (of a result: whether it has a call). Rows of one turn
    share the answered calls of that turn; schemas are few.
    """
    text_list = pa.list_(pa.string())
    kind = pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("arguments", pa.string()), ("refs", text_list)]))
    tool = pa.list_(pa.struct([("name", pa.string()), ("schema", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = [parse(r, t) for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                parsed = [pa.array([m[c] for m in made], t) for c, t in (("message", pa.string()), ("calls", kind), ("result_id", pa.string()), ("tools", tool))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *parsed], names=["conv_id", "turn", "message", "calls", "result_id", "tools"])

    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    parsed = tables.cut(rows.mapInArrow(work, "conv_id long, turn long, message string, calls array<struct<id:string,name:string,arguments:string,refs:array<string>>>, result_id string, tools array<struct<name:string,schema:string>>"))
    calls = parsed.where(F.size("calls") > 0).select("conv_id", "turn", F.xxhash64("message").alias("row"), F.posexplode("calls").alias("index", "call"))
    first = calls.where("call.id is not null and turn is not null").groupBy("conv_id", F.col("call.id").alias("id")).agg(F.min(F.struct("turn", "index")).alias("first"))
    first = first.select("conv_id", "id", F.col("first.turn").alias("call_turn"), F.col("first.index").alias("call_index"))
    answered = parsed.where("result_id is not null").select("conv_id", F.col("result_id").alias("id")).distinct().join(first, ["conv_id", "id"])
    answers = answered.groupBy("conv_id", F.col("call_turn").alias("turn")).agg(F.count("*").alias("n_answered"))

    needs = calls.select("conv_id", "turn", F.explode("call.refs").alias("id")).join(first, ["conv_id", "id"]).where("call_turn <> turn").select("conv_id", "turn", F.col("call_turn").alias("on")).distinct()
    moved = _moved(tables.cut(needs))

    tools = parsed.where("conv_id is not null and size(tools) > 0").select("conv_id", F.inline("tools"))
    # repeated rows have the same calls
    valid = _valid(calls.dropDuplicates(["conv_id", "turn", "row", "index"]), tools, schemas)
    valid = valid.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("row").alias("_r"), "n_valid")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.xxhash64("message") == F.col("_r"))
    out = parsed.join(valid, same, "left")
    out = out.join(answers, ["conv_id", "turn"], "left").join(first.withColumnRenamed("id", "result_id"), ["conv_id", "result_id"], "left")
    out = out.withColumn("base", F.coalesce("call_turn", "turn")).join(moved.withColumnRenamed("turn", "base"), ["conv_id", "base"], "left")
    return out.select(
        "conv_id", "turn",
        F.coalesce("order_turn", "base").alias("order_turn"),
        F.coalesce("order_level", F.lit(0)).alias("order_level"),
        F.col("call_turn").isNotNull().cast("int").alias("order_kind"),
        F.coalesce("call_index", F.lit(0)).alias("order_index"),
        "message",
        F.size("calls").alias("n_calls"),
        F.when(F.size("calls") > 0, F.coalesce("n_valid", F.lit(0))).otherwise(0).alias("n_valid"),
        F.coalesce("n_answered", F.lit(0)).cast("int").alias("n_answered"),
        F.when(F.col("result_id").isNotNull(), F.col("call_turn").isNotNull()).alias("linked"),
    )


def placed(turn: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """turn, order_turn and order_level of the messages of a conversation that must follow a later one.

    The message at turn[k] follows the one at on[k]. Messages are placed once all they need is, so
    each dependency is seen once, whatever the depth. If none can be, those left that lie on cycles or
    between them are placed at their turns and the rest goes on.
    """
    turns, at = np.unique(np.concatenate([turn, on]), return_inverse=True)
    n = len(turns)
    late, early = at[: len(turn)], at[len(turn) :]

    def lists(of: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]), to[np.argsort(of, kind="stable")]

    def targets(bounds: np.ndarray, to: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = bounds[nodes + 1] - bounds[nodes]
        return np.repeat(nodes, size), to[np.arange(size.sum()) + np.repeat(bounds[nodes] - np.cumsum(size) + size, size)]

    after, before = lists(early, late), lists(late, early)
    needs, needed = np.bincount(late, minlength=n), np.bincount(early, minlength=n)
    own = np.arange(n) * n
    best = np.full(n, -1)  # the latest place of what it needs, as turn * n + level
    place = np.full(n, -1)
    ready = np.flatnonzero(needs == 0)
    fixed = False
    while True:
        while len(ready):
            place[ready] = own[ready] if fixed else np.where(best[ready] > own[ready], best[ready] + 1, own[ready])
            fixed = False
            source, target = targets(*after, ready)
            np.maximum.at(best, target, place[source])
            np.subtract.at(needs, target, 1)
            ready = np.unique(target[(needs[target] == 0) & (place[target] < 0)])
        left = place < 0
        if not left.any():
            break
        wanted = needed.copy()
        np.subtract.at(wanted, early[~left[late]], 1)
        ends = np.flatnonzero(left & (wanted == 0))
        while len(ends):  # nothing left needs these
            left[ends] = False
            _, target = targets(*before, ends)
            np.subtract.at(wanted, target, 1)
            ends = np.unique(target[left[target] & (wanted[target] == 0)])
        ready, fixed = np.flatnonzero(left), True
    moved = np.flatnonzero(place != own)
    return turns[moved], turns[place[moved] // n], place[moved] % n


def _moved(needs: DataFrame) -> DataFrame:
    """conv_id, turn, order_turn, order_level of the messages that must follow a later one.

    needs (conv_id, turn, on): the message at turn follows the one at `on`.
    """

    def work(table: pa.Table) -> pa.Table:
        turn, order_turn, level = placed(table.column("turn").to_numpy(), table.column("on").to_numpy())
        conv = pa.array([table.column("conv_id")[0].as_py()] * len(turn), pa.int64())
        return pa.table({"conv_id": conv, "turn": pa.array(turn, pa.int64()), "order_turn": pa.array(order_turn, pa.int64()), "order_level": pa.array(level, pa.int32())})

    schema = "conv_id long, turn long, order_turn long, order_level int"
    if needs.where("on > turn").isEmpty():
        return needs.sparkSession.createDataFrame([], schema)
    some = needs.join(needs.where("on > turn").select("conv_id").distinct(), "conv_id", "left_semi")
    return some.groupBy("conv_id").applyInArrow(work, schema)


def op7_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(tables.read(spark, sf_dir, "conversations"))


#: For tables whose calls need no later result, whose arguments have their keys in order, and that declare no tools.
SQL = """
WITH m AS (
  SELECT conv_id, turn, role, text, row_number() OVER () AS r, CASE WHEN left(ltrim(text), 1) = '{' AND json_valid(text) THEN CAST(text AS JSON) END AS j FROM conversations
), kinds AS (
  SELECT *, CASE WHEN role = 'tool' AND json_type(j, '$.tool_call_id') = 'VARCHAR' THEN j->>'$.tool_call_id' END AS result_id,
    coalesce(json_type(j, '$.tool_calls') = 'ARRAY', false) AS has_calls, coalesce(CAST(to_json(role) AS VARCHAR), 'null') AS role_json,
    coalesce(CAST(json_extract(j, '$.content') AS VARCHAR), 'null') AS content
  FROM m
), calls AS (
  SELECT r, conv_id, turn, i, json_extract(j, '$.tool_calls[' || i || ']') AS c
  FROM (SELECT *, unnest(range(CAST(json_array_length(j, '$.tool_calls') AS BIGINT))) AS i FROM kinds WHERE has_calls AND result_id IS NULL)
), inner_ AS (
  SELECT r, conv_id, turn, i, CASE WHEN json_type(c, '$.id') = 'VARCHAR' THEN c->>'$.id' END AS id,
    CASE WHEN json_type(c, '$.function') = 'OBJECT' THEN json_extract(c, '$.function') ELSE c END AS f
  FROM calls
), made AS (
  SELECT *, CASE WHEN json_type(f, '$.name') = 'VARCHAR' THEN json_extract(f, '$.name') END AS name, json_type(f, '$.arguments') = 'VARCHAR' AS quoted,
    CASE WHEN json_type(f, '$.arguments') = 'VARCHAR' THEN f->>'$.arguments' ELSE coalesce(CAST(json_extract(f, '$.arguments') AS VARCHAR), '{}') END AS arguments
  FROM inner_
), per_row AS (
  SELECT r, count(*) AS n_calls, count(*) FILTER (WHERE json_valid(arguments)) AS n_valid,
    string_agg('{"arguments":' || CASE WHEN json_valid(arguments) THEN CAST(json(arguments) AS VARCHAR) ELSE CAST(to_json(arguments) AS VARCHAR) END
      || ',"id":' || coalesce(CAST(to_json(id) AS VARCHAR), 'null') || ',"name":' || coalesce(CAST(name AS VARCHAR), 'null') || '}', ',' ORDER BY i) AS shown
  FROM made GROUP BY r
), firsts AS (
  SELECT conv_id, id, min((turn, i)) AS f FROM made WHERE id IS NOT NULL AND turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY conv_id, id
), answers AS (
  SELECT f.conv_id, f.f[1] AS turn, count(*) AS n FROM firsts f WHERE EXISTS (SELECT 1 FROM kinds k WHERE k.conv_id = f.conv_id AND k.result_id = f.id) GROUP BY 1, 2
)
SELECT k.conv_id, k.turn, coalesce(f.f[1], k.turn) AS order_turn, 0 AS order_level, CASE WHEN f.id IS NULL THEN 0 ELSE 1 END AS order_kind,
  CAST(coalesce(f.f[2], 0) AS INTEGER) AS order_index,
  CASE WHEN k.result_id IS NOT NULL THEN '{"content":' || content || ',"role":' || role_json || ',"tool_call_id":' || CAST(to_json(k.result_id) AS VARCHAR) || '}'
    WHEN has_calls THEN '{"content":' || content || ',"role":' || role_json || ',"tool_calls":[' || coalesce(shown, '') || ']}'
    ELSE '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || role_json || '}' END AS message,
  CAST(coalesce(n_calls, 0) AS INTEGER) AS n_calls, CAST(coalesce(n_valid, 0) AS INTEGER) AS n_valid, CAST(coalesce(a.n, 0) AS INTEGER) AS n_answered,
  CASE WHEN k.result_id IS NOT NULL THEN f.id IS NOT NULL END AS linked
FROM kinds k LEFT JOIN per_row USING (r) LEFT JOIN firsts f ON f.conv_id = k.conv_id AND f.id = k.result_id LEFT JOIN answers a ON a.conv_id = k.conv_id AND a.turn = k.turn
"""
