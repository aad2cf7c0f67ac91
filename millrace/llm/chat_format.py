"""Chat formatting with tool-call linking.

Only built-in DataFrame functions.  An assistant's text may be a JSON object with
``tool_calls`` (a list of id, name, arguments) and a tool's text one with
``tool_call_id`` and ``content``.  Calls and results are hash-joined by
conversation and identifier.  A call whose arguments mention ``${other}`` needs
the result of the call ``other``; depths are found by resolving, round after
round, the calls all of whose needs are resolved, so a cycle never gets a depth.
Arguments are validated against the tools' schemas, and every message becomes one
line of canonical JSON: keys sorted, no blanks, calls in topological order.

The result has one row for each message, ordered by (conv_id, turn, depth), and
nothing gathers a conversation in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import cut, keep, store

#: Tools by name: the arguments they know with their JSON types, and those they need.
SCHEMAS: dict[str, tuple[dict[str, str], tuple[str, ...]]] = {
    "search": ({"query": "string", "limit": "integer"}, ("query",)),
    "calculate": ({"expression": "string"}, ("expression",)),
    "fetch": ({"url": "string"}, ("url",)),
}

_CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string>>>"
_RESULT = "struct<tool_call_id:string,content:string>"


def canonical(json_text: Column) -> Column:
    """JSON with sorted keys and no blanks; null for what is not JSON."""
    return F.to_json(F.try_parse_json(json_text))


def _kind(value: Column) -> Column:
    """The JSON type of a variant: string, integer, number, boolean, array, object or null."""
    found = F.schema_of_variant(value)
    return (
        F.when(found == "STRING", "string")
        .when(found == "BIGINT", "integer")
        .when(found.startswith("DECIMAL") | (found == "DOUBLE"), "number")
        .when(found == "BOOLEAN", "boolean")
        .when(found.startswith("ARRAY"), "array")
        .when(found.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def _valid(name: Column, arguments: Column, schemas: dict) -> Column:
    """Whether the arguments are an object that the schema of the named tool allows."""
    given = F.coalesce(F.json_object_keys(F.when(_kind(arguments) == "object", F.to_json(arguments))), F.array().cast("array<string>"))
    answer = F.lit(False)
    for tool, (known, needed) in sorted(schemas.items()):
        fine = (_kind(arguments) == "object") & (F.size(F.array_except(given, F.array(*map(F.lit, sorted(known))))) == 0)
        for argument, kind in sorted(known.items()):
            value = F.try_variant_get(arguments, f"$['{argument}']", "variant")
            right = (_kind(value) == kind) | ((_kind(value) == "integer") & F.lit(kind == "number"))
            missing = ~F.array_contains(given, argument)
            fine &= F.when(missing, F.lit(argument not in needed)).otherwise(right)
        answer = F.when(name == tool, fine).otherwise(answer)
    return F.coalesce(answer, F.lit(False))


def _depths(calls: DataFrame) -> DataFrame:
    """(conv_id, id, depth) of the calls that can be ordered; 0 for a call without needs.

    A round takes away the needs that the last one resolved; the calls that have
    none left are the next depth.  What a round reads and writes shrinks with the
    calls that are still open.
    """
    unresolved = cut(calls.select("conv_id", "id", F.explode("needs").alias("need")).distinct())
    waiting = calls.where(F.size("needs") > 0).select("conv_id", "id")
    newly = calls.where(F.size("needs") == 0).select("conv_id", "id")
    done = newly.withColumn("depth", F.lit(0))
    depth = 0
    while not unresolved.isEmpty():
        depth += 1
        unresolved = cut(unresolved.join(newly.select("conv_id", F.col("id").alias("need")), ["conv_id", "need"], "left_anti"))
        newly = cut(waiting.join(unresolved, ["conv_id", "id"], "left_anti"))
        if newly.isEmpty():
            break
        waiting = cut(waiting.join(newly, ["conv_id", "id"], "left_anti"))
        done = done.unionByName(newly.withColumn("depth", F.lit(depth)))
        if depth % 16 == 0:  # so that the plan stays small
            done = cut(done)
    return cut(done)


def format_chat(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row for each message: conv_id, turn, role, kind, depth, n_calls, n_linked, n_valid, message.

    ``kind`` is text, calls or result; ``depth`` orders calls and results (-1 for
    plain text, null for what belongs to a cycle, or for a result without a call).
    ``n_linked`` counts a message's calls that have a result, or a result's calls
    (0 or 1); ``n_valid`` counts the calls whose arguments their tool's schema
    allows; an unknown tool allows none.  Of calls or results that repeat an
    identifier in a conversation the earliest turn counts.  A null role is
    written as user and a null text as empty; text that is not such JSON is plain.
    Null conversations or turns stay null, and messages of a null conversation are
    never linked.  Texts of any length are parsed whole.  Repeated rows stay; other
    columns are not read; an empty table gives an empty result.
    """
    schemas = SCHEMAS if schemas is None else schemas
    rows = messages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    looks = F.col("text").startswith("{")
    called = F.when((F.col("role") == "assistant") & looks, F.from_json("text", _CALLS)["tool_calls"])
    result = F.when((F.col("role") == "tool") & looks, F.from_json("text", _RESULT))
    rows = store(rows.withColumn("calls", called).withColumn("result", result), "messages")

    arguments = F.try_parse_json("call.arguments")
    needs = F.array_distinct(F.regexp_extract_all(F.coalesce("call.arguments", F.lit("")), F.lit(r"\$\{([^}]+)\}"), F.lit(1)))
    calls = rows.select("row", "conv_id", "turn", F.posexplode("calls").alias("place", "call"))
    calls = calls.select(
        "row", "conv_id", "turn", "place",
        F.col("call.id").alias("id"),
        F.col("call.name").alias("name"),
        F.coalesce(canonical(F.col("call.arguments")), F.lit("null")).alias("arguments"),
        _valid(F.col("call.name"), arguments, schemas).alias("valid"),
        needs.alias("needs"),
    )
    calls = keep(calls)
    named = calls.where("conv_id is not null and id is not null")
    named = cut(named.groupBy("conv_id", "id").agg(F.min_by("needs", F.struct("turn", "place")).alias("needs")))
    depths = _depths(named)
    results = rows.where("result.tool_call_id is not null and conv_id is not null")
    answered = keep(results.select("conv_id", F.col("result.tool_call_id").alias("id")).distinct().withColumn("linked", F.lit(1)))

    by_call = calls.join(depths.hint("shuffle_hash"), ["conv_id", "id"], "left").join(answered.hint("shuffle_hash"), ["conv_id", "id"], "left")
    line = F.struct(
        F.coalesce("depth", F.lit(1 << 30)).alias("depth"), "place",
        F.concat(F.lit('{"arguments":'), F.col("arguments"), F.lit(',"id":'), _quoted(F.col("id")), F.lit(',"name":'), _quoted(F.col("name")), F.lit("}")).alias("json"),
    )
    per_message = by_call.groupBy("row").agg(
        F.count("*").alias("n_calls"),
        F.sum(F.coalesce("linked", F.lit(0))).alias("n_linked"),
        F.sum(F.col("valid").cast("int")).alias("n_valid"),
        F.max("depth").alias("call_depth"),
        F.array_sort(F.collect_list(line)).alias("lines"),
    )  # the calls of one message
    per_message = cut(per_message)
    of_result = results.select("row", "conv_id", F.col("result.tool_call_id").alias("id")).join(depths.withColumn("has_call", F.lit(1)), ["conv_id", "id"], "left")
    of_result = cut(of_result.select("row", F.col("depth").alias("result_depth"), "has_call"))

    whole = rows.join(per_message, "row", "left").join(of_result, "row", "left")
    kind = F.when(F.col("n_calls").isNotNull(), "calls").when(F.col("result.tool_call_id").isNotNull(), "result").otherwise("text")
    head = F.concat(F.lit(',"role":'), _quoted(F.col("role")))
    message = (
        F.when(kind == "calls", F.concat(F.lit('{"content":""'), head, F.lit(',"tool_calls":['), F.array_join(F.transform("lines", lambda x: x["json"]), ","), F.lit("]}")))
        .when(kind == "result", F.concat(F.lit('{"content":'), _quoted(F.coalesce("result.content", F.lit(""))), head, F.lit(',"tool_call_id":'), _quoted(F.col("result.tool_call_id")), F.lit("}")))
        .otherwise(F.concat(F.lit('{"content":'), _quoted(F.col("text")), head, F.lit("}")))
    )
    depth = F.when(kind == "calls", F.col("call_depth")).when(kind == "result", F.col("result_depth")).otherwise(F.lit(-1))
    return whole.select(
        "conv_id", "turn", "role",
        kind.alias("kind"),
        depth.cast("int").alias("depth"),
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_linked", "has_call", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("n_valid", F.lit(0)).cast("long").alias("n_valid"),
        message.alias("message"),
    )


def _quoted(text: Column) -> Column:
    """A text as a JSON string; null as null."""
    return F.when(text.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.struct(text.alias("s"))), r'(?s)^\{"s":(.*)\}$', 1))
