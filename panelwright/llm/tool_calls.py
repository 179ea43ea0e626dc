"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types that an argument may have, by JSON schema name, as Spark's variant types.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL.*|DOUBLE", "boolean": "BOOLEAN",
         "array": "ARRAY<.*>", "object": "OBJECT<.*>"}
Schema = Mapping[str, str]


def arguments_valid(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """Whether the arguments are a JSON object with just the fields of the tool's schema, each of its type."""
    parsed = F.try_parse_json(arguments)
    checks = F.lit(False)
    for tool, schema in schemas.items():
        kinds = [F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant")).rlike(f"^({TYPES[kind]})$")
                 for key, kind in schema.items()]
        fits = F.size(F.map_keys(F.try_variant_get(parsed, "$", "map<string,variant>"))) == len(schema)
        for k in kinds:
            fits = fits & k
        checks = F.when(name == tool, F.coalesce(fits, F.lit(False))).otherwise(checks)
    return checks


def quoted(text: Column) -> Column:
    """A string as JSON; null as null."""
    whole = F.to_json(F.struct(text.alias("v")))             # {"v":...}
    return F.when(text.isNull(), "null").otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def canonical(fields: Mapping[str, Column]) -> Column:
    """A JSON object with sorted keys and no space; the values are JSON already."""
    parts = []
    for k, (key, value) in enumerate(sorted(fields.items())):
        parts += [F.lit(("," if k else "{") + f'"{key}":'), value]
    return F.concat(*parts, F.lit("}"))


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and no space; null when it does not parse. Variants hold keys in sorted order."""
    return F.to_json(F.try_parse_json(text))


def linked_messages(messages: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """Messages with the state of their call, their place in the conversation and a JSON line.

    ``messages``: conv_id, turn, kind (``call``, ``result`` or ``message``), call_id, name, arguments (JSON text of calls),
    content (text of others). Calls and results meet by a hash join on (conv_id, call_id); of several calls or results
    with one id the first by turn counts and the others are not linked. Adds ``linked``, ``valid`` (calls: arguments fit
    the schema; results: their call is valid) and ``place``, ``step``: sorted by (place, step, turn), calls come before
    their results, results directly after a call that the log has later, and all else keeps its order; every link
    being a call and its result, that order is topological. ``line`` is canonical JSON.

    Null conv_id or call_id are never linked; unparsable arguments are invalid and written as null; repeated rows are
    all returned; an empty table gives an empty result. Only ids and turns are shuffled, pre-aggregated by id, so a
    conversation of any length is never gathered in one task; sort by the order columns to write files.
    """
    key = ["conv_id", "call_id"]
    known = messages.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    good = arguments_valid(F.col("name"), F.col("arguments"), schemas)
    ends = known.groupBy(*key).agg(
        F.min(F.when(F.col("kind") == "call", F.struct("turn", good.alias("valid")))).alias("__call"),
        F.min(F.when(F.col("kind") == "result", F.col("turn"))).alias("__result"),
    ).where(F.col("__call").isNotNull() | F.col("__result").isNotNull())
    rows = messages.join(ends, key, "left")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    own = F.when(call, F.col("turn") == F.col("__call.turn")).when(result, F.col("turn") == F.col("__result"))
    linked = F.coalesce(own & F.col("__call").isNotNull() & F.col("__result").isNotNull(), F.lit(False))
    late = result & linked & (F.col("__call.turn") > F.col("turn"))
    line = F.when(call, canonical({
        "arguments": F.coalesce(canonical_json(F.col("arguments")), F.lit("null")), "id": quoted(F.col("call_id")),
        "name": quoted(F.col("name")), "role": F.lit('"call"')})
    ).when(result, canonical({
        "content": quoted(F.col("content")), "id": quoted(F.col("call_id")), "role": F.lit('"result"')})
    ).otherwise(canonical({"content": quoted(F.col("content")), "role": F.lit('"message"')}))
    return rows.select(
        "conv_id", "turn", "kind", "call_id", linked.alias("linked"),
        F.when(call, good).when(result & linked, F.col("__call.valid")).alias("valid"),
        F.when(late, F.col("__call.turn")).otherwise(F.col("turn")).alias("place"),
        F.when(late, 1).otherwise(0).alias("step"), line.alias("line"),
    )


# The conversations table has no tool messages; its turns are read as an exchange with one tool.
REPLY_SCHEMA = {"chars": "integer", "prompt": "string"}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """User turns as calls of ``reply``, assistant turns as results of the turn before, other turns as messages."""
    call, result = F.col("role") == "user", F.col("role") == "assistant"
    asked = F.when(call, F.col("turn")).when(result, F.col("turn") - 1)
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.length("text").alias("chars")))
    return conversations.select(
        "conv_id", "turn",
        F.when(call, "call").when(result, "result").otherwise("message").alias("kind"),
        F.concat_ws(":", F.col("conv_id").cast("string"), asked.cast("string")).alias("__id"), asked.alias("__asked"),
        F.when(call, "reply").alias("name"), F.when(call, arguments).alias("arguments"), F.col("text").alias("content"),
    ).withColumn("call_id", F.when(F.col("__asked").isNotNull() & F.col("conv_id").isNotNull(), F.col("__id"))).drop(
        "__id", "__asked")
