"""Operator 8, tool-call linking: calls and results are hash-joined by
identifier, ordered topologically, checked against argument schemas, and
written as canonical JSON.  All of it is DataFrame operations.

A conversation is rows (conv_id, turn, role, text).  A text may hold calls as
``<tool_call>{"id", "name", "arguments", "after": [ids]}</tool_call>``; a row of
role ``tool`` is a result ``{"tool_call_id", "content"}``.  ``after`` names calls
of the same conversation that must come first.

The result has one row per message, call and result: kind, call_id, name, level
(calls: 0 without dependencies, else one more than the deepest of them; results:
that of their call), linked (a call has a result, a result has a call), errors
(sorted, joined by ``;``), valid (no errors) and json: keys sorted, no blanks.
Reading by (conv_id, level, turn, part) is a topological order, and no row needs
its neighbours, so one conversation may be of any size.

Defined cases: a null text is an empty message; JSON that doesn't parse, or
repeats a key, gives the error ``json`` and a null call_id; of calls with one id
the first (turn, part) counts and others get ``duplicate id``; unknown
dependencies get an error and don't delay; calls on a cycle, or behind one, have
no level; repeated rows each give rows; null ids of conversations match nothing;
other columns are ignored.  Ordering takes as many rounds as the longest chain of
dependencies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import table, written
from cartwheel.llm.registry import query

CALL = r"(?s)<tool_call>(.*?)</tool_call>"
TYPES = {"string": "^STRING", "integer": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\\([0-9]+,0\\))", "boolean": "^BOOLEAN", "object": "^OBJECT", "array": "^ARRAY",
         "number": "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"}


@dataclass(frozen=True)
class Tool:
    """A tool's name and its arguments: name to (type, required)."""

    name: str
    arguments: dict[str, tuple[str, bool]] = field(default_factory=dict)


TOOLS = (Tool("reply", {"prompt": ("string", True), "turn": ("integer", True)}),
         Tool("configure", {"instructions": ("string", True)}))


def _argument_errors(tools: tuple[Tool, ...]) -> Column:
    """Errors of ``args`` (map of variants) under the schema of tool ``name``."""
    chain = F.array(F.lit("unknown tool"))
    for t in tools:
        checks = []
        for a, (kind, required) in t.arguments.items():
            there = F.coalesce(F.map_contains_key("args", F.lit(a)), F.lit(False))
            is_kind = F.expr(f"schema_of_variant(args['{a}'])").rlike(TYPES[kind])
            if required:
                checks.append(F.when(~there, F.lit(f"missing {a}")))
            checks.append(F.when(there & ~F.coalesce(is_kind, F.lit(False)), F.lit(f"type {a}")))
        extra = F.transform(F.array_except(F.map_keys("args"), F.array(*map(F.lit, t.arguments)).cast("array<string>")), lambda x: F.concat(F.lit("unknown "), x))
        known = F.concat(F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"), extra)
        chain = F.when(F.col("name") == t.name, known).otherwise(chain)
    return F.when(F.col("args").isNull(), F.array(F.lit("arguments"))).otherwise(chain)


def _calls(messages: DataFrame, tools: tuple[Tool, ...]) -> DataFrame:
    found = messages.where("role is null or role <> 'tool'").select(
        "conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(CALL), 1)).alias("part", "raw"))
    v = found.withColumn("v", F.expr("try_parse_json(raw)"))
    v = v.select("conv_id", "turn", (F.col("part") + 1).alias("part"),
                 F.expr("try_variant_get(v, '$.id', 'string')").alias("call_id"), F.expr("try_variant_get(v, '$.name', 'string')").alias("name"),
                 F.expr("try_variant_get(v, '$.arguments', 'map<string,variant>')").alias("args"),
                 F.expr("try_variant_get(v, '$.arguments', 'variant')").alias("arguments"),
                 F.expr("array_distinct(coalesce(try_variant_get(v, '$.after', 'array<string>'), array()))").alias("after"),
                 F.when(F.col("v").isNull(), F.array(F.lit("json"))).alias("broken"))
    errors = F.coalesce("broken", F.concat(F.when(F.col("call_id").isNull(), F.array(F.lit("no id"))).otherwise(F.array().cast("array<string>")),
                                           _argument_errors(tools)))
    return v.select("conv_id", "turn", "part", "call_id", "name", "arguments", "after", errors.alias("errors"))


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, unknown) of the calls that count: each round
    settles those whose dependencies are settled."""
    deps = written(calls.where("size(after) > 0").select("conv_id", "call_id", F.explode("after").alias("dep")))
    if deps.isEmpty():
        return calls.select("conv_id", "call_id", F.lit(0).alias("level"), F.lit(False).alias("unknown"))
    names = calls.select("conv_id", F.col("call_id").alias("dep"), F.lit(True).alias("there"))
    deps = written(deps.join(names, ["conv_id", "dep"], "left"))
    unknown = deps.where("there is null").select("conv_id", "call_id", F.lit(True).alias("unknown")).distinct()
    need = written(deps.where("there").groupBy("conv_id", "call_id").agg(F.count("*").alias("n")))
    level = written(calls.select("conv_id", "call_id").join(need, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0)))
    fresh = level
    got = None  # settled dependencies of the calls that wait
    while not fresh.isEmpty():
        step = (deps.where("there").join(fresh.withColumnRenamed("call_id", "dep"), ["conv_id", "dep"])
                .groupBy("conv_id", "call_id").agg(F.count("*").alias("g"), F.max("level").alias("top")))
        got = step if got is None else got.unionByName(step).groupBy("conv_id", "call_id").agg(F.sum("g").alias("g"), F.max("top").alias("top"))
        got = written(got)
        ready = got.join(need, ["conv_id", "call_id"]).where("g = n")
        fresh = written(ready.select("conv_id", "call_id", (F.col("top") + 1).alias("level")))
        got = got.join(fresh, ["conv_id", "call_id"], "left_anti")
        level = level.unionByName(fresh)
    return (calls.select("conv_id", "call_id").join(level, ["conv_id", "call_id"], "left").join(unknown, ["conv_id", "call_id"], "left")
            .select("conv_id", "call_id", "level", F.coalesce("unknown", F.lit(False)).alias("unknown")))


def link(messages: DataFrame, tools: tuple[Tool, ...] = TOOLS) -> DataFrame:
    """Rows for all messages, calls and results; see the module's text."""
    rows = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    calls = written(_calls(rows, tools))
    results = rows.where("role = 'tool'").withColumn("v", F.expr("try_parse_json(text)"))
    results = written(results.select("conv_id", "turn", F.lit(0).alias("part"), F.expr("try_variant_get(v, '$.tool_call_id', 'string')").alias("call_id"),
                                     F.expr("try_variant_get(v, '$.content', 'variant')").alias("content")))
    named = calls.where("call_id is not null and conv_id is not null")
    first = written(named.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "part", "after")).alias("f"), F.count("*").alias("copies"))
                    .select("conv_id", "call_id", "f.turn", "f.part", "f.after", "copies"))
    levels = written(_levels(first))
    answered = written(results.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.lit(True).alias("answered")))
    known = written(levels.join(first.select("conv_id", "call_id", F.col("turn").alias("t0"), F.col("part").alias("p0")), ["conv_id", "call_id"])
                    .join(answered, ["conv_id", "call_id"], "left"))
    c = calls.join(known, ["conv_id", "call_id"], "left")
    is_first = F.col("t0").isNotNull() & F.col("turn").eqNullSafe(F.col("t0")) & (F.col("part") == F.col("p0"))
    more = F.array_compact(F.array(F.when(F.col("t0").isNotNull() & ~is_first, F.lit("duplicate id")), F.when(F.col("unknown"), F.lit("unknown dependency")),
                                   F.when(F.col("t0").isNotNull() & F.col("level").isNull(), F.lit("cycle"))))
    linked = F.coalesce(F.col("answered"), F.lit(False)) & is_first
    call_json = F.to_json(F.struct(F.col("arguments"), F.col("call_id").alias("id"), "name"))
    shape = lambda kind, errors, linked, json, part="part", call="call_id", name="name", level="level": [
        "conv_id", "turn", F.col(part).cast("int").alias("part"), F.lit(kind).alias("kind"), F.col(call).alias("call_id"), F.col(name).alias("name"),
        F.col(level).cast("int").alias("level"), linked.alias("linked"), F.array_join(F.array_sort(errors), ";").alias("errors"),
        (F.size(errors) == 0).alias("valid"), json.alias("json")]
    out_calls = c.select(*shape("call", F.concat("errors", more), linked, F.when(F.col("arguments").isNotNull() | F.col("call_id").isNotNull(), call_json)))
    r = results.join(known.select("conv_id", "call_id", "level", F.lit(True).alias("there")), ["conv_id", "call_id"], "left").withColumn("name", F.lit(None).cast("string"))
    there = F.coalesce("there", F.lit(False))
    r_errors = F.array_compact(F.array(F.when(F.col("call_id").isNull(), F.lit("json")), F.when(F.col("call_id").isNotNull() & ~there, F.lit("no call"))))
    out_results = r.select(*shape("result", r_errors, there, F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id")))))
    m = rows.where("role is null or role <> 'tool'").select(
        "conv_id", "turn", F.lit(0).alias("part"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("int").alias("level"), F.to_json(F.struct(F.trim(F.regexp_replace("text", CALL, "")).alias("content"), "role")).alias("j"))
    out_messages = m.select(*shape("message", F.array().cast("array<string>"), F.lit(False), F.col("j")))
    return out_messages.unionByName(out_calls).unionByName(out_results)


def as_tool_traffic(conversations: DataFrame) -> DataFrame:
    """Plain conversations as tool traffic: a system text configures the model,
    each user text calls it after that, and the assistant text that follows is
    the call's result."""
    call_id = F.concat_ws(":", "conv_id", "turn")
    system = conversations.where("role = 'system'").groupBy("conv_id").agg(F.min("turn").alias("t0"))
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).join(system, "conv_id", "left")
    wrap = lambda x: F.concat(F.lit("<tool_call>"), F.to_json(x), F.lit("</tool_call>"))
    after = F.when(F.col("t0").isNotNull(), F.array(F.concat_ws(":", "conv_id", "t0"))).otherwise(F.array().cast("array<string>"))
    text = (F.when(F.col("role") == "user", wrap(F.struct(call_id.alias("id"), F.lit("reply").alias("name"),
                                                          F.struct(F.col("turn"), F.col("text").alias("prompt")).alias("arguments"), after.alias("after"))))
            .when(F.col("role") == "system", wrap(F.struct(call_id.alias("id"), F.lit("configure").alias("name"), F.struct(F.col("text").alias("instructions")).alias("arguments"))))
            .when(F.col("role") == "assistant", F.to_json(F.struct(F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content"))))
            .otherwise(F.col("text")))
    return rows.select("conv_id", "turn", F.when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"), text.alias("text"))


OP8_SQL = """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, conv_id || ':' || turn AS id FROM conversations),
s AS (SELECT conv_id, min(turn) AS t0 FROM c WHERE role = 'system' GROUP BY 1),
asked AS (SELECT DISTINCT conv_id, conv_id || ':' || turn AS id FROM c WHERE role IN ('user', 'system')),
answers AS (SELECT DISTINCT conv_id || ':' || (turn - 1) AS id FROM c WHERE role = 'assistant')
SELECT conv_id, turn, 0 AS part, 'message' AS kind, NULL AS call_id, NULL AS name, NULL AS level, false AS linked, '' AS errors, true AS valid,
       '{"content":"","role":"' || role || '"}' AS json FROM c WHERE role IN ('user', 'system')
UNION ALL
SELECT c.conv_id, turn, 1, 'call', c.id, 'configure', 0, answers.id IS NOT NULL, '', true,
       to_json({'arguments': {'instructions': text}, 'id': c.id, 'name': 'configure'})::VARCHAR
FROM c LEFT JOIN answers ON c.id = answers.id WHERE role = 'system'
UNION ALL
SELECT c.conv_id, turn, 1, 'call', c.id, 'reply', CASE WHEN t0 IS NULL THEN 0 ELSE 1 END, answers.id IS NOT NULL, '', true,
       to_json({'arguments': {'prompt': text, 'turn': turn}, 'id': c.id, 'name': 'reply'})::VARCHAR
FROM c LEFT JOIN s USING (conv_id) LEFT JOIN answers ON c.id = answers.id WHERE role = 'user'
UNION ALL
SELECT c.conv_id, turn, 0, 'result', c.conv_id || ':' || (turn - 1), NULL,
       CASE WHEN a.id IS NULL THEN NULL WHEN t0 IS NULL OR t0 = turn - 1 THEN 0 ELSE 1 END, a.id IS NOT NULL,
       CASE WHEN a.id IS NULL THEN 'no call' ELSE '' END, a.id IS NOT NULL,
       to_json({'content': text, 'role': 'tool', 'tool_call_id': c.conv_id || ':' || (turn - 1)})::VARCHAR
FROM c LEFT JOIN s USING (conv_id) LEFT JOIN asked a ON a.id = c.conv_id || ':' || (turn - 1) WHERE role = 'assistant'"""


@query("op8_tool_calls", OP8_SQL)
def op8(spark, sf_dir):
    """All conversations as linked tool traffic."""
    return link(as_tool_traffic(table(spark, sf_dir, "conversations")))
