"""Tool-call linking, in DataFrame functions alone.

Messages are rows (conv_id, turn, role, text). A call is an element of ``tool_calls`` in an assistant
message ``{"tool_calls": [{"id", "name", "arguments": {...}}]}``; a result is a tool message
``{"tool_call_id", "content"}``. Calls and results of a conversation are joined by identifier (a hash
join on conversation and identifier, so a very long conversation spreads over all tasks); of several
results the earliest is taken and all are counted. A string ``${id}`` in the arguments makes a call
depend on another call of its conversation; levels order the calls topologically: 0 without
dependencies, else one more than the highest level among them. Calls that need one other call form
paths, which double in length each round of joins; only calls that need several take a round each. A ``${id}`` that names no call of the conversation orders nothing and
is an error of the call. Arguments are validated against the tool's schema and each linked call is
serialised as canonical JSON: keys sorted, no white space, numbers as parsed.

Messages with a null or unreadable text, or without an identifier, hold no call and no result. Calls of a
null conversation are returned but linked with nothing. Status of a call: ``ok``, ``invalid``
(arguments), ``cyclic`` (level null) or ``no result``, the first that applies of cyclic, invalid, no
result. A result without a call gives a row with status ``orphan``. Repeated messages are one message.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import written

#: tool -> parameter -> (JSON type, required)
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN",
          "array": "ARRAY<.*", "object": "OBJECT<.*"}


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Array of messages; empty for valid arguments."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    verdict = F.array(F.lit("unknown tool"))
    for tool in sorted(schemas):
        checks = []
        for parameter, (kind, required) in sorted(schemas[tool].items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$['{parameter}']", "variant"))
            present = F.array_contains(keys, parameter)
            checks.append(F.when(~present, F.lit(f"missing {parameter}") if required else F.lit(None))
                          .when(~F.coalesce(found.rlike(f"^{_TYPES[kind]}$"), F.lit(False)), F.lit(f"type of {parameter}")))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(p) for p in schemas[tool]])),
                            lambda k: F.concat(F.lit("unexpected "), k))
        own = F.concat(F.array_compact(F.array(*checks)), extra)
        verdict = F.when(name == tool, own).otherwise(verdict)
    return F.when(keys.isNull() | value.isNull(), F.array(F.lit("arguments are no object"))).otherwise(verdict)


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, position, call_id, name, arguments) of all calls."""
    shape = "tool_calls array<struct<id:string,name:string,arguments:string>>"
    said = messages.filter((F.col("role") == "assistant") & F.col("text").contains('"tool_calls"')).select(
        "conv_id", "turn", F.from_json("text", shape)["tool_calls"].alias("calls")).distinct()
    return said.select("conv_id", "turn", F.posexplode("calls").alias("position", "c")).filter(
        "c.id is not null").select("conv_id", "turn", F.col("position").cast("long").alias("position"),
                                   F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
                                   F.col("c.arguments").alias("arguments"))


def results_of(messages: DataFrame) -> DataFrame:
    """(conv_id, call_id, n_results, result): the earliest result of each identifier and their number."""
    said = messages.filter(F.col("role") == "tool").select(
        "conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("r")).filter(
        "r.tool_call_id is not null").distinct()
    return said.groupBy("conv_id", F.col("r.tool_call_id").alias("call_id")).agg(
        F.count(F.lit(1)).alias("n_results"),
        F.min(F.struct(F.col("turn"), F.col("r.content").alias("content")))["content"].alias("result"))


def _needs(arguments: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(arguments, F.lit(r"\$\{([^}\"]+)\}"), F.lit(1)))


def unresolved(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, missing): identifiers that the arguments refer to and that no call of the conversation has."""
    key = ["conv_id", "call_id"]
    wanted = calls.filter("conv_id is not null").select(*key, F.explode(_needs("arguments")).alias("needs")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("needs")).distinct()
    return wanted.join(known, ["conv_id", "needs"], "left_anti").groupBy(*key).agg(
        F.collect_list("needs").alias("missing"))


def _path_ends(needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, end, steps, closed) of the calls that need one other call.

    ``end`` is the first call of the path of needs that does not need exactly one, ``steps`` calls away.
    A round lets every open path go on by that of the call it has come to, so paths double. As long as any
    open path has an end, one as far away as the last round has reached closes in the next; a round that closes none
    leaves those that run into a cycle of such calls, which stay open.
    """
    key = ["conv_id", "call_id"]
    single = needs.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("needs").alias("end")).filter("n = 1").drop("n")
    passed = single.select("conv_id", F.col("call_id").alias("end"), F.lit(False).alias("closed"))
    paths = written(single.withColumn("steps", F.lit(1).cast("long")).join(passed, ["conv_id", "end"], "left").select(
        *key, "end", "steps", F.coalesce("closed", F.lit(True)).alias("closed")), "chat-paths")
    still = paths.filter("not closed").count()
    while still:
        following = paths.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("next"),
                                 F.col("steps").alias("more"), F.col("closed").alias("ends"))
        before, paths = still, written(paths.filter("closed").unionByName(
            paths.filter("not closed").join(following, ["conv_id", "end"]).select(
                *key, F.col("next").alias("end"), (F.col("steps") + F.col("more")).alias("steps"),
                F.col("ends").alias("closed"))), "chat-paths")
        still = paths.filter("not closed").count()
        if still == before:
            break
    return paths.withColumn("steps", F.when(F.col("closed"), F.col("steps")))


def _joint_levels(needs: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that need two or more others, where no cycle is in the way.

    Every need is replaced by the end of its path, so a round solves the calls whose needs end in calls
    without needs or in solved ones: there are as many rounds as such calls follow each other.
    """
    key = ["conv_id", "call_id"]
    joint = needs.join(needs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), key)
    ahead = paths.select("conv_id", F.col("call_id").alias("needs"), "end", "steps", F.lit(True).alias("through"))
    rest = joint.join(ahead, ["conv_id", "needs"], "left").select(
        *key, F.when(F.col("through"), F.col("end")).otherwise(F.col("needs")).alias("end"),
        (F.when(F.col("through"), F.col("steps")).otherwise(F.lit(0)) + 1).alias("steps"))
    needing = needs.select("conv_id", F.col("call_id").alias("end"), F.lit(True).alias("later")).distinct()
    # the level that a need asks for; null until its end is solved, and for good where its path is open
    rest = written(rest.join(needing, ["conv_id", "end"], "left").select(
        *key, "end", "steps", F.when(F.col("later").isNull(), F.col("steps")).alias("asked")), "chat-joint")
    solved = None
    while True:
        ready = written(rest.groupBy(*key).agg(F.max("asked").alias("level"), F.count("asked").alias("known"),
                                               F.count(F.lit(1)).alias("n")).filter("known = n").select(*key, "level"),
                        "chat-ready")
        if ready.isEmpty():
            return ready if solved is None else solved
        solved = ready if solved is None else solved.unionByName(ready)
        found = ready.select("conv_id", F.col("call_id").alias("end"), "level")
        rest = written(rest.join(ready.select(*key), key, "left_anti").join(found, ["conv_id", "end"], "left").select(
            *key, "end", "steps", F.coalesce("asked", F.col("level") + F.col("steps")).alias("asked")), "chat-joint")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of each call identifier; ``level`` is null within and behind a cycle."""
    key = ["conv_id", "call_id"]
    wanted = calls.filter("conv_id is not null").select(*key, F.explode_outer(_needs("arguments")).alias("needs")).distinct()
    known = wanted.select(*key).distinct()
    needs = written(wanted.filter("needs is not null").join(
        known.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"]), "chat-needs")
    paths = _path_ends(needs)
    joint = _joint_levels(needs, paths)
    several = needs.select(*key).distinct()
    at_end = paths.join(joint.select("conv_id", F.col("call_id").alias("end"), "level"), ["conv_id", "end"], "left").join(
        several.select("conv_id", F.col("call_id").alias("end"), F.lit(True).alias("later")), ["conv_id", "end"], "left")
    one = at_end.select(*key, (F.when(F.col("later"), F.col("level")).otherwise(F.lit(0)) + F.col("steps")).alias("level"))
    first = known.join(several, key, "left_anti").withColumn("level", F.lit(0).cast("long"))
    return known.join(first.unionByName(one).unionByName(joint), key, "left")


def canonical(name: Column, call_id: Column, arguments: Column, result: Column) -> Column:
    """Canonical JSON of a linked call: keys in order, no white space."""
    text = lambda c: F.regexp_replace(F.regexp_replace(  # noqa: E731  a JSON string of c
        F.to_json(F.struct(c.alias("x"))), r'^\{"x":', ""), r"\}$", "")
    part = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(text(c))
    return F.concat(F.lit('{"arguments":'), F.coalesce(F.to_json(F.try_parse_json(arguments)), F.lit("null")),
                    F.lit(',"id":'), part(call_id), F.lit(',"name":'), part(name), F.lit(',"result":'), part(result),
                    F.lit("}"))


def link_calls(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """One row for each call, and for each result without one: (conv_id, turn, position, call_id, name,
    level, status, errors, n_results, canonical)."""
    calls = written(calls_of(messages), "chat-calls")
    results = written(results_of(messages), "chat-results")
    key = ["conv_id", "call_id"]
    linked = calls.join(results.hint("shuffle_hash"), key, "left").join(
        levels(calls).withColumn("ordered", F.lit(True)), key, "left").join(unresolved(calls), key, "left")
    own, none = _needs("arguments"), F.expr("cast(array() as array<string>)")
    missing = F.when(F.col("conv_id").isNull(), own).otherwise(F.array_intersect(own, F.coalesce("missing", none)))
    errors = F.concat(argument_errors(F.col("name"), F.col("arguments"), schemas), F.transform(
        F.coalesce(missing, none), lambda x: F.concat(F.lit("unresolved ${"), x, F.lit("}"))))
    rows = linked.withColumn("errors", errors).select(
        "conv_id", "turn", "position", "call_id", "name", "level",
        F.when(F.col("ordered") & F.col("level").isNull(), "cyclic").when(F.size("errors") > 0, "invalid")
        .when(F.col("n_results").isNull(), "no result").otherwise("ok").alias("status"), "errors",
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        canonical(F.col("name"), F.col("call_id"), F.col("arguments"), F.col("result")).alias("canonical"))
    alone = results.join(calls.select(*key).distinct(), key, "left_anti")
    nothing = F.lit(None).cast("string")
    orphans = alone.select(
        "conv_id", F.lit(None).cast(calls.schema["turn"].dataType).alias("turn"), F.lit(None).cast("long").alias("position"),
        "call_id", nothing.alias("name"), F.lit(None).cast("long").alias("level"), F.lit("orphan").alias("status"),
        F.expr("cast(array() as array<string>)").alias("errors"), "n_results",
        canonical(nothing, F.col("call_id"), nothing, F.col("result")).alias("canonical"))
    return rows.unionByName(orphans)
