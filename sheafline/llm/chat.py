"""Chat formatting: tool calls linked to results, ordered, validated, and written as canonical JSON.

All of it is DataFrame functions. An assistant's message is either plain text or a JSON object with
``tool_calls`` (objects of id, name, arguments and, optionally, depends_on: ids of calls that go before)
and ``content``; a message of role ``tool`` is a JSON object with ``tool_call_id`` and ``content``. Other
members of these objects are kept. Calls and results of a conversation meet in a join on (conv_id, id).
Order is a key on each row, never a list of a conversation in one task: a row stands after all that it
depends on, otherwise in the given order. The keys come from doubled paths, so a chain of n calls takes
log2(n) rounds of joins, each written before the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch, drop

#: Of a tool's arguments: name -> (JSON type, required).
Schema = dict[str, tuple[str, bool]]

#: Spark's names of a variant's types, by JSON type.
_TYPES = {
    "string": "STRING.*",
    "integer": "BIGINT",
    "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
    "null": "VOID",
}


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no white space; null where the text isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def _errors(arguments: Column, tools: dict[str, Schema], name: Column) -> Column:
    """Sorted faults of a call's arguments (a variant) against the schema of its tool."""
    none = F.expr("cast(array() as array<string>)")
    kind = F.schema_of_variant(arguments)
    given = F.when(kind.startswith("OBJECT"), F.expr("try_cast(arguments as map<string, variant>)"))
    found = F.array(F.lit("unknown tool"))
    for tool in sorted(tools):
        schema = tools[tool]
        faults = [none]
        for arg in sorted(schema):
            type_, required = schema[arg]
            value = F.element_at(given, F.lit(arg))
            missing = ~F.map_contains_key(given, F.lit(arg))
            if required:
                faults.append(F.when(missing, F.array(F.lit(f"missing {arg}"))).otherwise(none))
            wrong = ~missing & ~F.coalesce(F.schema_of_variant(value), F.lit("VOID")).rlike(f"^{_TYPES[type_]}$")
            faults.append(F.when(wrong, F.array(F.lit(f"{arg} is not {type_}"))).otherwise(none))
        known = F.array(*[F.lit(a) for a in sorted(schema)]) if schema else none
        extra = F.transform(F.array_except(F.map_keys(given), known), lambda a: F.concat(F.lit("unexpected "), a))
        checked = F.when(given.isNull(), F.array(F.lit("arguments are not an object"))).otherwise(
            F.array_sort(F.concat(*faults, extra))
        )
        found = F.when(name == tool, checked).otherwise(found)
    return found


def link(messages: DataFrame, tools: dict[str, Schema] | None = None) -> DataFrame:
    """A row for each message and each call in it: conv_id long, turn long, item int (0: the message,
    from 1: its calls), kind string (message, call, result), call_id, name, order_turn long, level int,
    valid boolean, errors array<string>, json string (canonical).

    By (conv_id, order_turn, level, turn, item) the rows are in topological order: a result follows its
    call, a call those in depends_on. Errors: ``unknown tool``, faults of arguments, ``no result``, ``no
    call``, ``no id``, ``repeated id`` (an id counts where it comes first), ``unknown dependency``,
    ``cycle`` (also of calls that need one in a cycle). A null role or text counts as empty; null conv_id or
    turn stay null and link nothing. Text that is not such JSON is plain content: no object, a member given
    twice, tool_calls that are no array or hold other things than objects.

    json has sorted keys and no white space and holds every member of a call or a message, but for
    tool_calls, whose calls are rows; role is the row's, a call's type ``function``, and a missing content,
    arguments or name is empty text or null. Repeated rows return each. Other columns are not read; an
    empty table gives no rows.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "chat")
    none = F.expr("cast(array() as array<string>)")
    source = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    object_ = F.expr("try_cast(try_parse_json(text) as map<string, variant>)")
    parsed = (
        source.withColumn("whole", F.when(F.regexp_like("text", F.lit(r"^\s*\{")) & F.col("role").isin("assistant", "tool"), object_))
        .withColumn("calls", F.when(F.col("role") == "assistant", F.expr("try_cast(whole['tool_calls'] as array<variant>)")))
        .withColumn("calls", F.expr("transform(calls, c -> try_cast(c as map<string, variant>))"))
        .withColumn("calls", F.when((F.size("calls") > 0) & F.forall("calls", lambda c: c.isNotNull()), F.col("calls")))
        .withColumn("kind", F.when(F.col("role") == "tool", "result").otherwise("message"))
    )
    calls = (
        parsed.where("calls is not null")
        .select("conv_id", "turn", F.posexplode("calls").alias("at", "call"))
        .select(
            "conv_id",
            "turn",
            (F.col("at") + 1).alias("item"),
            F.expr("try_cast(call['id'] as string)").alias("call_id"),
            F.expr("try_cast(call['name'] as string)").alias("name"),
            F.expr("call['arguments']").alias("arguments"),
            F.coalesce(F.expr("try_cast(call['depends_on'] as array<string>)"), none).alias("needs"),
            "call",
        )
        .withColumn("errors", _errors(F.col("arguments"), tools or {}, F.col("name")))
        .withColumn("json", _object(F.col("call"), {"type": F.lit('"function"')}, {"id": F.lit("null"), "name": F.lit("null"), "arguments": F.lit("null")}))
        .drop("call", "arguments")
    )
    calls = scratch.table(calls)
    # Where an id comes first in its conversation: a partial aggregate, whatever a conversation holds.
    first = (
        calls.where("call_id is not null and conv_id is not null and turn is not null")
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "item")).alias("f"))
        .select("conv_id", "call_id", F.col("f.turn").alias("f_turn"), F.col("f.item").alias("f_item"))
    )
    levels = scratch.table(_levels(calls, first, scratch))
    results = parsed.where("kind = 'result'").withColumn("call_id", F.expr("try_cast(whole['tool_call_id'] as string)"))
    answered = results.where("call_id is not null").select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    own = (
        calls.join(first, ["conv_id", "call_id"], "left")
        .join(levels, ["conv_id", "call_id"], "left")
        .join(answered, ["conv_id", "call_id"], "left")
    )
    leads = (F.col("turn") == F.col("f_turn")) & (F.col("item") == F.col("f_item"))
    add = lambda when, what: F.when(when, F.array(F.lit(what))).otherwise(none)
    errors = F.array_sort(
        F.concat(
            "errors",
            add(F.col("call_id").isNull(), "no id"),
            add(~leads, "repeated id"),
            add(F.col("answered").isNull() & F.col("call_id").isNotNull(), "no result"),
            add(F.col("unknown"), "unknown dependency"),
            add(F.col("cycle"), "cycle"),
        )
    )
    told_calls = own.select(
        "conv_id",
        "turn",
        "item",
        F.lit("call").alias("kind"),
        "call_id",
        "name",
        F.coalesce("order_turn", "turn").alias("order_turn"),
        F.coalesce("level", F.lit(1)).alias("level"),
        errors.alias("errors"),
        "json",
    )
    told_results = (
        results.join(levels.withColumn("known", F.lit(True)), ["conv_id", "call_id"], "left")
        .select(
            "conv_id",
            "turn",
            F.lit(0).alias("item"),
            F.lit("result").alias("kind"),
            "call_id",
            F.lit(None).cast("string").alias("name"),
            F.greatest("turn", F.coalesce("order_turn", "turn")).alias("order_turn"),
            F.when(F.col("order_turn") >= F.col("turn"), F.col("level") + 1).otherwise(0).alias("level"),
            F.array_sort(
                F.concat(add(F.col("call_id").isNull(), "no id"), add(F.col("call_id").isNotNull() & F.col("known").isNull(), "no call"))
            ).alias("errors"),
            F.when(F.col("whole").isNotNull(), _object(F.col("whole"), {"role": _string(F.col("role"))}, {"content": F.lit("null")}))
            .otherwise(_plain())
            .alias("json"),
        )
    )
    told_messages = parsed.where("kind = 'message'").select(
        "conv_id",
        "turn",
        F.lit(0).alias("item"),
        "kind",
        F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("string").alias("name"),
        F.col("turn").alias("order_turn"),
        F.lit(0).alias("level"),
        none.alias("errors"),
        F.when(F.col("calls").isNotNull(), _object(F.col("whole"), {"role": _string(F.col("role")), "tool_calls": None}, {"content": F.lit('""')}))
        .otherwise(_plain())
        .alias("json"),
    )
    out = told_messages.union(told_results).union(told_calls)
    return out.select(
        "conv_id", "turn", "item", "kind", "call_id", "name", "order_turn", "level", (F.size("errors") == 0).alias("valid"), "errors", "json"
    )


def as_tool_dialogue(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: a dialogue of plain messages with tool calls put in by a rule, for tables
    that hold none.

    Each assistant's message becomes one of JSON with its text as content and one call, ``t`` and its turn, of
    ``look_up`` (``translate`` where the turn leaves 3 by 4) with the whole text as query; its limit is a
    text, not a number, where the turn leaves 1 by 8. In even conversations a call needs the one two turns
    before, in odd ones the one two turns after. Where the turn isn't divisible by 5 a result follows under
    the same turn. All other messages stay. Null turns get no call.
    """
    said = messages.select("conv_id", "turn", "role", "text")
    turn, calls = F.col("turn"), (F.col("role") == "assistant") & F.col("turn").isNotNull()
    near = F.concat(F.lit("t"), F.when(F.pmod("conv_id", F.lit(2)) == 0, turn - 2).otherwise(turn + 2).cast("string"))
    id_ = F.concat(F.lit("t"), turn.cast("string"))
    text = F.coalesce("text", F.lit(""))
    name = F.when(F.pmod(turn, F.lit(4)) == 3, "translate").otherwise("look_up")
    limit = F.when(F.pmod(turn, F.lit(8)) == 1, F.to_variant_object(F.array(F.lit("ten")))).otherwise(F.to_variant_object(F.array(F.lit(10))))
    call = F.struct(
        id_.alias("id"), name.alias("name"), F.struct(text.alias("query"), F.variant_get(limit, "$[0]", "variant").alias("limit")).alias("arguments"), F.array(near).alias("depends_on")
    )
    told = F.to_json(F.struct(text.alias("content"), F.array(call).alias("tool_calls")))
    asked = said.withColumn("text", F.when(calls, told).otherwise(F.col("text")))
    answer = F.to_json(F.struct(id_.alias("tool_call_id"), F.struct(F.length(text).alias("chars")).alias("content")))
    results = said.where(calls & (F.pmod(turn, F.lit(5)) != 0)).select("conv_id", "turn", F.lit("tool").alias("role"), answer.alias("text"))
    return asked.union(results)


def _string(text: Column) -> Column:
    """A JSON string; text is escaped by Spark's own writer."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("s"))), r"(?s)^\{\"s\":(.*)\}$", 1)


def _object(given: Column, own: dict[str, Column | None], least: dict[str, Column]) -> Column:
    """JSON of a map of variants with sorted keys. ``own``: members that stand in place of those of the same
    name, as JSON; None leaves one out. ``least``: members that are added where they are missing."""
    kept = F.filter(F.map_keys(given), lambda k: ~k.isin(*own))
    pairs = [F.transform(kept, lambda k: F.struct(k.alias("k"), F.to_json(F.element_at(given, k)).alias("j")))]
    more = lambda k, j: F.array(F.struct(F.lit(k).alias("k"), j.alias("j")))
    pairs += [more(k, j) for k, j in own.items() if j is not None]
    empty = F.expr("cast(array() as array<struct<k:string,j:string>>)")
    pairs += [F.when(F.map_contains_key(given, F.lit(k)), empty).otherwise(more(k, j)) for k, j in least.items()]
    written = F.transform(F.array_sort(F.concat(*pairs)), lambda p: F.concat(_string(p["k"]), F.lit(":"), p["j"]))
    return F.concat(F.lit("{"), F.array_join(written, ","), F.lit("}"))


def _plain() -> Column:
    return F.concat(F.lit('{"content":'), _string(F.col("text")), F.lit(',"role":'), _string(F.col("role")), F.lit("}"))


def _levels(calls: DataFrame, first: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, call_id, order_turn, level, unknown, cycle) of each id's first call.

    A call's place (order_turn, level) is (its own turn, 1), or, where what it needs stands in that turn or
    later, a level after the latest of that. Along a path of needs that is a function of the place at its end,
    told by three numbers: the path's latest turn ``top``, the level ``rise`` to which the path comes from
    where it first reaches that turn, and its length ``steps``; a place in a later turn than ``top`` stays in it
    and rises by ``steps``. Two such functions joined end to end, and the greater of two, are such functions.
    So each round joins the paths end to end, which doubles their length, and ends those that have
    nothing more to need. What still needs something after log2(calls) rounds needs a cycle; it keeps its
    own turn.
    """
    keys = ["conv_id", "call_id"]
    lead = calls.join(first, keys).where("turn = f_turn and item = f_item").groupBy(*keys).agg(F.min("turn").alias("turn"), F.first("needs").alias("needs"))
    lead = scratch.table(lead)
    needs = scratch.table(
        lead.select(*keys, "turn", F.explode(F.array_distinct("needs")).alias("need"))
        .join(first.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("is")), ["conv_id", "need"], "left")
    )
    unknown = needs.where("is is null").select(*keys).distinct().withColumn("unknown", F.lit(True))
    place = lead.select(*keys, F.struct(F.col("turn").alias("order_turn"), F.lit(1).alias("level")).alias("place"))
    paths = needs.where("is is not null").select(*keys, "need", F.col("turn").alias("top"), F.lit(1).alias("rise"), F.lit(1).alias("steps"))
    paths, at = scratch.write(paths)
    place_at = None
    most = paths.select(*keys).distinct().groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    rounds, left = most.bit_length() + 1, most
    while left and rounds:
        rounds -= 1
        ends = place.select("conv_id", F.col("call_id").alias("need"), F.col("place").alias("end"))
        told = paths.join(ends, ["conv_id", "need"])
        later = F.col("end.order_turn") >= F.col("top")
        moved = told.select(
            *keys,
            F.struct(
                F.greatest("end.order_turn", "top").alias("order_turn"),
                F.when(later, F.col("end.level") + F.col("steps")).otherwise(F.col("rise")).alias("level"),
            ).alias("place"),
        )
        place, new_at = scratch.write(place.union(moved).groupBy(*keys).agg(F.max("place").alias("place")))
        if place_at:
            drop(scratch.spark, place_at)
        place_at = new_at
        # ``more`` is the part of a path that is farther off.
        more = paths.select("conv_id", F.col("call_id").alias("need"), F.col("need").alias("beyond"), F.col("top").alias("m_top"), F.col("rise").alias("m_rise"), F.col("steps").alias("m_steps"))
        joined = paths.join(more, ["conv_id", "need"]).select(
            *keys,
            F.col("beyond").alias("need"),
            F.struct(
                F.greatest("top", "m_top").alias("top"),
                F.when(F.col("m_top") >= F.col("top"), F.col("m_rise") + F.col("steps")).otherwise(F.col("rise")).alias("rise"),
            ).alias("high"),
            (F.col("steps") + F.col("m_steps")).alias("steps"),
        )
        joined = joined.groupBy(*keys, "need").agg(F.max("high").alias("high"), F.max("steps").alias("steps"))
        grown, grown_at = scratch.write(joined.select(*keys, "need", "high.top", "high.rise", "steps"))
        drop(scratch.spark, at)
        paths, at = grown, grown_at
        left = 0 if paths.isEmpty() else 1
    cyclic = paths.select(*keys).distinct().withColumn("cycle", F.lit(True))
    cycle = F.coalesce("cycle", F.lit(False))
    return (
        place.join(lead.select(*keys, "turn"), keys)
        .join(unknown, keys, "left")
        .join(cyclic, keys, "left")
        .select(
            *keys,
            F.when(cycle, F.col("turn")).otherwise(F.col("place.order_turn")).alias("order_turn"),
            F.when(cycle, F.lit(1)).otherwise(F.col("place.level")).alias("level"),
            F.coalesce("unknown", F.lit(False)).alias("unknown"),
            cycle.alias("cycle"),
        )
    )
