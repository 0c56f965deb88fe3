"""Queries over model answers: schemas, comparison, usage, attempts, provider bodies, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.functions import identity, jsonschema, prompts
from sheafline.operators import answers
from sheafline.plans import schema as S

_SCHEMA = {
    "type": "object",
    "required": ["k", "name"],
    "properties": {"k": {"type": ["integer", "null"], "enum": [1, 2, 3, None]}, "name": {"type": "string"}, "tags": {"type": "array", "minItems": 2, "items": {"type": "string"}}},
    "additionalProperties": False,
}


@query("""
WITH a AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, event_id % 6 AS shape FROM events)
SELECT event_id, CASE shape WHEN 0 THEN '' WHEN 1 THEN '$: required property ''name'' is missing' || CASE WHEN k IN (1, 2, 3) THEN '' ELSE '; $.k: ' || k || ' is not one of [1, 2, 3, None]' END
   WHEN 2 THEN '$.k: expected integer or null, got string; $: property ''z'' is not allowed by the schema' WHEN 3 THEN '$: expected object, got array'
   WHEN 4 THEN '$.tags: expected at least 2 items, got 1; $.tags[0]: expected string, got integer' ELSE '$.k: expected integer or null, got boolean; $.name: expected string, got null' END AS violations
FROM a
""")
def json_schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers against a schema: each way in which one violates it, with its path."""
    k, name, event = F.get_json_object("props", "$.k"), F.col("event_type"), F.col("event_id")
    text = (
        F.when(event % 6 == 0, F.concat(F.lit('{"k": null, "name": "'), name, F.lit('", "tags": ["a", "b"]}')))
        .when(event % 6 == 1, F.concat(F.lit('{"k": '), k, F.lit("}")))
        .when(event % 6 == 2, F.concat(F.lit('{"z": 1, "name": "", "k": "'), k, F.lit('"}')))
        .when(event % 6 == 3, F.concat(F.lit("["), k, F.lit("]")))
        .when(event % 6 == 4, F.lit('{"k": 1, "name": "n", "tags": [7]}'))
        .otherwise(F.lit('{"k": true, "name": null}'))
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(text).alias("value"))
    return rows.select("event_id", F.array_join(jsonschema.violations(F.col("value"), _SCHEMA), "; ").alias("violations"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '' ELSE sha256('{"a":[1,2],"n":' || turn || '}') END AS value_sha256,
  CASE WHEN turn % 4 = 3 THEN 'INVALID_JSON: ' || substr(text, 1, 500) ELSE '' END AS error
FROM conversations
""")
def parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers bare, in a fence or padded are parsed; prose isn't JSON."""
    body = F.concat(F.lit('{"n": '), F.col("turn").cast("string"), F.lit(', "a": [1, 2]}'))
    raw = (
        F.when(F.col("turn") % 4 == 0, body)
        .when(F.col("turn") % 4 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(F.col("turn") % 4 == 2, F.concat(F.lit("\n  "), body, F.lit(" \u00a0")))
        .otherwise(F.col("text"))
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", prompts.parse_answer(raw).alias("a"))
    return rows.select(
        "conv_id", "turn", F.coalesce(identity.digest(F.to_json("a.value")), F.lit("")).alias("value_sha256"), F.coalesce("a.error", F.lit("")).alias("error")
    )


@query("""
WITH l AS (SELECT c_custkey AS id, 'nation' AS field, CAST(c_nationkey AS VARCHAR) AS v FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'none', 'null' FROM customer UNION ALL SELECT c_custkey, 'left', 'null' FROM customer),
r AS (SELECT s_suppkey AS id, 'nation' AS field, CAST(s_nationkey AS VARCHAR) AS v FROM supplier UNION ALL SELECT s_suppkey, 'segment', CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END FROM supplier UNION ALL SELECT s_suppkey, 'none', 'null' FROM supplier)
SELECT coalesce(l.id, r.id) AS id, coalesce(l.field, r.field) AS field, l.v AS "left", r.v AS "right", (l.id IS NOT NULL AND r.id IS NOT NULL AND l.v = r.v) AS agrees,
  CASE WHEN l.id IS NOT NULL AND r.id IS NOT NULL AND l.v = r.v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS agreement
FROM l FULL JOIN r ON l.id = r.id AND l.field = r.field
""")
def field_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers met field by field: customers against suppliers of the same number."""
    one = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"), F.lit("none"), F.lit("null"), F.lit("left"), F.lit("null")).alias("fields"),
    )
    other = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.create_map(F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("segment"), F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY"), F.lit("none"), F.lit("null")).alias("fields"),
    )
    return answers.compare(one, other, "id")


_USAGE = "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END"


@query(f"""
SELECT user_id, coalesce(CAST(sum({_USAGE}) AS BIGINT), -1) AS input_tokens, coalesce(CAST(sum(CASE WHEN user_id % 9 = 0 THEN NULL ELSE 4 END) AS BIGINT), -1) AS output_tokens,
  coalesce(CAST(sum({_USAGE} + 4) AS BIGINT), -1) AS total_tokens, -1 AS cached_tokens, coalesce(round(sum(CASE WHEN event_type = 'error' THEN value END), 4), -1) AS estimated_cost
FROM events GROUP BY 1
""")
def usage_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage of calls summed over what was measured; -1 stands for what never was."""
    k = F.when(F.col("event_type") != "view", F.get_json_object("props", "$.k").cast("long"))
    calls = table(spark, sf_dir, "events").select(
        "user_id", k.alias("input_tokens"), F.when(F.col("user_id") % 9 != 0, 4).alias("output_tokens"), (k + 4).alias("total_tokens"),
        F.lit(None).cast("long").alias("cached_tokens"), F.when(F.col("event_type") == "error", F.col("value")).alias("estimated_cost"),
    )
    found = answers.merge_usage(calls, ["user_id"]).withColumn("estimated_cost", F.round("estimated_cost", 4))
    return found.select("user_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in found.columns[1:]])


@query("""
SELECT user_id, string_agg(event_type || '=' || v, ',' ORDER BY event_type) AS provider_usage FROM (SELECT user_id, event_type, arg_max(CAST(json_extract(props, '$.k') AS VARCHAR), event_id) AS v FROM events GROUP BY ALL) GROUP BY 1
""")
def provider_usage_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers' own counters merged, the last of a name winning."""
    records = table(spark, sf_dir, "events").select("user_id", "event_id", F.create_map(F.col("event_type"), F.get_json_object("props", "$.k")).alias("provider_usage"))
    found = answers.merge_provider_usage(records, ["user_id"], "event_id")
    pairs = F.transform(F.array_sort(F.map_entries("provider_usage")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("user_id", F.array_join(pairs, ",").alias("provider_usage"))


@query("""
SELECT user_id, coalesce(round(sum(CASE WHEN event_type = 'click' THEN value END), 4), -1) AS load_time, coalesce(round(sum(value), 4), 0) AS total_time FROM events GROUP BY 1
""")
def timing_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of calls summed over what was measured."""
    null = F.lit(None).cast("double")
    calls = table(spark, sf_dir, "events").select(
        "user_id", null.alias("queue_time"), F.when(F.col("event_type") == "click", F.col("value")).alias("load_time"), null.alias("inference_time"), F.col("value").alias("total_time")
    )
    found = answers.merge_timing(calls, ["user_id"])
    return found.select("user_id", F.coalesce(F.round("load_time", 4), F.lit(-1.0)).alias("load_time"), F.round("total_time", 4).alias("total_time"))


@query("""
WITH c AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'TIMEOUT' WHEN 'assistant' THEN NULL ELSE 'CONTEXT_OVERFLOW' END AS error_type, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS attempt FROM conversations),
k AS (SELECT *, coalesce(min(CASE WHEN error_type = 'TIMEOUT' AND attempt < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS open FROM c)
SELECT conv_id, turn, attempt, CASE WHEN conv_id % 2 = 0 THEN 'call' ELSE 'n' || conv_id END || '-attempt-' || lpad(CAST(attempt AS VARCHAR), 3, '0') AS attempt_id,
  CASE error_type WHEN 'TIMEOUT' THEN 'RETRYABLE' WHEN 'CONTEXT_OVERFLOW' THEN 'INVALID' ELSE 'VALID' END AS validation
FROM k WHERE open = 1
""")
def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as attempts of a call, up to the first that needs no other one, three at most."""
    kind = F.when(F.col("role") == "user", "TIMEOUT").when(F.col("role") != "assistant", "CONTEXT_OVERFLOW")
    calls = table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("error_type"))
    node = F.when(F.col("conv_id") % 2 != 0, F.concat(F.lit("n"), F.col("conv_id").cast("string")))
    return answers.attempt_log(calls, ["conv_id"], ["turn"], node, 3).select("conv_id", "turn", "attempt", "attempt_id", "validation")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 2 = 0 AS native, event_id % 10 = 0 AS bare FROM events)
SELECT event_id, CASE WHEN native AND bare THEN 'resp' WHEN native THEN event_type ELSE 'o' || k END AS text, CASE WHEN native AND bare THEN -1 ELSE k END AS input_tokens,
  CASE WHEN native THEN 7 ELSE k + 1 END AS output_tokens, CASE WHEN native THEN CASE WHEN bare THEN -1 ELSE k + 7 END ELSE 2 * k + 1 END AS total_tokens,
  CASE WHEN NOT native AND k % 2 = 0 THEN 3 WHEN NOT native THEN 5 ELSE -1 END AS cached_tokens, CASE WHEN native THEN round(k / 1e9 * 1000000, 9) ELSE -1.0 END AS load_time, CASE WHEN native THEN 'stop' ELSE 'length' END AS finish_reason
FROM e
""")
def provider_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers' bodies of both shapes translated to text, usage and seconds."""
    k = F.get_json_object("props", "$.k").cast("long")
    native, bare = F.col("event_id") % 2 == 0, F.col("event_id") % 10 == 0
    body = (
        F.when(native & bare, F.format_string('{"response": "resp", "eval_count": 7, "load_duration": %d, "done_reason": "stop"}', k * 1_000_000))
        .when(
            native,
            F.format_string(
                '{"message": {"content": "%s"}, "prompt_eval_count": %d, "eval_count": 7, "load_duration": %d, "done_reason": "stop"}', F.col("event_type"), k, k * 1_000_000
            ),
        )
        .otherwise(
            F.format_string(
                '{"choices": [{"message": {"content": "o%d"}, "finish_reason": "length"}], "usage": {"prompt_tokens": %d, "completion_tokens": %d, "total_tokens": %d, %s}}',
                k, k, k + 1, 2 * k + 1, F.when(k % 2 == 0, '"cached_tokens": 3').otherwise('"prompt_tokens_details": {"cached_tokens": 5}'),
            )
        )
    )
    found = table(spark, sf_dir, "events").select("event_id", prompts.answer_of(F.when(native, "ollama").otherwise("openai"), F.parse_json(body)).alias("a"))
    or_none = lambda c: F.coalesce(F.col(c), F.lit(-1))
    return found.select(
        "event_id", "a.text", or_none("a.usage.input_tokens").alias("input_tokens"), or_none("a.usage.output_tokens").alias("output_tokens"),
        or_none("a.usage.total_tokens").alias("total_tokens"), or_none("a.usage.cached_tokens").alias("cached_tokens"),
        F.round(F.coalesce("a.timing.load_time", F.lit(-1.0)), 9).alias("load_time"), "a.finish_reason",
    )


@query("""
WITH e AS (SELECT event_id, 200 + event_id % 4 * 100 + CASE event_id % 8 WHEN 2 THEN 4 WHEN 6 THEN 13 ELSE 0 END AS status, CASE WHEN event_id % 3 = 0 THEN 'Prompt TOO LONG here' ELSE 'bad' END AS body, event_id % 5 AS exit_code, event_id % 7 AS said FROM events)
SELECT coalesce(CASE WHEN status BETWEEN 200 AND 299 THEN NULL WHEN status = 404 THEN 'MODEL_UNAVAILABLE' WHEN status IN (400, 413) AND body <> 'bad' THEN 'CONTEXT_OVERFLOW' ELSE 'PROVIDER_ERROR' END, '') AS http,
  CASE WHEN said = 0 THEN 'CORRUPTED_PDF' WHEN exit_code = 3 THEN 'ENCRYPTED_PDF' WHEN exit_code = 1 THEN 'INVALID_INPUT' WHEN said = 1 THEN 'PAGE_EXTRACTION_ERROR' WHEN exit_code = 2 THEN 'IO_ERROR' ELSE 'RENDER_ERROR' END AS engine,
  count(*) AS calls FROM e GROUP BY ALL
""")
def failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of providers and engines by kind."""
    event = F.col("event_id")
    status = F.lit(200) + event % 4 * 100 + F.when(event % 8 == 2, 4).when(event % 8 == 6, 13).otherwise(0)
    body = F.when(event % 3 == 0, "Prompt TOO LONG here").otherwise("bad")
    said = F.when(event % 7 == 0, "x Syntax Error y").when(event % 7 == 1, "Wrong page range given").otherwise("")
    return table(spark, sf_dir, "events").groupBy(
        F.coalesce(prompts.status_failure(status, body), F.lit("")).alias("http"), prompts.engine_failure(said, event % 5, F.lit("RENDER_ERROR")).alias("engine")
    ).agg(F.count(F.lit(1)).alias("calls"))


@query("""
SELECT user_id, CASE WHEN event_id % 3 = 0 THEN 'thinking' ELSE 'content' END AS channel, sha256(string_agg(event_type || CAST(json_extract(props, '$.k') AS VARCHAR), '' ORDER BY event_id)) AS text_sha256, count(*) AS pieces
FROM events WHERE event_id % 5 <> 0 GROUP BY ALL
""")
def stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of streamed answers, read as events, and joined by channel in their order; comments, blank
    lines and the end mark carry nothing."""
    event = F.col("event_id")
    data = F.format_string('data: {"t": "%s%s"}', F.col("event_type"), F.get_json_object("props", "$.k"))
    line = F.when(event % 5 != 0, data).when(event % 15 == 0, "data: [DONE]").when(event % 15 == 5, ": ping").otherwise("")
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("seq"), F.when(event % 3 == 0, "thinking").otherwise("content").alias("channel"), prompts.sse_payload(line).alias("v")
    ).where("v is not null")
    deltas = rows.select("user_id", "seq", "channel", F.variant_get("v", "$.t", "string").alias("text"))
    counted = deltas.groupBy("user_id", "channel").agg(F.count(F.lit(1)).alias("pieces"))
    whole = answers.collect_deltas(deltas, ["user_id"]).select("user_id", "channel", identity.digest(F.col("text")).alias("text_sha256"))
    return whole.join(counted, ["user_id", "channel"])


@query("""
SELECT event_id, sha256('{"a":{"x":1,"y":[true,null]},"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || ',"z":"' || event_type || ' é"}') AS canonical_sha256,
  sha256('{"a":{"x":1,"y":[true,null]},"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || ',"z":"' || event_type || ' \\u00e9"}') AS ascii_sha256
FROM events
""")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in any order and spacing, in canonical form, with and without characters beyond ASCII."""
    text = F.concat(F.lit('{ "z" : "'), F.col("event_type"), F.lit(' é" , "k": '), F.get_json_object("props", "$.k"), F.lit(', "a": {"y": [true, null], "x": 1}}'))
    own = identity.canonical_json(text)
    return table(spark, sf_dir, "events").select(
        "event_id", identity.digest(own).alias("canonical_sha256"), identity.digest(identity.escape_ascii(own)).alias("ascii_sha256")
    )


@query("""
SELECT 'compare' AS node, 'extract_a' AS "left", 'extract_b' AS "right", role, count(*) AS fields, count(*) FILTER (a.n = b.n) AS agreeing
FROM (SELECT conv_id, role, count(*) AS n FROM conversations WHERE turn // 2 % 2 = 0 GROUP BY ALL) a JOIN (SELECT conv_id, role, count(*) AS n FROM conversations WHERE turn // 2 % 2 = 1 GROUP BY ALL) b USING (conv_id, role) GROUP BY role
""")
def graph_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of nodes whose answers the default graph compares, over two halves of conversations."""
    pairs = answers.compared_pairs(answers.compile_graph(answers.default_graph()))
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id", "role", (F.floor(F.col("turn") / 2) % 2).alias("half")).agg(F.count(F.lit(1)).alias("n"))
    fields = lambda half: turns.where(F.col("half") == half).groupBy("conv_id").agg(
        F.map_from_entries(F.collect_list(F.struct("role", F.col("n").cast("string").alias("n")))).alias("fields")
    )
    node, left, right = pairs[0]
    met = answers.compare(fields(0), fields(1), "conv_id").where("left is not null and right is not null")
    return met.groupBy(F.lit(node).alias("node"), F.lit(left).alias("left"), F.lit(right).alias("right"), F.col("field").alias("role")).agg(
        F.count(F.lit(1)).alias("fields"), F.count_if("agrees").alias("agreeing")
    )


@query("""
SELECT o_orderkey % 5 AS node_id, count(*) AS reusable FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey % 5 = o_orderkey % 5) GROUP BY 1
""")
def cached_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node results that a run may use again: good, valid, with an answer, under the current key."""
    key = F.col("o_orderkey")
    results = table(spark, sf_dir, "orders").select(
        (key % 5).alias("node_id"), F.col("o_custkey").alias("request_key"), F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(key % 3 != 0, "answer").alias("result"), F.when(key % 7 != 0, "VALID").otherwise("INVALID").alias("validation"),
    )
    requests = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).cast("long").alias("node_id"), F.col("c_custkey").alias("request_key"))
    return answers.cached_results(results, requests).groupBy("node_id").agg(F.count(F.lit(1)).alias("reusable"))


@query("""
SELECT * FROM (VALUES (0, 'classify', '', 'simple_extract'), (1, 'extract_a', 'classify', 'simple_extract'), (2, 'extract_b', 'classify', 'simple_extract'),
  (3, 'compare', 'extract_a,extract_b', 'simple_extract'), (4, 'validate', 'compare', 'simple_extract'), (5, 'consolidate', 'validate', 'simple_extract')) t("position", node, needs, template)
""")
def default_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default inference graph, compiled, as a table of nodes and what they need."""
    plan = answers.compile_graph(answers.default_graph())
    rows = [(n, node.node_id, ",".join(node.depends_on), node.template) for n, node in enumerate(plan.nodes)]
    return spark.createDataFrame(rows, "position int, node string, needs string, template string")
