"""Queries over whole runs: graphs, requests, documents, images, records. Their engines are the deterministic
ones for tests, so what they give can be told in SQL."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.functions import identity, imaging, options
from sheafline.functions.engines import RawCodec, ScriptedProvider, TextOcr, TextPdf
from sheafline.operators import answers, layout, pages, routing, state
from sheafline.plans import processors as P
from sheafline.plans import schema as S
from sheafline.sources import files
from sheafline.sources.scratch import Scratch

_NO_EXTRA = "cast(map() as map<string,string>)"


def _said(text: str, status: int = 200) -> tuple[int, str]:
    return status, json.dumps({"choices": [{"message": {"content": text}}]})


def image_sizes(request: Mapping) -> tuple[int, str]:
    return _said(json.dumps({"sizes": [len(c) for c in request["image_contents"]]}))


def by_last_word(request: Mapping) -> tuple[int, str]:
    kind = int(request["prompt"].split()[-1]) % 6
    return _said("{}", 500) if kind == 2 else _said("{}", 404) if kind == 3 else _said("no json") if kind == 4 else _said('{"n": 1}')


_GRAPH = {
    "graph_id": "pairs", "graph_version": "1",
    "nodes": [{"node_id": "a", "template": "say"}, {"node_id": "b", "template": "ask"}, {"node_id": "c", "template": "meet", "depends_on": ["a", "b"]}],
}


@query("""
WITH n AS (SELECT n_nationkey AS k, '{"value":"Say ' || n_name || '"}' AS a, '{"value":"Ask ' || n_name || '"}' AS b FROM nation)
SELECT k::VARCHAR AS request_id, node_id, 'SUCCESS' AS status, value FROM (
  SELECT k, 'a' AS node_id, a AS value FROM n UNION ALL SELECT k, 'b', b FROM n UNION ALL SELECT k, 'c', '{"node_results":{"a":' || a || ',"b":' || b || '}}' FROM n)
""")
def graph_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph of three nodes over nations; the last one's prompt is the answers of the others."""
    templates = spark.createDataFrame([("say", "Say <doc>"), ("ask", "Ask <doc>"), ("meet", "<extra>")], "template string, text string")
    asked = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("request_id"), F.lit("openai").alias("provider"), F.lit("m").alias("model"), F.lit("").alias("template"),
        F.col("n_name").alias("document"), F.expr(_NO_EXTRA).alias("extra"), F.lit("{}").alias("options"),
    )
    return P.execute_graph(asked, templates, ScriptedProvider, _GRAPH).nodes.select("request_id", "node_id", "status", "value")


@query("""
SELECT p_partkey::VARCHAR AS request_id, 'SUCCESS' AS status,
  sha256('{"input_hashes":{"document":"' || sha256(p_name) || '","images":[' || CASE p_partkey % 3 WHEN 0 THEN '"' || sha256(p_brand) || '","' || sha256(p_type) || '"' WHEN 1 THEN '"' || sha256(p_brand) || '"' ELSE '' END
    || ']},"model":"m","model_version":null,"normalized_options":{},"provider":"vllm","rendered_prompt":"see ' || p_name || '","schema_hash":null}') AS request_key,
  '{"sizes":[' || CASE p_partkey % 3 WHEN 0 THEN strlen(p_brand) || ',' || strlen(p_type) WHEN 1 THEN strlen(p_brand)::VARCHAR ELSE '' END || ']}' AS value
FROM part
""")
def image_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with two, one and no images: each image is in the key, in its order, and reaches the provider."""
    brand, kind, key = F.col("p_brand").cast("binary"), F.col("p_type").cast("binary"), F.col("p_partkey")
    templates = spark.createDataFrame([("see", "see <doc>")], "template string, text string")
    asked = table(spark, sf_dir, "part").select(
        key.cast("string").alias("request_id"), F.lit("vllm").alias("provider"), F.lit("m").alias("model"), F.lit("see").alias("template"), F.col("p_name").alias("document"),
        F.expr(_NO_EXTRA).alias("extra"), F.lit("{}").alias("options"), F.when(key % 3 == 0, F.array(brand, kind)).when(key % 3 == 1, F.array(brand)).alias("image_contents"),
    )
    return P.process_requests(asked, templates, partial(ScriptedProvider, {}, image_sizes))["requests"].select("request_id", "status", "request_key", "value")


@query("""
SELECT s_suppkey::VARCHAR AS request_id, CASE s_suppkey % 6 WHEN 5 THEN 'SUCCESS' ELSE 'FAILED' END AS status, CASE s_suppkey % 6 WHEN 5 THEN '{"n":1}' END AS value,
  CASE s_suppkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 3 THEN 1 WHEN 5 THEN 1 ELSE 2 END AS attempts,
  CASE s_suppkey % 6 WHEN 0 THEN 'PROVIDER_ERROR: nobody is not a provider that can be reached' WHEN 1 THEN 'DEPENDENCY_ERROR: no template gone' WHEN 2 THEN 'PROVIDER_ERROR'
    WHEN 3 THEN 'MODEL_UNAVAILABLE' WHEN 4 THEN 'INVALID_JSON' END AS error
FROM supplier
""")
def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that cannot be sent, fail at once, fail after another attempt, and succeed."""
    key, schema = F.col("s_suppkey"), {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}
    templates = spark.createDataFrame([("do", "do <doc>")], "template string, text string")
    asked = table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("request_id"), F.when(key % 6 == 0, "nobody").otherwise("openai").alias("provider"), F.lit("m").alias("model"),
        F.when(key % 6 == 1, "gone").otherwise("do").alias("template"), key.cast("string").alias("document"), F.expr(_NO_EXTRA).alias("extra"), F.lit('{"max_attempts": 2}').alias("options"),
    )
    done = P.process_requests(asked, templates, partial(ScriptedProvider, {}, by_last_word), schema)["requests"]
    return done.select("request_id", "status", "value", "attempts", "error")


@query("""
SELECT lang AS model, count(*) AS requests, 'MODEL_UNAVAILABLE: ' || lang || ' is not among ["test-model"]' AS error FROM documents WHERE lang IS NOT NULL AND lang <> 'en' GROUP BY lang
""")
def unavailable_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose model the provider doesn't offer."""
    asked = table(spark, sf_dir, "documents").where("lang is not null").select("doc_id", F.when(F.col("lang") == "en", "test-model").otherwise(F.col("lang")).alias("model"))
    return P.model_available(asked, ScriptedProvider).groupBy("model", "error").agg(F.count(F.lit(1)).alias("requests"))


def _as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as PDFs with and without text, images and files of another kind, by their number."""
    key, text = F.col("doc_id") % 4, F.coalesce("text", F.lit(""))
    suffix = F.when(key == 1, "png").when(key == 3, "txt").otherwise("pdf")
    pdf = lambda body: F.concat(F.lit("%PDF-1.7\n"), body, F.lit("\n%%EOF"))
    content = F.when(key == 0, pdf(text)).when(key == 2, pdf(F.lit(""))).otherwise(text)
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select(name.alias("document_id"), F.concat(F.lit("in/"), name, F.lit("."), suffix).alias("path"), content.cast("binary").alias("content"))


def _whole(done: dict[str, DataFrame]) -> DataFrame:
    """The stages of a run, and its documents as rows without a stage."""
    documents = done["documents"].select("document_id", F.lit(None).cast("int").alias("page_number"), F.lit("").alias("stage"), "status", F.col("error").alias("reason"))
    return done["stages"].select("document_id", "page_number", "stage", "status", "reason").union(documents)


@query("""
WITH d AS (SELECT 'd' || doc_id AS document_id, doc_id % 4 AS kind, regexp_matches(text, '[^\\s]') AS words, text FROM documents),
p AS (SELECT *, kind = 0 AND words AS native FROM d WHERE kind IN (0, 2) OR kind = 1 AND text <> '')
SELECT document_id, 1 AS page_number, 'OCR' AS stage, CASE WHEN native THEN 'SKIPPED' ELSE 'REUSED' END AS status, CASE WHEN native THEN 'native_text_present' ELSE 'valid_result_reused' END AS reason FROM p
UNION ALL SELECT document_id, 1, 'LLM', 'SUCCESS', 'no_valid_result' FROM p
UNION ALL SELECT document_id, NULL, '', CASE WHEN kind = 3 OR kind = 1 AND text = '' THEN 'FAILED' ELSE 'SUCCESS' END,
  CASE WHEN kind = 3 THEN 'UNSUPPORTED_FORMAT' WHEN kind = 1 AND text = '' THEN 'INVALID_INPUT' END FROM d
""")
def workflow_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a run that stops after OCR, and through one that resumes it: what was read is not
    read again, and the models are asked."""
    templates = spark.createDataFrame([("read", "Read: <doc>")], "template string, text string")
    run = partial(P.process_documents, _as_files(spark, sf_dir), TextPdf, TextOcr, ScriptedProvider, templates, "read")
    first = run(P.Policy(stop_after_stage="OCR"))
    return _whole(run(P.Policy(), saved=Scratch(spark, "saved").table(first["stages"])))


@query("""
WITH s AS (SELECT 's' || s_suppkey AS document_id, s_suppkey % 2 = 0 AS native FROM supplier)
SELECT document_id, 1 AS page_number, 'OCR' AS stage, 'SKIP' AS action, 'explicit_skip' AS reason FROM s
UNION ALL SELECT document_id, 1, 'LLM', 'FORCE', 'forced_by_policy' FROM s
""")
def workflow_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a policy that skips one stage and forces the other makes of a run that had all it needs."""
    key, name = F.col("s_suppkey"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    pdf = F.concat(F.lit("%PDF-1.7\n"), F.col("s_name"), F.lit("\n%%EOF"))
    found = table(spark, sf_dir, "supplier").select(
        name.alias("document_id"), F.concat(name, F.when(key % 2 == 0, ".pdf").otherwise(".png")).alias("path"), F.when(key % 2 == 0, pdf).otherwise(F.col("s_name")).cast("binary").alias("content")
    )
    templates = spark.createDataFrame([("read", "Read: <doc>")], "template string, text string")
    run = partial(P.process_documents, found, TextPdf, TextOcr, ScriptedProvider, templates, "read")
    saved = Scratch(spark, "saved").table(run(P.Policy())["stages"])
    return run(P.Policy(skip_stages=("OCR",), force_stages=("LLM",)), saved=saved)["decisions"]


@query("""
SELECT n_regionkey AS region, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS page_number, n_name AS native_text, 'success' AS status FROM nation
""")
def merged_pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A PDF of one page for each nation, merged by region in the order of their numbers and split again."""
    page = F.concat(F.lit("%PDF-1.7\n"), F.col("n_name"), F.lit("\n%%EOF")).cast("binary")
    parts = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("document_id"), F.col("n_nationkey").alias("position"), page.alias("content"))
    merged = P.merge_pdfs(parts, TextPdf).withColumn("path", F.lit("merged.pdf"))
    pages = P.process_pdfs(merged, TextPdf)["pages"]
    return pages.select(F.col("document_id").cast("int").alias("region"), F.col("page_number").cast("long").alias("page_number"), "native_text", "status")


@query("""
SELECT n_nationkey AS nation, n_name || chr(10) || chr(10) || 'in region ' || n_regionkey AS text, n_name AS titles, 'in region ' || n_regionkey AS paragraphs, 'block_001,block_002' AS reading_order FROM nation
""")
def ocr_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page images read as structured documents: a title, a paragraph, and the order in which they are read."""
    content = F.concat("n_name", F.lit("\nin region "), F.col("n_regionkey").cast("string")).cast("binary")
    found = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("document_id"), F.lit(1).alias("page_number"), content.alias("content"))
    done = P.process_ocr(found, TextOcr)["documents"]
    joined = [F.array_join(c, ",").alias(c) for c in ("titles", "paragraphs", "reading_order")]
    key = [c for c in done.columns if c not in ("text", "titles", "paragraphs", "reading_order")][0]
    return done.select(F.regexp_extract(F.col(key).cast("string"), "^[0-9]+", 0).cast("int").alias("nation"), "text", *joined)


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def published_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts published as records and read back, line breaks and all."""
    path = Scratch(spark, "published").path()
    rows = table(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", "text")).alias("text"))
    files.publish_text(rows, path)
    back = files.published_text(spark, path).select(F.from_json("text", "doc_id long, text string").alias("r"))
    return back.select("r.doc_id", F.sha2("r.text", 256).alias("sha256"))


@query("""
SELECT 'r' || r_regionkey AS document_id, p.n AS page_number, '{"document_id":"r' || r_regionkey || '","native_text":null,"normalized_image":null,"ocr_markdown":null,"ocr_ready_image":null,"ocr_text":null,'
  || '"page_image":null,"page_number":' || p.n || ',"page_pdf":null,"status":"NOT_STARTED","vlm_ready_image":null}' AS payload
FROM region, range(1, 6) p(n) WHERE p.n <= r_regionkey
""")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page contexts written as records, read back by their schema, and written again."""
    documents = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("document_id"), F.col("r_regionkey").alias("page_count"))
    rows = state.create_pages(documents)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    back = state.from_payload(state.to_payload(rows, "document_id"), ddl)
    again = state.to_payload(back, "page_number").withColumnRenamed("page_number", "_n")
    return again.select(F.get_json_object("payload", "$.document_id").alias("document_id"), F.col("_n").cast("long").alias("page_number"), "payload")


@query(f"""
WITH s AS (SELECT {list(S.STAGES)} AS stages, {[*S.STAGES, 'none']} AS bounds),
o AS (SELECT o_orderkey, stages[o_orderkey % {len(S.STAGES)} + 1] AS stage, nullif(bounds[o_orderkey % {len(S.STAGES) + 1} + 1], 'none') AS boundary, stages FROM orders, s)
SELECT stage, coalesce(boundary, '') AS boundary, count(*) AS rows, boundary IS NULL OR list_position(stages, stage) <= list_position(stages, boundary) AS allowed FROM o GROUP BY ALL
""")
def stage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages that a boundary lets run."""
    key = F.col("o_orderkey")
    at = lambda names: F.get(F.array(*[F.lit(n) for n in names]), (key % len(names)).cast("int"))
    rows = table(spark, sf_dir, "orders").select(at(S.STAGES).alias("stage"), F.nullif(at([*S.STAGES, "none"]), F.lit("none")).alias("boundary"))
    allowed = routing.allowed(F.col("stage"), F.col("boundary"))
    return rows.groupBy("stage", F.coalesce("boundary", F.lit("")).alias("boundary"), allowed.alias("allowed")).agg(F.count(F.lit(1)).alias("rows"))


@query("""
SELECT o_orderkey, '{"n":' || o_orderkey || ',"s":"' || o_orderstatus || '","j":[1]}' AS typed, '1,x' AS engine, o_orderkey % 2 = 0 AS ocr, false AS layout,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE lower(o_orderstatus) END AS language
FROM orders
""")
def typed_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated options as typed values, OCR options in their normal form, engine options under what is fixed."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    stated = options.typed_values(F.array(F.concat(F.lit("n="), key.cast("string")), F.concat(F.lit("s="), status), F.lit("j=[1]")))
    none = F.lit(None).cast("string")
    language = F.when(key % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), status, F.lit(" ")))
    normal = options.normalized_ocr((key % 2 == 0).cast("string"), none, none, none, language)
    fixed = options.engine_config(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), status), F.create_map(F.lit("b"), F.lit("x")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(stated).alias("typed"), F.concat_ws(",", fixed["a"], fixed["b"]).alias("engine"), normal["ocr"].alias("ocr"), normal["layout"].alias("layout"),
        F.coalesce(normal["language"], F.lit("")).alias("language"),
    )


def _kernels(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        images = imaging.stacked(frame["content"].tolist(), 2, 2, 3)
        gray, wide = imaging.grayscale(images), imaging.convert(images, "BGRA")
        width, height = imaging.dimensions(imaging.upscale(gray, 2))
        told = {
            "first": gray[0, 0], "last": gray[1, 1], "bright": imaging.brighten(gray, 60)[0, 0], "small": imaging.resize(gray, 1, 1)[0, 0],
            "turned": imaging.apply_steps(gray, ["orientation"], {})[0, 1], "channels": imaging.channels(wide), "alpha": wide[0, 0, :, 3], "width": width, "height": height,
        }
        yield pd.DataFrame({"p_partkey": frame["p_partkey"].to_numpy()} | told)


@query("""
WITH b AS (SELECT p_partkey, [(p_partkey * 7 + i * 31 + p_size) % 256 FOR i IN range(12)] AS x FROM part),
g AS (SELECT p_partkey, [round_even(0.114 * x[3 * k + 1] + 0.587 * x[3 * k + 2] + 0.299 * x[3 * k + 3], 0) FOR k IN range(4)] AS g FROM b)
SELECT p_partkey, g[1]::INTEGER AS first, g[4]::INTEGER AS last, least(g[1] + 60, 255)::INTEGER AS bright, round_even((g[1] + g[2] + g[3] + g[4]) / 4, 0)::INTEGER AS small, g[1]::INTEGER AS turned,
  4 AS channels, 255 AS alpha, 4 AS width, 4 AS height FROM g
""")
def pixel_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small colour images through the kernels whose every pixel can be told: grey, brighter, averaged, turned
    clockwise, with an alpha channel, scaled up."""
    value = lambda i: (F.col("p_partkey") * 7 + i * 31 + F.col("p_size")) % 256
    content = F.unhex(F.concat(*[F.lpad(F.hex(value(i)), 2, "0") for i in range(12)]))
    images = table(spark, sf_dir, "part").select("p_partkey", content.alias("content"))
    return images.mapInPandas(_kernels, "p_partkey long, first int, last int, bright int, small int, turned int, channels int, alpha int, width int, height int")


@query("SELECT p_partkey, strlen(p_name) AS width, 1 AS height, 1 AS channels, sha256(p_name) AS sha256 FROM part")
def codec_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw images written as files by a codec and decoded again."""
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("document_id"), F.col("p_name").cast("binary").alias("content"), F.octet_length("p_name").alias("width"), F.lit(1).alias("height"), F.lit(1).alias("channels")
    )
    back = P.decode_images(P.encode_images(raw, RawCodec), RawCodec)
    return back.select(F.col("document_id").cast("long").alias("p_partkey"), F.col("width").cast("long").alias("width"), "height", "channels", F.sha2("content", 256).alias("sha256"))


@query("""
WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents), i AS (SELECT doc_id, h, sha256('["' || h || '","200"]') AS ih FROM d)
SELECT doc_id, sha256('{"input_hashes":["' || ih || '"],"normalized_options":{"dpi":200},"processor":"pdf","processor_version":"0.0.0"}') AS pdf,
  sha256('{"input_hashes":["' || ih || '"],"normalized_options":{},"processor":"llm","processor_version":"0.0.0"}') AS llm,
  sha256('{"input_hashes":["' || h || '"],"normalized_options":{"dpi":200},"processor":"workflow","processor_version":"0.0.0"}') AS document, sha256('{"dpi":200}') AS options
FROM i
""")
def stage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of stages and of whole documents, and the digest of options."""
    own, stated = identity.digest(F.col("text")), F.lit('{"dpi":200}')
    inputs = F.array(own, F.lit("200"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", identity.stage_key("PDF", inputs, stated).alias("pdf"), identity.stage_key("LLM", inputs, F.lit("{}")).alias("llm"),
        identity.document_key(own, stated).alias("document"), identity.options_hash(stated).alias("options"),
    )


@query("""
WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT k, CASE WHEN k % 150 NOT BETWEEN 1 AND 100 THEN 'TRANSFORMATION_ERROR: quality ' || k % 150 || ' is outside the encodable band 1-100' ELSE '' END AS options,
  CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'OCR_ERROR true' WHEN 2 THEN 'OCR_ERROR false' ELSE 'ENGINE_ERROR false' END AS conversion,
  'a,b,c' || CASE WHEN k % 3 > 0 THEN ',t' ELSE '' END AS ocr, CASE WHEN k % 2 = 0 THEN 'p,i,x' ELSE 'i,x' END AS page,
  concat_ws('; ', CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN 'a successful run recorded no attempt' END, CASE WHEN k % 5 = 0 AND k % 4 > 0 THEN 'a valid schema verdict carries violations' END,
    CASE WHEN k % 5 > 0 AND k % 4 = 0 THEN 'an invalid schema verdict names no violation' END, CASE WHEN k % 2 = 1 AND k % 7 = 0 THEN 'a failed run recorded no typed error' END) AS contradictions,
  CASE WHEN k % 3 = 0 THEN 'INTERNAL_ERROR: the processor reported failure without a typed error (false)' ELSE 'TIMEOUT: slow (true)' END AS failure
FROM o
""")
def result_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is refused, declared and described around a processor's result."""
    k, lit = F.col("o_orderkey"), F.lit
    status = F.when(k % 4 == 0, "success").when(k % 4 == 1, "partial_success").when(k % 4 == 2, "failure").otherwise("started")
    found, failed = layout.conversion_failure(status), state.describe_failure(F.when(k % 3 != 0, "TIMEOUT"), lit("slow"), lit(True))
    none = F.lit(None).cast("string")
    told = answers.contradictions(F.when(k % 2 == 0, "SUCCESS").otherwise("FAILED"), k % 3, k % 5 == 0, k % 4, k % 7)
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), F.coalesce(routing.image_options_fault(k % 150), lit("")).alias("options"),
        F.coalesce(F.concat(found["type"], lit(" "), found["recoverable"].cast("string")), lit("")).alias("conversion"),
        F.array_join(layout.declared_artifacts(lit("a"), lit("b"), lit("c"), lit("t"), k % 3), ",").alias("ocr"),
        F.array_join(pages.declared_artifacts(F.when(k % 2 == 0, "p"), lit("i"), none, F.array(lit("i"), lit("x"))), ",").alias("page"),
        F.array_join(told, "; ").alias("contradictions"),
        F.concat(failed["type"], lit(": "), failed["message"], lit(" ("), failed["recoverable"].cast("string"), lit(")")).alias("failure"),
    )


@query("""
SELECT n_regionkey AS region, '{"pages":[' || string_agg('{"extraction_strategy":"' || CASE WHEN n_nationkey % 2 = 0 THEN 'TEXT_ONLY' ELSE 'OCR_ONLY' END || '","page_number":' || n_nationkey || ',"result":'
  || CASE WHEN n_nationkey % 3 = 0 THEN 'null' ELSE '{"n":' || n_nationkey || '}' END || ',"selected_source":' || CASE WHEN n_nationkey % 5 = 0 THEN 'null' ELSE '"OCR_TEXT"' END || '}', ',' ORDER BY n_nationkey) || ']}' AS final_result
FROM nation GROUP BY 1
""")
def final_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages of documents came to, page by page."""
    k = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("document_id"), k.alias("page_number"), F.when(k % 5 != 0, "OCR_TEXT").alias("source"),
        F.when(k % 2 == 0, "TEXT_ONLY").otherwise("OCR_ONLY").alias("strategy"), F.when(k % 3 != 0, F.concat(F.lit('{"n":'), k.cast("string"), F.lit("}"))).alias("value"),
    )
    return state.final_results(rows).withColumnRenamed("document_id", "region")
