"""Queries over stage runs, pages and documents: routing, reuse, invalidation, folds, plans, traces.

Events play the stage runs: a user is a document, the event's number deals pages, stages and states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.functions import identity
from sheafline.operators import pages as P
from sheafline.operators import routing, state
from sheafline.plans import schema as S
from sheafline.sources import files

_STATES = "list_value('NOT_STARTED','READY','RUNNING','SUCCESS','REUSED','SKIPPED','FAILED','PAUSED','INVALIDATED')"
_PRIORITY = "list_position(['FAILED','INVALIDATED','RUNNING','SUCCESS','REUSED','READY','NOT_STARTED','SKIPPED','PAUSED'], status)"
#: One row a document, page and stage: the last event that deals it.
_RUNS = f"""runs AS (SELECT CAST(user_id AS VARCHAR) AS document_id, CAST(event_id % 6 AS INTEGER) AS page_number,
   (['PDF','IMAGE','OCR','LLM'])[event_id // 6 % 4 + 1] AS stage,
   arg_max(({_STATES})[CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 9 AS INTEGER) + 1], event_id) AS status,
   CAST(count(*) AS INTEGER) AS attempts, max(event_id) AS event_id FROM events GROUP BY ALL)"""


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, page_number, stage, status, attempts, event_id): the last event of each stage."""
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("document_id"),
            (event % 6).cast("int").alias("page_number"),
            _pick(S.STAGES, F.floor(event / 6) % 4).alias("stage"),
        )
        .agg(F.max_by(_pick(S.STAGE_STATES, k % 9), event).alias("status"), F.count(F.lit(1)).cast("int").alias("attempts"), F.max(event).alias("event_id"))
    )


@query(f"""
WITH {_RUNS} SELECT document_id, stage, arg_min(status, {_PRIORITY}) AS status FROM runs GROUP BY ALL
""")
def stage_status_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that speaks for each stage of a document over its pages."""
    return state.fold(runs(spark, sf_dir), ["document_id", "stage"])


@query(f"""
WITH {_RUNS} SELECT document_id, page_number, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status IN ('SUCCESS', 'REUSED')) THEN 'SUCCESS'
  WHEN bool_and(status = 'SKIPPED') THEN 'SKIPPED' END AS status FROM runs GROUP BY ALL
""")
def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each page by those of its stages."""
    return state.page_status(runs(spark, sf_dir), ["document_id", "page_number"])


@query("""
WITH p AS (SELECT CAST(conv_id AS VARCHAR) AS document_id, CASE WHEN role = 'system' THEN 'FAILED' WHEN role = 'user' THEN 'SUCCESS' ELSE 'SKIPPED' END AS status
           FROM conversations),
d AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS document_id, conv_id % 7 = 0 AS review, CASE conv_id % 5 WHEN 0 THEN 'OCR' WHEN 1 THEN 'LLM' END AS stop_after FROM conversations
      UNION ALL SELECT 'page-' || page_id, page_id % 7 = 0, CASE page_id % 5 WHEN 0 THEN 'OCR' WHEN 1 THEN 'LLM' END FROM pages)
SELECT d.document_id, CASE WHEN any_value(review) THEN 'REVIEW_REQUIRED' WHEN count(p.status) = 0 THEN 'FAILED' WHEN any_value(stop_after) = 'OCR' THEN 'PAUSED'
  WHEN bool_or(p.status = 'FAILED') THEN CASE WHEN bool_or(p.status = 'SUCCESS') THEN 'PARTIAL' ELSE 'FAILED' END ELSE 'SUCCESS' END AS status
FROM d LEFT JOIN p ON p.document_id = d.document_id GROUP BY 1
""")
def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' states by their pages: conversations have turns, web pages none; every seventh is under
    review."""
    turns, conv = table(spark, sf_dir, "conversations"), F.col("conv_id")
    status = F.when(F.col("role") == "system", "FAILED").when(F.col("role") == "user", "SUCCESS").otherwise("SKIPPED")
    pages = turns.select(conv.cast("string").alias("document_id"), status.alias("status"))
    listed = lambda df, id_, name: df.select(
        name.alias("document_id"), (id_ % 7 == 0).alias("review"), F.when(id_ % 5 == 0, "OCR").when(id_ % 5 == 1, "LLM").alias("stop_after")
    )
    page = F.col("page_id")
    empty = listed(table(spark, sf_dir, "pages"), page, F.concat(F.lit("page-"), page.cast("string")))
    return state.document_status(pages, listed(turns, conv, conv.cast("string")).distinct().unionByName(empty))


@query(f"""
WITH {_RUNS}, f AS (SELECT document_id, stage, arg_min(status, {_PRIORITY}) AS status FROM runs GROUP BY ALL)
SELECT document_id, string_agg(stage || '=' || status, ',' ORDER BY stage) AS states,
  coalesce(string_agg(stage, ',' ORDER BY stage) FILTER (status = 'REUSED'), '') AS reused, coalesce(string_agg(stage, ',' ORDER BY stage) FILTER (status = 'SKIPPED'), '') AS skipped
FROM f GROUP BY 1
""")
def execution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's stages with their folded states, and those reused and skipped."""
    found = state.execution_summary(runs(spark, sf_dir))
    pair = F.transform(F.array_sort(F.map_entries("states")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("document_id", F.array_join(pair, ",").alias("states"), F.array_join("reused", ",").alias("reused"), F.array_join("skipped", ",").alias("skipped"))


@query("""
SELECT 'REUSE' AS kind, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS checksum FROM orders o
WHERE o_orderstatus IN ('F', 'O') AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = CASE o_orderstatus WHEN 'F' THEN 'R' ELSE 'N' END)
""")
def reuse_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that stand: done, and under the key that is current; a semi join on both."""
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "REUSED").otherwise("RUNNING")
    key = F.when(F.col("o_orderstatus") == "F", "R").otherwise("N")
    stages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("stage_id"), status.alias("status"), key.alias("processing_key"))
    current = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("stage_id"), F.col("l_returnflag").alias("processing_key"))
    return state.reusable(stages, current).agg(
        F.lit("REUSE").alias("kind"), F.count(F.lit(1)).alias("orders"), F.sum("stage_id").alias("checksum")
    )


@query("""
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 10)
""")
def missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared outputs that aren't there, or are empty."""
    declared = table(spark, sf_dir, "orders").select("o_orderkey")
    present = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_quantity") - 10).alias("size"))
    return state.missing_artifacts(declared, present, ["o_orderkey"])


@query("""
SELECT l_orderkey AS stage_id, bool_and(o_orderkey IS NOT NULL AND coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE left(l_returnflag, 1) END = left(o_orderstatus, 1), true)) AS verified
FROM lineitem LEFT JOIN orders ON o_orderkey = l_partkey GROUP BY 1
""")
def verified_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages all of whose outputs are there with the digest that was recorded, where one was."""
    outputs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("stage_id"), F.col("l_partkey").alias("path"), F.when(F.col("l_linenumber") != 1, F.col("l_returnflag")).alias("sha256")
    )
    present = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("sha256"))
    return state.verified_stages(outputs, present)


_CLOSURE = """edges(needs, stage) AS (VALUES ('PDF', 'IMAGE'), ('IMAGE', 'OCR'), ('OCR', 'LLM')),
down(stage, dependent) AS (SELECT needs, stage FROM edges UNION SELECT d.stage, e.stage FROM down d JOIN edges e ON e.needs = d.dependent)"""


@query(f"""
WITH RECURSIVE {_CLOSURE}, {_RUNS},
hit AS (SELECT document_id, dependent AS stage, min(CASE WHEN attempts > 3 THEN NULL ELSE page_number END) AS x FROM runs JOIN down ON down.stage = runs.stage WHERE status = 'RUNNING' GROUP BY ALL),
touched AS (SELECT DISTINCT r.document_id, d.dependent AS stage, CASE WHEN r.event_id % 2 = 0 THEN r.page_number END AS page_number FROM runs r JOIN down d ON d.stage = r.stage WHERE r.status = 'RUNNING')
SELECT r.document_id, r.page_number, r.stage,
  CASE WHEN r.status IN ('SUCCESS', 'REUSED') AND EXISTS (SELECT 1 FROM touched t WHERE t.document_id = r.document_id AND t.stage = r.stage AND (t.page_number IS NULL OR t.page_number = r.page_number))
       THEN 'INVALIDATED' ELSE r.status END AS status
FROM runs r
""")
def invalidate_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Done stages that stand on one that runs again are stale, on its page or on every page."""
    rows = runs(spark, sf_dir).withColumn("reason", F.lit(None).cast("string"))
    changed = rows.where("status = 'RUNNING'").select(
        "document_id", F.when(F.col("event_id") % 2 == 0, F.col("page_number")).alias("page_number"), "stage", F.lit("rerun").alias("cause")
    )
    return state.invalidate(rows, changed).select("document_id", "page_number", "stage", "status")


@query(f"""
WITH RECURSIVE {_CLOSURE} SELECT stage, dependent FROM down
""")
def stage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that stands on each stage."""
    return state.stage_closure(spark)


@query(f"""
WITH RECURSIVE {_CLOSURE}, {_RUNS}
SELECT document_id, page_number, stage, CASE WHEN status IN ('SUCCESS', 'REUSED') AND stage IN (SELECT dependent FROM down WHERE stage = 'IMAGE') THEN 'INVALIDATED' ELSE status END AS status FROM runs
""")
def forced_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands on a forced stage is stale on every page."""
    rows = runs(spark, sf_dir).withColumn("reason", F.lit(None).cast("string"))
    return state.force(rows, ["IMAGE"]).select("document_id", "page_number", "stage", "status")


@query("""
WITH p AS (SELECT d.doc_id, l.quality, l.toxic, d.n_chars, d.doc_id % 4 = 0 AS native, d.doc_id % 3 <> 0 AS ocr, d.doc_id % 5 <> 0 AS image, coalesce(l.toxic, 0) = 0 AS allow_vlm, d.doc_id % 2 = 0 AS vlm
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
s AS (SELECT *, CASE WHEN native THEN 'NATIVE_TEXT' WHEN ocr THEN 'OCR_TEXT' END AS text_source FROM p)
SELECT CASE WHEN text_source IS NOT NULL THEN text_source || CASE WHEN allow_vlm AND vlm THEN ' + IMAGE' ELSE '' END WHEN image THEN 'IMAGE' END AS source,
       CASE WHEN native THEN 'native_text_present' WHEN ocr THEN 'native_text_empty' WHEN image THEN 'no_text_source_available' ELSE 'no_source_available' END AS reason,
       CASE WHEN native THEN CASE WHEN allow_vlm AND vlm THEN 'TEXT_PLUS_VLM' ELSE 'TEXT_ONLY' END WHEN ocr THEN CASE WHEN allow_vlm AND vlm THEN 'OCR_PLUS_VLM' ELSE 'OCR_ONLY' END WHEN image THEN 'VLM_ONLY' END AS strategy,
       CASE WHEN coalesce(quality, 1) = 0 THEN 'skipped_by_policy' WHEN native THEN 'native_text_present' END AS skip_reason,
       count(*) AS pages
FROM s GROUP BY ALL
""")
def source_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source and strategy of each page by what is there and allowed, and why OCR is skipped."""
    doc = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    native = routing.text_present(F.when(doc % 4 == 0, 1).otherwise(0), F.lit(None).cast("long"))
    ocr = routing.text_present(F.lit(None).cast("long"), F.when(doc % 3 != 0, 5).otherwise(0))
    allow = F.coalesce("toxic", F.lit(0)) == 0
    chosen = routing.select_source(allow, native, ocr, doc % 2 == 0, doc % 5 != 0)
    skip = routing.ocr_skip_reason(F.coalesce("quality", F.lit(1)) != 0, native)
    found = rows.select(chosen.alias("s"), skip.alias("skip_reason"))
    return (
        found.select("s.source", "s.reason", routing.strategy(F.col("s.source")).alias("strategy"), "skip_reason")
        .groupBy("source", "reason", "strategy", "skip_reason")
        .agg(F.count(F.lit(1)).alias("pages"))
    )


@query(f"""
WITH {_RUNS}
SELECT CASE WHEN stage = 'IMAGE' AND event_id % 10 = 0 THEN 'SKIP' WHEN stage = 'OCR' AND event_id % 10 < 2 THEN 'FORCE' WHEN stage = 'OCR' AND page_number = 1 THEN 'SKIP'
            WHEN status = 'FAILED' AND event_id % 3 <> 0 THEN 'BLOCKED' WHEN status = 'PAUSED' THEN 'BLOCKED' WHEN status IN ('SUCCESS', 'REUSED') AND event_id % 4 <> 0 THEN 'REUSE'
            WHEN event_id % 5 = 0 AND stage IN ('PDF', 'IMAGE') THEN 'BLOCKED' ELSE 'EXECUTE' END AS action,
       CASE WHEN stage = 'IMAGE' AND event_id % 10 = 0 THEN 'explicit_skip' WHEN stage = 'OCR' AND event_id % 10 < 2 THEN 'forced_by_policy' WHEN stage = 'OCR' AND page_number = 1 THEN 'native_text_present'
            WHEN status = 'FAILED' AND event_id % 3 <> 0 THEN 'failed_and_retry_disabled' WHEN status = 'PAUSED' THEN 'input_unavailable' WHEN status IN ('SUCCESS', 'REUSED') AND event_id % 4 <> 0 THEN 'valid_result_reused'
            WHEN event_id % 5 = 0 AND stage IN ('PDF', 'IMAGE') THEN 'before_start_stage_without_result' ELSE 'no_valid_result' END AS reason,
       stage, count(*) AS stages
FROM runs GROUP BY ALL
""")
def stage_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage would do: the first rule that holds, of eight."""
    event, status = F.col("event_id"), F.col("status")
    some = lambda when, name: F.when(when, F.array(F.lit(name))).otherwise(F.expr("cast(array() as array<string>)"))
    go = routing.resolve_stage(
        F.col("stage"), some(event % 10 == 0, "IMAGE"), some(event % 10 < 2, "OCR"),
        F.when((F.col("stage") == "OCR") & (F.col("page_number") == 1), "native_text_present"), status == "FAILED", event % 3 == 0,
        status != "PAUSED", status.isin(*state.DONE), event % 4 != 0, F.when(event % 5 == 0, "OCR"),
    )
    rows = runs(spark, sf_dir).select("stage", go.alias("go"))
    return rows.groupBy(F.col("go.action").alias("action"), F.col("go.reason").alias("reason"), "stage").agg(F.count(F.lit(1)).alias("stages"))


@query("""
WITH p AS (SELECT DISTINCT conv_id, turn FROM conversations),
s AS (SELECT conv_id, turn, stage, nth, CASE WHEN stage = 'PDF' AND conv_id % 3 = 0 THEN 'SKIP' WHEN stage = 'OCR' AND turn = 1 THEN 'SKIP' WHEN stage = 'IMAGE' AND conv_id % 4 = 0 THEN 'REUSE' ELSE 'EXECUTE' END AS action
      FROM p CROSS JOIN (VALUES ('PDF', 0), ('IMAGE', 1), ('OCR', 2), ('LLM', 3)) v(stage, nth)),
g AS (SELECT *, stage = 'PDF' OR turn % 2 = 0 AS ready FROM s),
h AS (SELECT *, coalesce(bool_or(action = 'REUSE' OR (action = 'EXECUTE' AND ready)) OVER (PARTITION BY conv_id, turn ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS given FROM g)
SELECT stage, CASE WHEN action = 'EXECUTE' AND NOT ready AND NOT given THEN 'BLOCKED' ELSE action END AS action,
  CASE WHEN action = 'EXECUTE' AND NOT ready AND NOT given THEN 'input_unavailable' WHEN action = 'EXECUTE' THEN 'no_valid_result' WHEN action = 'REUSE' THEN 'valid_result_reused'
       WHEN stage = 'PDF' THEN 'direct_image_input' ELSE 'native_text_present' END AS reason, count(*) AS stages
FROM h GROUP BY ALL
""")
def execution_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of all pages: a stage without a ready source needs one before it that gives something."""
    conv, turn = F.col("conv_id"), F.col("turn")
    pages = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    reasons = F.map_filter(
        F.create_map(F.lit("PDF"), F.when(conv % 3 == 0, "direct_image_input"), F.lit("OCR"), F.when(turn == 1, "native_text_present")), lambda _, v: v.isNotNull()
    )
    listed = pages.select(conv.cast("string").alias("document_id"), turn.cast("int").alias("page_number"), reasons.alias("skip_reason"))
    done = pages.where(conv % 4 == 0).select(conv.cast("string").alias("document_id"), turn.cast("int").alias("page_number"), F.lit("IMAGE").alias("stage"))
    none = F.expr("cast(array() as array<string>)")
    policy = F.struct(
        none.alias("skip_stages"), none.alias("force_stages"), F.lit(False).alias("retry_failed"), F.lit(True).alias("reuse_successful"),
        F.lit(None).cast("string").alias("start_from_stage"),
    )
    prior = done.limit(0).withColumn("status", F.lit(""))
    ready = (F.col("stage") == "PDF") | (F.col("page_number") % 2 == 0)
    plan = state.execution_plan(listed, policy, F.lit("k"), done, prior, ready)
    return plan.groupBy("stage", "action", "reason").agg(F.count(F.lit(1)).alias("stages"))


@query(f"""
WITH {_RUNS} SELECT CASE WHEN event_id % 2 = 0 AND attempts < 2 THEN 'retry processor' ELSE 'REVIEW_REQUIRED' END AS outcome, stage, count(*) AS failures FROM runs WHERE status = 'FAILED' GROUP BY ALL
""")
def error_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows failures: another attempt where the policy allows one, else a review."""
    failed = runs(spark, sf_dir).where("status = 'FAILED'")
    outcome = state.error_outcome(F.col("event_id") % 2 == 0, F.col("attempts"))
    return failed.groupBy(outcome.alias("outcome"), "stage").agg(F.count(F.lit(1)).alias("failures"))


@query(f"""
WITH {_RUNS}, r AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'w1' WHEN event_id % 3 = 1 THEN 'w2' END AS owner FROM runs)
SELECT CASE WHEN status = 'READY' AND coalesce(owner, 'w1') = 'w1' THEN 'RUNNING' WHEN status = 'RUNNING' AND owner = 'w2' THEN 'READY' ELSE status END AS status,
       coalesce(CASE WHEN status = 'READY' AND coalesce(owner, 'w1') = 'w1' THEN 'w1' WHEN status = 'RUNNING' AND owner = 'w2' THEN NULL ELSE owner END, '-') AS owner,
       count(*) AS stages, CAST(sum(attempts + CASE WHEN status = 'READY' AND coalesce(owner, 'w1') = 'w1' THEN 1 ELSE 0 END) AS BIGINT) AS attempts
FROM r GROUP BY ALL
""")
def stage_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One worker lets its running stages go, another takes those that are ready and free."""
    owner = F.when(F.col("event_id") % 3 == 0, "w1").when(F.col("event_id") % 3 == 1, "w2")
    rows = runs(spark, sf_dir).withColumn("owner", owner).withColumn("started_at", F.lit(None).cast("timestamp"))
    claimed = state.claim(rows, "w1")
    return (
        state.release(claimed, "w2").groupBy("status", F.coalesce("owner", F.lit("-")).alias("owner")).agg(F.count(F.lit(1)).alias("stages"), F.sum("attempts").alias("attempts"))
    )


@query(f"""
WITH {_RUNS} SELECT 'stage' AS kind, stage, CASE WHEN status = 'RUNNING' THEN 'READY' ELSE status END AS value, count(*) AS n FROM runs GROUP BY ALL
UNION ALL SELECT 'decision', stage, 'recovered_after_interruption', count(*) FROM runs WHERE status = 'RUNNING' GROUP BY ALL
""")
def recovered_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of an interrupted run are ready again, with a decision for each."""
    rows = runs(spark, sf_dir).withColumn("owner", F.lit("w1"))
    moved, told = state.recover(rows)
    n = F.count(F.lit(1)).alias("n")
    return (
        moved.groupBy(F.lit("stage").alias("kind"), "stage", F.col("status").alias("value")).agg(n)
        .unionByName(told.groupBy(F.lit("decision").alias("kind"), "stage", F.col("reason").alias("value")).agg(n))
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS document_id, CAST(CASE WHEN event_id % 5 = 0 THEN -1 ELSE event_id % 6 END AS INTEGER) AS page_number, event_type AS action, count(*) AS decisions FROM events GROUP BY ALL
""")
def decision_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of documents and of their pages in one trace."""
    event = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("document_id"), (event % 6).cast("int").alias("page_number"), F.col("event_type").alias("action"), "event_id")
    documents = rows.where(event % 5 == 0).drop("page_number")
    whole = state.trace(documents, rows.where(event % 5 != 0))
    return whole.groupBy("document_id", F.coalesce("page_number", F.lit(-1)).alias("page_number"), "action").agg(F.count(F.lit(1)).alias("decisions"))


@query("""
WITH p AS (SELECT conv_id, length(replace(replace(text, chr(10), ''), chr(13), '')) AS characters, len(regexp_extract_all(text, '[^\\s]+')) AS words, turn % 3 AS blocks FROM conversations)
SELECT conv_id, CAST(sum(characters) AS BIGINT) AS characters, CAST(sum(words) AS BIGINT) AS words, CAST(sum(blocks) AS BIGINT) AS text_blocks, CAST(0 AS BIGINT) AS images,
  round(avg(blocks * 0.25), 6) AS text_coverage, 0.0::DOUBLE AS image_coverage, 0.0::DOUBLE AS largest_image_coverage FROM p GROUP BY 1
""")
def page_to_document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages, measured and summed up to documents."""
    quarter = F.expr("named_struct('l', 0D, 't', 0D, 'r', 306D, 'b', 396D)")
    boxes = F.array_repeat(quarter, (F.col("turn") % 3).cast("int"))
    none = F.expr(f"cast(array() as array<{S.BOX}>)")
    pages = table(spark, sf_dir, "conversations").select(
        "conv_id", P.page_metrics(F.col("text"), boxes, none, F.lit(612.0), F.lit(792.0)).alias("m")
    )
    found = P.document_metrics(pages.select("conv_id", "m.*"), "conv_id")
    return found.withColumn("text_coverage", F.round("text_coverage", 6))


@query("""
WITH p AS (SELECT user_id, event_id, event_type, CASE event_type WHEN 'error' THEN CASE WHEN value > 50 THEN 'failed' ELSE 'partial' END ELSE 'success' END AS status,
  CASE WHEN event_type = 'signup' AND value > 50 THEN 1 ELSE 0 END AS missing FROM events),
v AS (SELECT *, CASE WHEN status = 'failed' THEN 'ERROR' WHEN missing > 0 THEN 'INVALID' WHEN event_type = 'view' THEN 'RENDER_ERROR' WHEN event_type = 'click' THEN 'PARTIAL'
   WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'PARTIAL' ELSE 'VALID' END AS validation FROM p)
SELECT user_id, CASE WHEN bool_and(status = 'success') THEN 'success' WHEN bool_or(status IN ('success', 'partial')) THEN 'partial' ELSE 'failed' END AS status,
  CASE WHEN user_id % 10 = 0 THEN 'ERROR' WHEN user_id % 10 = 1 OR count(*) <> max(CASE WHEN user_id % 10 = 2 THEN -1 ELSE (SELECT count(*) FROM events e WHERE e.user_id = v.user_id) END) THEN 'INVALID'
       WHEN bool_or(validation IN ('ERROR', 'INVALID')) THEN 'INVALID' WHEN bool_or(validation <> 'VALID') THEN 'PARTIAL' ELSE 'VALID' END AS validation
FROM v GROUP BY user_id
""")
def document_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and validation of documents by those of their pages."""
    kind, value, user = F.col("event_type"), F.col("value"), F.col("user_id")
    errors = (
        F.when(kind == "view", F.array(F.lit("RENDER_ERROR"), F.lit("RENDER_ERROR")))
        .when(kind == "click", F.array(F.lit("RENDER_ERROR"), F.lit("TEXT_EXTRACTION_ERROR")))
        .when((kind == "purchase") & (F.col("event_id") % 2 == 0), F.array(F.lit("PAGE_EXTRACTION_ERROR")))
        .otherwise(F.expr("cast(array() as array<string>)"))
    )
    failed = P.page_outcome(F.when(kind == "error", 1).otherwise(0), F.when(value > 50, 0).otherwise(1))
    missing = F.when((kind == "signup") & (value > 50), 1).otherwise(0)
    pages = table(spark, sf_dir, "events").withColumn("status", failed).withColumn("validation", P.page_validation(F.col("status"), missing, errors)).withColumn("document_errors", F.lit(0))
    outcome = P.document_outcome(pages, "user_id")
    counted = pages.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    checked = pages.select("user_id", "validation").join(counted, "user_id").select(
        "user_id", "validation", F.when(user % 10 == 0, "failed").otherwise("a").alias("status"), F.when(user % 10 == 1, 1).otherwise(0).alias("missing"),
        F.when(user % 10 == 2, -1).otherwise(F.col("n")).alias("page_count"),
    )
    return outcome.join(P.document_validation(checked, "user_id"), "user_id")


@query("""
SELECT page_id, 'out/' || regexp_replace(path, '\\.[^./]+$', '') AS folder FROM (SELECT page_id, 'd' || page_id % 7 || '/f.' || page_id || '.pdf' AS path FROM pages)
""")
def mirrored_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output folder of each input, mirroring where it stood."""
    path = F.format_string("/in/d%d/f.%d.pdf", F.col("page_id") % 7, F.col("page_id"))
    return table(spark, sf_dir, "pages").select("page_id", files.mirrored(path, "/in", "out").alias("folder"))


@query("""
SELECT status, CAST(count(*) AS BIGINT) AS files, count(*) FILTER (failed) AS failed, count(*) FILTER (NOT failed) AS succeeded,
  CASE WHEN count(*) FILTER (failed) > 0 THEN 1 ELSE 0 END AS exit_code
FROM (SELECT o_orderpriority AS status, o_orderstatus = 'F' OR o_totalprice > 400000 AS failed FROM orders) GROUP BY 1
""")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's files, how many did well, and the exit code that says whether all did."""
    bad = (F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 400000)
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("status")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(bad).alias("failed"), F.count_if(~bad).alias("succeeded"), F.max(F.when(bad, 1).otherwise(0)).alias("exit_code")
    )


@query(f"""
WITH {_RUNS} SELECT stage, stage || ':' || page_number AS stage_id, count(*) AS documents FROM runs GROUP BY ALL
""")
def stage_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages by the id that names them on their page."""
    rows = runs(spark, sf_dir)
    return rows.groupBy("stage", identity.stage_id(F.col("stage"), F.col("page_number")).alias("stage_id")).agg(F.count(F.lit(1)).alias("documents"))
