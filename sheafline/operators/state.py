"""Durable state of stages: reuse, invalidation, folds, retries, claims, plans and traces.

State is a table with a row for each (document_id, page_number, stage); every operator takes rows and
returns rows, and a caller publishes them by overwriting the partitions that they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions import identity
from sheafline.operators import routing
from sheafline.plans import schema as S

TERMINAL = ("SUCCESS", "REUSED", "SKIPPED", "FAILED", "INVALIDATED")
DONE = ("SUCCESS", "REUSED")


def closure(graph: dict[str, tuple[str, ...]], start: str, downstream: bool = True) -> tuple[str, ...]:
    """All that depends on a node, or all that it depends on, in the graph's own order."""
    if start not in graph:
        raise ValueError(f"unknown stage {start!r}")
    found = {start}
    while True:
        more = {n for n, needs in graph.items() if found & set(needs)} if downstream else {d for n in found for d in graph[n]}
        if more <= found:
            return tuple(n for n in graph if n in found and n != start)
        found |= more


def stage_edges(spark: SparkSession) -> DataFrame:
    """(stage, needs): the stages' graph as a table."""
    rows = [(s, n) for s, needs in S.STAGE_NEEDS.items() for n in needs]
    return spark.createDataFrame(rows, "stage string, needs string")


def stage_closure(spark: SparkSession) -> DataFrame:
    """(stage, dependent): every stage with all that stands on it. A handful of rows."""
    rows = [(s, d) for s in S.STAGE_NEEDS for d in closure(S.STAGE_NEEDS, s)]
    return spark.createDataFrame(rows, "stage string, dependent string")


def missing_artifacts(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Declared artifacts that aren't there: an anti join. present: (keys, size); empty ones are missing."""
    return declared.join(present.where("size > 0").select(*keys), keys, "left_anti")


def verified_stages(outputs: DataFrame, present: DataFrame) -> DataFrame:
    """(stage_id, verified): whether each output of a stage is there and has its recorded digest, where
    one was recorded. outputs: (stage_id, path, sha256); present: (path, sha256)."""
    there = present.select("path", F.col("sha256").alias("_now"))
    good = F.col("_now").isNotNull() & F.coalesce(F.col("_now") == F.col("sha256"), F.lit(True))
    return outputs.join(there, "path", "left").groupBy("stage_id").agg(F.bool_and(good).alias("verified"))


def reusable(stages: DataFrame, current: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """Rows of stages whose result still stands: done, under the key that the current configuration
    gives, outputs verified. current: (stage_id, processing_key); verified: (stage_id, verified)."""
    found = stages.where(F.col("status").isin(*DONE)).join(current, ["stage_id", "processing_key"], "left_semi")
    if verified is not None:
        found = found.join(verified.where("verified"), "stage_id", "left_semi")
    return found


def invalidate(stages: DataFrame, changed: DataFrame) -> DataFrame:
    """stages with each done stage that stands on a changed one INVALIDATED.

    changed: (document_id, page_number, stage, cause); a null page_number reaches every page.
    """
    spark = stages.sparkSession
    hit = changed.join(F.broadcast(stage_closure(spark)), "stage").select(
        "document_id", F.col("page_number").alias("_page"), F.col("dependent").alias("stage"), "cause"
    )
    by_page = hit.where("_page is not null").groupBy("document_id", "_page", "stage").agg(F.min("cause").alias("_one"))
    by_document = hit.where("_page is null").groupBy("document_id", "stage").agg(F.min("cause").alias("_all"))
    marked = (
        stages.join(by_document, ["document_id", "stage"], "left")
        .join(by_page.withColumnRenamed("_page", "page_number"), ["document_id", "page_number", "stage"], "left")
        .withColumn("_cause", F.coalesce("_one", "_all"))
    )
    stale = F.col("_cause").isNotNull() & F.col("status").isin(*DONE) & F.col("page_number").isNotNull()
    return marked.select(
        *[
            F.when(stale, "INVALIDATED").otherwise(F.col(c)).alias(c)
            if c == "status"
            else F.when(stale, F.col("_cause")).otherwise(F.col(c)).alias(c)
            if c == "reason"
            else F.col(c)
            for c in stages.columns
        ]
    )


def force(stages: DataFrame, forced: list[str]) -> DataFrame:
    """Invalidate, on every page, what stands on a forced stage; an unknown stage is an error."""
    for stage in forced:
        closure(S.STAGE_NEEDS, stage)
    each = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(f"forced:{s}").alias("cause")) for s in forced])
    changed = stages.select("document_id").distinct().select("document_id", F.lit(None).cast("int").alias("page_number"), F.inline(each))
    return invalidate(stages, changed)


def priority(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in S.STATE_PRIORITY]), status)


def fold(stages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): the state that speaks for a group of stages."""
    return stages.groupBy(*keys).agg(F.min_by("status", priority(F.col("status"))).alias("status"))


def page_status(stages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): FAILED if any stage is, SUCCESS if any is done, SKIPPED if all are, else null."""
    is_ = lambda *s: F.col("status").isin(*s)
    state = (
        F.when(F.bool_or(is_("FAILED")), "FAILED")
        .when(F.bool_or(is_(*DONE)), "SUCCESS")
        .when(F.bool_and(is_("SKIPPED")), "SKIPPED")
    )
    return stages.groupBy(*keys).agg(state.alias("status"))


def document_status(pages: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, status) of documents from page rows (key, status) and documents (key, review, stop_after).

    REVIEW_REQUIRED sticks; a document without pages has FAILED; one that stops before the last stage is
    PAUSED; failed pages make it PARTIAL beside good ones, else FAILED; all others are a SUCCESS.
    """
    found = pages.groupBy(key).agg(
        F.bool_or(F.col("status") == "FAILED").alias("_failed"), F.bool_or(F.col("status") == "SUCCESS").alias("_good")
    )
    state = (
        F.when(F.coalesce("review", F.lit(False)), "REVIEW_REQUIRED")
        .when(F.col("_failed").isNull() & F.col("_good").isNull(), "FAILED")
        .when(F.coalesce(F.col("stop_after") != S.STAGES[-1], F.lit(False)), "PAUSED")
        .when(F.coalesce("_failed", F.lit(False)), F.when(F.coalesce("_good", F.lit(False)), "PARTIAL").otherwise("FAILED"))
        .otherwise("SUCCESS")
    )
    return documents.join(found, key, "left").select(key, state.alias("status"))


def execution_summary(stages: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, states map<stage, status>, reused, skipped): folded over a document's pages."""
    folded = fold(stages, [key, "stage"])
    named = lambda s: F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("stage"))))
    return folded.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "status")))).alias("states"),
        named("REUSED").alias("reused"),
        named("SKIPPED").alias("skipped"),
    )


def error_outcome(retry_failed: Column, attempts: Column) -> Column:
    """What follows a stage's failure; whether the error could be recovered from isn't asked."""
    return F.when(retry_failed & (attempts < S.STAGE_ATTEMPTS), "retry processor").otherwise("REVIEW_REQUIRED")


def create_stages(pages: DataFrame, options: Column, key: Column, processor: Column, version: Column) -> DataFrame:
    """A NOT_STARTED row for each page and stage. pages: (document_id, page_number)."""
    stage = F.explode(F.array(*[F.lit(s) for s in S.STAGES]))
    rows = pages.select("document_id", "page_number", stage.alias("stage"))
    null = lambda kind: F.lit(None).cast(kind)
    return rows.select(
        "document_id",
        "page_number",
        "stage",
        identity.stage_id(F.col("stage"), F.col("page_number")).alias("stage_id"),
        processor.alias("processor"),
        version.alias("processor_version"),
        F.lit("NOT_STARTED").alias("status"),
        key.alias("processing_key"),
        identity.digest(options).alias("options_hash"),
        F.lit(0).alias("attempts"),
        null("timestamp").alias("started_at"),
        null("timestamp").alias("finished_at"),
        null("string").alias("reason"),
        null("string").alias("owner"),
        null("string").alias("error"),
    )


def set_status(stages: DataFrame, where: Column, status: str, reason: Column | None = None) -> DataFrame:
    """Rows that ``where`` picks move to a state; SKIPPED and REUSED need a reason, an end is stamped."""
    if status not in S.STAGE_STATES:
        raise ValueError(f"unknown state {status!r}")
    if status in ("SKIPPED", "REUSED") and reason is None:
        raise ValueError(f"{status} needs a reason")
    stamp = F.current_timestamp()
    moved = stages.withColumn("_go", F.coalesce(where, F.lit(False)))
    put = {"status": F.lit(status)}
    if reason is not None:
        put["reason"] = reason
    if status == "RUNNING":
        put["started_at"] = stamp
    if status in TERMINAL:
        put["finished_at"] = stamp
    return moved.select(*[F.when(F.col("_go"), put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in stages.columns])


def claim(stages: DataFrame, owner: str) -> DataFrame:
    """READY rows that nobody else owns go to the owner, RUNNING, with one attempt more."""
    free = (F.col("status") == "READY") & (F.col("owner").isNull() | (F.col("owner") == owner))
    put = {"status": F.lit("RUNNING"), "owner": F.lit(owner), "attempts": F.col("attempts") + 1, "started_at": F.current_timestamp()}
    return stages.select(*[F.when(free, put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in stages.columns])


def release(stages: DataFrame, owner: str) -> DataFrame:
    """The owner's RUNNING rows go back to READY."""
    held = (F.col("status") == "RUNNING") & (F.col("owner") == owner)
    put = {"status": F.lit("READY"), "owner": F.lit(None).cast("string")}
    return stages.select(*[F.when(held, put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in stages.columns])


def recover(stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RUNNING rows of a run that was cut off go back to READY, with a decision for each."""
    running = F.col("status") == "RUNNING"
    moved = stages.withColumn("owner", F.when(running, F.lit(None)).otherwise(F.col("owner")).cast("string")).withColumn(
        "status", F.when(running, "READY").otherwise(F.col("status"))
    )
    told = stages.where(running).select(
        "document_id", "page_number", "stage", F.lit("WAIT").alias("action"), F.lit("recovered_after_interruption").alias("reason"),
        F.current_timestamp().alias("at"),
    )
    return moved, told


def execution_plan(pages: DataFrame, policy: Column, key: Column, reusable_stages: DataFrame, prior: DataFrame, source_ready: Column) -> DataFrame:
    """(document_id, page_number, stage, action, reason): what each stage of each page would do.

    A stage's input is there if its source is ready or a stage before it, on the same page, is planned to
    run or to be reused. pages: (document_id, page_number, skip_reason map<stage, reason>).
    """
    stages = pages.select("*", F.posexplode(F.array(*[F.lit(s) for s in S.STAGES])).alias("nth", "stage"))
    same = ["document_id", "page_number", "stage"]
    joined = (
        stages.withColumn("processing_key", key)
        .join(reusable_stages.select(*same, F.lit(True).alias("_reusable")), same, "left")
        .join(prior.select(*same, F.col("status").alias("_prior")), same, "left")
    )
    action = routing.resolve_stage(
        F.col("stage"), policy["skip_stages"], policy["force_stages"], F.element_at("skip_reason", F.col("stage")),
        F.coalesce(F.col("_prior") == "FAILED", F.lit(False)), policy["retry_failed"], F.lit(True), F.coalesce("_reusable", F.lit(False)),
        policy["reuse_successful"], policy["start_from_stage"],
    )
    told = joined.withColumn("_go", action).withColumn("_ready", source_ready)
    whole = told.groupBy("document_id", "page_number").agg(
        F.array_sort(F.collect_list(F.struct("nth", "stage", "_go", "_ready"))).alias("_plan")
    )
    # In order: a stage whose source isn't ready needs one before it that gives something.
    gives = lambda s: s["_go"]["action"].isin("EXECUTE", "FORCE", "REUSE")

    def step(held: Column, s: Column) -> Column:
        starved = ~s["_ready"] & ~held["given"] & gives(s) & (s["_go"]["action"] != "REUSE")
        go = F.when(starved, F.struct(F.lit("BLOCKED").alias("action"), F.lit("input_unavailable").alias("reason"))).otherwise(s["_go"])
        row = F.struct(s["stage"].alias("stage"), go["action"].alias("action"), go["reason"].alias("reason"))
        return F.struct((held["given"] | (gives(s) & ~starved)).alias("given"), F.concat(held["out"], F.array(row)).alias("out"))

    start = F.struct(F.lit(False).alias("given"), F.expr("cast(array() as array<struct<stage:string,action:string,reason:string>>)").alias("out"))
    plan = F.aggregate("_plan", start, step, lambda h: h["out"])
    return whole.select("document_id", "page_number", F.inline(plan))


def trace(document_rows: DataFrame, page_rows: DataFrame) -> DataFrame:
    """Decisions or errors of documents, then of pages, one under the other."""
    return document_rows.unionByName(page_rows, allowMissingColumns=True)


# --- Records --------------------------------------------------------------------------------------


def to_payload(rows: DataFrame, key: str) -> DataFrame:
    """(key, payload): each row as one deterministic JSON record, nulls kept."""
    return rows.select(key, F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("payload"))


def from_payload(payloads: DataFrame, ddl: str) -> DataFrame:
    """Records read back by their schema; one that doesn't fit fails the job."""
    return payloads.select(F.from_json("payload", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def create_documents(requests: DataFrame) -> DataFrame:
    """A PAUSED row for each request (document_id, path, declared, input_sha256), with a run id."""
    return requests.select(
        "document_id", "path", routing.input_type(F.col("path"), F.col("declared"), F.lit(True)).alias("input_type"), F.col("input_sha256").alias("input_hash"),
        identity.run_id().alias("workflow_run_id"), F.lit("PAUSED").alias("status"), F.lit(None).cast("string").alias("final_result"),
    )


def create_pages(documents: DataFrame) -> DataFrame:
    """A row for each page of documents (document_id, page_count), every artifact still null."""
    number = F.explode(F.sequence(F.lit(1), F.col("page_count")))
    rows = documents.where("page_count > 0").select("document_id", number.alias("page_number"))
    return rows.select("*", F.lit("NOT_STARTED").alias("status"), *[F.lit(None).cast("string").alias(a) for a in S.PAGE_ARTIFACTS])


def matching_state(saved: DataFrame, graph_id: str, version: str) -> DataFrame:
    """Saved graph states of this graph and version; one of another is an error that names it."""
    other = (F.col("graph_id") != graph_id) | (F.col("graph_version") != version)
    wrong = F.concat(F.lit("DEPENDENCY_ERROR: the saved state is of "), "graph_id", F.lit(" "), "graph_version")
    return saved.withColumn("graph_id", F.when(other, F.raise_error(wrong).cast("string")).otherwise(F.col("graph_id")))


def describe_failure(error_type: Column, message: Column, recoverable: Column) -> Column:
    """struct<type, message, recoverable>: a failure always has a kind, also where a processor names none."""
    none = error_type.isNull()
    return F.struct(
        F.coalesce(error_type, F.lit("INTERNAL_ERROR")).alias("type"),
        F.when(none, "the processor reported failure without a typed error").otherwise(message).alias("message"),
        F.when(none, False).otherwise(recoverable).alias("recoverable"),
    )


def final_results(pages: DataFrame) -> DataFrame:
    """(document_id, final_result): what the pages of documents came to, in their order, as JSON. pages:
    (document_id, page_number, source, strategy, value, JSON text)."""
    string = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    page = F.concat(
        F.lit('{"extraction_strategy":'), string(F.col("strategy")), F.lit(',"page_number":'), F.col("page_number").cast("string"), F.lit(',"result":'), F.coalesce("value", F.lit("null")),
        F.lit(',"selected_source":'), string(F.col("source")), F.lit("}"),
    )
    rows = F.array_sort(F.collect_list(F.struct("page_number", page.alias("page"))))
    told = F.array_join(F.transform(rows, lambda r: r["page"]), ",")
    return pages.groupBy("document_id").agg(F.concat(F.lit('{"pages":['), told, F.lit("]}")).alias("final_result"))
