"""Queries that run as streams over what there is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.catalog.state import _PRIORITY, _STATES, _pick
from sheafline.plans import schema as S
from sheafline.plans.processors import latest
from sheafline.streaming import ingest


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of stage runs."""
    schema = table(spark, sf_dir, "events").schema
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    # As a pattern, since a stream's source may be one file here and a folder there.
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet")
    return rows.select(
        F.col("user_id").cast("string").alias("document_id"), (event % 6).cast("int").alias("page_number"), _pick(S.STAGES, F.floor(event / 6) % 4).alias("stage"),
        _pick(S.STAGE_STATES, k % 9).alias("status"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
    )


_ALL = f"""e AS (SELECT CAST(user_id AS VARCHAR) AS document_id, (['PDF','IMAGE','OCR','LLM'])[event_id // 6 % 4 + 1] AS stage,
  ({_STATES})[CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 9 AS INTEGER) + 1] AS status, ts FROM events)"""


@query(f"""
WITH {_ALL}, f AS (SELECT document_id, stage, arg_min(status, {_PRIORITY}) AS status FROM e GROUP BY ALL)
SELECT document_id, max(CASE WHEN stage = 'PDF' THEN status END) AS "PDF", max(CASE WHEN stage = 'IMAGE' THEN status END) AS "IMAGE",
  max(CASE WHEN stage = 'OCR' THEN status END) AS "OCR", max(CASE WHEN stage = 'LLM' THEN status END) AS "LLM" FROM f GROUP BY 1
""")
def streamed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded states of documents, kept as state while stage runs stream in; the last of each."""
    told = ingest.run_available(ingest.document_states(stream(spark, sf_dir)), "update")
    return latest(told, ["document_id"], "batch").drop("batch")


@query(f"""
WITH {_ALL} SELECT strftime(ts, '%Y-%m-%d') AS day, stage, status, count(*) AS runs FROM e GROUP BY ALL
""")
def streamed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage runs a day and state, counted over a stream with a watermark; the last of each window."""
    counts = ingest.stage_counts(stream(spark, sf_dir), "ts", "1 day", "400 days")
    told = ingest.run_available(counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "stage", "status", "runs"), "update")
    return latest(told, ["day", "stage", "status"], "batch").drop("batch")
