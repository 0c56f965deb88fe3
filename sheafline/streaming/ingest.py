"""Streams: files as they arrive, stage states as they change, answers as their pieces come."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sheafline.operators import state
from sheafline.plans import schema as S
from sheafline.sources import files
from sheafline.sources.scratch import Scratch


def arriving_files(spark: SparkSession, folder: str, suffixes: Sequence[str]) -> DataFrame:
    """New files of a folder as a stream of described inputs."""
    globs = "{" + ",".join(f"*.{s.lstrip('.')}" for s in suffixes) + "}"
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", globs).option("recursiveFileLookup", "true")
    return files.described_inputs(stream.load(folder))


def once(work: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """A stream of work without what came under the same key within the delay."""
    return work.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def stage_counts(runs: DataFrame, at: str, window: str, delay: str) -> DataFrame:
    """Stage runs a window and state; runs later than the delay are dropped."""
    return runs.withWatermark(at, delay).groupBy(F.window(at, window), "stage", "status").agg(F.count(F.lit(1)).alias("runs"))


def document_states(runs: DataFrame) -> DataFrame:
    """The folded state of each document's stages, told again whenever it changes.

    runs: (document_id, page_number, stage, status). The group's state holds the strongest status of
    each stage, of which there are four.
    """
    rank = {s: i for i, s in enumerate(S.STATE_PRIORITY)}

    def fold(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        stages = list(held.get) if held.exists else [None] * len(S.STAGES)
        for frame in frames:
            for stage, status in zip(frame["stage"], frame["status"]):
                i = S.STAGES.index(stage)
                if stages[i] is None or rank[status] < rank[stages[i]]:
                    stages[i] = status
        held.update(tuple(stages))
        yield pd.DataFrame([(key[0], *stages)], columns=["document_id", *S.STAGES])

    columns = ", ".join(f"{s} string" for s in S.STAGES)
    return runs.groupBy("document_id").applyInPandasWithState(
        fold, f"document_id string, {columns}", columns, "update", GroupStateTimeout.NoTimeout
    )


def run_available(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what there is now and return its result; for tests and catch-up runs."""
    spark = stream.sparkSession
    scratch = Scratch(spark, "stream")
    if mode == "append":
        out, checkpoint = scratch.path(), scratch.path()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    out, checkpoint = scratch.path(), scratch.path()

    def publish(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    query = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def fold_batch(runs: DataFrame) -> DataFrame:
    """What ``document_states`` ends with, as a batch."""
    folded = state.fold(runs, ["document_id", "stage"])
    return folded.groupBy("document_id").pivot("stage", list(S.STAGES)).agg(F.first("status"))
