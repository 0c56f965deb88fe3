"""What the operators share: scratch tables, ranks that need no single task, Arrow runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.sources.scratch import Scratch, drop

__all__ = ["Forest", "Scratch", "drop", "ranked", "runs", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked(df: DataFrame, key: str, order: list[str], rows: int, name: str = "rank") -> DataFrame:
    """Add the rank (long, from 0, gapless) of each row among the rows of its key.

    A key may hold any share of the rows: rows are dealt to buckets by a hash of the order columns,
    each bucket is ranked by itself, and the buckets' counts give where each starts.
    """
    buckets = max(16, min(4096, rows // 200_000))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_within", F.row_number().over(within))
        .join(starts, [key, "_bucket"])
        .withColumn(name, (F.col("_start") + F.col("_within") - 1).cast("long"))
        .drop("_bucket", "_start", "_within")
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in sorted batches, each run whole, however the batches cut it.

    Only one run and one batch are held at a time; callers bound the length of a run.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        if held:
            change[0] = any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns))
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        first = starts[0] if len(starts) else batch.num_rows
        if first:
            held.append(batch.slice(0, first))
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(lo, hi - lo)]
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1 whose roots are the smallest members, joined by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            open_ = a != b
            if not open_.any():
                return
            lo, hi = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(self.root, hi, lo)
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up
            a, b = lo, hi
