"""Connected components over links that may number as many as the rows.

Alternating large-star and small-star rounds: every round is two aggregates with map-side partial
sums and two equi-joins that Spark may split where a node has very many links. The links of a round
are written to the shared folder, so a lost executor costs one round, and the driver sees only a
count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch, drop


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links(u, v) of any orientation, repeats and self-links allowed -> (node, component).

    component is the smallest node reachable. Nodes without a link to another node are left out;
    links with a null end are ignored.
    """
    spark = links.sparkSession
    held, path = scratch.write(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        row = held.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if row["n"] == 0 or (row["n"], row["h"]) == seen:
            return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = (row["n"], row["h"])
        grown, at = scratch.write(_small_star(_large_star(held)))
        drop(spark, path)
        held, path = grown, at
