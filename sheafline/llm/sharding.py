"""Sharding as vector bin packing over bytes, tokens and rows.

Rows of equal texts are a group and stay together. A group that needs more than a SPLIT part of a shard
in any measure is cut into equal parts by a hash of the row's number; groups of under a FINE part are put
together, by a hash of the text, into BUNDLES bundles a shard. So the driver places a number of units
that the number of shards bounds, whatever the corpus holds: largest first, each where the dot product
of its measures with the shard's residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch, ranked

SHARDS = 40
SPLIT = 1 / 4
FINE = 1 / 256
BUNDLES = 512
#: Bytes that a row takes beside its text.
ROW_BYTES = 16
MEASURES = ("bytes", "tokens", "rows")


def place(units: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit. units: a row of measures for each, in parts of a shard's capacity."""
    found, room = np.zeros(len(units), np.int64), np.ones((shards, units.shape[1]))
    for i in np.argsort(-units.max(1), kind="stable"):
        found[i] = (room @ units[i]).argmax()
        room[found[i]] -= units[i]
    return found


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size long, text_crc32 long, law 'bytes', shard int, slot long, grown_shard null: a row a row.

    size is the text's UTF-8 bytes (null: none) plus ROW_BYTES; tokens are its words. slot is gapless
    from 0 in each shard. A null text is in one group with empty ones. Repeated rows and rows with a
    null doc_id are placed like any other; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce("text", F.lit(""))
    rows = scratch.table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit("\\S+")).cast("long").alias("tokens"),
            F.xxhash64(text).alias("key"),
            # Fixed once it is written; ids may be null or repeat in very many rows.
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = rows.groupBy("key").agg(*sums)
    total = rows.agg(*sums).first()
    # Of a shard's capacity; a measure that is zero everywhere takes no part.
    share = {m: max(total[m] or 0, 1) / shards for m in MEASURES}
    part = F.greatest(*[F.col(m) / F.lit(share[m]) for m in MEASURES])
    # Few rows: at most 3 * shards / FINE groups can be this large.
    large = groups.where(part > FINE).select("key", F.when(part > SPLIT, F.ceil(part / SPLIT)).otherwise(1).cast("int").alias("cuts"))
    large = spark.createDataFrame(large.collect(), "key long, cuts int")
    cut = F.col("cuts").isNotNull()
    dealt = (
        rows.join(F.broadcast(large), "key", "left")
        .withColumn("cut", F.when(cut, F.pmod(F.xxhash64("row"), F.col("cuts"))).otherwise(-1).cast("int"))
        .withColumn("unit", F.when(cut, F.col("key")).otherwise(F.pmod("key", F.lit(shards * BUNDLES))))
    )
    units = dealt.groupBy("unit", "cut").agg(*sums).orderBy("unit", "cut").collect()
    found = place(np.array([[u[m] / share[m] for m in MEASURES] for u in units]).reshape(-1, len(MEASURES)), shards)
    homes = spark.createDataFrame([(u["unit"], u["cut"], int(s)) for u, s in zip(units, found)], "unit long, cut int, shard int")
    placed = dealt.join(F.broadcast(homes), ["unit", "cut"]).select("doc_id", "size", "text_crc32", "shard", "row")
    return ranked(placed, "shard", ["doc_id", "text_crc32", "size", "row"], total["rows"] or 0, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
