"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one row kept of each group.

No link is lost at a cell's edge. For unit vectors x and y with cosine t or more, let x's home be
centre c and y's home centre d. As y is no nearer to c than to d, x is within sin(arccos t)*|c - d| of
the plane between them, and the same holds for y seen from c. So a pair of cells compares only the
vectors on either side that are near enough to the plane between, and every pair at or over the
threshold meets in exactly one block.

Equal vectors are one class with a weight before anything is compared. A cell is cut into blocks of a
bounded size, so a task holds two blocks whatever a cell holds. A block product returns each vector's
weighted number of links and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Forest, Scratch, runs
from sheafline.llm.components import connected_components
from sheafline.llm.vectors import batches_of, fit_sample, kmeans, matrix, packed, stored_type, tagged, unit, unpacked

THRESHOLD = 0.95
BLOCK_ROWS = 16_384
#: The most cells: centres and their distances stay under 10 MB on each executor.
MAX_CELLS = 1024


def _assign(centres: np.ndarray, blocks: list[int], threshold: float, kind: str):
    """Each class goes to every pair of blocks in which it can have a link."""
    starts = np.concatenate([[0], np.cumsum(blocks)])
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    reach = np.sqrt(1 - threshold * threshold) + 1e-9
    names = ["a", "b", "side", "id", "weight", "vec"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 512):
            if not batch.num_rows:
                continue
            original = matrix(batch.column("vec"), centres.shape[1])
            scores = unit(original) @ centres.T
            home = scores.argmax(1)
            near = scores[np.arange(len(scores)), home][:, None] - scores <= reach * apart[home] + 1e-12
            near[np.arange(len(scores)), home] = True
            row, cell = np.nonzero(near)
            many = np.asarray(blocks)[cell]
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row, other = np.repeat(row, many), np.repeat(starts[cell], many) + at
            ids = batch.column("id").to_numpy()
            own = starts[home] + _block(ids, np.asarray(blocks)[home])
            mine = own[row]
            column = packed(original, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.minimum(mine, other)),
                    pa.array(np.maximum(mine, other)),
                    pa.array((mine > other).astype(np.int32)),
                    pa.array(ids[row]),
                    batch.column("weight").take(pa.array(row)),
                    column.take(pa.array(row)),
                ],
                names,
            )

    return scan


def _block(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """A block for each id by a mixing hash."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int64)


def _home_counts(centres: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(centres), np.int64)
        for batch in batches_of(batches, 4096):
            if batch.num_rows:
                rows = unit(matrix(batch.column("vec"), centres.shape[1]))
                found += np.bincount((rows @ centres.T).argmax(1), minlength=len(centres))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), pa.array(found)], ["cell", "n"])

    return scan


def _compare(dimension: int, threshold: float, kind: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["a", "b"]):
            ids, weight = run.column("id").to_numpy(), run.column("weight").to_numpy()
            rows = unit(unpacked(run.column("vec"), dimension, kind))
            one = run.column("a")[0].as_py() == run.column("b")[0].as_py()
            side = run.column("side").to_numpy()
            left = np.arange(len(ids)) if one else np.flatnonzero(side == 0)
            right = left if one else np.flatnonzero(side == 1)
            forest, links = Forest(len(ids)), np.zeros(len(ids), np.int64)
            other = rows[right].T
            for at in range(0, len(left) if len(right) else 0, 256):
                part = left[at : at + 256]
                i, j = np.nonzero(rows[part] @ other >= threshold)
                i, j = part[i], right[j]
                i, j = i[i != j], j[i != j]
                np.add.at(links, i, weight[j])
                if not one:
                    np.add.at(links, j, weight[i])
                forest.join(i, j)
            linked = np.flatnonzero(links)
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[forest.root[linked]])],
                    ["id", "links", "root"],
                )

    return scan


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id long, n_links long, component_id long, kept boolean: a row for each row of vectors.

    Links join vectors of cosine ``threshold`` or more, all of them. Null, zero and non-finite vectors,
    vectors with a null component, of another dimension than most or with a null id link with nothing
    (n_links 0, component_id their own id, kept), also where another row of the same id has a usable vector.
    Repeated rows are vectors of their own that link with each other, and each returns. Other columns are not
    read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    every = tagged(vectors, id_column, vector_column)
    rows = every.where("takes_part").select("id", "vec")
    classes = scratch.table(rows.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")))
    rest = every.where("not takes_part").select(
        F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    sample = fit_sample(classes)
    if not len(sample):
        return rest.withColumn("kept", F.lit(True))
    total = classes.count()
    centres = kmeans(unit(sample), int(min(MAX_CELLS, max(1, -(-total // block_rows)))), spherical=True)
    found = classes.select("vec").mapInArrow(_home_counts(centres), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = {r["cell"]: r["n"] for r in found.collect()}
    blocks = [max(1, -(-counts.get(c, 0) // block_rows)) for c in range(len(centres))]
    dimension, kind = centres.shape[1], stored_type(vectors, vector_column)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(blocks) * (sum(blocks) + 1) // 2, 10_000))
    sent = classes.mapInArrow(
        _assign(centres, blocks, threshold, kind), "a long, b long, side int, id long, weight long, vec binary"
    )
    compared = scratch.table(
        sent.repartition(parts, "a", "b")
        .sortWithinPartitions("a", "b", "id")
        .mapInArrow(_compare(dimension, threshold, kind), "id long, links long, root long")
    )
    components = connected_components(compared.select(F.col("id").alias("u"), F.col("root").alias("v")), scratch)
    linked = compared.groupBy("id").agg(F.sum("links").alias("links"))
    told = (
        classes.join(linked, "id", "left")
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("vec").alias("_vec"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("_links"),
            F.coalesce("component", "id").alias("_component"),
        )
    )
    members = rows.join(told, rows["vec"] == told["_vec"]).select(F.col("id"), "_links", "_component")
    return (
        members.select(F.col("id").alias("vec_id"), F.col("_links").alias("n_links"), F.col("_component").alias("component_id"))
        .union(rest)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
