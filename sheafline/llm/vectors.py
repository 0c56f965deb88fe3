"""Vectors as rows of bytes, and k-means over bounded samples, shared by the embedding operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a k-means fit sees at most; they are those of the smallest hashes, the same on every run.
FIT_ROWS = 20_000


def tagged(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id long, vec array<double>, takes_part boolean) of every row: a row takes part if its id is not null
    and its vector has no null or non-finite component, is not all zero, and is of the commonest dimension
    among such rows (of two as common, the larger)."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.col("id").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0)
    common = rows.where(sound).groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.withColumn("takes_part", F.coalesce(sound & (F.size("vec") == (common["d"] if common else 0)), F.lit(False)))


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id long, vec array<double>) of the rows that take part, as ``tagged`` has it."""
    return tagged(vectors, id_column, vector_column).where("takes_part").select("id", "vec")


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """The rows of a list<double> column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def stored_type(vectors: DataFrame, vector_column: str = "embedding") -> str:
    """The numpy type that holds a column's components without loss: what moves is as wide as that."""
    return "f4" if vectors.schema[vector_column].dataType.elementType.typeName() == "float" else "f8"


def packed(rows: np.ndarray, kind: str = "f8") -> pa.Array:
    """The rows of a matrix as a column of bytes."""
    rows = np.ascontiguousarray(rows, kind)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, dimension: int, kind: str = "f8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dimension).astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component goes first, so no square overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def fit_sample(rows: DataFrame, limit: int = FIT_ROWS) -> np.ndarray:
    """At most ``limit`` vectors by the smallest hash of their ids, as a matrix on the driver."""
    found = rows.select("vec").orderBy(F.xxhash64("id", F.lit(7)), "id").limit(limit).toArrow().column("vec")
    if not len(found):
        return np.empty((0, 0))
    return matrix(found, len(found[0]))


def kmeans(rows: np.ndarray, k: int, spherical: bool, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """At most k centres of a sample, by Lloyd's rounds from distinct sample rows."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(rows, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        scores = rows @ centres.T
        if not spherical:
            scores -= 0.5 * (centres * centres).sum(1)
        home = scores.argmax(1)
        order = np.argsort(home, kind="stable")
        kinds, first = np.unique(home[order], return_index=True)
        centres[kinds] = np.add.reduceat(rows[order], first, axis=0)
        if spherical:
            norms = np.sqrt((centres * centres).sum(1, keepdims=True))
            keep = norms[:, 0] > 1e-12
            centres = centres[keep] / norms[keep]
        else:
            centres[kinds] /= np.diff([*first, len(order)])[:, None]
    return centres


def batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
