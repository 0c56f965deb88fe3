"""Nearest neighbours over a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and holds centres only; every row of the table is then filed
under its leaf by descent, in Spark. A query keeps a priority queue of the nodes that it has seen,
opens the nearest first, and so lists leaves in order. How many rows' worth of leaves it visits is
calibrated: queries among sample rows that the fit did not see are answered both ways, and the visits
widen until their recall reaches the target. The sample is sparser than the table, so its neighbours
lie farther off and its recall is the lower one.

Queries and rows meet by leaf: a leaf is cut into blocks of a bounded size, the queries that visit a
block stream past it, and each block returns its nearest for each query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch
from sheafline.llm.vectors import batches_of, fit_sample, kmeans, matrix, packed, unpacked, usable

NEIGHBOURS = 10
EVERY = 100
#: Of the true neighbours of held-out rows; the table's own recall comes out higher, as it is denser.
RECALL = 0.94
BRANCHES = 8
LEAF_ROWS = 64
BLOCK_ROWS = 8192
TURN_QUERIES = 65_536
CALIBRATION_QUERIES = 300


class Tree:
    """Centres by node; node 0 is the root. Children of a node are a slice; leaves are numbered."""

    def __init__(self, sample: np.ndarray, leaf_rows: int = LEAF_ROWS, branches: int = BRANCHES):
        self.centres = [sample.mean(0)]
        self.children: list[range] = [range(0)]
        self.members: dict[int, np.ndarray] = {}
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            kinds = []
            if len(rows) > leaf_rows:
                centres = kmeans(sample[rows], branches, spherical=False, seed=11 + node)
                home = _nearest(sample[rows], centres)
                kinds = [k for k in range(len(centres)) if (home == k).any()]
            if len(kinds) < 2:
                self.members[node] = rows
                continue
            first = len(self.centres)
            self.children[node] = range(first, first + len(kinds))
            for i, k in enumerate(kinds):
                self.centres.append(centres[k])
                self.children.append(range(0))
                todo.append((first + i, rows[home == k]))
        self.centres = np.array(self.centres)

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row, by descent to the nearest child."""
        node = np.zeros(len(rows), np.int64)
        todo = [0]
        while todo:
            here = todo.pop()
            below = self.children[here]
            if below:
                at = np.flatnonzero(node == here)
                if len(at):
                    node[at] = below.start + _nearest(rows[at], self.centres[below.start : below.stop])
                    todo += below
        return node

    def leaves(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first: a priority queue over the nodes seen so far."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield node
                continue
            gap = self.centres[below.start : below.stop] - query
            for child, far in zip(below, (gap * gap).sum(1).tolist()):
                heapq.heappush(queue, (far, child))

    def visits(self, query: np.ndarray, sizes: dict[int, int], share: float, least: int) -> list[int]:
        """The leaves that a query visits: until they hold ``share`` of all rows and ``least`` rows."""
        want, found, held = share * sum(sizes.values()), [], 0
        for leaf in self.leaves(query):
            found.append(leaf)
            held += sizes.get(leaf, 0)
            if held >= want and held > least:
                break
        return found


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)


def calibrate(tree: Tree, held: np.ndarray, neighbours: int, recall: float) -> float:
    """The least share of rows whose visits find ``recall`` of the true neighbours among rows that the
    tree was not fitted on."""
    leaf_of = tree.file(held)
    sizes = dict(zip(*(a.tolist() for a in np.unique(leaf_of, return_counts=True))))
    need = []
    for q in np.unique(np.linspace(0, len(held) - 1, CALIBRATION_QUERIES).astype(int)) if len(held) else ():
        gap = held - held[q]
        far = (gap * gap).sum(1)
        far[q] = np.inf
        near = np.argsort(far, kind="stable")[: min(neighbours, len(held) - 1)]
        count, seen = 0, {}
        for leaf in tree.leaves(held[q]):
            count += sizes.get(leaf, 0)
            seen[leaf] = count
        need += [seen[leaf_of[i]] for i in near]
    if not need:  # fewer than two rows held out: all leaves
        return 1.0
    return float(min(1.0, np.quantile(need, recall) / len(held)))


def _top(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and distances of the k rows nearest to the query, ties to the smaller id."""
    gap = rows - query
    far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    near = np.arange(len(ids))
    if len(ids) > k:
        near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
    order = near[np.lexsort((ids[near], far[near]))][:k]
    return ids[order], far[order]


def _meet(dimension: int, k: int):
    """Sorted rows: a block's vectors (kind 0), then the queries that visit it, which stream past."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("leaf", "block", "turn", "kind")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            out: list[tuple] = []
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if tuple(keys[lo, :3]) != key:
                    held, key = [], tuple(keys[lo, :3])
                part = batch.slice(lo, hi - lo)
                ids, vecs = part.column("id").to_numpy(), unpacked(part.column("vec"), dimension)
                if keys[lo, 3] == 0:
                    held.append((ids, vecs))
                elif held:
                    held = [tuple(np.concatenate(c) for c in zip(*held))]
                    out += [(np.full(len(near), q), near, far) for q, v in zip(ids, vecs) for near, far in [_top(*held[0], v, k)]]
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["asker", "vec_id", "score"])

    return scan


def _file(tree: Tree):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 4096):
            if batch.num_rows:
                rows = matrix(batch.column("vec"), tree.centres.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.file(rows)), batch.column("id"), packed(rows)], ["leaf", "id", "vec"]
                )

    return scan


def _ask(tree: Tree, sizes: dict[int, int], share: float, least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1024):
            if not batch.num_rows:
                continue
            vecs = matrix(batch.column("vec"), tree.centres.shape[1])
            visits = [tree.visits(v, sizes, share, least) for v in vecs]
            row = pa.array(np.repeat(np.arange(len(vecs)), [len(v) for v in visits]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(visits)), batch.column("asker").take(row), packed(vecs).take(row)],
                ["leaf", "id", "vec"],
            )

    return scan


def search(
    vectors: DataFrame,
    every: int = EVERY,
    neighbours: int = NEIGHBOURS,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id long, rank int (from 1), vec_id long, score double: the nearest found of each query.

    Queries are the rows whose id is divisible by ``every``, candidates every row of another id;
    nearness is Euclidean distance on the original vectors, ties go to the smaller id. Null, zero and
    non-finite vectors, vectors with a null component, of another dimension than most or with a null id
    take no part. A repeated row counts once; an id with several vectors asks for each of them, a ranking a
    vector, and rows of its own id are no candidates. Other columns are not read. An empty table, or one
    without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    rows = scratch.table(usable(vectors, id_column, vector_column).distinct())
    sample = fit_sample(rows)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Half of the sample, dealt by its hash order, is held out.
    tree = Tree(sample[::2])
    share = calibrate(tree, sample[1::2], neighbours, recall)
    # Of equal vectors only the smallest ids can be among the nearest, one more than asked for as the
    # query may be one of them; and equal queries are asked once.
    by_id = Window.partitionBy("vec").orderBy("id")
    useful = rows.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= neighbours + 1)
    filed = scratch.table(useful.mapInArrow(_file(tree), "leaf long, id long, vec binary"))
    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    # An id may have several vectors, so a vector's number, fixed once it is written, asks for it.
    askers = scratch.table(queries.select("vec").distinct().withColumn("asker", F.monotonically_increasing_id()))
    sizes = {r["leaf"]: r["count"] for r in filed.groupBy("leaf").count().collect()}
    total, asked = sum(sizes.values()), askers.count()
    # A row for each leaf of the tree, whose sample is bounded.
    cut = spark.createDataFrame([(leaf, -(-n // block_rows)) for leaf, n in sizes.items()], "leaf long, blocks int")
    turns = max(1, -(-int(asked * share) // TURN_QUERIES))
    shape = ["leaf", "block", "turn", "kind", "id", "vec"]
    left = (
        filed.join(F.broadcast(cut), "leaf")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        .withColumn("kind", F.lit(0))
        .select(*shape)
    )
    right = (
        askers.mapInArrow(_ask(tree, sizes, share, 4 * neighbours), "leaf long, id long, vec binary")
        .join(F.broadcast(cut), "leaf")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(turns)).cast("int"))
        .withColumn("kind", F.lit(1))
        .select(*shape)
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (
        left.union(right)
        .repartition(parts, "leaf", "block", "turn")
        .sortWithinPartitions("leaf", "block", "turn", "kind", "id")
        .mapInArrow(_meet(sample.shape[1], neighbours + 1), "asker long, vec_id long, score double")
    )
    nearest = Window.partitionBy("asker").orderBy("score", "vec_id")
    kept = found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= neighbours + 1)
    members = queries.join(askers, "vec").select(F.col("id").alias("query_id"), "asker")
    best = Window.partitionBy("query_id", "asker").orderBy("score", "vec_id")
    return (
        members.join(kept, "asker")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
