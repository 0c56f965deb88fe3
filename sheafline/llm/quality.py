"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's features are the hashes of its distinct words and of a few marks of its form, one weight
each, shared by all grades: P(grade <= k) = sigmoid(theta_k - score), with theta_0 < theta_1 < ... The
fit sees at most SAMPLE_ROWS labelled rows of each grade, those of the smallest hashes; it is full-batch
proximal Adagrad with an L1 penalty, so neutral words weigh nothing and long texts don't drift. Features
are counted by grade in Spark, and only those that FEWEST sample rows hold and whose slope at the start
outweighs the penalty reach the driver. Scoring is one pass over the documents without a shuffle.

Weights are zero or less: a word can speak against a text, never for it. So a short text is not rejected
for want of praise, and a text of words that no labelled document holds gets the top grade's own odds.

Grades: 0 toxic, 1 of low quality, 2 good.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch

SAMPLE_ROWS = 4000
FEWEST = 4
PENALTY = 1.5e-4
DAMPING = 0.01
ROUNDS = 400
RATE = 0.2
#: A document is kept if the probability of the highest grade is this or more.
KEEP = 0.75
GRADES = 3

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ALL = bytes(range(256))
#: Marks that prose and plain numbers seldom hold.
_NOT_ODD = bytes(b for b in _ALL if b not in b"#$%&*!|<>{}[]^~\\=_")
_NOT_UPPER = bytes(b for b in _ALL if not 65 <= b <= 90)
#: Edges of the form marks, in parts of a hundred.
_EDGES = (0.25, 0.5, 1, 2, 4, 6, 8, 10, 15, 20, 30, 40, 50, 60, 70, 80, 90)


def features(text: str | None) -> list[int]:
    """Hashes (64 bits) of the distinct lower-cased words, without marks at their ends, and of the
    form: shares of marks, capitals, distinct words and immediate repeats, as 'at least' steps."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return []
    distinct = {w.strip(_MARKS) for w in words}
    n = len(raw)
    shares = {
        b"\x00odd ": len(raw.translate(None, _NOT_ODD)) / n,
        b"\x00upper ": len(raw.translate(None, _NOT_UPPER)) / n,
        b"\x00again ": sum(map(operator.eq, words, words[1:])) / len(words),
        b"\x00bare ": sum(not w.strip(_MARKS) for w in words) / len(words),
    }
    found = [f + str(e).encode() for f, share in shares.items() for e in _EDGES if share * 100 >= e]
    digest = xxhash.xxh3_64_intdigest
    return [digest(w) for w in distinct] + [digest(f) for f in found]


@dataclass
class Model:
    weights: dict[int, float]
    thresholds: np.ndarray

    def score(self, text: str | None) -> float:
        get = self.weights.get
        return sum([w for w in map(get, features(text)) if w is not None])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k below the highest grade, a row for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -500, 500)))


UNGRADED = Model({}, np.full(GRADES - 1, -500.0))


class _Loss:
    """The slopes of the loss over rows of given grades, each of which stands for ``size`` of the corpus."""

    def __init__(self, grades: np.ndarray, share: np.ndarray):
        self.grades, self.size = grades, share / max(share.sum(), 1e-12)
        # Thresholds start at the grades' own odds.
        below = np.array([self.size[grades <= k].sum() for k in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
        self.start = np.log(below / (1 - below))

    def slopes(self, score: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By each row's score and by each threshold."""
        grades, size, at = self.grades, self.size, np.arange(len(score))
        cut = 1 / (1 + np.exp(np.clip(score[:, None] - edge, -500, 500)))  # P(grade <= k)
        padded = np.hstack([np.zeros((len(score), 1)), cut, np.ones((len(score), 1))])
        high, low = padded[at, grades + 1], padded[at, grades]
        chance = np.maximum(high - low, 1e-9)
        slope_high, slope_low = size * high * (1 - high) / chance, size * low * (1 - low) / chance
        of = lambda k: (slope_low * (grades == k + 1) - slope_high * (grades == k)).sum()
        return slope_high - slope_low, np.array([of(k) for k in range(GRADES - 1)])

    def pulls(self) -> np.ndarray:
        """Of a row of each grade, its slope at the start; 0 for a grade without rows."""
        edge = self.start[0] + np.concatenate([[0], np.cumsum(np.maximum(np.diff(self.start), 1e-2))])
        pull = self.slopes(np.zeros(len(self.grades)), edge)[0]
        return np.array([pull[self.grades == g][:1].sum() for g in range(GRADES)])


def fit_rows(columns: list[np.ndarray], grades: np.ndarray, share: np.ndarray) -> Model:
    """columns: each row's feature hashes; share: how many rows of the corpus each row stands for."""
    lengths = np.array([len(c) for c in columns])
    kinds, index, seen = np.unique(
        np.concatenate([*columns, np.empty(0, np.uint64)]), return_inverse=True, return_counts=True
    )
    row, loss = np.repeat(np.arange(len(columns)), lengths), _Loss(grades, share)
    # Thresholds are kept apart by a sum of positive steps.
    first, step = loss.start[0], np.log(np.maximum(np.diff(loss.start), 1e-2))
    edge = lambda: first + np.concatenate([[0], np.cumsum(np.exp(step))])
    # A feature whose slope at the start the penalty outweighs stays out.
    use = (seen >= FEWEST) & (np.bincount(index, loss.pulls()[grades][row], len(kinds)) > PENALTY)
    index, row, kinds = (np.cumsum(use) - 1)[index[use[index]]], row[use[index]], kinds[use]
    weights = np.zeros(len(kinds))
    square_w, square_t = np.full(len(weights), DAMPING**2), np.full(GRADES - 1, DAMPING**2)
    for _ in range(ROUNDS):
        pull, grad_edge = loss.slopes(np.bincount(row, weights[index], len(columns)), edge())
        grad = np.bincount(index, pull[row], len(weights))
        square_w += grad * grad
        move = RATE / np.sqrt(square_w)
        weights = weights - move * grad
        weights = np.minimum(weights + move * PENALTY, 0)
        after = np.cumsum(grad_edge[::-1])[::-1]
        grad_t = np.array([after[0], *(np.exp(step) * after[1:])])
        square_t += grad_t * grad_t
        change = RATE * grad_t / np.sqrt(square_t)
        first, step = first - change[0], step - change[1:]
    left = np.flatnonzero(weights)
    return Model(dict(zip(kinds[left].tolist(), weights[left].tolist())), edge())


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """labels(doc_id, quality, toxic): toxic 1 is grade 0, else quality 0 is grade 1, quality 1 grade 2.

    Rows without a doc_id, and those with neither toxic 1 nor a quality, grade nothing; of several
    labels of a document the lowest grade counts. Without a graded document every row gets the highest
    grade, so nothing is rejected.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    graded = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
        .where("doc_id is not null and grade is not null")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    totals = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    part = None
    for g in sorted(totals):
        mine = graded.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
        part = mine if part is None else part.union(mine)
    if part is None:
        return UNGRADED
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.sort(np.array(features(t.as_py()), np.uint64)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(rows, pa.binary())], ["doc_id", "grade", "x"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [np.frombuffer(x, np.int64) for x in part.column("x").to_pylist()]
                again = pa.array(np.repeat(np.arange(len(rows)), [len(r) for r in rows]))
                found = np.concatenate([*rows, np.empty(0, np.int64)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(again), part.column("grade").take(again), pa.array(found)], ["doc_id", "grade", "f"])

    # part has at most SAMPLE_ROWS * GRADES rows of two numbers, so it is broadcast, not the texts. Of a
    # repeated document one text counts.
    scratch = Scratch(docs.sparkSession, "quality")
    sample = scratch.table(
        texts.join(F.broadcast(part), "doc_id")
        .select("doc_id", F.col("grade").cast("int").alias("grade"), "text")
        .mapInArrow(hashed, "doc_id long, grade int, x binary")
        .groupBy("doc_id", "grade")
        .agg(F.min("x").alias("x"))
    )
    found = sample.select("doc_id", "grade").toArrow().sort_by("doc_id")
    ids, grades = found.column("doc_id").to_numpy(), found.column("grade").to_numpy().astype(np.int64)
    if not len(ids):
        return UNGRADED
    many = np.bincount(grades, minlength=GRADES)
    share = np.array([totals.get(int(g), 0) / many[g] for g in grades])
    pulls = _Loss(grades, share).pulls()
    each = sample.mapInArrow(unpacked, "doc_id long, grade int, f long")
    of = [F.count(F.when(F.col("grade") == g, 1)) for g in range(GRADES)]
    # A little under the penalty, as sums may differ in their last bits; the fit decides again.
    telling = each.groupBy("f").agg(F.count(F.lit(1)).alias("n"), sum((n * F.lit(float(p)) for n, p in zip(of, pulls)), F.lit(0.0)).alias("pull"))
    telling = telling.where((F.col("n") >= FEWEST) & (F.col("pull") > PENALTY * (1 - 1e-9))).select("f")
    held = each.join(telling, "f").select("doc_id", "f").toArrow().sort_by([("doc_id", "ascending"), ("f", "ascending")])
    of_row = np.searchsorted(ids, held.column("doc_id").to_numpy())
    columns = np.split(held.column("f").to_numpy().view(np.uint64), np.searchsorted(of_row, np.arange(1, len(ids))))
    scratch.clear()
    return fit_rows(columns, grades, share)


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """doc_id long, expected_grade double, p_top double, kept boolean: a row for each row of docs.

    p_top is the probability of the highest grade. A null, empty or white text has no features and
    gets the odds of the thresholds alone. Repeated rows and rows with a null doc_id return each;
    other columns are not read; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.fromiter((model.score(t.as_py()) for t in batch.column(1)), np.float64, batch.num_rows)
            tails = model.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep)],
                ["doc_id", "expected_grade", "p_top", "kept"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(scan, "doc_id long, expected_grade double, p_top double, kept boolean")


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of docs that the model keeps, all their columns as they are: one pass, no join."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = np.fromiter((model.score(t.as_py()) for t in texts), np.float64, batch.num_rows)
            yield batch.filter(pa.array(model.tails(scores)[:, -1] >= keep))

    return docs.mapInArrow(scan, docs.schema)
