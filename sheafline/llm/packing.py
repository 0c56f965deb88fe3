"""Best-fit packing of documents into sequences, after the Martello-Toth dominance reduction.

Packing needs only how many pieces there are of each length, at most ``capacity`` numbers however
large the corpus is, so the driver packs that histogram and never sees a document. A pattern is a
filling of a sequence and how many sequences take it; each length's pieces are then ranked without a
single task for a length, and the ranks are looked up in the patterns.

Reduction: while the longest piece left, with the best one or two partners that fit, provably
dominates every other set that could hold it, that set is fixed as a sequence. What remains is packed
best-fit decreasing, all pieces of a length at once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch, ranked
from sheafline.llm.tokens import END, encode

CAPACITY = 2048
#: A filling: runs (length, times), longest first.
Pattern = tuple[tuple[int, int], ...]


class _Lengths:
    """A multiset of lengths: ascending distinct lengths with counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int = 1) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def at_most(self, room: int, without: int) -> int | None:
        """The largest length that fits into room, one piece of ``without`` set aside."""
        i = bisect_right(self.sizes, room) - 1
        while i >= 0:
            size = self.sizes[i]
            if self.count[size] - (size == without) > 0:
                return size
            i -= 1
        return None

    def smallest(self, k: int, without: int, above: int = 0) -> list[int]:
        """The k smallest lengths over ``above`` with repeats, one piece of ``without`` set aside."""
        found: list[int] = []
        for size in self.sizes[bisect_right(self.sizes, above) :]:
            found += [size] * min(k - len(found), self.count[size] - (size == without))
            if len(found) == k:
                break
        return found

    def best_pair(self, room: int, without: int) -> tuple[int, int] | None:
        """Two pieces of the largest sum that fit into room together."""
        best, lo, hi = None, 0, bisect_right(self.sizes, room) - 1
        have = lambda s: self.count[s] - (s == without)
        while 0 <= lo <= hi:
            a, b = self.sizes[lo], self.sizes[hi]
            if a + b > room or not have(b):
                hi -= 1
            elif not have(a) or (lo == hi and have(a) < 2):
                lo += 1
            else:
                if best is None or a + b > sum(best):
                    best = (b, a)
                lo += 1
        return best


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """The sequences that the dominance criterion fixes, and the counts that it leaves.

    For the longest piece j, in a sequence of room c - j:
    - nothing fits beside it: it stands alone;
    - a partner fills the room exactly: nothing beats that pair;
    - no two others fit together: the longest partner that fits beats every other;
    - no three fit, and the longest partner is at least as long as the best pair: the pair {j, partner};
    - no three fit, the best pair holds the longest partner, and every other pair that fits has a
      piece no longer than the best pair's shorter one: that triple.
    Otherwise j is left for the packing. The passes repeat until one fixes nothing.
    """
    left, fixed, before = _Lengths(counts), [], None
    while before != left.count:
        before = dict(left.count)
        for j in sorted(before, reverse=True):
            while left.count.get(j) and (group := _dominant(left, j, capacity - j)):
                # Pieces that go only make the other sets poorer, so the set holds while it lasts.
                times = min(left.count[s] // n for s, n in group.items())
                for s, n in group.items():
                    left.take(s, n * times)
                fixed.append((tuple(sorted(group.items(), reverse=True)), times))
    return fixed, left.count


def _dominant(left: _Lengths, j: int, room: int) -> dict[int, int] | None:
    """The set with j that dominates all others, where the criterion finds one."""
    group = {j: 1}
    partner = left.at_most(room, j)
    if partner is None:
        return group
    two, three = left.smallest(2, j), left.smallest(3, j)
    if partner < room and len(two) == 2 and sum(two) <= room:
        if len(three) == 3 and sum(three) <= room:
            return None
        pair = left.best_pair(room, j)
        if partner < sum(pair):
            if pair[0] != partner or sum((left.smallest(2, j, above=pair[1]) + [room, room])[:2]) <= room:
                return None
            group[pair[1]] = group.get(pair[1], 0) + 1
    group[partner] = group.get(partner, 0) + 1
    return group


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: each length goes, as often as it fits, to the fullest
    sequences that have room, and then to new ones."""
    open_: dict[int, list[tuple[Pattern, int]]] = {capacity: []}
    rooms: list[int] = []
    done: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, times: int, room: int, size: int, n: int) -> None:
        left = room - size * n
        filled = (*pattern, (size, n))
        if left:
            if left not in open_ or not open_[left]:
                open_.setdefault(left, [])
                insort(rooms, left)
            open_[left].append((filled, times))
        else:
            done.append((filled, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                per = capacity // size
                if n // per:
                    put((), n // per, capacity, size, per)
                if n % per:
                    put((), 1, capacity, size, n % per)
                break
            room = rooms[i]
            pattern, times = open_[room].pop()
            if not open_[room]:
                rooms.pop(i)
            per = room // size
            whole = min(times, n // per)
            rest = times - whole
            if whole:
                put(pattern, whole, room, size, per)
                n -= whole * per
            if rest and 0 < n < per:
                put(pattern, 1, room, size, n)
                n, rest = 0, rest - 1
            if rest:
                if room not in open_ or not open_[room]:
                    open_.setdefault(room, [])
                    insort(rooms, room)
                open_[room].append((pattern, rest))
    return done + [x for room in rooms for x in open_[room]]


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and their numbers for a histogram of lengths from 1 to capacity."""
    fixed, kept = reduce_dominated(counts, capacity)
    return merge(fixed) + merge(best_fit(kept, capacity))


def merge(patterns: list[tuple[Pattern, int]]) -> list[tuple[Pattern, int]]:
    found: dict[Pattern, int] = {}
    for pattern, times in patterns:
        found[pattern] = found.get(pattern, 0) + times
    return list(found.items())


class Places:
    """Where the piece of a length and a rank goes: parallel arrays, ascending by length and rank."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern, times in patterns:
            offset = 0
            for size, n in pattern:
                rank = used.get(size, 0)
                rows.append((size, rank, sequence, offset, n))
                used[size] = rank + times * n
                offset += size * n
            sequence += times
        self.sequences = sequence
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.size, self.rank, self.sequence, self.offset, self.per = table.T.copy()

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.int64(1) << 44
        i = np.searchsorted(self.size * step + self.rank, size * step + rank, side="right") - 1
        past = rank - self.rank[i]
        return self.sequence[i] + past // self.per[i], self.offset[i] + past % self.per[i] * size


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id long, piece int, start long, length long, ids_crc32 long: the pieces of each row's ids.

    A document is the ids of its text (null: empty) and then END. Only a longer one than capacity is
    cut; its first piece takes the remainder and all others are full.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py(), vocabulary), np.uint32(END)).astype("<u4")
                start, piece = 0, 0
                while start < len(ids):
                    end = start + ((len(ids) - start) % capacity or capacity)
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start, piece = end, piece + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(scan, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with sequence_id long and offset long (gapless from 0).

    Every row of docs is packed, repeats and rows with a null doc_id too; an empty or null text is
    the one id END; an empty table gives an empty result. Other columns of docs are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    # A piece's number is fixed once it is written; ids may be null or repeat in very many rows.
    cut = scratch.table(pieces(docs, vocabulary, capacity).withColumn("row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(pack_counts(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = places.find(size, rank) if len(size) else (size, rank)
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    dealt = ranked(cut, "length", ["doc_id", "piece", "ids_crc32", "row"], sum(counts.values()))
    return dealt.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
