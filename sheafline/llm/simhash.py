"""SimHash near-dedup with BK-trees.

Fingerprints: whole texts, A-Z lower-cased, words between ASCII white space, shingles of three words
(a shorter sequence counts whole), XXH64 with seed 42, a bit set where over half the hashes have it.

Links at Hamming distance 3 or less are found without comparing all pairs. Of the distinct
fingerprints, two within 3 bits agree on one of four 16-bit blocks, and then on one of four 12-bit
blocks of the other 48 bits. Each fingerprint is sent to its 16 shards of 28 fixed bits. A shard with
more than SHARD_ROWS fingerprints is cut into chunks, and each pair of chunks is a shard of its own,
so no task's tree grows with the data and no link is lost. In a shard a BK-tree is built (children
keyed by their integer distance to the parent) and all its fingerprints walk it together, following
only the edges within the radius. The trees are handed to tasks by shuffle: their number grows with
the corpus, so a broadcast of them has no bound. A shard returns a spanning forest of its links, not
the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Forest, Scratch, runs

SHARD_ROWS = 4096
#: Fingerprints that walk a tree together: at most WALK * SHARD_ROWS pairs are held at a time.
WALK = 64
SHINGLE = 3
RADIUS = 3
SEED = 42


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint; 0 for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at : at + 16384]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of 64-bit words, or of single words."""
    bits = np.bitwise_count(a ^ b).astype(np.int64)
    return bits if bits.ndim == 1 else bits.sum(1)


class BKTree:
    """Distinct values of one or more 64-bit words; the children of a node stand by their distance to it.

    ``edge`` holds parent * span + distance in ascending order and ``child`` the node it leads to, so
    the edges of a node within a range of distances are one slice.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.span = 64 * (1 if values.ndim == 1 else values.shape[1]) + 1
        node = np.zeros(len(values) - 1, np.int64)
        left = np.arange(1, len(values))
        edges, children = [], []
        while len(left):
            key = node * self.span + distances(values[left], values[node])
            kinds, first, back = np.unique(key, return_index=True, return_inverse=True)
            edges.append(kinds)
            children.append(left[first])
            stay = np.ones(len(left), bool)
            stay[first] = False
            node, left = left[first][back][stay], left[stay]
        self.edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.child = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(self.edge)
        self.edge, self.child = self.edge[order], self.child[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays (query, node) of the pairs within the radius, one level of the tree after another."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(query):
            distance = distances(queries[query], self.values[node])
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            lo = np.searchsorted(self.edge, node * self.span + np.maximum(distance - radius, 0))
            hi = np.searchsorted(self.edge, node * self.span + np.minimum(distance + radius, self.span - 1), side="right")
            many = hi - lo
            total = int(many.sum())
            query = np.repeat(query, many)
            at = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
            node = self.child[at]


def _forest(values: np.ndarray, tree: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """For each value the smallest position linked to it, through a BK-tree of ``tree``'s positions."""
    forest, built = Forest(len(values)), BKTree(values[tree])
    for at in range(0, len(queries), WALK):
        part = queries[at : at + WALK]
        for query, node in built.within(values[part], RADIUS):
            forest.join(part[query], tree[node])
    return forest.root


def _shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    us, vs = [], []
    for run in runs(batches, ["key", "a", "b"]):
        values = run.column("fp").to_numpy().view(np.uint64)
        reps = run.column("rep").to_numpy()
        if len(values) < 2:
            continue
        if len(values) == 2:
            if int(values[0] ^ values[1]).bit_count() <= RADIUS:
                us.append(reps[:1])
                vs.append(reps[1:])
            continue
        a, b = run.column("a")[0].as_py(), run.column("b")[0].as_py()
        if a == b:
            tree = queries = np.arange(len(values))
        else:
            chunk = run.column("chunk").to_numpy()
            tree, queries = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
            if not len(tree) or not len(queries):
                continue
        root = _forest(values, tree, queries)
        linked = np.flatnonzero(root != np.arange(len(values)))
        us.append(reps[linked])
        vs.append(reps[root[linked]])
        if len(us) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
            us, vs = [], []
    if us:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])


def with_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id long, fp long): a row for each row of docs; a null or empty text has fingerprint 0."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(scan, "doc_id long, fp long")


def _shards(distinct: DataFrame) -> DataFrame:
    """A row for each fingerprint and each of its 16 shards; key: block, sub-block, their 28 bits."""
    keys = []
    for i in range(4):
        low = F.col("fp").bitwiseAND(F.lit((1 << 16 * i) - 1))
        high = F.shiftleft(F.shiftrightunsigned("fp", 16 * (i + 1)), 16 * i) if i < 3 else F.lit(0).cast("long")
        block, rest = F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)), low.bitwiseOR(high)
        for j in range(4):
            sub = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((4 * i + j) << 28).cast("long").bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(sub))
    return distinct.select("fp", "rep", F.explode(F.array(*keys)).alias("key"))


def near_links(distinct: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """distinct(fp, rep), each fp once -> links (u, v) between reps whose closure joins every pair of
    fingerprints within RADIUS bits."""
    return _linked(_shards(distinct), "fp", ["fp", "rep"], _shard_links, shard_rows)


def _linked(dealt: DataFrame, deal: str, columns: list[str], links: Callable, shard_rows: int, few_keys: bool = False, weight: Column | None = None) -> DataFrame:
    """The links of rows (key, columns) that share a key. A key of more than shard_rows rows is cut into
    chunks by a hash of ``deal``, and every pair of chunks is a shard of its own. few_keys: their number has
    a bound of its own, so their counts are broadcast. weight: the share of a chunk that a row fills, where
    rows differ in size; shard_rows bounds a chunk still."""
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(0.0) if weight is None else weight).alias("w")).where("n > 1")
    shared = shared.select("key", F.ceil(F.greatest(F.col("n") / F.lit(shard_rows), "w")).cast("int").alias("chunks"))
    shared = F.broadcast(shared) if few_keys else shared
    cut = (
        dealt.join(shared, "key")
        .withColumn("chunk", F.pmod(F.xxhash64(deal), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", *columns)
    )
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cut.repartition(parts, "key", "a", "b")
        .sortWithinPartitions("key", "a", "b", "rep")
        .mapInArrow(links, "u long, v long")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id long, fingerprint string (16 hex digits), component_id long, kept boolean: a row a row.

    component_id is the smallest doc_id reachable over links of RADIUS bits or less. Repeated rows
    each return; rows with a null doc_id link nothing and have a null component_id; null, empty and
    white texts have fingerprint 0 and link like any other; an empty table gives an empty result.
    kept is true where doc_id is the component_id.
    """
    from sheafline.llm.components import connected_components

    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.table(with_fingerprints(docs, id_column, text_column))
    distinct = scratch.table(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    components = connected_components(near_links(distinct), scratch)
    named = (
        distinct.join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    )
    return (
        fps.join(named, "fp", "left")
        .select(
            "doc_id",
            F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


# --- similar texts ----------------------------------------------------------------------------------

#: Words of a shingle and the share of common shingles from which two texts are near-duplicates.
SIMILAR_WORDS, SIMILARITY = 5, 0.8
#: 64-bit words of a wide fingerprint. Two of them are the companion that shards compare; the blocks that
#: deal texts to shards are cut from the others.
LANES, COMPANION = 16, 2
#: Bits of a block, least and most; between, so many that a shard holds about SHARD_ROWS texts.
BLOCK_BITS, MOST_BLOCK_BITS = 12, 16
#: Of pairs at the similarity the share that agrees on some block at least.
MEET = 0.999
#: The part of the blocks that goes first; later shards leave out what these have linked already.
FIRST = 1 / 4
#: Pairs with a set of at most so many shingles are found exactly, without fingerprints.
FEW = 64
#: Shards whose counts may be broadcast: 24 bytes each.
FEW_KEYS = 1 << 18
#: Bytes of sets of shingles that a task compares at a time, on average; a longer set stands alone.
SET_BYTES = 1 << 24
_LANE = (np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]


def differing(similarity: float) -> float:
    """The share of bits in which two sets of equal size and this similarity are expected to differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def shingle_hashes(text: str | None, words: int = SIMILAR_WORDS) -> np.ndarray:
    """The hashes of the set of shingles; the whole sequence where there are fewer words, none without."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    shingles = {b" ".join(found)} if len(found) <= words else set(map(b" ".join, zip(*(found[i:] for i in range(words)))))
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """LANES 64-bit words over a set of shingles; all zero for none."""
    if not len(hashes):
        return bytes(8 * LANES)
    ones = np.zeros(64 * LANES, np.int64)
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at : at + 1024, None] + _LANE
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        ones += np.unpackbits(mixed.view(np.uint8).reshape(len(mixed), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def set_bytes(hashes: np.ndarray) -> bytes:
    """A set of shingles as sorted 32-bit hashes."""
    return np.unique(hashes.astype(np.uint32)).tobytes()


def block_bits(texts: int, shard_rows: int = SHARD_ROWS) -> int:
    """The bits of a block for so many distinct texts."""
    return min(MOST_BLOCK_BITS, max(BLOCK_BITS, math.ceil(math.log2(max(texts, 1) / shard_rows))))


def block_count(similarity: float, bits: int = BLOCK_BITS) -> int:
    """How many blocks it takes for pairs at the similarity to agree on some block with the chance MEET."""
    agree = (1 - differing(similarity)) ** bits
    return math.ceil(math.log(1 - MEET) / math.log(1 - agree))


def block_places(count: int, bits: int) -> np.ndarray:
    """The places in a wide fingerprint of each block's bits, a row a block: the bits beside the companion
    are dealt out in a mixed order, again and again, so blocks share bits only where there are too few."""
    rng, own = np.random.default_rng(7), np.arange(64 * COMPANION, 64 * LANES)
    each = len(own) // bits
    rounds = [rng.permutation(own)[: each * bits].reshape(each, bits) for _ in range(-(-count // each))]
    return np.concatenate(rounds)[:count]


def _deal_blocks(places: np.ndarray, first: int):
    """A row for each text and block; ``first`` is the number of the first block."""
    count, bits = places.shape
    value, block = 1 << np.arange(bits, dtype=np.int64), np.arange(first, first + count, dtype=np.int64) << 32

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                raw = np.frombuffer(b"".join(part.column("wide").to_pylist()), np.uint8).reshape(-1, 8 * LANES)
                wide = raw.view(np.uint64)
                one = np.unpackbits(raw, axis=1, bitorder="little")
                keys = np.stack([one[:, p] @ value for p in places], axis=1) + block
                repeat = lambda x: pa.array(np.repeat(x, count))
                columns = [part.column("rep").to_numpy(), part.column("label").to_numpy(), *(wide[:, c].view(np.int64) for c in range(COMPANION))]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *map(repeat, columns)], ["key", "rep", "label", "f0", "f1"])

    return scan


def _companion_links(similarity: float):
    """A spanning forest of the pairs whose companions are near, and of the labels: who is in one tree may be
    similar, directly or through others, and who is not is not."""
    bits = 64 * COMPANION
    share = differing(similarity)
    radius = int(bits * share + 3 * math.sqrt(share * (1 - share) * bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "a", "b"]):
            reps, label = run.column("rep").to_numpy(), run.column("label").to_numpy()
            if len(reps) < 2 or (label == label[0]).all():
                continue
            values = np.stack([run.column(c).to_numpy().view(np.uint64) for c in ("f0", "f1")], axis=1)
            if len(reps) == 2:
                linked, to = (np.array([1]), np.array([0])) if distances(values[:1], values[1:])[0] <= radius else (np.empty(0, int),) * 2
            else:
                a, b, chunk = run.column("a")[0].as_py(), run.column("b")[0].as_py(), run.column("chunk").to_numpy()
                tree = np.arange(len(reps)) if a == b else np.flatnonzero(chunk == a)
                queries = tree if a == b else np.flatnonzero(chunk == b)
                if not len(tree) or not len(queries):
                    continue
                forest, built = Forest(len(reps)), BKTree(values[tree])
                _, first, back = np.unique(label, return_index=True, return_inverse=True)
                forest.root = first[back]
                for at in range(0, len(queries), WALK):
                    part = queries[at : at + WALK]
                    for query, node in built.within(values[part], radius):
                        forest.join(part[query], tree[node])
                # The first of a label stands for it; the others are with it already.
                linked = first[forest.root[first] != first]
                to = forest.root[linked]
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[to])], ["u", "v"])

    return scan


def _similar(similarity: float):
    """A spanning forest of the pairs of sets whose common part is ``similarity`` of their union or more.

    Every pair of a run is decided by the sets themselves, but for those that decided pairs have joined.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "a", "b"]):
            reps = run.column("rep").to_numpy()
            a, b, chunk = run.column("a")[0].as_py(), run.column("b")[0].as_py(), run.column("chunk").to_numpy()
            if len(reps) < 2 or a != b and (chunk == chunk[0]).all():
                continue
            sets = [np.frombuffer(h, np.uint32) for h in run.column("hashes").to_pylist()]
            size = np.array([len(h) for h in sets])
            start = np.cumsum(size) - size
            kinds, told = np.unique(np.concatenate(sets), return_inverse=True)
            forest, own, us, vs = Forest(len(reps)), np.zeros(len(kinds), bool), [], []
            for i in range(len(reps) - 1):
                rest = np.arange(i + 1, len(reps))
                able = (forest.root[rest] != forest.root[i]) & (size[rest] > 0) & (np.minimum(size[rest], size[i]) >= similarity * np.maximum(size[rest], size[i]))
                if a != b:
                    able &= chunk[rest] != chunk[i]
                rest = rest[able]
                if not len(rest):
                    continue
                many = size[rest]
                ends = np.cumsum(many)
                at = np.arange(ends[-1]) + np.repeat(start[rest] - ends + many, many)
                mine = told[start[i] : start[i] + size[i]]
                own[mine] = True
                common = np.add.reduceat(own[told[at]], ends - many, dtype=np.int64)
                own[mine] = False
                near = rest[common >= similarity * (size[i] + many - common)]
                near = near[np.unique(forest.root[near], return_index=True)[1]]
                us.append(reps[near])
                vs.append(np.repeat(reps[i], len(near)))
                forest.join(near, np.repeat(i, len(near)))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return scan


def _sets(words: int):
    """(rep, hashes): the sorted 32-bit hashes of each text's set of shingles, as bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [set_bytes(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "hashes"])

    return scan


def _digest(text: Column) -> Column:
    """SHA-256 of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


_WIDE = "doc_id long, digest binary, fp long, wide binary, small binary"


def with_wide_fingerprints(docs: DataFrame, id_column: str, text_column: str, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id long, digest binary, fp long, wide binary, small binary): both fingerprints of each row in one
    pass over the texts. small is the set itself where a set of FEW shingles can be similar to it, else null."""
    most = int(FEW / similarity)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, wide, small = np.empty(batch.num_rows, np.uint64), [], []
            for i, text in enumerate(batch.column(2)):
                text = text.as_py()
                own[i] = fingerprint(text)
                hashes = shingle_hashes(text, words)
                wide.append(wide_fingerprint(hashes))
                small.append(set_bytes(hashes) if 0 < len(hashes) <= most else None)
            columns = [batch.column(0), batch.column(1), pa.array(own.view(np.int64)), pa.array(wide, pa.binary()), pa.array(small, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "fp", "wide", "small"])

    text = F.col(text_column)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), _digest(text).alias("digest"), text.alias("text"))
    return source.mapInArrow(scan, _WIDE)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, size, h) for each hash of each small set."""
    for batch in batches:
        sets = [np.frombuffer(h, np.uint32) for h in batch.column("small").to_pylist()]
        if sets:
            size = np.array([len(h) for h in sets])
            rep = np.repeat(batch.column("rep").to_numpy(), size)
            columns = [pa.array(rep), pa.array(np.repeat(size, size)), pa.array(np.concatenate(sets).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "size", "h"])


def small_links(sets: DataFrame, similarity: float = SIMILARITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """sets(rep, small), sorted 32-bit hashes as bytes -> links (u, v) whose closure joins every similar pair.

    Exact. Of two similar sets of n and m hashes, the n - ceil(similarity * n) + 1 rarest of the one and the
    like of the other have a hash in common. So each set goes, for each of these that any other set holds, to
    the hash's shard, where the sets decide. A hash that very many sets hold is among the rarest only of sets
    that consist of such hashes; its shard is cut into chunks.
    """
    each = sets.mapInArrow(_unpack, "rep long, size long, h long")
    # What one set holds alone links nothing; the rest is few beside all hashes.
    held = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = each.join(held, "h").groupBy("rep").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "h"))).alias("common"))
    # Hashes that one set holds alone come first in the order, so they take up places.
    alone = F.col("size") - F.size("common")
    places = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - F.lit(1e-9)) + 1 - alone
    dealt = ranked.where(places > 0).select("rep", F.explode(F.slice(F.col("common.h"), F.lit(1), places.cast("int"))).alias("key"))
    members = dealt.join(sets.select("rep", F.col("small").alias("hashes")), "rep")
    return _linked(members, "rep", ["rep", "hashes"], _similar(similarity), shard_rows, weight=F.octet_length("hashes") / SET_BYTES)


def similar_links(
    classes: DataFrame, texts: DataFrame, scratch: Scratch, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """classes(rep, doc_id, digest, wide, small), each wide fingerprint once, and texts(doc_id, digest, text) ->
    links (u, v) of similar reps.

    Companions give each shard a forest of who may be similar; the trees of all shards joined are families,
    and no two texts of different families met as near. In a family the sets of shingles decide every pair,
    and only pairs so decided link. The first blocks go ahead: what they joined are labels, and later shards
    propose nothing within a label, so a large group of copies is not proposed again for each block. Small
    sets, whose bits tell too little, are found exactly beside that.
    """
    from sheafline.llm.components import connected_components

    bits = block_bits(classes.count(), shard_rows)
    places = block_places(block_count(similarity, bits), bits)
    few = len(places) << bits <= FEW_KEYS

    def proposed(labelled: DataFrame, first: int, last: int) -> DataFrame:
        dealt = labelled.mapInArrow(_deal_blocks(places[first:last], first), "key long, rep long, label long, f0 long, f1 long")
        return scratch.table(_linked(dealt, "rep", ["f0", "f1", "rep", "label"], _companion_links(similarity), shard_rows, few_keys=few).distinct())

    ahead = max(1, round(len(places) * FIRST))
    early = proposed(classes.select("rep", "wide", F.col("rep").alias("label")), 0, ahead)
    labels = connected_components(early, scratch).withColumnRenamed("node", "rep")
    labelled = classes.join(labels, "rep", "left").select("rep", "wide", F.coalesce("component", "rep").alias("label"))
    near = early.union(proposed(labelled, ahead, len(places)))
    families = scratch.table(
        connected_components(near, scratch).select(F.col("node").alias("rep"), F.col("component").alias("key"))
        .join(classes.select("rep", "doc_id", "digest"), "rep")
    )
    sets = texts.join(families, ["doc_id", "digest"]).select("rep", "text").mapInArrow(_sets(words), "rep long, hashes binary")
    # Repeated rows give a set again.
    members = scratch.table(families.select("rep", "key").join(sets.groupBy("rep").agg(F.min("hashes").alias("hashes")), "rep"))
    large = _linked(members, "rep", ["rep", "hashes"], _similar(similarity), shard_rows, weight=F.octet_length("hashes") / SET_BYTES)
    # Each is written by itself: a plan over all of them is planned anew, whole, as each of its stages ends.
    few_shingles = small_links(classes.where("small is not null").select("rep", "small"), similarity, shard_rows)
    return scratch.table(large).union(scratch.table(few_shingles))


def similar_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(doc_id long, digest binary, component_id long, first binary): the rows with an id by their group of
    near-duplicates. digest is the SHA-256 of the text, first that of the group's first text: of the smallest
    doc_id, component_id, and of its texts, where it is repeated, that of the smallest digest.

    Two texts are linked if their fingerprints are within RADIUS bits, as ``near_duplicates`` has it, or if
    their sets of shingles of ``words`` words are similar; an id links nothing. Candidates are read off wide
    fingerprints, whose differing bits follow the angle between the sets: BK-trees over companions of 128 bits
    give families, and in a family the sets decide, so no pair under the similarity is linked and one at it is
    missed rarely, with FEW shingles or fewer never. Empty texts, null among them, are a group. What it writes
    lies in ``scratch``, if given.
    """
    from sheafline.llm.components import connected_components

    scratch = scratch or Scratch(docs.sparkSession, "similar")
    rows = scratch.table(with_wide_fingerprints(docs, id_column, text_column, words, similarity).where("doc_id is not null"))
    # A class's number is fixed once it is written; ids may repeat with other texts.
    classes = scratch.table(
        rows.groupBy("wide").agg(F.min(F.struct("doc_id", "digest")).alias("first"), F.min("small").alias("small"))
        .select(F.monotonically_increasing_id().alias("rep"), "first.doc_id", "first.digest", "wide", "small")
    )
    own = scratch.table(rows.join(classes.select("wide", "rep"), "wide").select("doc_id", "digest", "fp", "rep"))
    distinct = scratch.table(own.groupBy("fp").agg(F.min("rep").alias("rep")))
    ties = own.select("fp", "rep").distinct().join(distinct.withColumnRenamed("rep", "least"), "fp").select(F.col("rep").alias("u"), F.col("least").alias("v"))
    text = F.col(text_column)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), _digest(text).alias("digest"), text.alias("text"))
    similar = similar_links(classes, texts, scratch, words, similarity)
    links = similar.union(scratch.table(near_links(distinct))).union(scratch.table(ties.where("u != v")))
    components = connected_components(links, scratch).withColumnRenamed("node", "rep")
    named = classes.join(components, "rep", "left").select("rep", "doc_id", "digest", F.coalesce("component", "rep").alias("group"))
    least = named.groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("least"))
    # Rows meet their class only, and nothing follows that would tie them to its task, so a class of very many
    # rows may be split.
    first = scratch.table(named.select("rep", "group").join(least, "group").select("rep", "least"))
    return own.join(first, "rep").select("doc_id", "digest", F.col("least.doc_id").alias("component_id"), F.col("least.digest").alias("first"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with one row of each of the ``similar_groups``, its first text's; all columns as they are.

    Rows of one id with texts that are no near-duplicates all stay; of rows with the same id and text a single
    one does. Rows with a null id all stay. Only ids are joined where an id has one text, so no column of docs
    can clash.
    """
    scratch, inner = Scratch(docs.sparkSession, "kept"), Scratch(docs.sparkSession, "similar")
    found = scratch.table(similar_groups(docs, id_column, text_column, scratch=inner))
    inner.clear()
    # Tables of ids, written, so that Spark knows their sizes and shuffles the texts only if it must.
    again = scratch.table(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("digest") == F.col("first"))
    gone = scratch.table(found.where(~stays).select("doc_id").distinct().join(again, "doc_id", "left_anti"))
    first = scratch.table(found.where(stays).join(again, "doc_id", "left_semi").select("doc_id", "digest").distinct())
    # The row travels as one struct, so no name of a column of docs can clash.
    source = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_column].cast("long").alias("doc_id"))
    once = source.join(gone, "doc_id", "left_anti").join(again, "doc_id", "left_anti")
    more = source.join(again, "doc_id", "left_semi").withColumn("digest", _digest(F.col(f"row.`{text_column}`")))
    more = more.join(first, ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return once.select("row").union(more.select("row")).select("row.*")
