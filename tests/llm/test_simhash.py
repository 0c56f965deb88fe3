"""SimHash near-dedup against brute force, and its defined edge cases."""

import random

import numpy as np
import xxhash

from sheafline.llm import simhash as H
from sheafline.llm.common import Forest


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: (doc_id, fp) rows -> doc_id -> smallest doc_id reachable."""
    values = [f for _, f in fps]
    label = [d for d, _ in fps]
    while True:
        new = [min(label[j] for j in range(len(fps)) if (values[i] ^ values[j]).bit_count() <= 3) for i in range(len(fps))]
        if new == label:
            return {d: label[i] for i, (d, _) in enumerate(fps)}
        label = new


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \t\n\v\f\r", "One", "one two", "A b\x1cC  d", "ÀÉ é x y", "a " * 200_000]
    texts += ["".join(rng.choices("abÉ \n\tZ😀", k=rng.randint(0, 80))) for _ in range(200)]
    for text in texts:
        assert H.fingerprint(text) == brute_fingerprint(text), repr(text)[:60]


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("a b é")).alias("h")).first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64("a b é".encode(), seed=42).intdigest()


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 5, np.uint64)
    values = np.unique(np.array([int(rng.choice(centres)) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(400)], np.uint64))
    tree = H.BKTree(values)
    found = {(int(q), int(n)) for qs, ns in tree.within(values, 3) for q, n in zip(qs, ns)}
    assert found == {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert list(H.BKTree(values[:1]).within(values[:1], 0))


def test_forest():
    forest = Forest(6)
    forest.join(np.array([5, 3, 4]), np.array([3, 1, 4]))
    assert forest.root.tolist() == [0, 1, 2, 1, 4, 1]


def shingles(text, words=5):
    found = (text or "").encode().lower().split()
    return {tuple(found)} if 0 < len(found) <= words else {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute_groups(rows):
    """(doc_id, text) rows -> doc_id -> smallest doc_id reachable by three bits or by similar sets."""
    fps, sets = [brute_fingerprint(t) for _, t in rows], [shingles(t) for _, t in rows]
    near = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3 or (sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    links = [[j for j in range(len(rows)) if near(i, j) or i == j] for i in range(len(rows))]
    label = [d for d, _ in rows]
    while True:
        new = [min(label[j] for j in links[i]) for i in range(len(rows))]
        if new == label:
            return {d: label[i] for i, (d, _) in enumerate(rows)}
        label = new


def near_rows(rng, n):
    """Fingerprint rows with chains of near ones and repeats."""
    rows, fp = [], rng.getrandbits(64)
    for i in range(n):
        step = rng.choice([0, 1, 2, 3, 3, 4, 30])
        fp ^= sum(1 << b for b in rng.sample(range(64), step))
        rows.append((i * 7 % 1009, fp))
    return rows


def test_links_against_brute_force(spark):
    from pyspark.sql import functions as F

    from sheafline.llm.common import Scratch
    from sheafline.llm.components import connected_components

    rows = near_rows(random.Random(3), 300)
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in rows]
    fps = spark.createDataFrame(signed, "doc_id long, fp long")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    for shard_rows in (H.SHARD_ROWS, 3):  # the small one cuts shards into chunks
        links = H.near_links(distinct, shard_rows)
        found = {r["node"]: r["component"] for r in connected_components(links, Scratch(spark, "t")).collect()}
        rep = {r["fp"]: r["rep"] for r in distinct.collect()}
        expected = brute_components(rows)
        for (d, _), (_, f) in zip(rows, signed):
            assert found.get(rep[f], rep[f]) == expected[d]


def test_edge_cases(spark):
    rows = [(5, None, "x"), (3, "", "x"), (9, "  ", "x"), (7, "one two three four", "y"), (2, "One two\nthree four", "y"), (2, "One two\nthree four", "y"), (None, "one two three four", None), (8, "other words in here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumnRenamed("fp", "component_id")
    got = H.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    told = {(r["doc_id"], r["fingerprint"], r["component_id"], r["kept"]) for r in got}
    four = f"{brute_fingerprint('one two three four'):016x}"
    assert {(5, "0" * 16, 3, False), (3, "0" * 16, 3, True), (9, "0" * 16, 3, False), (7, four, 2, False), (2, four, 2, True), (None, four, None, False)} <= told
    assert H.near_duplicates(docs.limit(0)).count() == 0
    kept = H.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 2), (False, 3), (False, 8), (True, 0)]


def test_components_of_long_chains_and_stars(spark):
    from sheafline.llm.common import Scratch
    from sheafline.llm.components import connected_components

    links = [(i, i + 1) for i in range(0, 120)] + [(500, 500 + i) for i in range(1, 80)] + [(900, 900), (None, 3), (3, None)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(df, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(121)}, **{500 + i: 500 for i in range(80)}}
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0


def copies(rng, bases, n):
    """Documents, and copies of them with some words changed."""
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    found = [rng.choices(vocabulary, k=rng.randint(30, 300)) for _ in range(bases)]
    for _ in range(n):
        words = list(rng.choice(found[:bases]))
        for _ in range(int(len(words) * rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.06, 0.2]))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        found.append(words)
    return [(i * 13 % 1009, " ".join(w)) for i, w in enumerate(found)]


def test_similar_texts_are_grouped(spark):
    rng = random.Random(12)
    rows = copies(rng, 60, 260)
    rows += [(2000 + i, t) for i, t in enumerate([None, "", " ", "one two", "One  two", "one two three four five", "one two three four six"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in H.similar_groups(docs).collect()}
    assert set(got) == set(expected)
    wrong = [d for d in got if got[d] != expected[d]]
    # Never linked without cause; at the very edge of the similarity a pair may be missed.
    assert len(wrong) <= 0.01 * len(rows)
    assert all(expected[d] == expected[got[d]] for d in got)


def test_a_base_and_its_copies(spark):
    """Copies much like their base and less like each other: loose pairs must not stand in for real ones."""
    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        words = list(base)
        for at in rng.sample(range(5, 395, 6), 6):
            words[at] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    sets = [shingles(t) for _, t in rows[:60]]
    alike = lambda x, y: len(x & y) / len(x | y)
    assert all(0.84 < alike(sets[0], s) < 0.87 for s in sets[1:])
    assert sum(alike(x, y) < 0.8 for x in sets[1:] for y in sets[1:]) > 0.9 * 59 * 58
    got = {r["doc_id"]: r["component_id"] for r in H.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 1001 and sum(c != 0 for c in got.values()) <= 2


def test_labels_keep_no_pair_apart(spark):
    """Real pairs in a large family just under the similarity, whose loose pairs look sure by their bits."""
    from sheafline.llm.common import Scratch

    rng = random.Random(23)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    places, taken, rows = range(5, 391, 6), [], []
    while len(taken) < 100:
        common, *private = (lambda p: (p[:2], p[2:5], p[5:]))(rng.sample(places, 8))
        pair = [set(common + own) for own in private]
        if any(len(p & q) > 1 for p in pair for q in taken):
            continue
        taken += pair
        new = {at: f"x{rng.randrange(10**9)}" for at in common}
        for own in private:
            edits = new | {at: f"x{rng.randrange(10**9)}" for at in own}
            rows.append((len(rows), " ".join(edits.get(i, w) for i, w in enumerate(base))))
    sets = [shingles(t) for _, t in rows]
    pairs = {(i, j) for i in range(100) for j in range(i + 1, 100) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert pairs == {(i, i + 1) for i in range(0, 100, 2)}
    classes = [(i, i, bytearray(b"x"), bytearray(H.wide_fingerprint(H.shingle_hashes(t))), None) for i, t in rows]
    classes = spark.createDataFrame(classes, "rep long, doc_id long, digest binary, wide binary, small binary")
    texts = spark.createDataFrame([(i, bytearray(b"x"), t) for i, t in rows], "doc_id long, digest binary, text string")
    links = H.similar_links(classes, texts, Scratch(spark, "t"))
    assert {(min(r["u"], r["v"]), max(r["u"], r["v"])) for r in links.collect()} == pairs


def test_families_are_decided_pair_by_pair(spark):
    """A family in one piece, in chunks of rows and in chunks of bytes: the same groups as by brute force."""
    from pyspark.sql import functions as F

    rng = random.Random(22)
    rows = copies(rng, 6, 120)
    rows = sorted(dict(rows).items())
    sets = {d: np.unique(H.shingle_hashes(t).astype(np.uint32)) for d, t in rows}
    members = spark.createDataFrame([(d, 1, bytearray(h.tobytes())) for d, h in sets.items()], "rep long, key long, hashes binary")
    linked = {(i, j) for i in sets for j in sets if i < j and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}

    def groups(links):
        at = {d: k for k, d in enumerate(sets)}
        forest = Forest(len(at))
        forest.join(np.array([at[u] for u, _ in links]), np.array([at[v] for _, v in links]))
        return forest.root.tolist()

    for shard_rows, weight in ((H.SHARD_ROWS, None), (9, None), (H.SHARD_ROWS, F.octet_length("hashes") / 5000)):
        found = [(r["u"], r["v"]) for r in H._linked(members, "rep", ["rep", "hashes"], H._similar(0.8), shard_rows, weight=weight).collect()]
        assert {(min(p), max(p)) for p in found} <= linked and groups(found) == groups(linked)
        assert shard_rows < 10 or weight is not None or len(found) < len(rows)


def test_wide_trees_and_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (1, 2), np.uint64)
    flips = np.packbits(rng.random((300, 128)) < 0.12, axis=1).view(np.uint64)
    values = np.unique(base ^ flips, axis=0)
    found = {(int(q), int(n)) for qs, ns in H.BKTree(values).within(values, 25) for q, n in zip(qs, ns)}
    assert found == {(i, j) for i in range(len(values)) for j in range(len(values)) if H.distances(values[i : i + 1], values[j : j + 1])[0] <= 25}
    blocks = H.block_count(0.8)
    assert 1 - (1 - (1 - H.differing(0.8)) ** H.BLOCK_BITS) ** blocks > 0.9989
    assert H.differing(1.0) == 0 and H.wide_fingerprint(H.shingle_hashes("")) == bytes(128)
    assert [H.block_bits(n) for n in (0, 10**6, 1 << 26, 10**9, 10**12)] == [12, 12, 14, 16, 16]
    for bits in range(12, 17):
        places = H.block_places(H.block_count(0.8, bits), bits)
        assert places.shape[1] == bits and places.min() >= 128 and places.max() < 1024
        assert all(len(set(p.tolist())) == bits for p in places)


def test_small_sets_are_found_exactly(spark):
    """Random families of small texts, many with a common passage, at and around the similarity."""
    rng = random.Random(24)
    passage = [f"c{i}" for i in range(30)]
    rows = []
    for f in range(120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))]
        if f % 2:
            base = base + passage[: rng.randint(8, 30)]
        for _ in range(4):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.choice([0, 1, 2, -1, -2, rng.randrange(len(words))])] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words[: len(words) - rng.randint(0, 3)])))
    # 4 shingles inside 5 and 12 inside 15 are at 0.8 exactly.
    for n, m in [(8, 9), (16, 19)] * 40:
        words = [f"y{rng.randrange(10**9)}" for _ in range(m)]
        rows += [(len(rows), " ".join(words[:n])), (len(rows) + 1, " ".join(words))]
    sets = {d: shingles(t) for d, t in rows}
    pairs = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    source = [(d, bytearray(H.set_bytes(H.shingle_hashes(t)))) for d, t in rows]
    for shard_rows in (H.SHARD_ROWS, 7):
        found = [(r["u"], r["v"]) for r in H.small_links(spark.createDataFrame(source, "rep long, small binary"), shard_rows=shard_rows).collect()]
        assert {(min(p), max(p)) for p in found} <= set(pairs)
        told, real = Forest(len(rows)), Forest(len(rows))
        told.join(*np.array(found).T)
        real.join(*np.array(pairs).T)
        assert told.root.tolist() == real.root.tolist() and len(pairs) > 200
    got = {r["doc_id"]: r["component_id"] for r in H.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_crowds_just_under_the_similarity(spark):
    """Groups whose pairs lie just under 0.8, a few at or over it: those are all found."""
    rng = random.Random(25)
    rows = []
    for _ in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(900)]
        for _ in range(40):
            words = list(base)
            for at in rng.sample(range(900), 12):
                words[at] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if i // 40 == j // 40 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    got = {r["doc_id"]: r["component_id"] for r in H.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert pairs and sum(got[i] == got[j] for i, j in pairs) >= 0.99 * len(pairs)


def test_one_id_with_several_texts(spark):
    """Only near-duplicates go: an id with different texts keeps them, and a repeated row goes once."""
    words = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(1, words("a"), 1), (1, words("b"), 2), (2, words("c"), 3), (2, words("c"), 3), (3, words("b"), 4), (3, words("d"), 5), (None, words("a"), 6), (4, None, 7), (4, "", 8), (5, " ", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in H.keep_one(docs).collect())
    assert got == sorted([(0, words("a")), (1, words("a")), (1, words("b")), (2, words("c")), (3, words("d")), (4, "")])
    assert H.keep_one(docs).columns == docs.columns and H.keep_one(docs.limit(0)).count() == 0
