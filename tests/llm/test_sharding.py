"""Vector bin packing: balance, groups, hot groups, edge cases."""

import random
import zlib

import numpy as np

from sheafline.llm import sharding


def test_placement_balances_all_measures():
    rng = np.random.default_rng(4)
    units = rng.dirichlet(np.ones(3000), 3).T * 10  # three measures, each 10 shards' worth
    found = sharding.place(units, 10)
    load = np.array([units[found == s].sum(0) for s in range(10)])
    assert load.max() < 1.05 and load.min() > 0.95


def shards(spark, rows, n=8):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    return sharding.shard(docs, n).collect()


def test_rows(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "bb", "ccc", "é"], k=rng.randint(0, 60))), "x") for i in range(3000)]
    rows += [(10_000 + i, "the same text many times over", "x") for i in range(1500)]  # a third is one group
    rows += [(None, "no id", None), (7, rows[7][1], "x"), (20_000, None, "x"), (20_001, "", "x")]
    got = shards(spark, rows)
    assert len(got) == len(rows)
    text = {d: t for d, t, _ in rows}
    for r in got:
        t = text[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 16 and r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "bytes" and r["grown_shard"] is None
    sizes, counts, slots, homes = {}, {}, {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        counts[r["shard"]] = counts.get(r["shard"], 0) + 1
        slots.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault(text[r["doc_id"]] or "", set()).add(r["shard"])
    assert set(sizes) == set(range(8))
    assert max(sizes.values()) <= 1.02 * min(sizes.values()) and max(counts.values()) <= 1.05 * min(counts.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = homes.pop("the same text many times over")
    assert len(hot) > 1 and all(len(h) == 1 for h in homes.values())  # only the hot group is cut


def test_edge_cases(spark):
    assert shards(spark, []) == []
    got = shards(spark, [(1, None, None)])
    assert [(r["size"], r["text_crc32"], r["slot"]) for r in got] == [(16, 0, 0)]
    assert len(shards(spark, [(1, "a", None)] * 5)) == 5


def test_placement_against_plain_python():
    """Largest first, each unit where the dot product with what is left is highest, ties to the first shard."""
    rng = random.Random(6)
    for _ in range(20):
        units = [[rng.random() / 3 for _ in range(3)] for _ in range(60)]
        room, want = [[1.0] * 3 for _ in range(6)], [0] * len(units)
        for i in sorted(range(len(units)), key=lambda i: -max(units[i])):
            gain = [sum(r * u for r, u in zip(left, units[i])) for left in room]
            want[i] = max(range(6), key=lambda s: (round(gain[s], 12), -s))
            room[want[i]] = [r - u for r, u in zip(room[want[i]], units[i])]
        assert sharding.place(np.array(units), 6).tolist() == want


def test_a_hot_group_without_ids_is_cut(spark):
    rows = [(None, "no id, but very often the same", "x")] * 1200 + [(3, "one id and one text", "x")] * 900 + [(100 + i, f"text {i} of its own", "x") for i in range(900)]
    got = shards(spark, rows)
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert len(got) == 3000 and max(counts) <= 1.25 * min(counts)
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
