"""Best-fit packing: lower bounds, exact optima of small cases, whole documents, edge cases."""

import random
import zlib
from math import ceil

import numpy as np
import pytest

from sheafline.llm import packing as K
from sheafline.llm import tokens

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def used(patterns):
    found = {}
    for pattern, times in patterns:
        for size, n in pattern:
            found[size] = found.get(size, 0) + n * times
    return found


def fewest(sizes, capacity):
    """The exact least number of sequences, by search over small instances."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= sizes[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best[0]


def counts(sizes):
    found = {}
    for s in sizes:
        found[s] = found.get(s, 0) + 1
    return found


def test_reduction_keeps_an_optimum():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([10, 20, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        fixed, kept = K.reduce_dominated(counts(sizes), capacity)
        assert all(sum(s * n for s, n in p) <= capacity for p, _ in fixed)
        rest = [s for s, n in kept.items() for _ in range(n)]
        assert used(fixed) == {s: n - kept.get(s, 0) for s, n in counts(sizes).items() if n > kept.get(s, 0)}
        assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(sizes, capacity), (capacity, sizes)


def test_all_is_packed_once_and_fits():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([7, 50, 2048])
        sizes = [min(capacity, max(1, int(rng.lognormvariate(4, 1)))) if rng.random() < 0.5 else rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
        patterns = K.pack_counts(counts(sizes), capacity)
        assert used(patterns) == counts(sizes)
        assert all(sum(s * n for s, n in p) <= capacity for p, _ in patterns)
        assert sum(n for _, n in patterns) <= sum(n for _, n in K.best_fit(counts(sizes), capacity)) + 1


def test_large_counts_take_no_longer():
    n = 10**9
    patterns = K.pack_counts({2048: n, 1500: n, 548: n, 300: 3 * n, 7: 5 * n, 1: n}, 2048)
    assert used(patterns) == {2048: n, 1500: n, 548: n, 300: 3 * n, 7: 5 * n, 1: n}
    total = 2048 + 1500 + 548 + 900 + 35 + 1
    assert sum(t for _, t in patterns) <= 1.2 * ceil(total * n / 2048)


def test_places_are_gapless():
    patterns = K.pack_counts({5: 7, 3: 9, 2: 4, 1: 3}, 10)
    places = K.Places(patterns)
    taken = {}
    for size, n in {5: 7, 3: 9, 2: 4, 1: 3}.items():
        sequence, offset = places.find(np.full(n, size), np.arange(n))
        for s, o in zip(sequence, offset):
            taken.setdefault(int(s), []).append((int(o), size))
    assert len(taken) == places.sequences
    for parts in taken.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 10


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(7)
    safe = [chr(c) for c in range(0x2030) if tokens._SAFE.fullmatch(chr(c))]
    for c in safe:
        text = f"a{c}b {c}{c} 1{c}2{c} {c}\n{c}'s"
        assert tokens.encode(text, VOCABULARY).tolist() == exact.encode(text, add_special_tokens=False).ids, hex(ord(c))
    wild = [*safe, "😀", "字", "́", "​", "٣", " ", "<|endoftext|>", "  ", "\x85", "\xa0", "\x1c"]
    for _ in range(300):
        text = "".join(rng.choices(wild, k=rng.randint(0, 40)))
        assert tokens.encode(text, VOCABULARY).tolist() == exact.encode(text, add_special_tokens=False).ids, repr(text)
    assert tokens.encode(None, VOCABULARY).tolist() == []


def test_documents(spark):
    rng = random.Random(8)
    texts = [None, "", " ", "word " * 5000, "é字😀<|endoftext|>"] + [" ".join(rng.choices(["the", "cat", "zq"], k=rng.randint(1, 900))) for _ in range(80)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, None, "x"), (None, "lost", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = K.pack(docs, VOCABULARY, 512).collect()
    ids = {(d, t): np.append(tokens.encode(t, VOCABULARY), np.uint32(0)).astype("<u4") for d, t, _ in rows}
    text_of = dict(enumerate(texts)) | {None: "lost"}
    seen = {}
    for r in got:
        whole = ids[(r["doc_id"], text_of[r["doc_id"]])]
        assert zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for doc, pieces in seen.items():
        n = len(ids[(doc, text_of[doc])])
        copies = 2 if doc == 0 else 1
        assert sum(p[2] for p in pieces) == n * copies
        if n > 512:
            assert [p[2] for p in sorted(pieces)][1:] == [512] * (len(pieces) - 1) and sorted(pieces)[0][2] == (n % 512 or 512)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(by) <= 1.1 * ceil(sum(len(x) for x in ids.values()) / 512)  # few, long pieces
    assert K.pack(docs.limit(0), VOCABULARY).count() == 0
