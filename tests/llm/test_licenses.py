"""License scans: planted notices are found whole, near misses are not, edge cases; brute force."""

import random
import time

from sheafline.llm import licenses


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_planted_notices():
    rng = random.Random(1)
    for _ in range(60):
        names = rng.sample(sorted(licenses.TEMPLATES), rng.randint(0, 4))
        text, planted = prose(rng, rng.randint(0, 40)), []
        for name in names:
            notice = licenses.TEMPLATES[name]
            text += rng.choice(["\n", " ", "\n\n"])
            start = len(text)
            text += notice
            planted.append((name, start))
            text += rng.choice([" ", "\n"]) + prose(rng, rng.randint(0, 150))
        assert [(h[0], h[1]) for h in licenses.scan_text(text)] == planted, text[:300]


def test_wording_is_checked_exactly():
    long = licenses.TEMPLATES["MIT"]
    hit = licenses.scan_text(long.replace("hereby granted", "granted hereby").replace("publish, ", ""))
    assert [h[0] for h in hit] == ["MIT"] and hit[0][4] >= 2
    assert licenses.scan_text("Licensed under CC BY-NC 4.0.")[0][0] == "CC-BY-NC-4.0"
    assert licenses.scan_text("licensed UNDER cc by 4.0")[0][0] == "CC-BY-4.0"
    for other in ("Licensed under the Apache License, Version 1.1.", "She renewed her driving license in April.", "GNU General Public License, version 9", "All wrongs reserved."):
        assert licenses.scan_text(other) == [], other
    half = long[: len(long) // 2]
    assert licenses.scan_text(half) == []


def test_long_texts_and_odd_characters():
    rng = random.Random(2)
    filler = prose(rng, 30_000)
    text = filler + "\nAll rights reserved.\n" + filler + "\nReleased under the MIT License.\n"
    assert [(h[0], text[h[1] : h[2]]) for h in licenses.scan_text(text)] == [("all-rights-reserved", "All rights reserved"), ("MIT-notice", "Released under the MIT License")]
    # Many cues side by side make a block that is longer than one piece.
    many = ("All rights reserved. " + prose(rng, 3) + " ") * 1500
    assert len(licenses.scan_text(many)) == 1500
    odd = "İ😀 " * 50 + "All rights reserved."
    assert [odd[h[1] : h[2]] for h in licenses.scan_text(odd)] == ["All rights reserved"]


def test_short_notices_in_long_blocks():
    """A cue each 700 characters makes one long block; a dictionary saves nothing there, and still the notice is found."""
    rng = random.Random(4)
    vocabulary = prose(rng, 400).split()
    for name in ("all-rights-reserved", "CC-BY-4.0", "MIT-notice", "GPL-3.0-notice"):
        for size in (4_000, 8_000, 20_000, 60_000):
            parts = [" ".join(rng.choices(vocabulary, k=105)) + " license " for _ in range(size // 700)]
            parts.insert(rng.randrange(len(parts)), licenses.TEMPLATES[name] + " ")
            text = "".join(parts)
            hits = licenses.scan_text(text)
            assert [h[0] for h in hits] == [name], (name, size)
            assert text[hits[0][1] : hits[0][2]] == licenses.TEMPLATES[name].rstrip(".") and hits[0][3] > 0


def test_a_broken_quotation_hides_no_notice():
    """A longer unbroken stretch than the notice has must not be the only place that is tried."""
    rng = random.Random(6)
    told = licenses.TEMPLATES["MIT"].split()
    quoted, changed = " ".join(told[: len(told) * 2 // 3]), list(told)
    for at in range(15, len(told), 25):
        changed[at] = "zzz"
    for parts in ([quoted, " ".join(changed)], [" ".join(changed), quoted], [quoted, quoted, " ".join(changed), quoted]):
        text = "".join(prose(rng, 45) + " licensed " + part + " " for part in parts)
        hits = licenses.scan_text(text)
        assert [h[0] for h in hits] == ["MIT"] and text[hits[0][1] :].startswith(" ".join(changed)[:200]), parts


def test_notices_at_the_cuts_of_blocks():
    rng = random.Random(5)
    for lead in range(19_000, 20_600, 90):
        filler = "licensed " + " licensed ".join(prose(rng, 60) for _ in range(70))
        text = filler[:lead] + " " + licenses.TEMPLATES["MIT"] + " " + filler[:5000]
        assert [(h[0], h[1], h[4], h[5]) for h in licenses.scan_text(text)] == [("MIT", lead + 1, 0, 0)], lead


def test_rows(spark):
    rows = [(1, "All rights reserved.", "x"), (2, None, "x"), (3, "", None), (None, "All rights reserved.", None), (1, "All rights reserved.", "x"), (4, "nothing here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = [(r["doc_id"], r["license"], r["start"], r["end"], r["missing"], r["added"]) for r in licenses.scan(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, "all-rights-reserved", 0, 19, 0, 0)] * 2 + [(None, "all-rights-reserved", 0, 19, 0, 0)], key=str)
    assert licenses.scan(docs.limit(0)).count() == 0


def brute(text):
    """(license, first word, last word) of every place whose words hold a template but for its slack."""
    block, found = [w for w, _, _ in licenses.words(text)], set()
    for name, wording in licenses.TEMPLATES.items():
        told = [w for w, _, _ in licenses.words(wording)]
        slack = int(len(told) * licenses.SLACK)
        if len(told) > 20:
            continue
        for lo in range(len(block)):
            # Lengths of the longest common subsequence of the words from lo and the template.
            row = [0] * (len(told) + 1)
            for hi in range(lo, min(len(block), lo + len(told) + slack)):
                old, row = row, [0] * (len(told) + 1)
                for j, w in enumerate(told, 1):
                    row[j] = old[j - 1] + 1 if block[hi] == w else max(old[j], row[j - 1])
                size, common = hi - lo + 1, row[-1]
                kept = [w for w in told if w in block[lo : hi + 1]]
                whole = all(w in kept for w in told if any(c.isdigit() for c in w))
                if len(told) - common <= slack and size - common <= slack and whole:
                    found.add((name, lo, hi + 1))
    return found


def test_against_brute_force():
    """Edited short notices: each hit is a place that brute force allows, and none of its places is left over."""
    rng = random.Random(14)
    short = sorted(n for n, t in licenses.TEMPLATES.items() if len(licenses.words(t)) <= 20)
    for _ in range(150):
        told = []
        for _ in range(rng.randint(1, 5)):
            told += prose(rng, rng.randint(0, 6)).split()
            notice = licenses.TEMPLATES[rng.choice(short)].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                at = rng.randrange(len(notice))
                notice[at : at + rng.randint(0, 1)] = rng.choice([[], ["zzz"]])
            told += notice
        text = " ".join(told)
        starts = [s for _, s, _ in licenses.words(text)]
        places = brute(text)
        hits = [(n, starts.index(s), starts.index(s) + len(licenses.words(text[s:e]))) for n, s, e, *_ in licenses.scan_text(text)]
        assert all(any(n == name and lo <= a and b <= hi for name, lo, hi in places) for n, a, b in hits), text
        for name, lo, hi in places:
            # Every template but one word may hold a cue; without any no block stands around it.
            span = text[starts[lo] : starts[hi - 1] + len(licenses.words(text)[hi - 1][0])]
            assert any(a < hi and lo < b for _, a, b in hits) or not licenses.cues(span), (name, text)


def test_many_notices_cost_as_much_as_their_number():
    scan = lambda n: (time.process_time(), len(licenses.scan_text("All rights reserved. " * n)), time.process_time())
    scan(10)
    (a, n, b), (c, m, d) = scan(300), scan(2400)
    assert (n, m) == (300, 2400) and d - c < 16 * (b - a)
