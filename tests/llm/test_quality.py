"""Ordinal regression: held-out accuracy, the link's properties, edge cases."""

import random

import numpy as np
import pytest
from conftest import DATA

from sheafline.llm import quality

WORDS = ["river", "stone", "garden", "winter", "music", "letter", "window", "harbour", "mountain", "paper", "quiet", "under"]
BAD = ["vile", "hateful", "nasty"]


def corpus(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 120))
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        text = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words) if grade == 1 else " ".join(words) + "."
        rows.append((i, text, grade))
    return rows


def fitted(rows):
    columns = [np.array(quality.features(t), np.uint64) for _, t, _ in rows]
    return quality.fit_rows(columns, np.array([g for _, _, g in rows]), np.ones(len(rows)))


def test_held_out_accuracy():
    rows = corpus(1500, 1)
    model = fitted(rows[:1000])
    scores = np.array([model.score(t) for _, t, _ in rows[1000:]])
    kept = model.tails(scores)[:, -1] >= quality.KEEP
    truth = np.array([g for _, _, g in rows[1000:]]) == 2
    assert (kept == truth).mean() > 0.97
    assert kept[truth].mean() > 0.98


def test_thresholds_are_ordered_and_tails_too():
    model = fitted(corpus(400, 2))
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.linspace(-20, 20, 50))
    assert (tails[:, 0] >= tails[:, 1]).all() and (np.diff(tails, axis=0) >= 0).all()
    assert len(model.weights) < 60  # neutral words weigh nothing


def test_a_single_bad_word_in_a_long_text_counts():
    model = fitted(corpus(1000, 3))
    clean = " ".join(random.Random(1).choices(WORDS, k=20_000))
    tail = lambda t: model.tails(np.array([model.score(t)]))[0, -1]
    assert tail(clean) >= quality.KEEP > tail(clean + " hateful")
    assert tail(None) == tail("") == tail(" \n") >= quality.KEEP


def test_rows(spark):
    rows = corpus(300, 4)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "vile", None), (5, rows[5][1], "x"), (900, None, None)], "doc_id long, text string, kept string")
    grades = [(i, int(g != 1), int(g == 0)) for i, _, g in rows] + [(None, 1, 0), (7, None, None), (8, 0, 1)]
    labels = spark.createDataFrame(grades, "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) + 3
    assert all(0 <= r["expected_grade"] <= 2 and r["kept"] == (r["p_top"] >= quality.KEEP) for r in got)
    good = quality.keep_good(docs, model)
    assert good.columns == docs.columns and good.count() == sum(r["kept"] for r in got)
    assert quality.score(docs.limit(0), model).count() == 0


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in quality.score(docs, quality.fit(docs, none)).collect())
    elsewhere = spark.createDataFrame([(99, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in quality.score(docs, quality.fit(docs, elsewhere)).collect())
    one_grade = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in quality.score(docs, quality.fit(docs, one_grade)).collect())


def test_fit_is_the_same_each_time(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    one, two = quality.fit(docs, labels), quality.fit(docs.repartition(7), labels)
    assert one.weights.keys() == two.weights.keys()
    assert all(two.weights[k] == pytest.approx(w, abs=1e-6) for k, w in one.weights.items())


def test_counting_in_spark_loses_no_feature(spark):
    """What reaches the driver gives the model that all features of all rows give."""
    rows = corpus(600, 8)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g != 1), int(g == 0)) for i, _, g in rows], "doc_id long, quality int, toxic int")
    got, want = quality.fit(docs, labels), fitted(rows)
    assert got.weights.keys() == want.weights.keys() and got.weights
    assert all(got.weights[k] == pytest.approx(w, abs=1e-9) for k, w in want.weights.items())
    assert got.thresholds == pytest.approx(want.thresholds, abs=1e-9)
