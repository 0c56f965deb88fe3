"""The pipeline on the smallest tables: each stage against what it must keep and change."""

import importlib
import re
import shutil
import subprocess
import sys

import pytest
from conftest import DATA, ROOT

import __spark_entry__
import corpus_pipeline
from sheafline.llm import quality, queries
from test_simhash import brute_groups


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs, found = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{root}/{i}")
        after = spark.read.parquet(f"{root}/{i}")
        found.append((name, docs, after))
        docs = after
    return found


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality classifier", "SimHash near-dedup", "PII redaction", "best-fit packing"]
    for _, before, after in stages[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_quality(spark, stages):
    _, before, after = stages[0]
    model = quality.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    rejected = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    assert rejected == {r["doc_id"] for r in quality.score(before, model).collect() if not r["kept"]}
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [d for d, v in labels.items() if v == (1, 0)]
    assert sum(d not in rejected for d in good) >= 0.95 * len(good)


def test_dedup(stages):
    _, before, after = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert {r["doc_id"] for r in after.collect()} == set(brute_groups(rows).values())


def test_privacy(stages):
    _, before, after = stages[2]
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
    assert set(texts) == {r["doc_id"] for r in before.collect()}
    for text, n in texts.values():
        assert n == len(text) and not re.search(r"[\w.]+@[\w-]+\.\w+", text)
    for r in before.collect():
        if not re.search(r"[@+:]|\d", r["text"]):
            assert texts[r["doc_id"]][0] == r["text"]


def test_packing(stages):
    _, before, after = stages[3]
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_is_the_stages_in_a_row(spark, stages):
    key = lambda r: (r["doc_id"], r["piece"], r["ids_crc32"], r["length"])
    assert sorted(map(key, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(key, stages[-1][2].collect()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_and_are_registered(spark, name):
    assert __spark_entry__.queries()[name](spark, DATA).count() >= 0


def test_ten_operators():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()


def test_the_rest_works_without_this_subpackage(tmp_path):
    for name in ("sheafline", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "sheafline" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_it():
    for path in (ROOT / "sheafline").rglob("*.py"):
        if "llm" not in path.parts:
            assert "sheafline.llm" not in path.read_text(), path
    assert importlib.import_module("sheafline.llm")
