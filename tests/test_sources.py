"""Files in, tables and files out, streams."""

import json

import pytest
from pyspark.sql import functions as F

from sheafline.functions import jsonschema
from sheafline.sources import files
from sheafline.streaming import ingest


@pytest.fixture()
def folder(tmp_path):
    for name, body in {"a.pdf": b"%PDF-1.7 %%EOF", "sub/b.PDF": b"%PDF-1.7", "sub/c.png": b"x", "d.txt": b"x", "out/e.pdf": b"%PDF-1.7 %%EOF"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    return tmp_path


def names(df, folder):
    return sorted(r["path"].split(f"{folder}/")[1] for r in df.collect())


def test_inputs(spark, folder):
    assert names(files.inputs_under(spark, str(folder), ["pdf"]), folder) == ["a.pdf", "out/e.pdf", "sub/b.PDF"]
    assert names(files.inputs_under(spark, str(folder), ["pdf"], recursive=False), folder) == ["a.pdf"]
    assert names(files.inputs_under(spark, str(folder), ["pdf", "png"], skip=f"{folder}/out"), folder) == ["a.pdf", "sub/b.PDF", "sub/c.png"]
    told = {r["path"].rsplit("/", 1)[1]: (r["input_type"], r["fault"]) for r in files.described_inputs(files.inputs_under(spark, str(folder), ["pdf", "png"])).collect()}
    assert told == {"a.pdf": ("PDF", None), "b.PDF": ("PDF", "CORRUPTED_PDF"), "c.png": ("IMAGE", None), "e.pdf": ("PDF", None)}
    mirrored = files.inputs_under(spark, str(folder), ["png"]).select(files.mirrored(F.col("path"), str(folder), "/o")).first()[0]
    assert mirrored == "/o/sub/c"


def test_assets(spark, tmp_path):
    (tmp_path / "template").mkdir(), (tmp_path / "schema").mkdir()
    (tmp_path / "template" / "t.md").write_text("Hi\n<doc>\n")
    (tmp_path / "schema" / "s.schema.json").write_text('{"type": "object"}')
    (tmp_path / "schema" / "bad.schema.json").write_text('{"oneOf": []}')
    assert [tuple(r) for r in files.templates(spark, str(tmp_path)).collect()] == [("t", "Hi\n<doc>\n")]
    assert files.load_schema(spark, str(tmp_path), "s") == {"type": "object"} and files.load_schema(spark, str(tmp_path), None) is None
    with pytest.raises(jsonschema.UnsupportedSchema):
        files.load_schema(spark, str(tmp_path), "bad")
    assert files.settings("# c\nA=1\n\nB='x=y'\n") == {"A": "1", "B": "x=y"}


def test_publication(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame(list(r), "document_id string, status string")
    files.publish_table(rows(("a", "READY"), ("b", "READY")), path, ["document_id"])
    files.publish_table(rows(("a", "SUCCESS")), path, ["document_id"])
    assert {(r["document_id"], r["status"]) for r in spark.read.parquet(path).collect()} == {("a", "SUCCESS"), ("b", "READY")}
    files.publish_json(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "json"))
    assert [line for p in (tmp_path / "json").glob("*.json") for line in p.read_text().splitlines()] == ['{"a":null,"b":1}']
    assert [tuple(r) for r in files.read_json(spark, str(tmp_path / "json"), "a string, b int").collect()] == [(None, 1)]
    empty = spark.createDataFrame([("x", b"")], "path string, content binary")
    with pytest.raises(Exception, match="empty"):
        files.publish_binary(empty, str(tmp_path / "bin"))
    files.publish_binary(empty, str(tmp_path / "bin2"), allow_empty=True)
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        files.read_json(spark, str(tmp_path / "bad.json"), "a string").collect()


def test_table_files(spark):
    rows = spark.createDataFrame([("d", [("table_001", "| a |")])], "document_id string, tables array<struct<table_id:string,markdown:string>>")
    assert [tuple(r) for r in files.table_files(rows, "/o").collect()] == [("/o/d/tables/table_001.md", "| a |")]


def test_files_stream_in(spark, folder):
    got = ingest.run_available(ingest.arriving_files(spark, str(folder), ["pdf", "png"]).select("path", "input_type"))
    assert got.count() == 3  # the pattern of a stream is as written: b.PDF is another suffix


def test_stream_of_states_ends_as_the_batch(spark, tmp_path):
    rows = [("d", 1, "PDF", "SUCCESS"), ("d", 2, "PDF", "FAILED"), ("d", 1, "OCR", "SKIPPED"), ("e", 1, "LLM", "READY")]
    runs = spark.createDataFrame(rows, "document_id string, page_number int, stage string, status string")
    for n, part in enumerate((runs.where("page_number = 1"), runs.where("page_number = 2"))):
        part.write.mode("append").parquet(str(tmp_path / "runs"))
    stream = spark.readStream.schema(runs.schema).parquet(str(tmp_path / "runs"))
    told = ingest.run_available(ingest.document_states(stream), "update")
    last = {r["document_id"]: (r["PDF"], r["IMAGE"], r["OCR"], r["LLM"]) for r in told.orderBy("batch").collect()}
    assert last == {r["document_id"]: (r["PDF"], r["IMAGE"], r["OCR"], r["LLM"]) for r in ingest.fold_batch(runs).collect()}
    assert last["d"] == ("FAILED", None, "SKIPPED", None)


def test_json_round_trip(spark):
    state = spark.createDataFrame([("d", [("PDF", "SUCCESS")])], "document_id string, stages array<struct<stage:string,status:string>>")
    text = state.select(F.to_json(F.struct("*")).alias("j"))
    back = text.select(F.from_json("j", state.schema).alias("s")).select("s.*")
    assert back.collect() == state.collect() and json.loads(text.first()["j"])["document_id"] == "d"


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    from types import SimpleNamespace

    from sheafline.sources.scratch import shared_dir

    def session(master, folder=None):
        conf = {"spark.checkpoint.dir": folder} if folder else {}
        context = SimpleNamespace(master=master, getConf=lambda: conf)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d, set=conf.__setitem__), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
        assert shared_dir(session(master, "file:///shared/")) == "file:///shared"
    assert shared_dir(session("local[4]")).startswith("file://")


def test_published_texts_come_back(spark, tmp_path):
    texts = ["a", "two\nlines\r\nand more", "back\\slash \\n", "", "\\\n"]
    files.publish_text(spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "part int, text string"), f"{tmp_path}/out", partitions=["part"])
    back = files.published_text(spark, f"{tmp_path}/out")
    assert sorted((r["part"], r["text"]) for r in back.collect()) == sorted((i % 2, t) for i, t in enumerate(texts))
