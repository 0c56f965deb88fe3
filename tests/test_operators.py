"""Operators on small tables, against plain Python where order matters."""

import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import answers, layout, routing, state
from sheafline.plans import schema as S


def shares(a, b, top, bottom):
    shorter = min(b - a, bottom - top)
    return shorter > 0 and min(b, bottom) - max(a, top) > shorter / 2


def brute_rows(items):
    rows = []
    for item in sorted(items, key=lambda i: (i["t"], i["l"], i["order"])):
        home = None if item["whole"] else next((r for r in rows if not r["whole"] and shares(*r["span"], item["t"], item["b"])), None)
        if home is None:
            rows.append({"span": (item["t"], item["b"]), "whole": item["whole"], "items": [item]})
        else:
            home["span"] = (min(home["span"][0], item["t"]), max(home["span"][1], item["b"]))
            home["items"].append(item)
    rows.sort(key=lambda r: (r["span"][0], r["items"][0]["l"]))
    return {i["item"]: (n, p) for n, r in enumerate(rows, 1) for p, i in enumerate(sorted(r["items"], key=lambda i: (i["l"], i["order"])), 1)}


def test_visual_rows(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for page in range(60):
        items = []
        for n in range(rng.randint(1, 15)):
            top = rng.randint(0, 20) / 10
            items.append({"page": page, "item": n, "l": float(rng.randint(0, 5)), "t": top, "r": 9.0, "b": top + rng.randint(0, 8) / 10, "order": n, "whole": rng.random() < 0.1})
        rows += items
        expected |= {(page, i): v for i, v in brute_rows(items).items()}
    df = spark.createDataFrame(rows, "page int, item int, l double, t double, r double, b double, order int, whole boolean")
    got = {(r["page"], r["item"]): (r["row"], r["place"]) for r in layout.visual_rows(df, ["page"]).collect()}
    assert got == expected
    assert layout.visual_rows(df.limit(0), ["page"]).count() == 0


def test_reading_falls_back_without_boxes(spark):
    rows = [(1, 0, "b", (0.5, 0.1, 0.6, 0.2), 0), (1, 1, "a", (0.1, 0.1, 0.2, 0.2), 1), (1, 2, "c", (0.1, 0.5, 0.2, 0.6), 2), (1, 3, "", (0.0, 0.0, 1.0, 1.0), 3),
            (2, 0, "x", None, 0), (2, 1, "y", (0.0, 0.0, 1.0, 1.0), 1)]
    df = spark.createDataFrame(rows, f"page int, item int, text string, bbox {S.BOX}, order int").withColumn("whole", F.lit(False))
    got = {r["page"]: r["reading"] for r in layout.render_reading(df, ["page"]).collect()}
    assert got == {1: "a   b\n\nc", 2: "x\n\ny"}


def test_paragraphs_merge_and_break(spark):
    box = lambda t: (0.0, t, 1.0, t + 0.1)
    rows = [("d", 1, 0, "text", "a", box(0.1), 1), ("d", 1, 1, "text", "b", None, 1), ("d", 1, 2, "title", "T", box(0.3), 2), ("d", 1, 3, "text", "c", box(0.4), 1), ("d", 2, 4, "text", "e", box(0.0), 1)]
    df = spark.createDataFrame(rows, f"document_id string, page int, order int, type string, text string, bbox {S.BOX}, level int")
    got = [(r["type"], r["text"], r["level"]) for r in layout.merge_blocks(df.where("order != 1")).orderBy("page", "order").collect()]
    assert got == [("paragraph", "a", None), ("title", "T", 2), ("paragraph", "c e", None)]
    # A null box stands at the corner of its page, so before the others.
    first = layout.merge_blocks(df).orderBy("page", "order").first()
    assert first["text"] in ("b a",) and first["bbox"]["t"] == 0.1


def test_tables(spark):
    grid = lambda cells: spark.range(1).select(layout.table_markdown(layout.normalized_grid(F.lit(cells) if cells else F.expr("cast(array() as array<array<string>>)")))).first()[0]
    assert grid([["a", " b "], ["c"]]) == "| a | b |\n| --- | --- |\n| c |  |"
    assert grid([["a|b"]]) == "| a|b |\n| --- |"
    assert grid([]) == ""


def test_text_report(spark):
    tail = "10\t20\t30\t5\t9"
    rows = ["level\thead", f"3\t1\t0\t0\t0\t0\t{tail}\t###FLOW###", f"4\t1\t0\t0\t0\t0\t{tail}\tx", f"5\t1\t0\t0\t0\t0\t{tail}\tone", f"5\t1\t0\t0\t0\t0\t{tail}\ttwo",
            f"4\t1\t0\t0\t0\t0\t{tail}\tx", f"5\t1\t0\t0\t0\t0\t{tail}\tthree", f"3\t1\t0\t0\t0\t0\t{tail}\tempty", f"3\t1\t0\t0\t0\t0\t{tail}\tnext", f"5\t1\t0\t0\t0\t0\t{tail}\tfour", "5\tshort"]
    df = spark.createDataFrame([(1, "\n".join(rows))], "page int, report string")
    got = layout.tsv_blocks(df, ["page"]).orderBy("block").collect()
    assert [(r["block_id"], r["text"]) for r in got] == [("block_001", "one two\nthree"), ("block_002", "four")]
    assert got[0]["bbox"].asDict() == {"l": 10.0, "t": 20.0, "r": 40.0, "b": 25.0}
    assert layout.tsv_text(df, ["page"]).first()["text"] == "one two\nthree\nfour"


def test_image_reports_are_matched_by_position(spark):
    line = "{} {} image 120 90 rgb 3 8 jpeg no 7 0 72 72 1K 1%"
    df = spark.createDataFrame([(1, "page num type\n" + line.format(1, 0) + "\n" + line.format(2, 1))], "page int, report string")
    report = layout.image_report(df, ["page"], "page")
    assert [(r["width"], r["encoding"]) for r in report.collect()] == [(120, "jpeg")]
    files = spark.createDataFrame([(1, "img-010.png"), (1, "img-009.png")], "page int, path string")
    zipped = layout.match_images(report, files, ["page"]).orderBy("pos").collect()
    assert [r["path"] for r in zipped] == ["img-009.png", "img-010.png"] and not zipped[0]["count_matches"]


def test_rules_hold_in_their_order(spark):
    names = ["skip", "force", "reason", "failed", "available", "reusable", "start"]
    expected = {"skip": ("SKIP", "explicit_skip"), "force": ("FORCE", "forced_by_policy"), "reason": ("SKIP", "why"), "failed": ("BLOCKED", "failed_and_retry_disabled"),
                "available": ("BLOCKED", "input_unavailable"), "reusable": ("REUSE", "valid_result_reused"), "start": ("BLOCKED", "before_start_stage_without_result")}
    some = lambda on: F.array(F.lit("PDF")) if on else F.expr("cast(array() as array<string>)")
    for i in range(len(names) + 1):
        on = {n: j >= i for j, n in enumerate(names)}  # all rules from the i-th on hold at once
        go = routing.resolve_stage(
            F.lit("PDF"), some(on["skip"]), some(on["force"]), F.lit("why" if on["reason"] else None).cast("string"), F.lit(on["failed"]), F.lit(False), F.lit(not on["available"]),
            F.lit(on["reusable"]), F.lit(True), F.lit("LLM" if on["start"] else None).cast("string"))
        got = spark.range(1).select(go.alias("g")).first()["g"]
        assert tuple(got) == (expected[names[i]] if i < len(names) else ("EXECUTE", "no_valid_result"))


def test_image_rules(spark):
    row = lambda **m: spark.createDataFrame([({"blur": 60.0, "sharpness": 5.0, "contrast": 40.0, "brightness": 150.0, "noise": 1.0, "text_coverage": 0.2, "skew": None} | m)],
        "blur double, sharpness double, contrast double, brightness double, noise double, text_coverage double, skew double")
    got = lambda **m: (lambda r: (r["class"], r["profile"]["name"], r["shift"]))(routing.classify_images(row(**m)).first())
    assert got() == ("TEXT_IMAGE", "clean", None)
    assert got(brightness=10.0) == ("LOW_QUALITY", "clean", 120.0)
    assert got(brightness=250.0)[2] is None
    assert got(noise=6.0, brightness=200.0, contrast=20.0)[1] == "noisy"
    assert got(brightness=200.0, contrast=20.0)[1] == "washed_out"
    assert got(skew=-15.0)[1] == "uneven_or_skewed" and got(skew=-90.0)[1] == "clean"
    assert got(text_coverage=0.02)[0] == "MIXED_IMAGE" and got(text_coverage=0.019)[0] == "VISUAL_IMAGE"


def test_closure():
    assert state.closure(S.STAGE_NEEDS, "IMAGE") == ("OCR", "LLM")
    assert state.closure(S.STAGE_NEEDS, "OCR", downstream=False) == ("PDF", "IMAGE")
    with pytest.raises(ValueError):
        state.closure(S.STAGE_NEEDS, "NOPE")


def test_invalidation_reaches_one_page_or_all(spark):
    rows = [("d", p, s, "SUCCESS", None) for p in (1, 2) for s in S.STAGES]
    stages = spark.createDataFrame(rows, "document_id string, page_number int, stage string, status string, reason string")
    changed = spark.createDataFrame([("d", 1, "IMAGE", "one"), ("d", None, "OCR", "all")], "document_id string, page_number int, stage string, cause string")
    got = {(r["page_number"], r["stage"]): (r["status"], r["reason"]) for r in state.invalidate(stages, changed).collect()}
    assert got[(1, "OCR")] == ("INVALIDATED", "one") and got[(2, "OCR")] == ("SUCCESS", None)
    assert got[(2, "LLM")][0] == "INVALIDATED" and got[(1, "PDF")][0] == "SUCCESS"
    assert len(got) == len(rows)


def test_states_move_with_reasons(spark):
    pages = spark.createDataFrame([("d", 1)], "document_id string, page_number int")
    stages = state.create_stages(pages, F.lit("{}"), F.lit("k"), F.lit("p"), F.lit("1"))
    assert sorted(r["stage_id"] for r in stages.collect()) == ["IMAGE:1", "LLM:1", "OCR:1", "PDF:1"]
    skipped = state.set_status(stages, F.col("stage") == "OCR", "SKIPPED", F.lit("why"))
    row = skipped.where("stage = 'OCR'").first()
    assert row["status"] == "SKIPPED" and row["finished_at"] is not None and skipped.where("status = 'NOT_STARTED'").count() == 3
    with pytest.raises(ValueError):
        state.set_status(stages, F.lit(True), "REUSED")
    with pytest.raises(ValueError):
        state.set_status(stages, F.lit(True), "NOPE")


def test_comparison_tells_absent_from_null(spark):
    left = spark.createDataFrame([(1, '{"a": null, "b": 1, "c": 2}'), (2, "5")], "id int, v string")
    right = spark.createDataFrame([(1, '{"a": null, "b": 1.0, "d": null}'), (2, "5")], "id int, v string")
    fields = lambda df: df.select("id", answers.as_fields(F.parse_json("v")).alias("fields"))
    got = {(r["id"], r["field"]): r["agrees"] for r in answers.compare(fields(left), fields(right), "id").collect()}
    assert got == {(1, "a"): True, (1, "b"): got[(1, "b")], (1, "c"): False, (1, "d"): False, (2, "value"): True}


def test_graphs():
    plan = answers.compile_graph(answers.default_graph())
    assert [n.node_id for n in plan.nodes] == list(S.DEFAULT_GRAPH) and plan.nodes[3].depends_on == ("extract_a", "extract_b")
    assert {(n.template, n.schema, n.task == n.node_id) for n in plan.nodes} == {("simple_extract", "simple", True)}
    assert answers.compared_pairs(plan) == [("compare", "extract_a", "extract_b")]
    head, a, b = {"graph_id": "g", "graph_version": "1"}, {"node_id": "a", "template": "t"}, {"node_id": "b", "template": "t"}
    assert answers.compile_graph(head | {"nodes": [a, b | {"depends_on": ["a"], "schema": None, "task": "x"}]}).nodes[1].task == "x"
    refused = {
        "needs a graph descriptor": None, "no graph_id": {"graph_version": "1", "nodes": [a]}, "no graph_version": {"graph_id": "g", "nodes": [a]}, "declares no nodes": head | {"nodes": []},
        "not supported: edges": head | {"nodes": [a], "edges": []}, "is not a mapping": head | {"nodes": ["a"]}, "no node_id": head | {"nodes": [a | {"node_id": " "}]},
        "declares a twice": head | {"nodes": [a, a]}, "not supported: when": head | {"nodes": [a | {"when": 1}]}, "not a list": head | {"nodes": [a | {"depends_on": "b"}]},
        "do not precede it: b": head | {"nodes": [a | {"depends_on": ["b"]}, b]}, "no template": head | {"nodes": [{"node_id": "a"}]}, "no task": head | {"nodes": [a | {"task": ""}]},
    }
    for told, bad in refused.items():
        with pytest.raises(answers.GraphError, match=told):
            answers.compile_graph(bad)


def test_merged_paragraphs_leave_empty_texts_out(spark):
    from sheafline.functions import geometry as G

    rows = spark.createDataFrame([(1, 1, i, "text", t, 0.1 * i) for i, t in enumerate(["a", "", "b", ""])], "document_id int, page int, `order` int, type string, text string, y double")
    blocks = rows.withColumn("bbox", G.box(F.col("y"), F.col("y"), F.col("y") + 1, F.col("y") + 1)).withColumn("level", F.lit(None).cast("int")).drop("y")
    assert [r["text"] for r in layout.merge_blocks(blocks).collect()] == ["a b"]


def test_records_round_trip(spark):
    rows = spark.createDataFrame([("d", None, [1, 2])], "document_id string, note string, pages array<int>")
    payload = state.to_payload(rows, "document_id")
    assert payload.first()["payload"] == '{"document_id":"d","note":null,"pages":[1,2]}'
    assert state.from_payload(payload, "document_id string, note string, pages array<int>").collect() == rows.collect()


def test_new_documents_and_pages(spark):
    requests = spark.createDataFrame([("d", "a.pdf", "auto", "h")], "document_id string, path string, declared string, input_sha256 string")
    row = state.create_documents(requests).first()
    assert (row["input_type"], row["status"]) == ("PDF", "PAUSED") and row["workflow_run_id"].startswith("run-")
    pages = state.create_pages(spark.createDataFrame([("d", 2), ("e", 0)], "document_id string, page_count int")).collect()
    assert [(r["page_number"], r["native_text"]) for r in pages] == [(1, None), (2, None)]


def test_saved_graphs_must_match(spark):
    saved = spark.createDataFrame([("g", "1")], "graph_id string, graph_version string")
    assert state.matching_state(saved, "g", "1").count() == 1
    with pytest.raises(Exception, match="saved state is of g 1"):
        state.matching_state(saved, "g", "2").collect()


def test_records_of_extractions(spark):
    row = spark.range(1).select(
        layout.ocr_metadata(F.lit("a.png"), F.lit("2"), F.lit("{}"), F.lit(3), F.lit("VALID"), F.lit(0.5), F.array(F.lit("deskew"))).alias("m")
    ).first()["m"]
    assert (row["engine"], row["processor"], row["processor_version"], row["input"], row["transformations"]) == (S.OCR_ENGINE, "ocr", "0.0.0", "a.png", ["deskew"])


def _plain_blocks(report):
    """[text, left] of each block of a text report, by plain loops."""
    blocks = [[[[]], None]]
    for line in report.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        cells = line.split("\t")
        level = cells[0].strip(" ") if len(cells) >= 12 else ""
        if level == "3":
            blocks.append([[[]], float(cells[6])])
        elif level == "4":
            blocks[-1][0].append([])
        elif level == "5":
            blocks[-1][0][-1].append(cells[11].strip())
    told = [("\n".join(t for t in (" ".join(w for w in words if w) for words in lines) if t), left) for lines, left in blocks]
    return [b for b in told if b[0]]


def test_reports_with_odd_words(spark):
    row = lambda level, word="", more="": f"{level}\t1\t1\t1\t1\t1\t{len(word)}\t20\t30\t5\t99\t{word}{more}"
    parts = [
        row(5, "before"), row(3, "head"), row(4), row(5, "a b"), row(5, "c\x85d e"), row(5, " \xa0f　"), row(5, " "), row(5), row(4), row(" 5 ", "g", "\tmore"), "5\tshort\trow", "3\tshort",
        "", row("\xa05", "not"), row("35", "not"), row(3, "empty"), row(4), row(4), row(" 3 ", "last one"), row(5, "3"), row(2, "no"), row(5, "h"),
    ]
    reports = ["\n".join(parts), "\r\n".join(parts), "\n".join(p for p in parts if not any(c in p for c in " \x85\xa0　 ")), "", row(5, "x"), "\n".join([row(3)] + [row(5, "\v")] * 3)]
    df = spark.createDataFrame(list(enumerate(reports)), "page int, report string")
    got = {n: [] for n in range(len(reports))}
    for r in layout.tsv_blocks(df, ["page"]).orderBy("page", "block").collect():
        got[r["page"]].append((r["text"], r["bbox"] and r["bbox"]["l"]))
        assert r["block"] == len(got[r["page"]])
    assert got == {n: _plain_blocks(report) for n, report in enumerate(reports)}
    for r in layout.tsv_text(df, ["page"]).collect():
        assert r["text"] == "\n".join(t for t, _ in got[r["page"]]) and r["blocks"] == len(got[r["page"]])
    assert "regexp" not in layout.tsv_text(df, ["page"])._jdf.queryExecution().optimizedPlan().toString().lower()
