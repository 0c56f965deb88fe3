"""Column functions on boundary cases."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from sheafline.functions import geometry as G
from sheafline.functions import identity, jsonschema, options, prompts
from sheafline.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_words_split_at_unicode_white_space(spark):
    text = "a b c\x1fd e　f\x85g"
    assert one(spark, X.word_count(F.lit(text))) == len(text.split()) == 7
    assert one(spark, X.word_count(F.lit(""))) == 0
    assert one(spark, X.word_count(F.lit(None).cast("string"))) is None
    assert one(spark, X.is_blank(F.lit("  \n\x1f"))) is True
    assert one(spark, X.strip(F.lit("  a b\x85"))) == "a b"


def test_normal_forms(spark):
    assert one(spark, X.sanitize(F.lit("a\r\nb\rc\x00d"))) == "a\nb\ncd"
    assert one(spark, X.normalize_ocr_text(F.lit("\n\na  \r\nb\t\n\n \n"))) == "\n\na\nb"
    assert one(spark, X.normalize_markdown(F.lit(" \n"))) == ""
    assert one(spark, X.normalize_markdown(F.lit("x  "))) == "x\n"
    assert one(spark, X.page_characters(F.lit("a\r\nb😀"))) == 3


def test_tokens(spark):
    for text, n in (("", 0), ("a", 1), ("abcd", 1), ("abcde", 2), ("ab\r\ncd", 2)):
        assert one(spark, X.tokens(F.lit(text))) == n
    assert one(spark, X.truncate_to_tokens(F.lit("abcdefgh"), F.lit(1))) == "abcd"
    assert one(spark, X.truncate_to_tokens(F.lit("abcdefgh"), F.lit(-3))) == ""


def test_context_verdict(spark):
    cases = [(10, 10, 0, None, "fits"), (11, 10, 0, None, "exceeds"), (1, None, 0, None, "unmeasured"), (1, 10, 1, None, "unmeasured"),
             (11, 10, 1, None, "exceeds"), (1, 10, 2, 4, "fits"), (1, 10, 2, 5, "exceeds"), (1, 10, 1, -5, "fits")]
    rows = spark.createDataFrame(cases, "p int, w int, i int, c int, v string")
    for r in rows.select("v", X.context_verdict(F.col("p"), F.col("w"), F.col("i"), F.col("c")).alias("got")).collect():
        assert r["got"] == r["v"]


def test_boxes(spark):
    box = lambda *b: G.box(*[F.lit(float(x)) for x in b])
    assert one(spark, G.area(box(0, 0, 2, 3))) == 6
    assert one(spark, G.area(box(2, 0, 0, 3))) == 0
    assert one(spark, G.area(F.expr("cast(null as struct<l:double,t:double,r:double,b:double>)"))) == 0
    assert one(spark, G.coverage(F.lit(5.0), F.lit(0.0))) == 0 and one(spark, G.coverage(F.lit(5.0), F.lit(2.0))) == 1
    assert one(spark, G.shares_a_line(box(0, 0, 1, 2), box(0, 1, 1, 3))) is False  # exactly half
    assert one(spark, G.shares_a_line(box(0, 0, 1, 2), box(0, 0.9, 1, 3))) is True
    assert one(spark, G.shares_a_line(box(0, 0, 1, 0), box(0, 0, 1, 3))) is False


def test_canonical_json_and_keys(spark):
    assert one(spark, identity.canonical_json(F.lit('{"b": [1, {"d": null, "c": "é"}], "a": 1.5}'))) == '{"a":1.5,"b":[1,{"c":"é","d":null}]}'
    assert one(spark, identity.canonical_json(F.lit("{"))) is None
    text = '{"x":"é😀 "}'
    assert one(spark, identity.escape_ascii(F.lit(text))) == json.dumps(json.loads(text), separators=(",", ":"))
    body = json.dumps({"input_hashes": ["aa"], "normalized_options": {"dpi": 200}, "processor": "pé", "processor_version": "1"}, sort_keys=True, separators=(",", ":"))
    key = identity.processing_key(F.lit("pé"), F.lit("1"), F.array(F.lit("aa")), F.lit('{"dpi":200}'))
    assert one(spark, key) == hashlib.sha256(body.encode()).hexdigest()
    assert identity.canonical_ascii({"b": "é", "a": 1}) == '{"a":1,"b":"\\u00e9"}'


def test_volatile_options_do_not_change_a_request_key(spark):
    none = F.lit(None).cast("string")
    no_images = F.expr("cast(array() as array<string>)")

    def key(**stated):
        m = F.create_map(*[F.lit(x) for kv in stated.items() for x in kv])
        return one(spark, identity.request_key(F.lit("p"), F.lit("m"), none, F.lit("hi"), none, no_images, none, m))

    assert key(a="1") == key(a="1", stream="true", api_key="s")
    assert key(a="1") != key(a="2")
    assert key(a="1", b="2") == key(b="2", a="1")


def test_options(spark):
    parse = lambda text: options.parse(F.lit(text))
    assert one(spark, options.max_attempts(parse('{"max_attempts": 5}'))) == 5
    for bad in ('{"max_attempts": true}', '{"max_attempts": "5"}', '{"max_attempts": 0}', "{}"):
        assert one(spark, options.max_attempts(parse(bad))) == 2
    assert one(spark, options.timeout(parse('{"timeout": 1.5}'))) == 1.5
    assert one(spark, options.timeout(parse('{"timeout": -1}'))) == 30.0
    assert one(spark, options.text(parse('{"model_version": "  "}'), "model_version")) is None
    assert one(spark, parse("[1]")) is None
    try:
        one(spark, options.required(parse("{}"), "allow_ocr"))
    except Exception as error:
        assert "allow_ocr is required" in str(error)
    else:
        raise AssertionError("an absent policy must be an error")


def test_templates_fill_in_one_pass(spark):
    extra = F.create_map(F.lit("k"), F.lit("<doc>"))
    filled = one(spark, prompts.render(F.lit("<extra:k>|<doc>|<extra>|<schema>|<other>"), F.lit("<schema>\r\n$1\\"), extra, F.lit("{}")))
    assert filled["prompt"] == '<doc>|<schema>\n$1\\|{"k":"<doc>"}|{}|<other>' and filled["error"] is None
    none = F.lit(None).cast("string")
    for template in ("<doc>", "<schema>", "<extra:z>"):
        got = one(spark, prompts.render(F.lit(template), none, extra, none))
        assert got["prompt"] is None and template in got["error"]


def test_answers_are_unwrapped_once(spark):
    parse = lambda raw: one(spark, F.to_json(prompts.parse_answer(F.lit(raw))["value"]))
    assert parse('```json\n{"a": 1}\n```') == '{"a":1}'
    assert parse(' \n[1] ') == "[1]"
    assert parse("```\n```json\n1\n```\n```") is None
    assert parse("no json") is None
    error = one(spark, prompts.parse_answer(F.lit("x" * 600))["error"])
    assert error == "INVALID_JSON: " + "x" * 500


SCHEMA = {
    "type": "object", "required": ["a", "b"], "additionalProperties": False,
    "properties": {"a": {"type": ["string", "null"]}, "b": {"type": "array", "minItems": 1, "items": {"type": "object", "properties": {"n": {"type": "integer", "enum": [1, 2]}}}}, "c": {"type": "number"}},
}


def test_schema_violations(spark):
    cases = {
        '{"a": null, "b": [{"n": 1}]}': [],
        "[]": ["$: expected object, got array"],
        '{"a": 1, "b": []}': ["$.a: expected string or null, got integer", "$.b: expected at least 1 items, got 0"],
        '{"b": [{"n": 3}, {"n": true}, 5]}': [
            "$: required property 'a' is missing", "$.b[0].n: 3 is not one of [1, 2]", "$.b[1].n: expected integer, got boolean", "$.b[2]: expected object, got integer"],
        '{"a": "x", "b": [{}], "c": 1, "z": 0, "y": 0}': ["$: property 'y' is not allowed by the schema", "$: property 'z' is not allowed by the schema"],
        '{"a": "x", "b": [{}], "c": false}': ["$.c: expected number, got boolean"],
    }
    for text, expected in cases.items():
        assert one(spark, jsonschema.violations(F.parse_json(F.lit(text)), SCHEMA)) == expected, text
    for bad in ({"type": "object", "pattern": "x"}, {"properties": {"a": {"oneOf": []}}}, {"items": {"maximum": 3}}, []):
        try:
            jsonschema.check_schema(bad)
        except jsonschema.UnsupportedSchema:
            continue
        raise AssertionError(bad)


def test_boxes_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, *[rng.choice([0.0, 0.25, 0.5, 0.75, 1.0, 2.0]) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, l double, t double, r double, b double")
    got = {r["id"]: r["a"] for r in df.select("id", G.area(F.struct("l", "t", "r", "b")).alias("a")).collect()}
    for i, left, t, r, b in rows:
        assert got[i] == max(0, r - left) * max(0, b - t)


def test_provider_and_engine_failures(spark):
    status = lambda s, b="": one(spark, prompts.status_failure(F.lit(s), F.lit(b)))
    assert [status(200), status(404), status(400, "Context Length"), status(413), status(500, "too long")] == [
        None, "MODEL_UNAVAILABLE", "CONTEXT_OVERFLOW", "PROVIDER_ERROR", "PROVIDER_ERROR"]
    engine = lambda e, c: one(spark, prompts.engine_failure(F.lit(e), F.lit(c), F.lit("RENDER_ERROR")))
    assert [engine("Syntax Error", 3), engine("", 3), engine("", 1), engine("Wrong page range given", 99), engine("", 2), engine("", 9)] == [
        "CORRUPTED_PDF", "ENCRYPTED_PDF", "INVALID_INPUT", "PAGE_EXTRACTION_ERROR", "IO_ERROR", "RENDER_ERROR"]


def test_typed_options(spark):
    items = F.array(*[F.lit(x) for x in ("a=1", "b=x y", 'c={"k": [true]}', "d=", "a=2", 'e="q')])
    got = one(spark, F.transform_values(options.typed_values(items), lambda _, v: F.to_json(v)))
    assert got == {"a": "2", "b": '"x y"', "c": '{"k":[true]}', "d": '""', "e": '"\\"q"'}
    stated = F.create_map(*[F.lit(x) for x in ("api_key", "k", "top_p", "1", "timeout", "3")])
    assert one(spark, options.without_control(stated)) == {"top_p": "1"}
    fixed = F.create_map(F.lit("top_p"), F.lit("2"))
    assert one(spark, options.engine_config(stated, fixed)) == {"api_key": "k", "timeout": "3", "top_p": "2"}


def test_a_body_is_parsed_once(spark):
    bodies = ['{"message": {"content": "x"}, "eval_count": 7, "prompt_eval_count": 2}', '{"choices": [{"message": {"content": "y"}}], "usage": {"prompt_tokens": 3}}', None]
    rows = [(i, p, b) for i, (p, b) in enumerate(zip(("ollama", "openai", "openai"), bodies))]
    df = spark.createDataFrame(rows, "n int, p string, b string").select("n", prompts.answer_of(F.col("p"), F.try_parse_json("b")).alias("a")).select("n", "a.text", "a.usage.input_tokens", "a.usage.total_tokens")
    assert [tuple(r) for r in df.orderBy("n").collect()] == [(0, "x", 2, 9), (1, "y", 3, None), (2, None, None, None)]
    assert df._jdf.queryExecution().analyzed().toString().count("parse_json") == 1
