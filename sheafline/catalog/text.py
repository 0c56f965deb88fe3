"""Queries over texts: measurements, normal forms, tokens, keys, prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.functions import identity, options, prompts
from sheafline.functions import text as X
from sheafline.operators import layout, pages, routing
from sheafline.plans import schema as S

#: A page of US letter size, in points.
WIDTH, HEIGHT = 612.0, 792.0

_WORDS = "len(regexp_extract_all(text, '[^\\s]+'))"
_CHARS = "length(replace(replace(text, chr(10), ''), chr(13), ''))"


@query(f"""
SELECT lang, CASE WHEN {_CHARS} >= 20 THEN 'TEXT' ELSE 'IMAGE' END AS class, count(*) AS documents,
       CAST(sum({_CHARS}) AS BIGINT) AS characters, CAST(sum({_WORDS}) AS BIGINT) AS words,
       CAST(sum(CAST(ceil(length(text) / 4.0) AS BIGINT)) AS BIGINT) AS tokens
FROM documents GROUP BY ALL
""")
def text_metrics_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of native text: measured, classed, summed by language and class."""
    none = F.expr(f"cast(array() as array<{S.BOX}>)")
    docs = table(spark, sf_dir, "documents").select(
        "lang", "text", pages.page_metrics(F.col("text"), none, none, F.lit(WIDTH), F.lit(HEIGHT)).alias("m")
    )
    m = F.col("m")
    kind = pages.page_class(m["characters"], m["text_coverage"], m["image_coverage"], m["largest_image_coverage"])
    return docs.groupBy("lang", kind.alias("class")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(m["characters"]).alias("characters"),
        F.sum(m["words"]).alias("words"),
        F.sum(X.tokens(F.col("text"))).alias("tokens"),
    )


@query(f"""
SELECT doc_id, length(text) AS characters, CAST({_WORDS} AS BIGINT) AS words,
       length(text) / (612.0::DOUBLE * 792.0::DOUBLE) AS text_density,
       CAST(len(string_split(text, chr(10))) AS BIGINT) AS blocks, CAST(len(string_split(text, chr(10))) AS BIGINT) AS paragraphs,
       CAST(0 AS BIGINT) AS tables, NOT regexp_matches(text, '[^\\s]') AS empty, true AS structure_detected
FROM documents
""")
def ocr_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as extractions, their lines as paragraphs."""
    kinds = F.transform(F.split("text", "\n"), lambda _: F.lit("paragraph"))
    m = layout.ocr_metrics(F.col("text"), kinds, F.lit(0), F.lit(WIDTH), F.lit(HEIGHT))
    return table(spark, sf_dir, "documents").select("doc_id", m.alias("m")).select("doc_id", "m.*")


@query("""
SELECT CASE WHEN doc_id % 17 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'PARSE_ERROR' ELSE 'ERROR' END
            WHEN doc_id % 13 = 0 THEN 'INCOMPLETE' WHEN NOT regexp_matches(text, '[^\\s]') THEN 'EMPTY'
            WHEN length(text) < 8 THEN 'LOW_CONTENT' ELSE 'VALID' END AS state, count(*) AS documents
FROM documents GROUP BY 1
""")
def ocr_validation_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extractions by validation state; every 17th run failed, every 13th lost an artifact."""
    doc = F.col("doc_id")
    state = layout.ocr_state(
        F.when(doc % 17 == 0, "failed").otherwise("success"),
        F.when(doc % 2 == 0, "EXPORT_ERROR").otherwise("ENGINE_ERROR"),
        F.lit(True),
        F.when(doc % 13 == 0, 1).otherwise(0),
        F.lit(0),
        X.is_blank(F.col("text")),
        F.length("text"),
    )
    return table(spark, sf_dir, "documents").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("documents"))


_NORMAL = "regexp_replace(array_to_string(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '\\s+$', '')), chr(10)), '\\n+$', '')"


@query(f"""
SELECT doc_id, sha256({_NORMAL}) AS text_sha256,
       sha256(CASE WHEN length({_NORMAL}) > 0 THEN {_NORMAL} || chr(10) ELSE '' END) AS markdown_sha256,
       length(replace(text, chr(13), '')) AS sanitized
FROM documents
""")
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal forms of extracted text and Markdown, as digests."""
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select("doc_id", X.normalize_ocr_text(text).alias("clean"), F.length(X.sanitize(text)).alias("sanitized"))
    return rows.select(
        "doc_id", identity.digest(F.col("clean")).alias("text_sha256"), identity.digest(X.ended(F.col("clean"))).alias("markdown_sha256"), "sanitized"
    )


@query("""
WITH t AS (SELECT doc_id, text, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens, doc_id % 3 AS images,
                  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 512 END AS win, CASE WHEN doc_id % 2 = 0 THEN 100 END AS cost FROM documents)
SELECT doc_id, tokens, length(CASE WHEN tokens <= 64 THEN text ELSE substr(text, 1, 256) END) AS kept,
       CASE WHEN images > 0 AND cost IS NULL THEN CASE WHEN coalesce(tokens > win, false) THEN 'exceeds' ELSE 'unmeasured' END
            WHEN win IS NULL THEN 'unmeasured'
            WHEN tokens + images * coalesce(cost, 0) > win THEN 'exceeds' ELSE 'fits' END AS verdict,
       'the prompt needs about ' || tokens || ' text tokens' || CASE WHEN images > 0 THEN ' plus ' || images || ' image(s) at ' ||
       CASE WHEN cost IS NULL THEN 'unstated cost' ELSE 'about ' || cost || ' tokens each' END ELSE '' END || ', and the stated window is '
       || coalesce(CAST(win AS VARCHAR), 'None') AS message
FROM t
""")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token estimates, truncation to 64 tokens, and what is known of the fit into a window."""
    doc = F.col("doc_id")
    tokens, images = X.tokens(F.col("text")), doc % 3
    window = F.when(doc % 5 != 0, 512)
    cost = F.when(doc % 2 == 0, 100)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tokens.alias("tokens"),
        F.length(X.truncate_to_tokens(F.col("text"), F.lit(64))).alias("kept"),
        X.context_verdict(tokens, window, images, cost).alias("verdict"),
        X.overflow_message(tokens, window, images, cost).alias("message"),
    )


@query("""
SELECT 'document' AS kind, doc_id AS id, sha256(text) AS content_sha256,
       sha256('{"input_hashes":{"document":"' || sha256(text) || '","images":[]},"model":"m","model_version":null,"normalized_options":{"temperature":"0"},"provider":"p","rendered_prompt":"read ' || doc_id || '","schema_hash":null}') AS request_key,
       sha256('{"input_hashes":["' || sha256(text) || '"],"normalized_options":{"dpi":200},"processor":"ocr","processor_version":"1"}') AS processing_key,
       sha256('pdf|1|' || sha256(text) || '|{"dpi": 200}') AS piped_key
FROM documents
UNION ALL
SELECT 'page', page_id, sha256(html),
       sha256('{"input_hashes":{"document":"' || sha256(html) || '","images":[]},"model":"m","model_version":null,"normalized_options":{"temperature":"0"},"provider":"p","rendered_prompt":"read ' || page_id || '","schema_hash":null}'),
       sha256('{"input_hashes":["' || sha256(html) || '"],"normalized_options":{"dpi":200},"processor":"ocr","processor_version":"1"}'),
       sha256('pdf|1|' || sha256(html) || '|{"dpi": 200}')
FROM pages
""")
def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, request keys, processing keys and piped keys of documents and pages; the switch for
    streaming and the credential are in the options and change nothing."""

    def keyed(name: str, kind: str, id_: str, content: str) -> DataFrame:
        digest = identity.digest(F.col(content))
        stated = F.create_map(*[F.lit(x) for x in ("temperature", "0", "stream", "true", "api_key", "k")])
        prompt = F.concat(F.lit("read "), F.col(id_).cast("string"))
        none = F.lit(None).cast("string")
        no_images = F.expr("cast(array() as array<string>)")
        return table(spark, sf_dir, name).select(
            F.lit(kind).alias("kind"),
            F.col(id_).alias("id"),
            digest.alias("content_sha256"),
            identity.request_key(F.lit("p"), F.lit("m"), none, prompt, digest, no_images, none, stated).alias("request_key"),
            identity.processing_key(F.lit("ocr"), F.lit("1"), F.array(digest), F.lit('{"dpi":200}')).alias("processing_key"),
            identity.piped_key(F.lit("pdf"), F.lit("1"), digest, F.lit('{"dpi": 200}')).alias("piped_key"),
        )

    return keyed("documents", "document", "doc_id", "text").unionByName(keyed("pages", "page", "page_id", "html"))


@query("""
SELECT sha256(text) AS content_sha256, min(doc_id) AS first_id, count(*) AS uses, count(*) - 1 AS reusable
FROM documents GROUP BY 1 HAVING count(*) > 1
""")
def duplicate_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content that comes more than once: work that is done once and reused."""
    docs = table(spark, sf_dir, "documents").select("doc_id", identity.digest(F.col("text")).alias("content_sha256"))
    uses = F.count(F.lit(1))
    return docs.groupBy("content_sha256").agg(F.min("doc_id").alias("first_id"), uses.alias("uses"), (uses - 1).alias("reusable")).where("uses > 1")


@query("""
SELECT doc_id, sha256('Read:' || chr(10) || text || chr(10) || 'in ' || lang || ' {"lang":"' || lang || '","note":"<doc>"} {"type":"object"}') AS prompt_sha256,
       CAST(NULL AS VARCHAR) AS error
FROM documents WHERE doc_id % 10 <> 0
UNION ALL SELECT doc_id, NULL, 'DEPENDENCY_ERROR: <doc>' FROM documents WHERE doc_id % 10 = 0
""")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template filled in one pass: what is inserted is never scanned again, and every tenth request
    lacks its document."""
    template = F.lit("Read:\n<doc>\nin <extra:lang> <extra> <schema>")
    document = F.when(F.col("doc_id") % 10 != 0, F.col("text"))
    extra = F.create_map(F.lit("note"), F.lit("<doc>"), F.lit("lang"), F.col("lang"))
    done = prompts.render(template, document, extra, F.lit('{"type":"object"}'))
    return table(spark, sf_dir, "documents").select("doc_id", done.alias("r")).select(
        "doc_id", identity.digest(F.col("r.prompt")).alias("prompt_sha256"), F.col("r.error").alias("error")
    )


@query("""
WITH b AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN url || '.PDF' WHEN 1 THEN 'a/b.png' WHEN 2 THEN 'a/b.TIFF' WHEN 3 THEN 'a.b/c'
                  WHEN 4 THEN 'x.webp' WHEN 5 THEN 'y.txt' ELSE 'z.gif' END AS path, CASE WHEN page_id % 5 = 0 THEN 'PDF' ELSE 'auto' END AS declared,
                  page_id % 11 <> 0 AS there FROM pages)
SELECT page_id, CASE WHEN NOT there THEN 'UNSUPPORTED' WHEN declared <> 'auto' THEN declared
                     WHEN lower(path) LIKE '%.pdf' THEN 'PDF' WHEN regexp_matches(lower(path), '\\.(png|jpg|jpeg|tif|tiff|bmp|webp|gif)$') THEN 'IMAGE'
                     ELSE 'UNSUPPORTED' END AS input_type,
       CASE WHEN NOT there THEN 'INVALID_INPUT' WHEN NOT regexp_matches(lower(path), '\\.(bmp|jpeg|jpg|png|tif|tiff)$') THEN 'UNSUPPORTED_FORMAT'
            WHEN page_id % 6 = 0 THEN 'INVALID_INPUT' END AS image_fault
FROM b
""")
def input_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of input by declaration and suffix, and the first failing check of an image."""
    page = F.col("page_id")
    names = {0: F.concat("url", F.lit(".PDF")), 1: "a/b.png", 2: "a/b.TIFF", 3: "a.b/c", 4: "x.webp", 5: "y.txt"}
    path = F.lit("z.gif")
    for k, name in names.items():
        path = F.when(page % 7 == k, name).otherwise(path)
    there = page % 11 != 0
    size = F.when(there, F.when(page % 6 == 0, 0).otherwise(9))
    return table(spark, sf_dir, "pages").withColumn("path", path).select(
        "page_id",
        routing.input_type(F.col("path"), F.when(page % 5 == 0, "PDF").otherwise("auto"), there).alias("input_type"),
        routing.image_precheck(F.col("path"), size).alias("image_fault"),
    )


@query("""
WITH b AS (SELECT page_id, CASE page_id % 8
    WHEN 0 THEN '%PDF-1.7' || chr(10) || html || '%%EOF' WHEN 1 THEN html WHEN 2 THEN '%PDF-3.0' || html || '%%EOF' WHEN 3 THEN '%PDF-1.4' || html
    WHEN 4 THEN '%PDF-2.0 /Encrypt %%EOF' WHEN 5 THEN '' WHEN 6 THEN '%PDF-1.1%%EOF' || repeat('x', 4000) ELSE '%PDF-2.1' || repeat('x', 3000) || '%%EOF' END AS body FROM pages)
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'UNSUPPORTED_PDF' WHEN length(body) = 0 THEN 'CORRUPTED_PDF' WHEN body NOT LIKE '\\%PDF-%' ESCAPE '\\' THEN 'CORRUPTED_PDF'
     WHEN NOT regexp_matches(body, '^%PDF-[12]\\.') THEN 'UNSUPPORTED_PDF' WHEN NOT contains(right(body, 2048), '%%EOF') THEN 'CORRUPTED_PDF'
     WHEN contains(right(body, 2048), '/Encrypt') THEN 'ENCRYPTED_PDF' END AS fault
FROM b
""")
def pdf_precheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failing check of files that pretend to be PDFs."""
    page, html = F.col("page_id"), F.col("html")
    bodies = [
        F.concat(F.lit("%PDF-1.7\n"), html, F.lit("%%EOF")), html, F.concat(F.lit("%PDF-3.0"), html, F.lit("%%EOF")), F.concat(F.lit("%PDF-1.4"), html),
        F.lit("%PDF-2.0 /Encrypt %%EOF"), F.lit(""), F.lit("%PDF-1.1%%EOF" + "x" * 4000),
    ]
    body = F.lit("%PDF-2.1" + "x" * 3000 + "%%EOF")
    for k, b in enumerate(bodies):
        body = F.when(page % 8 == k, b).otherwise(body)
    path = F.when(page % 9 == 0, "a.txt").otherwise("a.PDF")
    return table(spark, sf_dir, "pages").select("page_id", pages.precheck(path, body.cast("binary")).alias("fault"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) + 1 ELSE 2 END AS attempts,
       CASE event_id % 4 WHEN 1 THEN value + 1 ELSE 30.0 END AS timeout,
       CAST(CASE WHEN event_id % 4 = 2 THEN 4096 ELSE -1 END AS BIGINT) AS context_window,
       CASE WHEN event_id % 4 = 2 THEN 'v1' END AS version
FROM events
""")
def stated_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options count only with the right type: true, texts and blanks leave the defaults."""
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    text = (
        F.when(event % 4 == 0, F.format_string('{"max_attempts": %d, "timeout": "5"}', k + 1))
        .when(event % 4 == 1, F.concat(F.lit('{"timeout": '), (F.col("value") + 1).cast("string"), F.lit(', "max_attempts": true}')))
        .when(event % 4 == 2, F.lit('{"context_window": 4096, "model_version": "v1"}'))
        .otherwise(F.lit('{"context_window": 0, "model_version": " ", "max_attempts": 0, "timeout": -1}'))
    )
    stated = table(spark, sf_dir, "events").select("event_id", options.parse(text).alias("o"))
    o = F.col("o")
    return stated.select(
        "event_id",
        options.max_attempts(o).cast("long").alias("attempts"),
        options.timeout(o).alias("timeout"),
        F.coalesce(options.context_window(o), F.lit(-1)).alias("context_window"),
        options.text(o, "model_version").alias("version"),
    )


@query("""
SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, user_id % 7 = 0 AS flag,
       CASE WHEN user_id % 7 = 0 THEN 'a=b' ELSE '' END AS note
FROM events
""")
def key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY=VALUE items as a map, the last of a name winning."""
    user = F.col("user_id")
    items = F.array(
        F.lit("k=0"), F.concat(F.lit("kind="), "event_type"), F.concat(F.lit("k="), F.get_json_object("props", "$.k")),
        F.when(user % 7 == 0, "note=a=b").otherwise("note="),
    )
    found = table(spark, sf_dir, "events").select("event_id", "user_id", options.key_values(items).alias("m"))
    return found.select("event_id", F.col("m")["kind"].alias("kind"), F.col("m")["k"].alias("k"), (user % 7 == 0).alias("flag"), F.col("m")["note"].alias("note"))
