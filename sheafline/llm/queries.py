"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafline.llm.common import table


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"))


#: The tools that the calls of the conversations may name: argument -> (JSON type, required).
TOOLS = {
    "look_up": {"query": ("string", True), "limit": ("integer", False)},
    "translate": {"query": ("string", True), "to": ("string", True), "limit": ("integer", False)},
}


def op8_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, with calls put in by a rule, as the tables hold none; errors joined by "; "."""
    from pyspark.sql import functions as F

    from sheafline.llm.chat import as_tool_dialogue, link

    return link(as_tool_dialogue(table(spark, sf_dir, "conversations")), TOOLS).withColumn("errors", F.array_join("errors", "; "))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.quality import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.pii import find

    return find(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


def op6_bpe_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafline.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), stable=True)


QUERIES: dict = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_license_scan,
        op3_personal_data,
        op4_best_fit_packing,
        op5_vector_sharding,
        op6_bpe_distinct_words,
        op7_embedding_near_dedup,
        op8_tool_call_linking,
        op9_simhash_near_dedup,
        op10_nearest_neighbours,
    )
}
#: Vectors are compared pair by pair here, which only small tables bear. The other operators fit models,
#: call tokenizers, compress or pack, which SQL cannot say; tests hold them against brute force.
ORACLES: dict = {
    "op8_tool_call_linking": """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(role = 'assistant' AND turn IS NOT NULL, false) AS asks FROM conversations),
c AS (SELECT conv_id, turn, text, CASE WHEN conv_id % 2 = 0 THEN turn - 2 ELSE turn + 2 END AS near FROM m WHERE asks),
p(conv_id, turn, here, steps) AS (
  SELECT conv_id, turn, turn, 0 FROM c
  UNION SELECT p.conv_id, p.turn, c.near, p.steps + 1 FROM p JOIN c ON c.conv_id = p.conv_id AND c.turn = p.here
    JOIN c d ON d.conv_id = c.conv_id AND d.turn = c.near),
l AS (SELECT conv_id, turn, max(here) AS order_turn, arg_max(steps, here) + 1 AS level FROM p GROUP BY ALL),
told AS (
  SELECT conv_id, turn, 0 AS item, 'message' AS kind, NULL AS call_id, NULL AS name, turn AS order_turn, 0 AS level, '' AS errors,
    '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || '}' AS json FROM m
  UNION ALL
  SELECT c.conv_id, c.turn, 1, 'call', 't' || c.turn, CASE WHEN c.turn % 4 = 3 THEN 'translate' ELSE 'look_up' END, l.order_turn, l.level,
    concat_ws('; ', CASE WHEN c.turn % 8 = 1 THEN 'limit is not integer' END, CASE WHEN c.turn % 4 = 3 THEN 'missing to' END,
      CASE WHEN c.turn % 5 = 0 THEN 'no result' END,
      CASE WHEN NOT EXISTS (SELECT 1 FROM c d WHERE d.conv_id = c.conv_id AND d.turn = c.near) THEN 'unknown dependency' END),
    '{"arguments":{"limit":' || CASE WHEN c.turn % 8 = 1 THEN '"ten"' ELSE '10' END || ',"query":' || to_json(c.text)::VARCHAR || '},"depends_on":["t' || c.near
      || '"],"id":"t' || c.turn || '","name":"' || CASE WHEN c.turn % 4 = 3 THEN 'translate' ELSE 'look_up' END || '","type":"function"}'
  FROM c JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn
  UNION ALL
  SELECT c.conv_id, c.turn, 0, 'result', 't' || c.turn, NULL, l.order_turn, l.level + 1, '',
    '{"content":{"chars":' || length(c.text) || '},"role":"tool","tool_call_id":"t' || c.turn || '"}'
  FROM c JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn WHERE c.turn % 5 <> 0)
SELECT conv_id, turn, item::INTEGER AS item, kind, call_id, name, order_turn, level::INTEGER AS level, errors = '' AS valid, errors, json FROM told
""",
    "op7_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(u, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.c),
c AS (SELECT u, min(c) AS component_id FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT c.u AS vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.u = c.component_id AS kept FROM c LEFT JOIN n ON n.u = c.u
""",
}
