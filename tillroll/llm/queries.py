"""The registered queries of this subpackage: one per operator, over whole tables.

Each takes (spark, sf_dir) and derives the asked columns from its operator's
output. SQL can express three of them; the others need hash functions, tokenizers, or
learned models, and ``tests/llm`` holds each against a brute-force version.
"""

from pyspark.sql import functions as F

from tillroll.llm import (
    additive_model,
    context_tree,
    importance,
    kd_shards,
    packing,
    periodic_runs,
    secrets_crf,
    sentencepiece_codec,
    simhash,
    token_shards,
    tool_calls,
    weak_quality,
    weighted_sampling,
)
from tillroll.llm.common import importable
from tillroll.llm.oracle_sql import OP12_SQL, OP13_SQL


def _table(spark, sf_dir, name):
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"))


def op2_context_tree(spark, sf_dir):
    return context_tree.score_texts(_table(spark, sf_dir, "documents"))


def op3_weighted_sampling(spark, sf_dir):
    return weighted_sampling.edit_report(_table(spark, sf_dir, "documents"))


def op4_wavelet_shards(spark, sf_dir):
    return token_shards.write_and_read(_table(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id"
    )


def op6_secret_scan(spark, sf_dir):
    found = secrets_crf.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secrets_crf.summary("spans"))


def op7_quality_rules(spark, sf_dir):
    return weak_quality.judge(_table(spark, sf_dir, "documents"))


def op8_kd_tree(spark, sf_dir):
    rows = kd_shards.shard(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_tool_calls(spark, sf_dir):
    found = tool_calls.every_message(_table(spark, sf_dir, "conversations"))
    return found.withColumn("conv_id", F.col("conv_id").cast("long"))


def op11_additive_model(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels")
    scored = additive_model.score_quality(_table(spark, sf_dir, "documents"), labels)
    return scored.withColumn(
        "predicted", (F.col("score") >= additive_model.THRESHOLD).cast("int")
    )


def op12_periodic_runs(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return periodic_runs.periodic_runs(docs, reading=periodic_runs.tiled)


def op13_importance(spark, sf_dir):
    benchmark = _table(spark, sf_dir, "benchmark")
    return importance.resample(_table(spark, sf_dir, "documents"), benchmark)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_context_tree": op2_context_tree,
    "op3_weighted_sampling": op3_weighted_sampling,
    "op4_wavelet_shards": op4_wavelet_shards,
    "op5_simhash": op5_simhash,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_kd_tree": op8_kd_tree,
    "op9_packing": op9_packing,
    "op10_tool_calls": op10_tool_calls,
    "op11_additive_model": op11_additive_model,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_importance": op13_importance,
}

# Questions without an answer, answers without a question, chains of questions that are
# two turns apart, and all that is neither; the table has no tool calls.
OP10_SQL = """
WITH m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), chained AS (
  SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain
  FROM m WHERE role = 'user'
), deep AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS depth
  FROM chained
), asked AS (
  SELECT d.conv_id, d.turn, d.text, d.depth, r.text AS result,
         row_number() OVER (PARTITION BY d.conv_id ORDER BY d.depth, d.turn) - 1 AS position,
         concat_ws('; ', CASE WHEN d.text = '' THEN 'text: too short' END,
                   CASE WHEN d.depth = 0 AND d.turn > 1 THEN 'after: unknown call' END) AS errors
  FROM deep d LEFT JOIN m r ON r.conv_id = d.conv_id AND r.turn = d.turn + 1 AND r.role = 'assistant'
), unasked AS (
  SELECT r.conv_id, r.turn - 1 AS turn, r.text AS result
  FROM m r LEFT JOIN asked a ON a.conv_id = r.conv_id AND a.turn = r.turn - 1
  WHERE r.role = 'assistant' AND a.turn IS NULL
)
SELECT conv_id, conv_id || ':' || turn AS call_id,
       CASE WHEN result IS NULL THEN 'open' ELSE 'answered' END AS status, position, depth,
       1 AS n_calls, CASE WHEN result IS NULL THEN 0 ELSE 1 END AS n_results, errors,
       errors = '' AS valid,
       '{' || CASE WHEN turn > 1 THEN '"after":"' || conv_id || ':' || (turn - 2) || '",' ELSE '' END
       || '"arguments":{"text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},'
       || CASE WHEN errors = '' THEN '' ELSE '"errors":["' || replace(errors, '; ', '","') || '"],' END
       || '"id":"' || conv_id || ':' || turn || '","name":"reply","position":' || position
       || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || CAST(to_json(result) AS VARCHAR) END
       || '}' AS json
FROM asked
UNION ALL
SELECT conv_id, conv_id || ':' || turn, 'unknown call', NULL, NULL, 0, 1, 'result: unknown call', false,
       '{"errors":["result: unknown call"],"id":"' || conv_id || ':' || turn || '","result":'
       || CAST(to_json(result) AS VARCHAR) || '}'
FROM unasked
UNION ALL
SELECT conv_id, NULL, status, NULL, NULL, 0, 0, CASE WHEN status = 'message' THEN '' ELSE status END,
       status = 'message',
       '{' || CASE WHEN status = 'message' THEN '' ELSE '"errors":["' || status || '"],' END
       || CASE WHEN role IS NULL THEN '' ELSE '"role":' || CAST(to_json(role) AS VARCHAR) || ',' END
       || '"text":' || CAST(to_json(coalesce(text, '')) AS VARCHAR)
       || CASE WHEN turn IS NULL THEN '' ELSE ',"turn":' || turn END || '}'
FROM (
  SELECT *, CASE WHEN conv_id IS NULL OR turn IS NULL THEN 'no conversation'
                 WHEN role = 'tool' THEN 'no identifier' ELSE 'message' END AS status
  FROM conversations
  WHERE conv_id IS NULL OR turn IS NULL OR role IS NULL OR role NOT IN ('user', 'assistant')
)
"""

ORACLE_SQL = {
    "op10_tool_calls": OP10_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_importance": OP13_SQL,
}
