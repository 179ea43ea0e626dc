"""The registered query of each operator: production parameters, whole tables, contract columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import (
    decontaminate, exact_dedup, filter_audit, hard_negatives, language, main_text, mixing, secret_scan, set_join, sharding,
    token_files, tool_calls, toxicity,
)
from panelwright.llm.common import table
from panelwright.session import scratch_path


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.training_order(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "position")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_hash")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token_files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, str(public_tokenizers.path("byte_bpe_50k.json")))
    return token_files.token_index(token_files.read_token_files(spark, path))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tool_calls.as_tool_messages(table(spark, sf_dir, "conversations"))
    return tool_calls.linked_messages(messages, {"reply": tool_calls.REPLY_SCHEMA})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=relabelled)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.dealt(table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = filter_audit.file_stream(spark, f"{sf_dir}/documents.parquet")
    buckets = filter_audit.buckets_of(table(spark, sf_dir, "documents").count())
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"), buckets=buckets)


QUERIES = {
    f.__name__: f for f in (
        op1_mix_sources, op2_near_duplicates, op3_decontaminate, op4_toxicity, op5_token_files, op6_secrets, op7_language,
        op8_main_text, op9_exact_dedup, op10_tool_calls, op11_hard_negatives, op12_sharding, op13_filter_audit,
    )
}

SQL: dict[str, str] = {
    "op9_exact_dedup": r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body
""",
    "op10_tool_calls": """
WITH m AS (
    SELECT *, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
        CASE role WHEN 'user' THEN turn WHEN 'assistant' THEN turn - 1 END AS asked
    FROM conversations
), k AS (SELECT *, CASE WHEN asked IS NOT NULL THEN conv_id || ':' || asked END AS call_id FROM m),
e AS (
    SELECT call_id, min(turn) FILTER (WHERE kind = 'call') AS call_turn,
        min(text IS NOT NULL) FILTER (WHERE kind = 'call') AS good, min(turn) FILTER (WHERE kind = 'result') AS result_turn
    FROM k WHERE call_id IS NOT NULL GROUP BY call_id
), j AS (
    SELECT k.*, coalesce(call_turn IS NOT NULL AND result_turn IS NOT NULL
        AND turn = CASE kind WHEN 'call' THEN call_turn WHEN 'result' THEN result_turn END, false) AS linked, good
    FROM k LEFT JOIN e USING (call_id)
)
SELECT conv_id, turn, kind, call_id, linked,
    CASE WHEN kind = 'call' THEN text IS NOT NULL WHEN kind = 'result' AND linked THEN good END AS valid,
    turn AS place, 0 AS step,
    CASE kind
        WHEN 'call' THEN '{"arguments":{"chars":' || length(text) || ',"prompt":' || to_json(text) || '},"id":"' || call_id
            || '","name":"reply","role":"call"}'
        WHEN 'result' THEN '{"content":' || to_json(text) || ',"id":"' || call_id || '","role":"result"}'
        ELSE '{"content":' || to_json(text) || ',"role":"message"}' END AS line
FROM j
""",
    "op11_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS vec FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT a.uid, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM v a JOIN v b ON a.uid != b.uid WHERE a.vec_id % 100 = 0),
q AS (SELECT uid, anchor_id, other AS positive_id, score AS positive_score FROM p WHERE same
    QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, other) <= 5),
n AS (SELECT q.*, p.other AS negative_id, p.score AS negative_score,
        row_number() OVER (PARTITION BY q.uid, positive_id ORDER BY score DESC, other) AS rank
    FROM q JOIN p ON p.uid = q.uid AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
    "op13_filter_audit": r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) AS c,
        regexp_matches(body, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM d LEFT JOIN l USING (doc_id)
), m AS (
    SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
        count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY 1, 2
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
    SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order, [x1.bit, x2.bit, x3.bit, x4.bit, x5.bit] AS bits
    FROM x x1, x x2, x x3, x x4, x x5 WHERE x1.bit + x2.bit + x3.bit + x4.bit + x5.bit = 31
        AND (x1.bit | x2.bit | x3.bit | x4.bit | x5.bit) = 31
), s AS (
    SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM o, range(1, 6) t(step)
), r AS (
    SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (WHERE mask & bit = 0 AND mask & before = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(m.good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
        coalesce(sum(m.toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
    FROM m, s GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
""",
}
