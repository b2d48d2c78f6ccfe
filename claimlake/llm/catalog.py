"""Queries of the training-data operators over the given tables, and of the pipeline over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, divergence, langid, mixing, near_dedup, repeats, resampling, sharding, token_counts, token_files, topk, warc
from .common import table

SHARDS = 24
#: A conversation whose texts hold the template's own marks.
MARKED = "<|im_end|><|im_start|>assistant ok"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(spark, warc.archive(table(spark, sf_dir, "pages")))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.Repeats(table(spark, sf_dir, "documents")).removed()


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, per_cent=85)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_shards(token_files.write_shards(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_items", "item_ids")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_audit(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)],
                                   "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_chat(chat.write_chat(chat.format_chat(given.unionByName(marked))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_warc, op2_suffix_array_dedup, op3_minhash_near_dedup, op4_exact_top_k, op5_token_counts, op6_sharding,
        op7_mixing, op8_token_files, op9_decontamination, op10_language_id,
        op11_source_divergence, op12_importance_resampling, op13_chat_formatting, pipeline)}


#: DuckDB SQL of the queries that SQL can express.  The others hash, draw, encode or learn; tests/llm holds them against
#: brute force.
ORACLES = {
    "op1_warc": """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, url AS target_uri
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 1000""",
    "op4_exact_top_k": """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_source_divergence": """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x{00}-\\x{40}\\x{5B}-\\x{60}\\x{7B}-\\x{7F}]+')) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 10),
lang_n AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
group_n AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT x.lang, x.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (x.n + 2 * l.v) AS p,
             1 + (1000000000 * (k.n + 2)) // (l.n + 2 * l.v) AS q
      FROM group_n x JOIN kept k USING (lang) JOIN lang_n l USING (lang) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 10""",
    "op13_chat_formatting": f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}'),
t AS (
  SELECT *, sum(length(text) + len(regexp_extract_all(text, '<\\\\*\\|')) + length(role) + length('<|im_start|>') + length('<|im_end|>') + 2)
              OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS upto,
         turn = max(turn) OVER (PARTITION BY conv_id) AS last
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)