"""One registered query per operator, over its whole table, and comparison SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import (
    chat,
    decontaminate,
    interplay,
    mixing,
    neighbours,
    secrets,
    sharding,
    simhash,
    tokenbin,
    topk,
    toxicity,
    warc,
    whitening,
)
from surveyloom.llm.frames import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_mix_sources")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


@query("op9_shard_lpt")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op3_warc_pages", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS keep FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < keep THEN keep END AS refers_to
FROM k""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path)


@query("op4_simhash_bk_tree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_documents(table(spark, sf_dir, "documents"), width=3, radius=3).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op2_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS parts FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.parts, v.parts)::BIGINT AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op5_bit_packed_tokens")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenbin.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenbin.token_table(spark, path)


@query("op8_chat_round_trip", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (
  SELECT *, '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
                      ELSE 'Role ' || to_json(role)::VARCHAR END || ':' || chr(10)
    || regexp_replace(text, '(\\*)(### (?:System:|User:|Assistant:|Role ")|</turn>)', '\\\1\2', 'g')
    || chr(10) || '</turn>' || chr(10) AS formatted FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    formatted = chat.format_conversations(rows)
    return chat.conversation_digests(chat.written(formatted, new_path(spark, "chat")))


@query("op1_secret_battery")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count("random"))


@query("op6_toxicity_string_kernel")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_latent_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_filter_interplay", r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
m AS (
  SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (
  SELECT filter_order, step, bit, coalesce((SELECT sum(g.bit) FROM f AS g
    WHERE position(g.letter IN filter_order) < step), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step), f WHERE substr(filter_order, step, 1) = letter),
r AS (
  SELECT part, filter_order, step, any_value(s.bit) AS bit,
    coalesce(sum(n) FILTER (mask & (before | s.bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & s.bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & s.bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = s.bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & s.bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & s.bit > 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interplay.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_learned_partitions")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op13_bit_sliced_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=8)
