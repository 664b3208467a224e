"""One registered production query per operator: each reads its whole table."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexkit.llm import (bpe, chat_format, context_mixing, exact_dedup, fill_middle, html_extract, kneser_ney,
                          language_id, m_tree, ngram_join, packing, token_alignment, url_rules)
from indexkit.llm.common import crc_mod, read
from indexkit.llm.registry import query


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.packable(read(spark, sf_dir, "documents")))


@query("op2_bpe_encode_decode")
def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op3_m_tree_top_k", """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 10""")
def op3_m_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return m_tree.top_k(rows, rows.filter("vec_id % 100 = 0"), 10)


@query("op4_quality_kneser_ney")
def op4_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return kneser_ney.classify(docs, read(spark, sf_dir, "labels")).drop("text")


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_language_crf")
def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


_CONTROL = "|".join(re.escape(c) for c in chat_format.CONTROLS)


@query("op5_chat_format", rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '(\\|{_CONTROL})', '\1+', 'g')) AS body,
         CASE role WHEN 'user' THEN {sum(map(len, chat_format.MARKS['user']))}
                   WHEN 'assistant' THEN {sum(map(len, chat_format.MARKS['assistant']))}
                   WHEN 'system' THEN {sum(map(len, chat_format.MARKS['system']))}
                   ELSE {sum(map(len, chat_format.OTHER))} + length(regexp_replace(role, '(\\|{_CONTROL})', '\1+', 'g'))
         END AS marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(body + marks)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""")
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(turns.unionByName(planted),
                                            public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op6_url_rules")
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


@query("op7_lm_context_mixing")
def op7_lm_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return context_mixing.score(docs, crc_mod(F.col("doc_id"), 7) == 2)


@query("op8_exact_dedup", r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM keyed WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id)""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.deduplicate(docs, exact_dedup.stable_half(F.col("doc_id")))


@query("op13_fill_in_middle", r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed),
cut AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:lo], '') AS p, array_to_string(units[lo + 1:hi], '') AS m,
         array_to_string(units[hi + 1:n], '') AS s
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.transform(fill_middle.plan(fill_middle.store(docs)))
    return fill_middle.digests(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                            "output_sha256", "restored_sha256")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_html_wrappers")
def op12_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")
