"""Registered queries ``opN_<name>``: each applies its operator to its whole table with production
parameters and derives the agreed result columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import (
    chat, embeddings, filter_audit, mixing, ngram_join, packing, pii, quality_model, quality_rules, sharding,
    spelling, token_codes, unigram)
from cardflow.llm.common import scratch_folder, ship_code, table, written

Builder = Callable[[SparkSession, str], DataFrame]


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    proposed = written(pii.proposed(docs).drop("text"), "pii-candidates")  # candidates once, without the texts
    found = pii.chosen(proposed, pii.fit_proposed(proposed))
    base = F.col("__pii.base")
    counts = [pii.counted(base, kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"),
                        pii.joined(F.col("__pii.all")).alias("spans"))


#: Names of the shards that documents are placed on.
SHARDS = tuple(f"shard-{k:03d}" for k in range(256))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.place(docs, "doc_id", SHARDS, spread=("text",)).select("doc_id", "slot", "shard")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


TOOLS: chat.Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
    "summarise": {"text": ("string", True), "sentences": ("integer", False), "after": ("string", False)},
    "measure": {"value": ("number", True), "exact": ("boolean", True), "after": ("string", False)},
}


def tool_dialogue(conversations: DataFrame) -> DataFrame:
    """The conversations with every assistant turn written as a tool call and every later user turn as
    the result of the turn before: the shape that tool-calling data has. Arguments come from the
    texts, some of them of a wrong type; a call refers to that of the assistant turn before."""
    turn, text = F.col("turn"), F.col("text")
    name = lambda t: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), t.cast("string"))
    after = F.when(turn > 2, F.concat(F.lit("${"), name(turn - 2), F.lit("}")))
    odd = F.pmod(F.length(text), F.lit(7)) == 0
    arguments = F.when(F.pmod(turn, F.lit(3)) == 0, F.to_json(F.struct(
        F.substring_index(text, " ", 6).alias("query"), F.when(~odd, F.length(text)).alias("limit"), after.alias("after")))).when(
        F.pmod(turn, F.lit(3)) == 1, F.to_json(F.struct(
            text.alias("text"), F.when(odd, F.length(text)).alias("sentences"), after.alias("after")))).otherwise(
        F.to_json(F.struct((F.length(text) / 8).alias("value"), F.when(odd, F.lit("yes")).otherwise(F.lit("no")).alias("exact"),
                           after.alias("after"))))
    tool = F.element_at(F.array(F.lit("search"), F.lit("summarise"), F.lit("measure")),
                        (F.pmod(turn, F.lit(3)) + 1).cast("int"))
    fixed = F.regexp_replace(arguments, '"exact":"no"', '"exact":false')
    call = F.concat(F.lit('{"tool_calls":[{"id":'), F.concat(F.lit('"'), name(turn), F.lit('"')), F.lit(',"name":"'), tool,
                    F.lit('","arguments":'), fixed, F.lit("}]}"))
    result = F.to_json(F.struct(name(turn - 1).alias("tool_call_id"), text.alias("content")))
    said = F.when(F.col("role") == "assistant", call).when((F.col("role") == "user") & (turn > 1), result).otherwise(text)
    role = F.when((F.col("role") == "user") & (turn > 1), "tool").otherwise(F.col("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), said.alias("text"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_calls(tool_dialogue(table(spark, sf_dir, "conversations")), TOOLS)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    vectors = written(table(spark, sf_dir, "documents").select("doc_id", quality_model.features("text").alias("vector")),
                      "quality-vectors")
    model = quality_model.fit(quality_model.training_rows(vectors, table(spark, sf_dir, "labels")))
    scored = vectors.select("doc_id", quality_model.held_out().alias("held_out"),
                            quality_model.score_vector(model, "vector").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_model.THRESHOLD).cast("int"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    judged = quality_rules.with_verdict(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "__rules.*").drop("tail_outside", "longest_run")


def op9_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-codes")
    token_codes.write_tokens(table(spark, sf_dir, "documents"), folder, byte_bpe())
    return token_codes.read_tokens(spark, folder)


def op10_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    shards = F.size(F.array_distinct("spans.shard"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", shards.alias("n_shards"),
                      F.array_min("spans.shard").alias("least_shard"))


QUERIES: dict[str, Builder] = {
    "op1_pii": op1_pii,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_tool_calls": op4_tool_calls,
    "op5_embeddings": op5_embeddings,
    "op6_quality": op6_quality,
    "op7_ngram_join": op7_ngram_join,
    "op8_rules": op8_rules,
    "op9_token_codes": op9_token_codes,
    "op10_unigram": op10_unigram,
    "op11_spelling": op11_spelling,
    "op12_filter_audit": op12_filter_audit,
    "op13_mixing": op13_mixing,
}


def builders() -> dict[str, Builder]:
    return dict(QUERIES)


#: The audit restated: every text judged by patterns, every order of the filters walked step by step.
FILTER_AUDIT_SQL = r"""
WITH RECURSIVE judged AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS body,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents d),
failures AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 'E' ELSE '' END AS fails
  FROM judged),
marked AS (
  SELECT f.*, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM failures f
  LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
             FROM labels GROUP BY doc_id) l ON l.doc_id = f.doc_id),
cells AS (SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
letters(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, left(filter_order, step - 1) AS earlier
  FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
audited AS (
  SELECT c.part, s.filter_order, s.step, s.letter,
         sum(CASE WHEN translate(fails, earlier || letter, '') = fails THEN docs ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN docs ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') <> fails THEN docs ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN docs ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, earlier, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells c, steps s
  GROUP BY c.part, s.filter_order, s.step, s.letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM audited
"""

#: Every pair of vectors compared, components by reachability.
EMBEDDINGS_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM usable a, usable b
  WHERE a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 ELSE false END),
reached AS (
  SELECT u, v FROM links
  UNION
  SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
parts AS (SELECT u, min(v) AS least FROM reached GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN parts ON parts.u = vec_id LEFT JOIN counts ON counts.u = vec_id
"""

#: Shingle sets of every text, intersections counted over shared shingles, components by reachability.
JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END AS s
  FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT u, v FROM links
  UNION
  SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
parts AS (SELECT u, min(v) AS least FROM reached GROUP BY u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id
FROM sets LEFT JOIN parts ON parts.u = doc_id
"""

ORACLES: dict[str, str] = {
    "op5_embeddings": EMBEDDINGS_SQL,
    "op7_ngram_join": JACCARD_SQL,
    "op12_filter_audit": FILTER_AUDIT_SQL,
}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
