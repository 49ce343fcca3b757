"""Corpus pipeline: quality classifier, quality rules, near duplicates, personal data, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept;
between the stages rows are written as Parquet in the shared folder and read again. The quality
stages write them themselves, as only so their Python workers are handed few rows at a time. The
last stage returns the packed pieces, the others the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import ngram_join, packing, pii, quality_model, quality_rules
from cardflow.llm.common import arrow_rows, likely_in, ship_code, table, unlikely_in, unused, written

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
#: Common shingles asked of two prefixes, in percent of the set; more than for 90 % similarity.
PREFIX_EXTRA = 10
#: Bitmap rows (of 4 KB) that tell documents to be dropped from the others.
GONE_BITMAP = 1024
#: A small cache of token chunks, little text encoded and, in all stages, few documents handed over at a time: the
#: workers also hold what the stages before have left, and the executor's JVM its whole heap.
CACHE_CHUNKS, SLICE_BYTES, BATCH_ROWS = 50_000, 500_000, 500


def few_at_a_time(df: DataFrame, name: str) -> DataFrame:
    """``df`` written while workers are handed at most ``BATCH_ROWS`` rows at a time: the bound holds for plans made here."""
    with arrow_rows(df.sparkSession, BATCH_ROWS):
        return written(df, name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant, fitted on the labels outside the held-out part, accepts."""
    ship_code(spark)
    vectors = few_at_a_time(docs.select("doc_id", quality_model.features("text").alias("vector")), "stage-vectors")
    model = quality_model.fit(quality_model.training_rows(vectors, table(spark, sf_dir, "labels")))
    if model is None:  # nothing to learn from: nothing is rejected
        return docs
    score = quality_model.score_text(model, "text")
    return few_at_a_time(docs.filter(score >= quality_model.THRESHOLD), "pipeline-quality-classifier")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the compression bands."""
    ship_code(spark)
    rules = unused(docs, "__rules")
    return few_at_a_time(quality_rules.with_verdict(docs, name=rules).filter(f"{rules}.kept").drop(rules),
                         "pipeline-quality-rules")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group linked by five-word shingles at 0.8 or more.

    Of repeated rows with the same id and text one stays. An id with different texts is as many
    documents: each goes only if its own text links. Rows with a null id are in no group and stay.
    """
    known = docs.filter("doc_id is not null")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        keyed, key = docs, "doc_id"
    else:  # row ids in the order of (doc_id, text), so that the least id of a group is that of its least row
        key = unused(docs, "__row")
        keyed = written(known.dropDuplicates(["doc_id", "text"]).orderBy("doc_id", "text")
                        .withColumn(key, F.monotonically_increasing_id()), "stage-rows")
    with arrow_rows(spark, BATCH_ROWS):
        linked = written(ngram_join.jaccard_components(keyed, doc_id=key, width=SHINGLE_WORDS, percent=SIMILARITY_PERCENT,
                                                       extra=PREFIX_EXTRA), "stage-components")
    gone = written(linked.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "stage-gone")
    # texts that surely stay aren't shuffled: a bitmap of fixed size tells most of them
    kept = unlikely_in(keyed, key, gone, GONE_BITMAP).unionByName(
        likely_in(keyed, key, gone, GONE_BITMAP).join(gone, key, "left_anti")).select(*docs.columns)
    return kept if key == "doc_id" else kept.unionByName(docs.filter("doc_id is null"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind; ``n_chars`` follows the text."""
    spans = unused(docs, "__pii")
    found = pii.with_spans(docs, pii.fit(docs), name=spans)
    clean = found.withColumn("text", pii.redacted(F.col("text"), F.col(f"{spans}.all"))).drop(spans)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents packed into sequences of 2048 ids, one row a piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_chunks=CACHE_CHUNKS,
                        slice_bytes=SLICE_BYTES, batch_rows=BATCH_ROWS)


STAGES = [
    ("quality classifier", quality_stage),
    ("quality rules", rules_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        # two stages write their rows themselves
        docs = kept if "scratch_folder" in vars(kept) else written(kept, f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression, tokenising and boosting can't be written in SQL; tests compare the operators, and of the stages
#: the n-gram Jaccard join, with plain Python.
ORACLE_SQL = None
