"""Corpus pipeline over ``documents``: each stage applies one operator of
``covstar.llm`` to all that the stage before kept.

1. language: documents without a recognisable language go;
2. quality: documents that the quality model rejects go;
3. near_duplicates: of each group of near copies one document stays;
4. repeated_passages: passages that also start earlier are cut out;
5. packing: what is left is packed into token sequences.

All stages but the last return the columns of their input. Texts that are null,
empty or without letters have no language and go in stage 1. Stage 3 keeps the row
of each group with the smallest (id, hash of the text, place in the input); rows
without an id come last.
No SQL expresses the models, so ``ORACLE_SQL`` is None and tests compare with
plain versions of the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covstar.llm import crf_quality, lang_id, packing, simhash_gray, suffix_dedup
from covstar.llm.common import crc_mod, stored, table
from covstar.llm.queries import QUALITY_FROM, byte_pieces

#: Below this score no language is recognised.
LANGUAGE_FROM = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    judged = lang_id.predictor(lang_id.train(docs, ~held))(F.col("text"))
    kept = (F.col("cp_lang.lang_pred") != lang_id.UNKNOWN) & (F.col("cp_lang.score") >= LANGUAGE_FROM)
    return docs.withColumn("cp_lang", judged).filter(kept).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    scored = crf_quality.scorer(crf_quality.train(docs, table(spark, sf_dir, "labels"), ~held))(F.col("text"))
    return docs.withColumn("cp_score", scored).filter(F.col("cp_score") >= QUALITY_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stored(docs.withColumn("cp_row", F.monotonically_increasing_id()), "rows")
    found = simhash_gray.near_duplicates(rows.select(F.col("cp_row").alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("cp_member"), F.col("component_id").alias("cp_group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "cp_row")
    first = (rows.select("cp_row", order.alias("cp_order")).join(groups, F.col("cp_row") == F.col("cp_member"))
             .groupBy("cp_group").agg(F.min("cp_order").alias("cp_first")).select(F.col("cp_first.cp_row").alias("cp_stays")))
    return rows.join(first, F.col("cp_row") == F.col("cp_stays"), "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.deduplicated(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(byte_pieces(docs))


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
