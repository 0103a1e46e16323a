"""Corpus pipeline: quality, near duplicates, benchmark decontamination, tokenisation.

``STAGES`` are applied in order to ``documents``; each works on all rows that
its predecessor kept and its result is written before the next one reads it.
All but the last return the columns of ``documents``.

Defined results: null and empty texts are judged like any other by the first
stage and are like no other text; of rows that share a doc_id one of each text
stays; a null doc_id counts as the last one; an empty table gives no rows;
other columns pass through, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelab.llm import bpe_codec, decontam, jaccard_join, mil_quality
from scorelab.llm.common import materialise, table
from scorelab.llm.queries import tokenizer_file

#: No stage but the third can be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    return mil_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the least doc_id (of rows that share it, one of each text)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(jaccard_join.LAST_ID))
    name, same = decontam.apart(docs, "key"), decontam.apart(docs, "text")
    kept = jaccard_join.jaccard_components(docs).where("doc_id <=> component_id").select(key.alias(name)).distinct()
    keyed = docs.withColumns({name: key, same: F.md5("text")})
    return keyed.join(kept, name, "left_semi").dropDuplicates([name, same]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; in the others, spans shared with the benchmark are cut out."""
    clean = decontam.remove(docs, table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding gives its bytes again."""
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = bpe_codec.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [("quality", good_quality), ("near duplicates", one_of_each_group), ("decontamination", decontaminated), ("tokens", tokenised)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the last one's rows, without the ids themselves."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name.replace(" ", "_"))
    return docs.select("doc_id", "lang", "source", "n_tokens", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "round_trip")
