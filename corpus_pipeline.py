"""The corpus pipeline: five operators of metroframe.llm, one after another.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame;
run() writes each result as Parquet below the session's shared folder and reads it again.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.llm.common import written
from metroframe.llm.decontaminate import leaks
from metroframe.llm.jaccard_join import jaccard_components
from metroframe.llm.line_dedup import dedup_lines
from metroframe.llm.quality_rules import quality_filter
from metroframe.llm.queries import benchmark, trusted
from metroframe.llm.sentencepiece_codec import encode_decode


ROW = "row_key_of_stage"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality_filter(docs, trusted(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on five sites or more go, but for their first place; n_chars follows the text."""
    out = dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row key, from all columns: rows without an id, or that share one, are told apart; equal rows are not."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.xxhash64(*columns, *[c.isNull() for c in columns]).alias(ROW), F.struct(*columns).alias("doc"),
                       F.col("doc_id"), F.col("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays, null ids last; of equal rows one."""
    rows = keyed(docs)
    groups = written(jaccard_components(rows.select(ROW, "text"), ROW).select(F.col("doc_id").alias(ROW), "component_id"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first")
    best = groups.distinct().join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(first)
    best = written(best.select("component_id", F.col(f"first.{ROW}").alias(ROW)), "groups_best")
    # joins are on the row key alone: a group of any size is spread
    gone = (groups.filter(f"component_id <> {ROW}").select(ROW).union(best.select("component_id"))
            .join(best.select(ROW), ROW, "left_anti").select(ROW, F.lit(True).alias("gone")))
    repeated = rows.groupBy(ROW).count().filter("count > 1").select(ROW, F.lit(False).alias("gone"))
    marks = written(gone.union(repeated).groupBy(ROW).agg(F.max("gone").alias("gone")), "groups_marks")
    found = rows.join(marks, ROW, "left").select(ROW, "doc", "gone")
    once = found.filter("not gone").dropDuplicates([ROW])
    return found.filter("gone is null").union(once).select("doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = keyed(docs)
    hit = leaks(rows.select(ROW, "text"), benchmark(spark, sf_dir), ROW).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(hit, ROW, "left_anti").select("doc.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and a digest of the text decoded from them."""
    rows = encode_decode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# SQL cannot express the first and the last three stages; tests/llm/test_pipeline.py holds them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
