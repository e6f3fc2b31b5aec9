"""The registered queries of this package: QUERIES and ORACLE_SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.llm.common import documents
from metroframe.llm.decontaminate import leaks
from metroframe.llm.html_wrapper import extract
from metroframe.llm.jaccard_join import jaccard_components
from metroframe.llm.lexical_search import search
from metroframe.llm.line_dedup import dedup_lines, line_dedup_sql
from metroframe.llm.personal_data import counted as counted_private
from metroframe.llm.personal_data import listed as listed_private
from metroframe.llm.personal_data import personal_data
from metroframe.llm.quality_rules import quality
from metroframe.llm.secret_scan import counted, listed, secrets
from metroframe.llm.sentencepiece_codec import encode_decode
from metroframe.llm.sharding import shards_of
from metroframe.llm.suffix_dedup import suffix_dedup
from metroframe.llm.token_alignment import align_tokens
from metroframe.llm.token_files import read_token_files, write_token_files
from metroframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# the words of a text as an SQL list; \x09-\x0D are tab to carriage return
WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_decode(documents(spark, sf_dir).select("doc_id", "text"),
                         public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 and toxic = 0").select("doc_id")


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), trusted(spark, sf_dir))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query("op4_html_wrapper")
def op4_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


@query("op6_line_dedup", line_dedup_sql())
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir)).select(
        "doc_id", counted("base", "assign").alias("n_assign"), counted("base", "access").alias("n_access"),
        counted("base", "hex").alias("n_hex"), F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_of(documents(spark, sf_dir), 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("bigint").alias("n_kept"))


@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir)).select(
        "doc_id", *[counted_private("base", k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(listed_private("base").cast("binary"), 256).alias("base_sha256"), listed_private("spans").alias("spans"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# the terms of a text as an SQL list: digits, letters and all beyond ASCII, A-Z in lower case
TERMS_SQL = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL.format(text='text')} AS t FROM documents),
  s AS (SELECT count(*) AS n_all, sum(len(t))::BIGINT AS l_all FROM d WHERE len(t) > 0),
  q AS (SELECT DISTINCT r, item_id, term FROM (SELECT row_number() OVER () AS r, item_id, unnest({TERMS_SQL.format(text='text')}) AS term FROM benchmark)),
  p AS (SELECT d.r, doc_id, len(t) AS n, u.term, count(*) AS tf FROM d, unnest(d.t) AS u(term)
        WHERE u.term IN (SELECT term FROM q) GROUP BY ALL),
  w AS (SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, n_all),
  c AS (SELECT q.r AS item, item_id, p.r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all))))::BIGINT AS score
        FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@query("op11_lexical_search", SEARCH_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), benchmark(spark, sf_dir))
