"""The corpus operators applied to the given tables, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm.bpe_codec import round_trip
from txnguard.llm.common import table
from txnguard.llm.fill_in_middle import middle_digests, middle_sql
from txnguard.llm.fingerprints import fingerprint_documents
from txnguard.llm.hard_negatives import mine_negatives, negatives_sql, relabelled
from txnguard.llm.language_id import identify_languages
from txnguard.llm.line_dedup import drop_spread_lines, line_sql
from txnguard.llm.mixing import mix, mixing_sql, size_documents
from txnguard.llm.near_dups import NearDupConfig, near_dup_sql, near_duplicates
from txnguard.llm.packing import cut_pieces, pack
from txnguard.llm.quality import judge_quality, quality_sql
from txnguard.llm.token_counts import count_tokens
from txnguard.llm.url_filters import RULES, judge_urls, page_links, url_sql
from txnguard.llm.warc import archive_round_trip, warc_sql

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@_query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(cut_pieces(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER)))


@_query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"))


@_query
def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = size_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_spread_lines(table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@_query
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return judge_urls(pages, RULES, page_links(pages))


ORACLES |= {
    "op5_quality_rules": quality_sql(),
    "op6_source_mixing": mixing_sql(),
    "op7_line_dedup": line_sql(),
    "op10_url_filters": url_sql(),
}


@_query
def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), NearDupConfig(words=2))


ORACLES["op4_minhash_near_dedup"] = near_dup_sql(words=2)


@_query
def op2_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages")).drop("uri")


@_query
def op3_prefix_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


ORACLES["op2_warc_archives"] = warc_sql()


@_query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"))


@_query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = relabelled(table(spark, folder, "embeddings"))
    return mine_negatives(vectors, F.col("vec_id") % 50 == 0)


@_query
def op12_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@_query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle_digests(table(spark, folder, "documents"))


ORACLES |= {"op11_hard_negatives": negatives_sql(), "op13_fill_in_middle": middle_sql()}
