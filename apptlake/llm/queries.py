"""Registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake.llm.bpe import round_trip
from apptlake.llm.chunk_dedup import dedup_substrings
from apptlake.llm.collocations import collocations
from apptlake.llm.decontaminate import contamination
from apptlake.llm.jaccard_join import Rule, similarity_classes
from apptlake.llm.licenses import license_scan
from apptlake.llm.mixing import Mix, mix_sources
from apptlake.llm.multiset_hash import edited_fingerprints
from apptlake.llm.pu_quality import quality_scores
from apptlake.llm.quality_rules import line_first
from apptlake.llm.spelling import spelling_variants
from apptlake.llm.suffix_dedup import repeated_passages
from apptlake.llm.token_files import read_token_files, write_token_files
from apptlake.session import scratch_path

#: Large sources, languages and topics give way to small ones.
PRODUCTION_MIX = Mix(temper={"source": 0.7, "lang": 0.7, "topic": 0.8})

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    REGISTERED[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op7_line_first(spark, sf_dir):
    return line_first(documents(spark, sf_dir)).drop("clean_text")


@query
def op9_multiset_hash(spark, sf_dir):
    return edited_fingerprints(documents(spark, sf_dir))


@query
def op6_pair_index_bpe(spark, sf_dir):
    rows = round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = read_token_files(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_pu_quality(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op10_license_scan(spark, sf_dir):
    return license_scan(documents(spark, sf_dir))


@query
def op4_chunk_dedup(spark, sf_dir):
    return dedup_substrings(documents(spark, sf_dir))


@query
def op2_raked_mix(spark, sf_dir):
    return mix_sources(documents(spark, sf_dir), PRODUCTION_MIX)


@query
def op1_jaccard_join(spark, sf_dir):
    return similarity_classes(documents(spark, sf_dir), Rule(width=3, percent=90))


@query
def op5_sparse_suffixes(spark, sf_dir):
    return repeated_passages(documents(spark, sf_dir))


@query
def op11_suffix_arrays(spark, sf_dir):
    rows = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.col("longest").cast("bigint").alias("longest"),
    )


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir))


@query
def op13_collocations(spark, sf_dir):
    return collocations(documents(spark, sf_dir))
