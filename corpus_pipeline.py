"""A training corpus from documents: each stage works on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir). ``run`` writes what a stage returns as Parquet
in the shared scratch folder and hands the table it reads back to the next one. All stages but the
last return the columns of documents, whatever further ones they have.

Null and empty texts fail the base rules of the first stage; an empty table stays empty throughout.
Rows without an id pass the stages that tell documents apart by id, but are never drawn. Rows that
repeat an id are told apart by their texts; of rows alike in both one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.bpe import round_trip
from apptlake.llm.chunk_dedup import dedup_substrings
from apptlake.llm.common import Scratch, stored
from apptlake.llm.jaccard_join import Rule, similarity_classes
from apptlake.llm.mixing import Mix, mix_sources
from apptlake.llm.quality_rules import line_first
from apptlake.operators.dedup import latest_per_key

NEAR = Rule(width=5, percent=80)
MIX = Mix(temper={"source": 0.7, "lang": 0.7, "topic": 0.8})
TOKENIZER = "word_bpe_49k.json"


def _with_rest(docs: DataFrame) -> DataFrame:
    """Id and text, and the other columns in one that no operator's names clash with."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_rest"))


def _as_documents(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of documents again, with another text and its length."""
    new = {"doc_id": F.col("doc_id"), "text": F.col(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(
        *[(new[c] if c in new else F.col("_rest")[c]).alias(c) for c in docs.columns]
    )


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go; of the others, the lines that pass stay."""
    judged = line_first(_with_rest(docs), carry=["_rest"])
    return _as_documents(judged.where("kept"), docs, "clean_text")


def near_duplicates(spark, docs, sf_dir):
    """Of documents joined by links the one with the smallest id stays.

    Where ids are missing or stand on several rows, a document is an id with a hash of the text, and
    one without an id comes after all that have one. Rows alike in both are one document.
    """
    odd = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1)
    if odd.isEmpty():
        classes = similarity_classes(docs, NEAR)
        others = classes.where("component_id != doc_id").select("doc_id").distinct()
        return docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.xxhash64(text).alias("hash"))
    rows = docs.select(key.alias("_key"), text.alias("_text"), F.struct("*").alias("_row"))
    classes = similarity_classes(rows, NEAR, "_key", "_text")
    others = classes.where("component_id != doc_id").select(F.col("doc_id").alias("_key")).distinct()
    single = latest_per_key(rows, ["_key"], [F.xxhash64("_row")])
    return single.join(others, "_key", "left_anti").select("_row.*")


def substring_dedup(spark, docs, sf_dir):
    """Passages that stand in an earlier document are cut; what is left without words goes."""
    cut = dedup_substrings(_with_rest(docs), carry=["_rest"])
    whole = (F.col("n_removed") == 0) | F.col("text").rlike("[^ \\t-\\r]")
    return _as_documents(cut.where(whole), docs, "text")


def source_mix(spark, docs, sf_dir):
    """Documents are drawn so that sources, languages and topics weigh what they should; a document
    that has to weigh more than it does stands in the mix several times."""
    rows = docs.select("doc_id", "text", "source", "lang", F.struct("*").alias("_row"))
    mixed = mix_sources(rows, MIX, carry=["_row"]).where("copies > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), "copies")), "_row").select("_row.*")


def encoding(spark, docs, sf_dir):
    """Token ids of every document, and the hash of the text that they decode to."""
    rows = round_trip(docs, public_tokenizers.path(TOKENIZER))
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", encoding),
]

#: SQL can express neither the chunks, the raking nor the merges; tests hold the stages against
#: plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch() as steps:
        for name, stage in STAGES[:-1]:
            before, docs = docs, steps.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            steps.done(before)
        return stored(STAGES[-1][1](spark, docs, sf_dir), "encoded")
