"""The stages of the pipeline against plain versions, one text at a time."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from apptlake.llm.jaccard_join import Rule  # noqa: E402
from apptlake.llm.mixing import topic_of  # noqa: E402
from test_llm_chunks import plain as plain_cuts  # noqa: E402
from test_llm_jaccard import brute as plain_classes  # noqa: E402
from test_llm_mixing import plain as plain_mix  # noqa: E402
from test_llm_quality import plain as plain_rules  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def stage(name, spark, rows, columns="doc_id long, text string, lang string, source string, n_chars long"):
    docs = rows if not isinstance(rows, list) else spark.createDataFrame(rows, columns)
    return sorted(tuple(r) for r in STAGES[name](spark, docs, SF_DIR).collect())


@pytest.fixture(scope="module")
def given(spark):
    return sorted(tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect())


def test_stages_and_their_whole(spark, given):
    rules = {r[0]: plain_rules(r[1]) for r in given}
    want = [(k, rules[k][-1], lang, source, len(rules[k][-1])) for k, _, lang, source, _ in given if rules[k][-2]]
    one = stage("quality rules", spark, given)
    assert one == want

    classes = plain_classes([(r[0], r[1]) for r in one], Rule(5, 80))
    two = stage("n-gram Jaccard join", spark, one)
    assert two == [r for r in one if classes[r[0]][1] == r[0]]
    assert len(two) < len(one)

    cut = plain_cuts([(r[0], r[1]) for r in two])
    three = stage("substring dedup", spark, two)
    assert three == [
        (k, cut[k][0], lang, source, len(cut[k][0]))
        for k, text, lang, source, _ in two
        if cut[k][0] == text or cut[k][0].split()
    ]

    four = stage("mixing sources to target weights", spark, three)
    docs = spark.createDataFrame(three, "doc_id long, text string, lang string, source string, n_chars long")
    topics = {r.doc_id: (r.t, r.c) for r in docs.select(
        "doc_id", topic_of(F.col("text")).alias("t"),
        (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(17)), 11) / F.lit(float(1 << 53))).alias("c"),
    ).collect()}
    cells = {}
    for k, text, lang, source, _ in three:
        key = (source, lang, topics[k][0])
        cells[key] = cells.get(key, 0) + len(text.split())
    shares = plain_mix({k: v for k, v in cells.items() if v}, corpus_pipeline.MIX)
    copies = Counter(r[0] for r in four)
    for row in three:
        k, text, lang, source, _ = row
        expected = corpus_pipeline.MIX.keep_share * shares[(source, lang, topics[k][0])][0]
        gap = expected - int(expected) - topics[k][1]
        if abs(gap) > 1e-4:
            assert copies[k] == int(expected) + (gap > 0)
    assert four == sorted(row for row in three for _ in range(copies[row[0]]))
    assert max(copies.values()) > 1

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    five = stage("BPE encoding and decoding", spark, four)
    for (k, n, ids, digest), row in zip(five, four, strict=True):
        encoding = library.encode(row[1], add_special_tokens=False)
        assert (k, n) == (row[0], len(encoding.ids))
        assert np.frombuffer(bytes(ids), "<u4").tolist() == encoding.ids
        decoded = library.decode(encoding.ids, skip_special_tokens=False)
        assert digest == hashlib.sha256(decoded.encode()).hexdigest()

    whole = sorted(tuple(r) for r in queries()["pipeline"](spark, SF_DIR).collect())
    assert whole == five


def test_clean_documents_pass_the_filters(spark, given):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r[0] for r in stage("quality rules", spark, given)}
    long_enough = {r[0] for r in given if len((r[1] or "").split()) >= 10}
    good = [k for k, quality in labels.items() if quality == 1 and k in long_enough]
    assert sum(k in kept for k in good) >= 0.97 * len(good)


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows_and_names(spark, odd, nothing, name):
    rows = STAGES[name](spark, odd, SF_DIR)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert rows.columns == odd.columns
    found = rows.collect()
    # The mix may have a document several times.
    assert len(found) <= 12 or name.startswith("mixing") and len({r.doc_id for r in found}) <= 12
    if name == "n-gram Jaccard join":
        assert sorted(str(r.doc_id) for r in found) == ["1", "12", "12", "5", "6", "7", "9", "None", "None"]
    assert STAGES[name](spark, nothing, SF_DIR).collect() == []


def test_near_duplicates_keep_different_texts_of_one_id(spark):
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, text), (1, "something else altogether, of another source."), (None, f"{text} more"), (None, "no id"), (2, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted(map(str, kept)) == sorted(
        str(r) for r in docs.collect() if r.text not in (f"{text} more",) and r.doc_id != 2
    )


def test_the_mix_of_the_pipeline_reaches_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source")
    mix = corpus_pipeline.MIX
    tokens = F.size(F.split(F.trim("text"), "[ \\t-\\r]+"))
    mixed = corpus_pipeline.source_mix(spark, docs, SF_DIR).withColumn("n", tokens)
    given = {r.lang: r.n for r in docs.groupBy("lang").agg(F.sum(tokens).alias("n")).collect()}
    whole = sum(n ** mix.temper["lang"] for n in given.values())
    found = {r.lang: r.n for r in mixed.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = sum(found.values())
    for lang, n in given.items():
        assert found[lang] / total == pytest.approx(n ** mix.temper["lang"] / whole, abs=0.01)
