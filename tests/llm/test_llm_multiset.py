from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from apptlake.llm.multiset_hash import (
    as_text,
    edited_fingerprints,
    fingerprints,
    paragraph_hashes,
    vector,
    with_paragraph,
    without_paragraph,
)

SF_DIR = "/root/testdata/sf0.001"


def prints(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.fingerprint for r in sorted(fingerprints(docs).collect())]


def plain(text):
    """Lane sums and number of paragraphs, one number at a time."""
    parts = [p for p in re.split(r"\n|(?<=[.!?]) ", text) if p]
    sums = [[0, 0] for _ in range(64)]
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42).to_bytes(8, "little")
        for k, pair in enumerate(sums):
            x = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(h, 42))
            pair[0] = (pair[0] + (x & 0xFFF)) % 2**30
            pair[1] = (pair[1] + (x >> 32 & 0xFFF)) % 2**30
    return sums, len(parts)


def plain_print(text):
    sums, count = plain(text)
    return "".join(f"{high << 32 | low:016x}" for low, high in sums) + f"{count:08x}"


def plain_likeness(one, other):
    if plain_print(one) == plain_print(other):
        return 1.0
    a, b = (np.array(sums).ravel() - n * 0xFFF / 2 for sums, n in (plain(one), plain(other)))
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return min(1.0, max(0.0, a @ b / size)) if size else 0.0


def test_fingerprints_and_likeness_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    got = sorted(edited_fingerprints(docs).collect())
    for k, (row, text, new) in enumerate(zip(got, texts, edited(texts), strict=True)):
        after = texts[(k + 1) % len(texts)]
        assert (row.fingerprint, row.edited_fingerprint) == (plain_print(text), plain_print(new))
        assert row.near_edited == pytest.approx(plain_likeness(text, new), abs=1e-9)
        assert row.near_next == pytest.approx(plain_likeness(text, after), abs=1e-9)


def test_order_plays_no_part_and_number_does(spark):
    a, b, c, d = prints(spark, "One.\nTwo is here. And three.", "And three.\nOne.\nTwo is here.", "One.\nOne.", "One.")
    assert a == b
    assert len({a, c, d}) == 3


def test_a_paragraph_can_be_put_in_and_taken_out(spark):
    rows = spark.createDataFrame([("One.\nTwo.", "Three.", "One.\nTwo.\nThree.")], "a string, p string, b string")
    hashed = rows.select("*", paragraph_hashes(F.col("a")).alias("ha"), paragraph_hashes(F.col("b")).alias("hb"))
    made = hashed.select("*", vector(F.col("ha")).alias("va"), vector(F.col("hb")).alias("vb"))
    row = made.select(
        (with_paragraph(F.col("va"), F.col("p")) == F.col("vb")).alias("put"),
        (without_paragraph(F.col("vb"), F.col("p")) == F.col("va")).alias("taken"),
        as_text(F.col("va"), F.lit(2)).alias("text"),
    ).first()
    assert row.put and row.taken and len(row.text) == 64 * 16 + 8


def edited(texts):
    """Edited text of every document, in ascending order of ids."""
    result = []
    for k, text in enumerate(texts):
        half = len(text) // 2
        result.append(text[: len(text) - half] + texts[(k + 1) % len(texts)][:half])
    return result


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(7)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(edited_fingerprints(docs).collect())
    want = [hashlib.sha256(t.encode()).hexdigest() for t in edited([t for _, t in rows])]
    assert [r.edited_sha256 for r in got] == want
    assert [(r.doc_id, r.n_chars) for r in got] == [(k, len(t)) for k, t in rows]
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    own = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    assert all(own[r.doc_id] == r.fingerprint for r in got)


def test_plan_moves_texts_twice_without_python(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        df = edited_fingerprints(docs)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Python" not in text and "Arrow" not in text
    assert "ReusedExchange" in text


def test_odd_rows(spark, odd, nothing):
    got = edited_fingerprints(odd).collect()
    assert len(got) == 12
    empty = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(empty) == 1
    assert {r.near_edited for r in got if r.n_chars == 0} == {1.0}
    assert len({r.fingerprint for r in got if r.doc_id in (9, 10)}) == 1
    assert edited_fingerprints(nothing).collect() == []


def test_one_document_is_its_own_next(spark):
    docs = spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")
    row = edited_fingerprints(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest()
