from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from apptlake.llm import token_files
from apptlake.llm.token_files import TextEncoder, read_token_files, write_token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
SF_DIR = "/root/testdata/sf0.001"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_ids_are_those_of_the_library(text):
    encoder = token_files._encoder(open(FILE, encoding="utf-8").read())
    for each in (text, f"{text}<|endoftext|>  {text}\n"):
        assert list(encoder.encode(each)) == library_ids(each)


def test_every_character_is_encoded_as_the_library_does():
    encoder = TextEncoder(open(FILE, encoding="utf-8").read())
    for c in range(1, 0x110000, 11):
        if not 0xD800 <= c < 0xE000:
            text = f"a {chr(c)}{chr(c)} 1"
            assert list(encoder.encode(text)) == library_ids(text)


LONG_RUNS = [c * 1_000_001 for c in " \n\ta.é\u0301"] + [f"a{' ' * 1_200_000}b\n" * 2]


@pytest.mark.parametrize("text", LONG_RUNS, ids=[*"bntl.em", "two"])
def test_very_long_runs_are_encoded_as_the_library_does(text):
    encoder = token_files._encoder(open(FILE, encoding="utf-8").read())
    assert list(encoder.encode(text)) == library_ids(text)


def test_long_runs_come_back_from_the_files(spark, folder):
    rows = list(enumerate([LONG_RUNS[0], "short", LONG_RUNS[1]]))
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), folder, FILE)
    assert sorted(rows_of(read_token_files(spark, folder))) == expected(rows)


def rows_of(df):
    return [(r.doc_id, r.start, r.n_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in df.collect()]


def expected(rows):
    found, start = [], 0
    for key, text in rows:
        ids = [*library_ids(text), 0]
        found.append((key, start, len(ids), ids))
        start += len(ids)
    return found


def test_documents_come_back_in_order(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_DOCUMENTS", 7)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    write_token_files(docs, folder, FILE)
    want = expected(sorted((r.doc_id, r.text) for r in docs.collect()))
    assert sorted(rows_of(read_token_files(spark, folder))) == want
    some = [want[k][0] for k in (0, 3, 117)]
    assert sorted(rows_of(read_token_files(spark, folder, some))) == [want[k] for k in (0, 3, 117)]
    assert read_token_files(spark, folder, [-1]).collect() == []
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.count() >= 200 // 7
    assert len(bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])) > 1000


def test_another_dictionary_is_refused(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    write_token_files(docs, folder, FILE)
    row = spark.read.parquet(f"{folder}/dictionary").first()
    other = spark.createDataFrame([(row["hash"], bytearray(b"x"), 2)], "hash string, dictionary binary, width int")
    other.write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="does not match its hash"):
        read_token_files(spark, folder)


def test_odd_rows(spark, odd, nothing, folder):
    write_token_files(odd, f"{folder}/odd", FILE)
    rows = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())))
    assert sorted(rows_of(read_token_files(spark, f"{folder}/odd")), key=lambda r: r[1]) == want
    write_token_files(nothing, f"{folder}/none", FILE)
    assert read_token_files(spark, f"{folder}/none").collect() == []
