from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from apptlake.llm.bpe import Encoder, MergeTable, round_trip

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(FILE, encoding="utf-8") as file:
        return Encoder(MergeTable(file.read()))


def agree(encoder, texts):
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    for text, ids, encoding in zip(texts, encoder.encode(texts), want, strict=True):
        assert ids.tolist() == encoding.ids, text
        decoded = LIBRARY.decode(encoding.ids, skip_special_tokens=False)
        assert encoder.table.decode(ids) == decoded


TEXT = st.text(st.characters(codec="utf-8"), max_size=60)
WORDS = st.lists(st.sampled_from(["aaaa", "Don't", "ΣΑΣ", "İ", "ﬁ", "é", "123", "<|endoftext|>", "\x00", "\x1c"]), max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXT, WORDS.map(" ".join), WORDS.map("".join)), min_size=1, max_size=5))
def test_ids_and_decoded_texts_are_those_of_the_library(encoder, texts):
    agree(encoder, texts)


def test_every_character_is_encoded_as_the_library_does(encoder):
    characters = [chr(c) for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    agree(encoder, [f"a{c}1 {c}" for c in characters])


def test_words_forgotten_are_encoded_alike_again(encoder, monkeypatch):
    monkeypatch.setattr("apptlake.llm.bpe.REMEMBERED", 3)
    for _ in range(3):
        agree(encoder, ["some words that are forgotten", "aaaa aaa aa a", ""])


def test_round_trip_of_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = round_trip(odd, FILE).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((k, LIBRARY.encode(t or "", add_special_tokens=False).ids) for k, t in rows), key=key)
    got = sorted(((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found), key=key)
    assert got == want
    assert {r.decoded for r in found if r.doc_id in (5, 6, 7)} == {""}
    assert round_trip(nothing, FILE).collect() == []
