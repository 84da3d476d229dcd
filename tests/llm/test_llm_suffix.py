from __future__ import annotations

import random

import numpy as np
import pytest

from apptlake.llm.common import Scratch
from apptlake.llm.shingles import WORD, _LOWER
from apptlake.llm import suffix_dedup
from apptlake.llm.suffix_dedup import Sparse, _window_minima, repeated_passages, selected

SF_DIR = "/root/testdata/sf0.001"


def covered(rows, width):
    """For every document, which words lie in a run of so many that stands at an earlier place."""
    seen, result = set(), {}
    for key, text in rows:
        words = WORD.findall((text or "").translate(_LOWER))
        flags = [False] * len(words)
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if window in seen:
                flags[k : k + width] = [True] * width
            seen.add(window)
        result[key] = flags
    return result


def check(rows, docs, how):
    want, allowed = covered(rows, how.passage), covered(rows, how.head)
    got = {key: [False] * len(flags) for key, flags in want.items()}
    for row in repeated_passages(docs, how).collect():
        assert row.n_words == sum(s.end - s.start for s in row.spans)
        for span in row.spans:
            got[row.doc_id][span.start : span.end] = [True] * (span.end - span.start)
    missed = sum(w and not g for key in want for w, g in zip(want[key], got[key], strict=True))
    beyond = sum(g and not a for key in want for a, g in zip(allowed[key], got[key], strict=True))
    assert beyond == 0
    assert missed <= 0.005 * sum(map(sum, want.values()))
    assert all(any(got[key]) for key, flags in want.items() if any(flags))


def passages(seed):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(1500)]
    shared = [[rng.choice(words) for _ in range(n)] for n in (50, 51, 60, 90, 200)]
    rows = []
    for n in range(250):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 100))]
        for passage in shared:
            if rng.random() < 0.4:
                at = rng.randrange(len(text))
                text[at:at] = passage
        rows.append((n, " ".join(text)))
    return rows


@pytest.mark.parametrize("how", [Sparse(range_rows=300), Sparse(), Sparse(passage=30, window=8, kgram=4)])
def test_passages_in_many_documents(spark, how):
    rows = passages(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(rows, docs, how)


@pytest.mark.parametrize("how", [Sparse(range_rows=40), Sparse()])
def test_no_word_is_missed_where_copies_share_parts_with_others(spark, how):
    # Passages stand inside each other here, so that neighbours in order share one side alone.
    rows = passages(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, got = covered(rows, how.passage), {}
    for row in repeated_passages(docs, how).collect():
        got[row.doc_id] = {k for span in row.spans for k in range(span.start, span.end)}
    missed = sum(w and k not in got.get(key, ()) for key, flags in want.items() for k, w in enumerate(flags))
    assert missed == 0


def test_a_document_on_two_rows_is_no_copy_of_itself(spark):
    text = " ".join(f"own{n}" for n in range(80))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert repeated_passages(docs).collect() == []


def test_repeated_heads_are_stored_before_their_join(spark, monkeypatch):
    # An aggregate on one side of the join keeps Spark from splitting a hot head.
    made, real = [], Scratch.stored
    monkeypatch.setattr(Scratch, "stored", lambda self, df, name: made.append(name) or real(self, df, name))
    repeated_passages(spark.createDataFrame(passages(3)[:20], "doc_id long, text string")).collect()
    assert made.index("repeated-heads") < made.index("places")


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    check(sorted((r.doc_id, r.text) for r in docs.collect()), docs, Sparse())


def test_minima_of_windows():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 40):
        values = rng.integers(0, 5, n).astype(np.uint64)
        want = {k + 3 - int(np.argmin(values[k : k + 4][::-1])) for k in range(n - 3)}
        assert set(_window_minima(values, 4).tolist()) == want


@pytest.mark.parametrize("how", [Sparse(), Sparse(passage=30, window=13, kgram=5)])
def test_texts_in_a_row_are_worked_on_at_once(monkeypatch, how):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (0, 3, 34, 35, 36, 50, 90, 400, 0)] * 30
    texts += [np.zeros(120, dtype=np.uint64)]
    alone = [selected(t, how) for t in texts]
    words, counts = np.concatenate(texts), np.array([len(t) for t in texts])
    calls, real = [], suffix_dedup._polynomial
    monkeypatch.setattr(suffix_dedup, "_polynomial", lambda *a: calls.append(a[1]) or real(*a))
    places, heads = suffix_dedup.selected_of_all(words, counts, how)
    assert len(calls) == 2  # however many texts there are
    of = np.repeat(np.arange(len(texts)), counts)[places]
    at = places - (np.cumsum(counts) - counts)[of]
    assert of.tolist() == [k for k, (p, _) in enumerate(alone) for _ in p]
    assert at.tolist() == [int(x) for p, _ in alone for x in p]
    assert heads.tolist() == [int(x) for _, h in alone for x in h]
    want = []
    for k, (found, hashes) in enumerate(alone):
        single = (texts[k] >> np.uint64(32)).astype(">u4")
        for place, head in zip(found.tolist(), hashes, strict=True):
            front = int(head).to_bytes(8, "big")
            end = place + how.head
            want.append(b"\0" + front + single[end : end + how.tail].tobytes())
            want.append(b"\1" + front + single[max(0, place - how.window) : place][::-1].tobytes())
    all_heads = real(words, how.head, 22)
    assert suffix_dedup._sides(words, all_heads, counts, of, at, how).to_pylist() == want


def test_a_passage_selects_the_same_places_wherever_it_stands():
    how, rng = Sparse(), np.random.default_rng(4)
    passage = rng.integers(0, 1 << 62, 50, dtype=np.uint64)
    for _ in range(50):
        before = rng.integers(0, 1 << 62, int(rng.integers(0, 60)), dtype=np.uint64)
        after = rng.integers(0, 1 << 62, int(rng.integers(0, 60)), dtype=np.uint64)
        places, _ = selected(np.concatenate((before, passage, after)), how)
        inner = {int(p) - len(before) for p in places}
        # One of those that the passage alone selects, early enough for a whole head.
        assert inner & {int(p) for p in selected(passage, how)[0]}


def test_odd_rows(spark, odd, nothing):
    got = {r.doc_id: r for r in repeated_passages(odd).collect()}
    # The long texts repeat themselves; of the second one every word is a copy.
    assert set(got) == {9, 10}
    assert got[10].n_words > got[9].n_words > 0
    assert repeated_passages(nothing).collect() == []
