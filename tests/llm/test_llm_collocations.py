from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from apptlake.llm import collocations as module
from apptlake.llm.collocations import PRIME, collocations, fingerprints, prefix_polynomials, product


def plain(rows, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for k in range(len(words) - n + 1):
                    counts[lang][tuple(words[k : k + n])] += 1
    result = []
    for lang, count in counts.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= 30}
        rows = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            longer = (
                q for q, b in candidates.items()
                if len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if next(longer, None) is None:
                rows.append((-score, -a, " ".join(p).encode(), a, count[p[:k]], count[p[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(rows)[:top], 1):
            result.append((lang, rank, phrase.decode(), a, left, right, totals[lang], -score))
    return sorted(result)


def found(docs, **how):
    return sorted(tuple(r) for r in collocations(docs, **how).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "The", "of", "é", "漢字", "x-1", "a\x00b", "\x0b", "zz"] + [f"w{i}" for i in range(20)]
    rows = [("en", None), ("en", ""), ("en", " . "), (None, "\n")]
    for _ in range(600):
        text = "".join(
            rng.choice(words[: 3 + int(25 * rng.random() ** 3)]) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n"])
            for _ in range(rng.randint(0, 60))
        )
        rows.append((rng.choice(["en", "de", None, "und", "en"]), text))
    return rows


def test_prefix_polynomials_modulo_the_prime():
    rng = random.Random(2)
    a, b = (np.array([rng.randrange(PRIME) for _ in range(500)], dtype=np.uint64) for _ in range(2))
    assert product(a, b).tolist() == [x * y % PRIME for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    sums = prefix_polynomials(a)
    for n in (1, 2, 4):
        expected = [
            sum(int(a[i + k]) * pow(module._BASE, k, PRIME) for k in range(n)) % PRIME for i in range(len(a) - n + 1)
        ]
        assert fingerprints(sums, n, np.zeros(len(a), np.uint64)).tolist() == expected


def test_equals_counting_everything(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    expected = plain(rows)
    assert len(expected) > 50
    assert found(docs) == expected
    assert found(docs, top=3) == [r for r in expected if r[1] <= 3]


def test_a_full_table_changes_nothing(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    monkeypatch.setattr(module.bit_table, "__defaults__", (64,))
    assert found(docs) == plain(rows)
    # With all bits set every phrase is verified as if its fingerprint were frequent.
    monkeypatch.setattr(module, "bit_table", lambda prints: np.full(1, (1 << 64) - 1, np.uint64))
    assert found(docs) == plain(rows)


def test_tasks_may_sum_up_in_parts(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows * 2, "lang string, text string").coalesce(1)
    monkeypatch.setattr(module, "FINGERPRINTS_AT_ONCE", 10)
    assert found(docs) == plain(rows * 2)


def test_fingerprints_are_merged_by_ranges_outside_the_heap(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    plain_rows = docs.selectExpr("coalesce(lang, 'und') AS _lang", "coalesce(text, '') AS _text")
    one, many = (module._counted(plain_rows, (1, 2), ranges) for ranges in (1, 50))
    counted = sorted(map(tuple, one.collect()))
    assert len(counted) > 50 and sorted(map(tuple, many.collect())) == counted
    # No task holds a hash map of fingerprints in its heap, and a range is bounded by the bytes of text.
    assert "HashAggregate" not in many._jdf.queryExecution().toString()
    monkeypatch.setattr(module, "RANGE_BYTES", 500)
    assert found(docs) == plain(rows)


def test_words_get_values_of_their_own():
    words = [b"a", b"a\0", b"\0", b"a" * 8, b"a" * 9, b"a" * 8 + b"b" * 8, b"b" * 8 + b"a" * 8, *(b"%d" % n for n in range(5000))]
    values = module.values_of(pa.array(words, pa.binary()))
    assert len(set(values.tolist())) == len(words) and max(values.tolist()) < PRIME
    assert module.values_of(pa.array(words, pa.binary())[3:]).tolist() == values[3:].tolist()
    assert module.values_of(pa.array([], pa.binary())).tolist() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == plain([(r.lang, r.text) for r in docs.collect()])


def test_odd_rows(spark, odd, nothing):
    assert found(odd) == plain([(r.lang, r.text) for r in odd.collect()])
    assert found(nothing) == []
    assert found(spark.createDataFrame([(None, None)], "lang string, text string")) == []
