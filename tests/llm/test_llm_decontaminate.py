from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from apptlake.llm.decontaminate import (
    block_of,
    contamination,
    decontaminated,
    searched,
    suffix_array,
)
from conftest import CLASHING

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(texts, items, window):
    """Words, words hit, items and longest match of every text, by comparing everything."""
    parts = [(name or "", words(text)) for name, text in items]
    result = []
    for text in texts:
        own, hit, names, longest = words(text), set(), set(), 0
        for name, item in parts:
            size = min(window, len(item))
            for i in range(len(item) - size + 1 if item else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == item[i : i + size]:
                        hit |= set(range(j, j + size))
                        names.add(name)
                        more = size
                        while own[j + more : j + more + 1] == item[i + more : i + more + 1] != []:
                            more += 1
                        longest = max(longest, more)
        result.append((len(own), len(hit), sorted(names), longest))
    return result


def test_suffixes_are_in_order():
    import numpy as np

    rng = random.Random(1)
    for _ in range(100):
        runs = [[rng.randint(1, 3) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(0, 5))]
        text = np.array([x for run in runs for x in [*run, 0]] + [0])
        suffixes = [text[p : p + list(text[p:]).index(0)].tolist() for p in suffix_array(text, 9)]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(map(len, runs))


def test_search_equals_comparing_everything():
    rng = random.Random(3)
    for _ in range(200):
        letters = rng.choice([["a"], ["a", "b"], ["A", "b", "é", "c1"]])

        def text(most, letters=letters):
            some = rng.choices(letters + ["zz"] * rng.randint(0, 2), k=rng.randint(0, most))
            return rng.choice([" ", "\n", ". "]).join(some)

        texts = [text(30) for _ in range(rng.randint(0, 5))]
        items = [(rng.choice(["x", "y", "10", None]), text(14)) for _ in range(rng.randint(0, 4))]
        window = rng.choice([1, 3, 4])
        n, spans, names, longest = searched([t.encode() for t in texts], block_of(items, window), window)[:4]
        hits = [sum(s["end"] - s["start"] for s in x) for x in spans.to_pylist()]
        found = zip(
            n.to_pylist(), hits, [sorted(set(x)) for x in names.to_pylist()],
            [x or 0 for x in longest.to_pylist()], strict=True,
        )
        assert list(found) == plain(texts, items, window)


def rows_of(found):
    return sorted((r.doc_id, r.n_words, r.n_hit, list(r.items), r.longest) for r in found.collect())


def test_given_documents_in_one_block_and_in_many(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").withColumn("item_id", F.col("item_id").cast("string"))
    texts = docs.orderBy("doc_id").collect()
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    expected = [(d.doc_id, *p) for d, p in zip(texts, plain([d.text for d in texts], items, 10), strict=True)]
    assert any(row[2] for row in expected)
    assert rows_of(contamination(docs, benchmark)) == expected
    assert rows_of(contamination(docs, benchmark, block_bytes=1_000)) == expected
    left = {r.doc_id for r in decontaminated(docs, benchmark).collect()}
    assert left == {row[0] for row in expected if not row[2]}


def test_locations_point_at_the_passage(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"Zero, {passage.upper()}! And more."), (2, passage[:40])], "doc_id long, text string")
    items = spark.createDataFrame([("q", f"before it {passage} after"), ("s", "and more")], "item_id string, text string")
    first, second = sorted(contamination(docs, items).collect())
    assert [tuple(s) for s in first.spans] == [(1, 15)] and first["items"] == ["q", "s"]
    assert (first.longest, first.longest_at, first.longest_item, first.longest_item_at) == (12, 1, "q", 2)
    assert second.longest_at is None and second.longest_item is None and not second.contaminated


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame(
        [("a", None), ("b", ""), (None, "one"), ("c", "the SAME id"), ("c", "a text of its own")], "item_id string, text string"
    )
    for block_bytes in (1 << 20, 8):
        found = contamination(odd, items, block_bytes=block_bytes)
        expected = plain([r.text for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
        assert sorted(map(str, rows_of(found.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))))) == sorted(
            str((-1 if r.doc_id is None else r.doc_id, *p)) for r, p in zip(odd.collect(), expected, strict=True)
        )
    assert contamination(nothing, items).count() == 0
    assert contamination(odd, items.limit(0)).where("contaminated").count() == 0
    clean = decontaminated(odd, items)
    assert clean.columns == odd.columns and set(CLASHING) < set(clean.columns)
    assert clean.count() == sum(not p[1] for p in expected)
