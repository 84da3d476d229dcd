from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from apptlake.llm.common import Scratch
from apptlake.llm.mixing import MARGINS, SWEEP_AFTER, Mix, mix_sources, n_tokens, topic_of

SF_DIR = "/root/testdata/sf0.01"
MIX = Mix(temper={"source": 0.5, "lang": 0.7, "topic": 0.8}, targets={"lang": {"en": 2, "de": 1, "fr": 1, "xx": 5}})


def plain(cells, mix):
    """Raked shares by the same steps on arrays; ``cells`` maps (source, lang, topic) to tokens."""
    keys = sorted(cells)
    tokens = np.array([cells[k] for k in keys])
    weights = tokens / tokens.sum()
    groups = []
    for m, margin in enumerate(MARGINS):
        values = sorted({k[m] for k in keys})
        of = np.array([values.index(k[m]) for k in keys])
        if (mix.targets or {}).get(margin):
            target = np.array([mix.targets[margin].get(v, 0.0) for v in values])
        else:
            target = np.bincount(of, tokens) ** mix.temper[margin]
        groups.append((of, target / target.sum()))
    for _ in range(200):
        for of, target in groups:
            now = np.bincount(of, weights, len(target))
            weights = weights * np.divide(target, now, out=np.zeros_like(target), where=now > 0)[of]
    ratio = weights / weights.sum() * tokens.sum() / tokens
    return {k: (r, min(1.0, mix.keep_share * r)) for k, r in zip(keys, ratio, strict=True)}


def test_weights_hold_all_margins_and_follow_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mix_sources(docs, MIX).collect()
    assert len(rows) == docs.count()
    cells = {}
    for r in rows:
        key = (r.source, r.lang, r.topic)
        cells[key] = cells.get(key, 0) + r.n_tokens
    want = plain(cells, MIX)
    for r in rows:
        weight, probability = want[(r.source, r.lang, r.topic)]
        assert r.weight == pytest.approx(weight, rel=1e-4, abs=1e-9)
        assert r.probability == pytest.approx(probability, rel=1e-4, abs=1e-9)
    shares = {}
    for r in rows:
        shares[r.lang] = shares.get(r.lang, 0) + r.weight * r.n_tokens
    total = sum(shares.values())
    assert {k: round(v / total, 4) for k, v in shares.items()} == {"en": 0.5, "de": 0.25, "fr": 0.25, "es": 0.0}
    drawn = sum(r.n_tokens for r in rows if r.drawn)
    expected = sum(r.n_tokens * r.probability for r in rows)
    assert drawn == pytest.approx(expected, rel=0.08)
    assert not any(r.drawn for r in rows if r.probability == 0)


def test_a_draw_is_the_same_again_and_changes_with_the_seed(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    draws = [
        {r.doc_id for r in mix_sources(d, mix).where("drawn").collect()}
        for d, mix in ((docs, Mix()), (docs.repartition(7), Mix()), (docs, Mix(seed=3)))
    ]
    assert draws[0] == draws[1] != draws[2]


def test_copies_of_the_drawn_documents_hold_the_margins(spark):
    # A tenth of the tokens is to be half of the mix: each of them four times, the others in part.
    rows = [(n, "one two three four", "small" if n % 10 == 0 else "large", f"l{n % 3}") for n in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mix = Mix(targets={"source": {"small": 1, "large": 1}})
    got = mix_sources(docs, mix).collect()
    assert all(r.drawn == (r.copies > 0) for r in got)
    taken = {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.n_tokens * r.copies
    total = sum(taken.values())
    assert total == pytest.approx(0.8 * 4 * 6000, rel=0.03)
    assert taken["small"] / total == pytest.approx(0.5, abs=0.02)
    assert {r.copies for r in got if r.source == "small"} <= {3, 4, 5}


def test_tokens_and_topics_are_worked_out_without_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for r in docs.select("text", n_tokens(F.col("text")).alias("n"), topic_of(F.col("text")).alias("t")).limit(50).collect():
        assert r.n == len(r.text.split()) and r.t is not None


def test_a_round_joins_the_cells_with_one_table_a_margin(spark, monkeypatch):
    plans, kept = [], Scratch.stored

    def noted(self, df, name):
        if name == "raked":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(self, df, name)

    def full_collections():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    monkeypatch.setattr(Scratch, "stored", noted)
    before = full_collections()
    mix_sources(spark.read.parquet(f"{SF_DIR}/documents.parquet"), MIX)
    # Each margin's sums read what the margins before it have made: 1 + 2 + 4 joins, none with targets.
    assert plans and all(plan.count("Join ") <= 7 for plan in plans)
    # The driver's heap is swept now and then on the way.
    assert full_collections() - before >= len(plans) // SWEEP_AFTER >= 2


def test_odd_rows(spark, odd, nothing):
    rows = mix_sources(odd, Mix(keep_share=1.0), carry=["_key"]).collect()
    assert len(rows) == 12 and {r._key for r in rows} == {"my _key"}
    assert not any(r.drawn for r in rows if r.doc_id is None or not r.n_tokens)
    assert {r.probability for r in rows if not r.n_tokens} == {0.0}
    assert len({(r.drawn, r.weight) for r in rows if r.doc_id == 2}) == 1
    assert mix_sources(nothing).collect() == []
