from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from apptlake.llm.pu_quality import estimated_prior, fit, held_out, measures, quality_scores, score, train, _bins

SF_DIR = "/root/testdata/sf0.1"


def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def area(scores, labels):
    """Share of pairs of a good and a bad text that are ranked rightly."""
    order = np.argsort(np.argsort(scores))
    good = labels == 1
    n, m = good.sum(), (~good).sum()
    return (order[good].sum() - n * (n - 1) / 2) / (n * m)


def test_held_out_texts_are_told_apart(spark):
    docs, labels = tables(spark)
    found = quality_scores(docs, labels)
    rows = found.join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    fold = [r for r in rows if r.held_out and r.quality is not None]
    quality = np.array([r.quality for r in fold])
    scores = np.array([r.score for r in fold])
    assert len(fold) > 1000 and area(scores, quality) > 0.98
    assert ((scores >= 0.5) == (quality == 1)).mean() > 0.95


def test_labels_of_the_held_out_fold_play_no_part(spark):
    docs, labels = tables(spark)
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = train(docs, labels, sample=500), train(docs, turned, sample=500)
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.cuts, other.cuts)


def test_the_prior_is_near_the_share_of_positives():
    rng = np.random.default_rng(1)
    positives = rng.normal(1, 1, (4000, 3))
    for share in (0.5, 0.8):
        mixed = np.where(rng.random((4000, 1)) < share, rng.normal(1, 1, (4000, 3)), rng.normal(-4, 1, (4000, 3)))
        cuts = np.quantile(mixed, np.linspace(0.1, 0.9, 9), axis=0).T
        assert abs(estimated_prior(_bins(positives, cuts), _bins(mixed, cuts)) - share) < 0.06


def plain_risk(model, positives, unlabelled, weights, decay=1e-3):
    """The unbiased risk, text by text; its part on negatives; decay of the weights besides."""

    def output(x):
        indicators = [float(v > c) for v, cuts in zip(x, model.cuts, strict=True) for c in cuts] + [1.0]
        return sum(a * b for a, b in zip(indicators, weights, strict=True))

    def mean_loss(rows, sign):
        return sum(float(np.logaddexp(0, -sign * output(x))) for x in rows) / len(rows)

    negative = mean_loss(unlabelled, -1) - model.prior * mean_loss(positives, -1)
    whole = model.prior * mean_loss(positives, 1) + max(0.0, negative)
    return whole + decay / 2 * float(np.square(weights).sum()), negative


def test_the_fit_is_a_minimum_of_the_plain_risk():
    rng = np.random.default_rng(4)
    positives = rng.normal(0.5, 1, (300, 2))  # alike enough that no risk is driven to zero
    unlabelled = np.where(rng.random((400, 1)) < 0.5, rng.normal(0.5, 1, (400, 2)), rng.normal(-0.5, 1, (400, 2)))
    model = fit(positives, unlabelled, prior=0.4)
    least, negative = plain_risk(model, positives, unlabelled, model.weights)
    assert negative > 0
    assert least < plain_risk(model, positives, unlabelled, np.zeros_like(model.weights))[0] - 0.05
    for _ in range(30):
        other = model.weights + rng.normal(0, 0.1, len(model.weights))
        assert plain_risk(model, positives, unlabelled, other)[0] > least - 1e-4


def test_fit_without_examples_is_no_model(spark, odd, nothing):
    assert fit(np.empty((0, 16)), np.ones((3, 16))) is None
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(odd, labels).collect()} == {0.5}
    assert quality_scores(nothing, labels).collect() == []


def test_odd_rows_are_scored(spark, odd):
    labels = spark.createDataFrame([(k, int((k or 9) > 3)) for k in (1, 2, 2, 9, 10, 12, None)], "doc_id long, quality int")
    rows = quality_scores(odd, labels, sample=50).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (9, 10)}) == 1
    assert len(measures("")) == len(measures("A text. ")) == 16


def test_scores_depend_on_text_alone(spark):
    docs, labels = tables(spark)
    docs = docs.limit(300)
    model = train(docs, labels)
    other = docs.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    one = {r.doc_id: r.score for r in score(docs, model).collect()}
    two = {r.doc_id - 10_000_000: r.score for r in score(other, model).collect()}
    assert one == two
