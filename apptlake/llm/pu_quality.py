"""Operator 8: a quality classifier learnt from positives and unlabelled text.

A linear model over binned measures of a text minimises the non-negative unbiased risk
    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]):
trusted positives, unlabelled documents and an estimated class prior take the place of negatives.
The prior is estimated from the same two samples: a first model tells positives from unlabelled
text, and its output on positives put aside says how much of the unlabelled text looks like them.

Fitting takes bounded samples, at most ``sample`` documents of each kind, those whose ids hash
lowest; the model is a few hundred numbers. Every whole text is scored.

Defined results: null and empty texts are scored as texts without words; without any positive the
score is 0.5 throughout; repeated rows get equal scores; columns other than id and text never enter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import slices, text_of

SAMPLE = 5_000
BINS = 12
SYMBOLS = "#*$%&|<>"


def measures(text: str) -> list[float]:
    """Shares and sizes that tell prose from junk."""
    words, lines, chars = text.split(), text.split("\n"), max(1, len(text))
    n, distinct = max(1, len(words)), len(set(words))
    ends = sum(x.endswith((".", "!", "?", '"')) for x in lines)
    return [
        float(np.log1p(len(words))),
        float(np.log1p(len(text))),
        len(text) / n,
        distinct / n,
        distinct / n**0.75,
        sum(map(eq, words, words[1:])) / n,
        max(Counter(words).values(), default=0) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, SYMBOLS)) / chars,
        text.count("|") / n,
        text.count("!!") / n,
        sum(map(text.count, "0123456789")) / chars,
        sum(map(text.count, ".,;:?")) / n,
        ends / len(lines),
        len(set(lines)) / len(lines),
        len(words) / len(lines),
    ]


@dataclass(frozen=True)
class Model:
    """Cut points of every measure, weights of the bins they make, and the class prior."""

    cuts: np.ndarray
    weights: np.ndarray
    prior: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return _bins(x, self.cuts)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.bins(x) @ self.weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _bins(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One indicator for each cut point that a measure exceeds, and a constant."""
    over = (x[:, :, None] > cuts[None, :, :]).reshape(len(x), -1)
    return np.concatenate((over, np.ones((len(x), 1), dtype=bool)), axis=1).astype(np.float32)


def _adam(gradient, size: int, steps: int = 250, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    w, m, v = (np.zeros(size, dtype=np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimated_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in unlabelled text: how alike its mean output is to that of positives
    put aside, for a model that tells the two samples apart."""
    train, aside = p[: len(p) * 3 // 4], p[len(p) * 3 // 4 :]
    x = np.concatenate((train, u))
    y = np.concatenate((np.ones(len(train)), np.zeros(len(u)))).astype(np.float32)
    weight = np.where(y == 1, 0.5 / max(1, len(train)), 0.5 / len(u)).astype(np.float32)
    w = _adam(lambda w: x.T @ (weight * (_sigmoid(x @ w) - y)), x.shape[1])
    # Of unlabelled text, so much reaches the level that nine in ten positives reach.
    inside, outside = _sigmoid(aside @ w), _sigmoid(u @ w)
    level = np.quantile(inside, 0.10)
    alike = (outside >= level).mean() / max(1e-9, (inside >= level).mean())
    # Less two standard errors: too high a prior would leave no risk on negatives to minimise.
    return float(np.clip(alike - 2 * np.sqrt(0.1 / max(1, len(aside))), 0.05, 0.98))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model | None:
    """Minimise the non-negative risk; None without positives or unlabelled texts."""
    if not len(positives) or not len(unlabelled):
        return None
    both = np.concatenate((positives, unlabelled))
    cuts = np.quantile(both, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T
    p, u = _bins(positives, cuts), _bins(unlabelled, cuts)
    if prior is None:
        prior = estimated_prior(p, u)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        sp, su = _sigmoid(zp), _sigmoid(zu)
        plus = -prior * p.T @ (1 - sp) / len(p)
        minus = u.T @ su / len(u) - prior * p.T @ sp / len(p)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # Where the estimated risk on negatives is below zero, step back instead of fitting it.
        return plus + minus if risk >= 0 else -minus

    return Model(cuts, _adam(gradient, p.shape[1]), prior)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _measured(rows: DataFrame, keep: str, kind: str) -> DataFrame:
    """``keep`` and the measures of ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                values = [measures(t) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(keep), pa.array(values, pa.list_(pa.float64()))],
                    names=[keep, "measures"],
                )

    return rows.select(keep, "_text").mapInArrow(run, f"{keep} {kind}, measures array<double>")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model | None:
    """Fit on labelled positives and unlabelled documents outside the held-out fold."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    first = lambda ids: (  # noqa: E731  the ids that hash lowest: never more than the bound
        ids.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
        .distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    good = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("_label"))
    good = good.groupBy("doc_id").agg(F.min("_label").alias("_label")).where("_label = 1")
    chosen = first(good.select("doc_id").join(rows.select("doc_id"), "doc_id", "left_semi"))
    chosen = chosen.withColumn("_positive", F.lit(True)).unionByName(
        first(rows.select("doc_id")).withColumn("_positive", F.lit(False))
    )
    # At most twice the bound in ids, hence broadcast; one row for each id however often it stands.
    texts = rows.join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "_positive").agg(F.min("_text").alias("_text"))
    found = _measured(texts, "_positive", "boolean").collect()
    split = {flag: [r["measures"] for r in found if r["_positive"] == flag] for flag in (True, False)}
    order = {k: np.array(sorted(v), dtype=np.float64) for k, v in split.items()}
    # Sorted, so that the fit doesn't depend on the order of arrival; then mixed by a fixed seed.
    return fit(*(np.random.default_rng(0).permutation(order[k]) for k in (True, False)))


def score(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``score``, from 0 to 1, of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                values = np.array([measures(t) for t in part.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(shared.value.score(values), pa.float64())],
                    names=["doc_id", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train and score: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    return score(docs, train(docs, labels, **options)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
