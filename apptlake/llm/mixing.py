"""Operator 2: mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token weights of the cells are raked:
in turn, the cells of each source, language and topic are scaled to that margin's target share,
until all three margins hold. What a cell should weigh against the tokens it has gives the
expected number of copies of its documents: the whole part of it for sure, and one more by a hash of
the id with the probability of the rest. Cells that have less than their share are so repeated, and
the margins hold for the copies taken.

The corpus is read once for the cells' sums, which are added up per task before they are shuffled,
and once for the draw. Raking works on the table of cells alone, as DataFrame steps: three small
aggregations and joins a round, whose lineage is cut each round.

Defined results: null and empty texts have no tokens and are never drawn, nor is a row without an
id; a missing source or language is a value of its own. Targets of values that no document has are
left out, values without a target get none; both in proportion. An empty table gives an empty
result. Rows alike in id are drawn or left together. Columns other than those named are ignored,
or carried along as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import SPACE_CLASS, Scratch, stored, text_of, trimmed

MARGINS = ("source", "lang", "topic")

#: Rounds of raking after which the driver's memory is swept. Every round leaves plans, broadcast factors
#: and task binaries there; Spark sooner lets the heap grow up to its limit than it lets go of them.
SWEEP_AFTER = 3


@dataclass(frozen=True)
class Mix:
    """Target shares by margin; a margin without them gets its own shares, tempered.

    ``temper`` is the power that shares are taken to (1 leaves a margin as it is, 0 makes it even).
    ``keep_share`` is the size of the mix as a part of all tokens. Cells that would have to give more
    than they have give their documents several times.
    """

    targets: Mapping[str, Mapping[str, float]] | None = None
    temper: Mapping[str, float] | None = None
    keep_share: float = 0.8
    rounds: int = 30
    tolerance: float = 1e-6
    seed: int = 17


def n_tokens(text: Column) -> Column:
    """Words of a text."""
    body = trimmed(text)
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, SPACE_CLASS + "+")))


def topic_of(text: Column) -> Column:
    """A coarse topic by the form of a text, for tables without such a column: what it mostly
    holds (lists, figures, notes) and, for prose, how long it is."""
    size = F.length(text)
    lines = 1 + size - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    bars = size - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(bars * 40 > size, "lists")
        .when(size < 400, "notes")
        .when(size > 800 * lines, "essays")
        .when(size > 6000, "long reads")
        .otherwise("articles")
    )


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens and documents of every cell that has tokens."""
    return (
        rows.where("_tokens > 0")
        .groupBy(*MARGINS)
        .agg(F.sum("_tokens").cast("double").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    )


def margin_targets(cells: DataFrame, margin: str, mix: Mix) -> DataFrame:
    """``margin`` and ``_target``: shares that add up to 1 over the values that have tokens."""
    have = cells.groupBy(margin).agg(F.sum("tokens").alias("_have"))
    given = (mix.targets or {}).get(margin)
    if given is None:
        power = (mix.temper or {}).get(margin, 1.0)
        want = have.select(margin, F.pow("_have", F.lit(power)).alias("_want"))
    else:
        listed = [(value, float(share)) for value, share in given.items()]
        listed = cells.sparkSession.createDataFrame(listed, f"{margin} string, _want double")
        want = have.select(margin).join(listed, margin)
    whole = want.agg(F.sum("_want")).first()[0]
    return want.select(margin, (F.col("_want") / F.lit(whole)).alias("_target"))


def rake(cells: DataFrame, mix: Mix, steps: Scratch) -> DataFrame:
    """Add ``weight``, the share of all tokens that each cell should have.

    Starts from the shares the cells have. Ends when no margin was off by more than the tolerance,
    or after the given rounds where targets contradict each other. Cells of a value without a
    target fall out with weight 0.
    """
    stored = steps.stored
    cells = stored(cells, "cells")
    whole = cells.agg(F.sum("tokens")).first()[0]
    if not whole:
        return cells.withColumn("weight", F.lit(0.0))
    # Each cell has its three targets with it, so that no round has to join them again.
    wanted = [f"_target_{margin}" for margin in MARGINS]
    weighted = cells.withColumn("weight", F.col("tokens") / F.lit(whole))
    for margin, target in zip(MARGINS, wanted, strict=True):
        targets = stored(margin_targets(cells, margin, mix), f"target-{margin}")
        weighted = weighted.join(targets.withColumnRenamed("_target", target), margin, "left")
    weighted = stored(weighted, "shares")
    for round_ in range(mix.rounds):
        before = weighted
        weighted = weighted.withColumn("_off", F.lit(0.0))
        for margin, target in zip(MARGINS, wanted, strict=True):
            now = weighted.groupBy(margin).agg(F.sum("weight").alias("_now"), F.max(target).alias("_target"))
            factors = now.select(margin, F.try_divide("_target", "_now").alias("_factor"))
            factor = F.coalesce("_factor", F.lit(0.0))
            off = F.when(F.col("weight") > 0, F.abs(factor - 1)).otherwise(0.0)
            weighted = weighted.join(factors, margin, "left").select(
                *MARGINS,
                "tokens",
                "documents",
                *wanted,
                (F.col("weight") * factor).alias("weight"),
                F.greatest("_off", off).alias("_off"),
            )
        weighted = stored(weighted, "raked")
        steps.done(before, sweep=cells.sparkSession if round_ % SWEEP_AFTER == 0 else None)
        if weighted.agg(F.max("_off")).first()[0] <= mix.tolerance:
            break
    return weighted.drop("_off", *wanted)


def probabilities(weighted: DataFrame, mix: Mix) -> DataFrame:
    """Turn ``weight`` into that of a token of the cell (1: as often as it is there) and add
    ``_expected``, the copies of a document, scaled so that the mix has ``keep_share`` of all tokens,
    and ``probability``, that of one copy at least."""
    tokens, shares = weighted.agg(F.sum("tokens"), F.sum("weight")).first()
    ratio = F.col("weight") * F.lit((tokens or 1.0) / (shares or 1.0)) / F.col("tokens")
    return weighted.select(
        *MARGINS,
        ratio.alias("weight"),
        (F.lit(mix.keep_share) * ratio).alias("_expected"),
        F.least(F.lit(1.0), F.lit(mix.keep_share) * ratio).alias("probability"),
    )


def mix_sources(
    docs: DataFrame,
    mix: Mix = Mix(),
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rake, then draw documents.

    Returns ``doc_id``, ``source``, ``lang``, ``topic``, ``n_tokens``, ``weight`` (of a token of the
    document in the raked mix, 1 where nothing changes), ``probability`` and ``drawn`` (whether it is
    in the mix at all) and ``copies`` (how often) of every document, and the columns to ``carry``
    along, which must not have one of these names. The mix has a document as often as ``copies`` says;
    taken once each, the drawn ones fall short in cells whose ``weight`` is above 1 / ``keep_share``.
    """
    text = text_of(text_col)
    also = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        (topic_of(text) if topic is None else topic).alias("topic"),
        n_tokens(text).cast("long").alias("_tokens"),
        also.alias("_carried"),
    )
    named = rows.na.fill("", list(MARGINS))
    with Scratch() as steps:
        weighted = rake(cells_of(named), mix, steps)
        each = stored(probabilities(weighted, mix), "cell-probabilities")
    # 53 bits of a hash make a number below 1 that depends on the id and the seed alone.
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(mix.seed)), 11) / F.lit(float(1 << 53))
    probability = F.when(F.col("_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    expected = F.when(F.col("_tokens") > 0, F.coalesce("_expected", F.lit(0.0))).otherwise(0.0)
    copies = F.floor(expected) + (chance < expected - F.floor(expected)).cast("int")
    return named.join(each, list(MARGINS), "left").select(
        "doc_id",
        *MARGINS,
        F.col("_tokens").alias("n_tokens"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        probability.alias("probability"),
        (F.col("doc_id").isNotNull() & (chance < probability)).alias("drawn"),
        F.when(F.col("doc_id").isNotNull(), copies).otherwise(0).cast("int").alias("copies"),
        *[F.col("_carried")[c].alias(c) for c in carry],
    )
