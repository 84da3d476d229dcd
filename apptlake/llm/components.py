"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import Scratch, stored


def connected(links: DataFrame, keep: Scratch | None = None, most_rounds: int = 60) -> DataFrame:
    """The links' components as a stored table; see ``_connected``. With ``keep`` it is one of the
    steps there."""
    with Scratch() as steps:
        return (keep.stored if keep else stored)(_connected(links, most_rounds, steps), "roots")


def _connected(links: DataFrame, most_rounds: int, steps: Scratch) -> DataFrame:
    """``_node`` and ``_root``, the smallest node reachable, of every linked node but the roots.

    ``links`` has columns ``_a`` and ``_b`` of one kind; neither order nor repeats matter. Every
    round hooks the larger neighbours of each node, then its smaller ones, to the least of them,
    with partial minima before each shuffle. Links shrink to stars in about log2 of the longest
    path rounds; only sums over the links reach the driver.
    """
    now = steps.stored(
        links.where("_a != _b")
        .select(F.greatest("_a", "_b").alias("_node"), F.least("_a", "_b").alias("_root"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("_root").alias("_node"), F.col("_node").alias("_root")))
        least = both.groupBy("_node").agg(F.least(F.min("_root"), F.col("_node")).alias("_least"))
        large = (
            both.join(least, "_node")
            .where("_root > _node")
            .select(F.col("_root").alias("_node"), F.col("_least").alias("_root"))
            .where("_node != _root")
            .distinct()
        )
        least = large.groupBy("_node").agg(F.min("_root").alias("_least"))
        small = large.join(least, "_node")
        last, now = now, steps.stored(
            small.select(F.col("_root").alias("_node"), F.col("_least").alias("_root"))
            .where("_node != _root")
            .unionByName(least.select("_node", F.col("_least").alias("_root")))
            .distinct(),
            "stars",
        )
        steps.done(last)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_node", "_root") % 1_000_003)).first()
        if state == before:
            return now
        before = state
    raise RuntimeError("the links have not settled")
