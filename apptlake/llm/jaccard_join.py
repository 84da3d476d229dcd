"""Operator 1: exact Jaccard join of documents over word shingles, by universe partition.

Sets whose Jaccard similarity reaches the threshold differ in at most H shingles, H following from
their sizes. Shingles are dealt by hash into m segments, m set by the size band of a document. A
document that relies on segments worth H + 1 in all must, by the pigeonhole principle, agree in one
of them with every similar document. A segment counts 1 if its subset has to be equal, and 2 if one
shingle may be missing on either side (the one-deletion neighbourhood).

* Index: of every band a document may have partners in, the hash of each segment's subset; in bands
  of small sets, where segments are few, their one-deletion neighbourhoods as well.
* Allocation by cost: a document relies on the segments whose subsets are rarest. Those that nobody
  shares cost nothing; one that can rely on them alone has no partner and drops out.
* Verification compares the shingles themselves, of pairs whose sizes and parities (how many of the
  shingles in each part of the universe, modulo 2) differ no more than those of similar sets can.

Documents of equal sets are one class, represented by its smallest id. What is asked for are the
classes and the components that links make, so a bucket needs no pairs of documents that are already
joined: its members are first compared with one of them, the hub. What is left is paired across the
components known so far, each member outside the bucket's greatest component with all others, where
that makes few pairs for its members. These are met in blocks, and only those whose sizes and
parities allow a link become rows. Members of other buckets are told apart by their differences
from the hub: two that are not joined by it differ less from one another than their differences add
up to, hence have one of the rarer differences in common; those make new, narrower buckets. No pair
that could be a link is left out.

Defined results: null texts and texts without words have no shingles and are linked with nothing,
each its own class and component. Rows that share an id are one document as far as classes and
components go; rows without an id get a null component. Repeated texts fall into one class. Columns
other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import Scratch, kind_of, slices, stored, text_of
from apptlake.llm.components import connected
from apptlake.llm.shingles import exact_shingles, mixed, shingle_sets


@dataclass(frozen=True)
class Rule:
    """Words in a shingle and least similarity in percent; the rest steers cost, not results."""

    width: int = 5
    percent: int = 80
    #: Up to this set size, bands use one-deletion neighbourhoods.
    small: int = 16
    #: Segments beyond those needed, in percent; they let a document pass over its common ones.
    spare: int = 5
    #: Pairs across components up to which a bucket is paired.
    paired: int = 4096
    #: The same for each of its members, so that pairs grow in proportion to members.
    paired_each: int = 1024
    #: Times that buckets are narrowed; whatever is open after the last is paired across components.
    rounds: int = 6

    def distance(self, total: int) -> int:
        """Most shingles by which two similar sets of so many shingles in all can differ."""
        return (100 - self.percent) * total // (100 + self.percent)


def bands(rule: Rule) -> list[int]:
    """Largest set size of each band: steps of 80 percent, so that few sets reach into the next."""
    tops = [4]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 4, tops[-1] * 9 // 5))
    return tops


class Partition:
    """Keys of a set in the bands where it may have partners."""

    def __init__(self, rule: Rule):
        self.rule, self.tops = rule, bands(rule)

    def segments(self, top: int) -> int:
        worth = self.rule.distance(2 * top) + 1
        if top <= self.rule.small:
            return -(-worth // 2)
        return -(-worth * (100 + self.rule.spare) // 100)

    def keys(self, tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
        """Band, keys and how many of them the set has to rely on (0: on all of them).

        In its own band, which is the index, a set has a key for every segment. In bands above,
        where it only looks for partners, it has as many as it may rely on and some to spare,
        those of the segments where it has most.
        """
        n, rule = len(tokens), self.rule
        if not n:
            return
        reach = 100 * n // rule.percent
        band = own = int(np.searchsorted(self.tops, n))
        spread = mixed(tokens, 1)
        while band == 0 or self.tops[band - 1] < reach:
            top = self.tops[band]
            needed = rule.distance(n + min(top, reach)) + 1
            m = self.segments(top)
            of = (spread % np.uint64(m)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(spread[order])))
            edges = np.searchsorted(of[order], np.arange(m + 1))
            subsets = sums[edges[1:]] - sums[edges[:-1]]
            place = np.uint64(band << 40) + np.arange(m, dtype=np.uint64)
            sizes = edges[1:] - edges[:-1]
            # The lowest bit says that a subset is empty, as those of unlike documents often are.
            even = ~np.uint64(1)
            whole = mixed(subsets + mixed(place, 2), 3) & even | (sizes == 0).astype(np.uint64)
            if top <= rule.small:
                less = mixed(subsets[of] - spread + mixed(place[of], 2), 3) & even
                less |= (sizes[of] == 1).astype(np.uint64)
                yield band, np.concatenate((whole, less)), 0
            elif band == own:
                yield band, whole, needed
            else:
                fullest = np.argsort(-sizes, kind="stable")
                yield band, whole[fullest[: -(-needed * (100 + rule.spare) // 100)]], needed
            band += 1
            if self.tops[band - 1] >= reach:
                return


def parities(tokens: np.ndarray) -> np.ndarray:
    """Whether the tokens in each of many parts of the universe are odd in number, as bits of 64-bit
    numbers. There are at least two parts a token; their number is a power of two, and folding the
    numbers in halves gives those of half as many parts.

    Sets differ in at least as many tokens as their parities do.
    """
    parts = max(64, 1 << (2 * len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount((mixed(tokens, 21) & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


#: Numbers of 64 parities that blocks of a bucket compare, and most documents a side of a block.
SIEVE, BLOCK = 512, 512


def _folded(bits: np.ndarray, numbers: int) -> np.ndarray:
    """Parities of fewer parts: folded in halves until there are so many numbers."""
    while len(bits) > numbers:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _likely(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that may be links: neither the sizes nor the parities of the sets differ by more
    than those of similar sets can. Far shorter than the texts, these spare most pairs theirs."""
    side = lambda doc, n: sketches.select(
        F.col("_doc").alias(doc), F.col("_size").alias(f"_size_{n}"), F.col("_parities").alias(f"_parities_{n}")
    )
    both = F.col("_size_1") + F.col("_size_2")
    near = 100 * F.least("_size_1", "_size_2") >= rule.percent * F.greatest("_size_1", "_size_2")
    most = F.floor((100 - rule.percent) * both / (100 + rule.percent))
    xor = lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))

    def half(a):
        n = F.size(a) / 2
        return xor(F.slice(a, 1, n.cast("int")), F.slice(a, n.cast("int") + 1, n.cast("int")))

    # Sets of similar sizes have as many parts or twice as many.
    one, two = F.col("_parities_1"), F.col("_parities_2")
    one, two = (F.when(F.size(a) > F.size(b), half(a)).otherwise(a) for a, b in ((one, two), (two, one)))
    apart = F.aggregate(xor(one, two), F.lit(0), lambda n, x: n + F.bit_count(x))
    found = pairs.join(side("_a", 1), "_a").join(side("_b", 2), "_b")
    return found.where(near).where(apart <= most).select(*pairs.columns)


def _signatures(rows: DataFrame, rule: Rule) -> DataFrame:
    """``_doc``, parities (and folded ones), size, hash of the set, and for each band its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = Partition(rule)
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                texts = [t.encode() for t in part.column("_text").to_pylist()]
                sets, again = shingle_sets(texts, rule.width)
                parts = [
                    [{"band": b, "needed": k, "keys": keys.view(np.int64)} for b, keys, k in partition.keys(s)]
                    for s in sets
                ]
                # Of independent hashes, so that sets of one shingle have all 128 bits as well.
                halves = [
                    np.array([mixed(s, 11).sum(dtype=np.uint64) for s in each], dtype=np.uint64).view(np.int64)
                    for each in (sets, again)
                ]
                bits = [parities(s) for s in sets]
                kind = pa.list_(
                    pa.struct([("band", pa.int32()), ("needed", pa.int32()), ("keys", pa.list_(pa.int64()))])
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_doc"),
                        pa.array(bits, pa.list_(pa.int64())),
                        pa.array([_folded(b, SIEVE).tobytes() for b in bits], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(halves[0]),
                        pa.array(halves[1]),
                        pa.array(parts, kind),
                    ],
                    names=["_doc", "_parities", "_sieve", "_size", "_high", "_low", "_parts"],
                )

    return rows.mapInArrow(
        run,
        f"_doc {kind_of(rows, '_doc')}, _parities array<bigint>, _sieve binary, _size bigint, _high bigint, _low bigint, "
        "_parts array<struct<band:int,needed:int,keys:array<bigint>>>",
    )


def _shared_keys(signatures: DataFrame, members: DataFrame, steps: Scratch) -> DataFrame:
    """``_key``, ``_doc``, ``_score``, ``_chosen``: the keys that documents share, and whether the
    document relies on them.

    ``members`` has the documents of classes of several: the class and how many it has. Of these
    only the first takes part, and a key that no other class has is not shared. The score of a
    document says how common its keys are; copies of one original lie around it.
    """
    # What a document has in a band goes along in one number, as there are many keys.
    what = F.shiftleft(F.col("band").cast("long"), 48) + F.shiftleft(F.col("needed").cast("long"), 24)
    each = signatures.select("_doc", F.inline("_parts")).select(
        "_doc", (what + F.size("keys")).alias("_what"), F.explode("keys").alias("_key")
    )
    common = each.groupBy("_key").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    shared = each.join(common, "_key").join(members, "_doc", "left")
    shared = shared.where("(_class IS NULL OR _class = _doc) AND _count > coalesce(_members, 1)")
    # What a document doesn't share it may rely on for nothing; it needs the rarest of the others,
    # and empty subsets last of all.
    empty = F.col("_key").bitwiseAND(F.lit(1)).alias("_empty")
    own = shared.groupBy("_doc", "_what").agg(
        F.sort_array(F.collect_list(F.struct(empty, "_count", "_key"))).alias("_shared")
    )
    size, mask = F.size("_shared"), F.lit((1 << 24) - 1)
    needed = F.shiftright("_what", 24).bitwiseAND(mask)
    lacking = F.when(needed == 0, size).otherwise(
        F.greatest(F.lit(0), needed - (F.col("_what").bitwiseAND(mask) - size))
    )
    score = F.aggregate("_shared", F.lit(0).cast("long"), lambda s, x: s + x["_count"] * (1 - x["_empty"]))
    own = own.select("_doc", lacking.alias("_lacking"), score.alias("_score"), "_shared")
    return steps.stored(own.select("_doc", "_lacking", "_score", F.posexplode("_shared").alias("_n", "_s")).select(
        F.col("_s")["_key"].alias("_key"), "_doc", "_score", (F.col("_n") < F.col("_lacking")).alias("_chosen")
    ), "shared-keys")


def _relied_on(own: DataFrame) -> DataFrame:
    """The shared keys that some document relies on."""
    relied = own.groupBy("_key").agg(F.max("_chosen").alias("_any"), F.count(F.lit(1)).alias("_count"))
    return own.join(relied.where("_any AND _count > 1").select("_key"), "_key")


def _compared(pairs: DataFrame, texts: DataFrame, rule: Rule, differences: bool) -> DataFrame:
    """``_a``, ``_b``, ``_linked`` for pairs of documents, by their shingles. With ``differences``,
    also the sizes of both sets and the hashes of the shingles in one of them alone."""
    a = texts.select(F.col("_doc").alias("_a"), F.col("_text").alias("_text"))
    b = texts.select(F.col("_doc").alias("_b"), F.col("_text").alias("_other"))
    rows = pairs.join(a, "_a").join(b, "_b").select("_a", "_b", "_text", "_other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, frozenset()
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                found = []
                for k, (text, other) in enumerate(
                    zip(part.column("_text").to_pylist(), part.column("_other").to_pylist(), strict=True)
                ):
                    if other != last:
                        last, hub = other, exact_shingles(other, rule.width)
                    own = exact_shingles(text, rule.width)
                    common = len(own & hub)
                    union = len(own) + len(hub) - common
                    delta = []
                    if differences:
                        delta = [xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in own ^ hub]
                    found.append((100 * common >= rule.percent * union > 0, len(own), len(hub), delta))
                columns = list(zip(*found, strict=True)) or [(), (), (), ()]
                kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_a"), part.column("_b")]
                    + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["_a", "_b", "_linked", "_size_a", "_size_b", "_delta"],
                )

    kind = kind_of(pairs, "_a")
    return rows.mapInArrow(
        run,
        f"_a {kind}, _b {kind}, _linked boolean, _size_a bigint, _size_b bigint, _delta array<bigint>",
    )


def _rooted(rows: DataFrame, roots: DataFrame | None, doc: str, name: str) -> DataFrame:
    """Add the component of a document as known so far: itself, if it has no links."""
    if roots is None:
        return rows.withColumn(name, F.col(doc))
    found = roots.select(F.col("_node").alias(doc), F.col("_root").alias(name))
    return rows.join(found, doc, "left").withColumn(name, F.coalesce(name, doc))


def _hubs(buckets: DataFrame, rule: Rule) -> DataFrame:
    """``_key`` and ``_b``: what the members of every bucket are compared with.

    That is the member whose keys are the most common. Large buckets of one family have different
    ones, and a document would be compared with many; so they take the best hub of any bucket that
    one of their members is in. Any document serves as a hub, whether of the bucket or not.
    """
    hubs = buckets.groupBy("_key").agg(
        F.max(F.struct("_score", "_doc")).alias("_best"),
        (F.count(F.lit(1)) * F.count(F.when(F.col("_chosen"), 1)) > rule.paired).alias("_large"),
    )
    large = buckets.select("_key", "_doc").join(hubs.where("_large"), "_key")
    known = large.groupBy("_doc").agg(F.max("_best").alias("_known"))
    shared = large.join(known, "_doc").groupBy("_key").agg(F.max("_known").alias("_known"))
    return hubs.join(shared, "_key", "left").select("_key", F.coalesce("_known", "_best")["_doc"].alias("_b"))


def _open(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Buckets that span several components, how many members each has and how many pairs it would
    take across components, and whether a member is in the greatest of these (``_inner``). With
    ``_n_outer``, ``_k_outer`` and ``_k_inner``: members, and chosen ones, outside it and inside."""
    rows = _rooted(buckets, roots, "_doc", "_component")
    parts = rows.groupBy("_key", "_component").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_chosen"), 1)).alias("_k")
    )
    spans = parts.groupBy("_key").agg(
        F.max(F.struct("_n", "_component", "_k")).alias("_main"),
        F.sum("_n").alias("_members"),
        F.sum("_k").alias("_k_all"),
        (F.sum("_n") * F.sum("_k") - F.sum(F.col("_n") * F.col("_k"))).alias("_pairs"),
    )
    main = F.col("_main")
    rows = rows.join(spans.where("_pairs > 0"), "_key").withColumns({
        "_inner": F.col("_component") == main["_component"],
        "_n_outer": F.col("_members") - main["_n"],
        "_k_outer": F.col("_k_all") - main["_k"],
        "_k_inner": main["_k"],
    })
    return rows.drop("_main", "_k_all")


def _in_block(left: list[tuple], right: list[tuple], rule: Rule) -> Iterator[tuple]:
    """Pairs of documents of different components whose sizes and parities allow a link."""
    numbers = min(len(r[3]) for r in (*left, *right)) // 8
    bits = lambda r: _folded(np.frombuffer(r[3] or b"", dtype=np.uint64), numbers)
    code: dict[str, int] = {}
    components = np.array([code.setdefault(r[1], len(code)) for r in right])
    sizes = np.array([r[2] for r in right], dtype=np.int64)
    table = np.stack([bits(r) for r in right])
    for x in left:
        apart = np.bitwise_count(table ^ bits(x)).sum(axis=1, dtype=np.int64)
        near = 100 * np.minimum(sizes, x[2]) >= rule.percent * np.maximum(sizes, x[2])
        near &= apart * (100 + rule.percent) <= (100 - rule.percent) * (sizes + x[2])
        near &= components != code.get(x[1], -1)
        yield from ((x[0], right[k][0]) for k in np.flatnonzero(near))


def _across(buckets: DataFrame, sketches: DataFrame | None = None, rule: Rule = Rule()) -> DataFrame:
    """``_a`` and ``_b``: the pairs of open buckets across components that may be links, or all of
    them without ``sketches``. One of the two is outside the greatest component, so that two of one
    component are met no more often than there are pairs.

    The chosen outside meet all, those inside meet what is outside. Both sides are cut into blocks by
    a hash, and each block of one side meets each of the other in a group of its own: a large bucket
    takes many small groups, and its rows are copied once and for each ``BLOCK`` pairs of theirs.
    """
    if sketches is None:
        rows = buckets.withColumns({"_size": F.lit(0).cast("long"), "_sieve": F.lit(b"")})
    else:
        rows = buckets.join(sketches.select("_doc", "_size", "_sieve"), "_doc")
    hashed = F.xxhash64("_doc")

    def copies(met: int, right: bool, here, own, other):
        """The groups of a document that is on one side of a meeting: its block with each other."""
        mine = F.pmod(hashed, F.ceil(own / BLOCK)).cast("int")
        theirs = F.sequence(F.lit(0), (F.ceil(other / BLOCK) - 1).cast("int"))
        groups = F.transform(
            theirs,
            lambda k: F.struct(
                F.lit(met).alias("_met"),
                (k if right else mine).alias("_i"),
                (mine if right else k).alias("_j"),
                F.lit(right).alias("_right"),
            ),
        )
        kind = "array<struct<_met:int,_i:int,_j:int,_right:boolean>>"
        none = F.array().cast(kind)
        return F.when(here & (own > 0) & (other > 0), groups.cast(kind)).otherwise(none)

    chosen, inner = F.col("_chosen"), F.col("_inner")
    n, n_outer, k_outer, k_inner = (F.col(c) for c in ("_members", "_n_outer", "_k_outer", "_k_inner"))
    groups = F.concat(
        copies(0, False, chosen & ~inner, k_outer, n),
        copies(0, True, F.lit(True), n, k_outer),
        copies(1, False, chosen & inner, k_inner, n_outer),
        copies(1, True, ~inner, n_outer, k_inner),
    )
    # A component is only told from others, for which its text does, whatever kind ids are of.
    group = ["_key", "_met", "_i", "_j"]
    rows = rows.withColumn("_component", F.col("_component").cast("string"))
    rows = rows.select("_key", "_doc", "_component", "_size", "_sieve", F.inline(groups))
    rows = rows.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], ids) for k in (0, 1)], names=["_x", "_y"]
            )

        now, sides, ids, found = None, ([], []), None, []
        for batch in batches:
            ids = batch.schema.field("_doc").type
            columns = [batch.column(c).to_pylist() for c in (*group, "_right", "_doc", "_component", "_size", "_sieve")]
            for *of, right, doc, component, size, sieve in zip(*columns, strict=True):
                if of != now:
                    if sides[0] and sides[1]:
                        found += _in_block(*sides, rule)
                    if len(found) > 10_000:
                        yield made(found)
                        found = []
                    now, sides = of, ([], [])
                sides[right].append((doc, component, size, sieve))
        if sides[0] and sides[1]:
            found += _in_block(*sides, rule)
        if found:
            yield made(found)

    kind = kind_of(rows, "_doc")
    pairs = rows.mapInArrow(run, f"_x {kind}, _y {kind}")
    return pairs.select(F.greatest("_x", "_y").alias("_a"), F.least("_x", "_y").alias("_b")).distinct()


def _narrower(compared: DataFrame, rule: Rule, steps: Scratch) -> DataFrame:
    """Buckets by the rarer differences of documents from their hub.

    Two documents with d and e differences from it that are similar, hence at most H apart, share at
    least (d + e - H) / 2 of these. By the usual argument on prefixes they share one of the first
    d - (that) + 1 and e - (that) + 1 in any common order; rare ones come first. The document with
    fewer differences (``_chosen``) gets by with fewer.
    """
    p = F.lit(rule.percent)
    reach = F.floor(100 * F.col("_size_a") / p)
    most = F.floor((100 - p) * (F.col("_size_a") + reach) / (100 + p)).cast("long")
    rows = compared.select(
        F.col("_b").alias("_hub"), F.col("_a").alias("_doc"), "_linked", "_delta", most.alias("_h"),
        F.size("_delta").cast("long").alias("_d"),
    )
    each = steps.stored(rows.select("_hub", "_doc", F.explode("_delta").alias("_item")), "differences")
    counts = each.groupBy("_hub", "_item").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    # Differences that nobody else has come first and make no bucket.
    ranked = each.join(counts, ["_hub", "_item"]).groupBy("_hub", "_doc").agg(
        F.sort_array(F.collect_list(F.struct("_count", "_item"))).alias("_items")
    )
    rows = rows.drop("_delta").join(ranked, ["_hub", "_doc"])
    d, h = F.col("_d"), F.col("_h")
    slack = F.ceil(d * (100 - p) / (100 + p))
    # A document that the hub links needs only partners that it doesn't link.
    as_smaller = F.when(
        F.col("_linked"), d - F.greatest(F.lit(1), F.ceil((1 + d - slack) / 2)) + 1
    ).otherwise(d - F.ceil((F.greatest(2 * d, h + 1) - h) / 2) + 1)
    as_larger = F.when(F.col("_linked"), F.lit(0)).otherwise(F.least(d, h + 1))
    alone = d - F.size("_items")
    rows = rows.select(
        "_hub", "_doc", "_items",
        F.greatest(F.lit(0), as_smaller - alone).alias("_few"),
        F.greatest(F.lit(0), F.greatest(as_smaller, as_larger) - alone).alias("_many"),
        d.alias("_d"),
    )
    items = rows.select("_hub", "_doc", "_few", "_many", "_d", F.posexplode("_items").alias("_n", "_i"))
    return items.where(F.col("_n") < F.col("_many")).select(
        F.xxhash64("_hub", F.col("_i")["_item"]).alias("_key"),
        "_doc",
        (-F.col("_d")).alias("_score"),
        (F.col("_n") < F.col("_few")).alias("_chosen"),
    )


def similarity_classes(
    docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Join all documents with all.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links) and
    ``class_id`` (the smallest id with the same set).
    """
    with Scratch() as steps:
        return stored(_classes(docs, rule, id_col, text_col, steps), "classes")


def _classes(docs: DataFrame, rule: Rule, id_col: str, text_col: str, steps: Scratch) -> DataFrame:
    stored, spark = steps.stored, docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_doc"), text_of(text_col).alias("_text"))
    signatures = stored(_signatures(rows, rule), "signatures")
    ids = stored(signatures.select("_doc", "_size", "_high", "_low"), "sets")
    sketches = signatures.where("_size > 0 AND _doc IS NOT NULL").select("_doc", "_size", "_parities", "_sieve")
    sized = ids.where("_size > 0 AND _doc IS NOT NULL")
    classes = sized.groupBy("_high", "_low", "_size").agg(
        F.min("_doc").alias("_class"), F.count(F.lit(1)).alias("_members")
    )
    # Stored by themselves, so that the join has an exchange on either side and may split a hot class.
    classes = stored(classes.where("_members > 1"), "large-classes")
    copies = stored(sized.join(classes, ["_high", "_low", "_size"]).drop("_size"), "copies")
    # Ids that stand on several rows are no mere copies: what links one of their texts links all.
    twice = stored(sized.groupBy("_doc").count().where("count > 1").select("_doc"), "repeated-ids")
    members = copies.join(twice, "_doc", "left_anti").select("_doc", "_class", "_members")
    buckets = signatures.where("_size > 0 AND _doc IS NOT NULL").select("_doc", "_parts")
    shared = _shared_keys(buckets, members, steps)
    buckets = stored(_relied_on(shared), "buckets")
    involved = buckets.select("_doc").distinct()
    texts = stored(rows.join(involved, "_doc", "left_semi"), "texts")
    sketches = stored(sketches.join(involved, "_doc", "left_semi").distinct(), "sketches")
    steps.done(signatures, shared, sweep=spark)

    same = copies.join(twice, "_doc", "left_semi").where("_doc != _class")
    links = same.select(F.col("_doc").alias("_a"), F.col("_class").alias("_b"))
    roots: DataFrame | None = None

    def link(compared: DataFrame) -> DataFrame:
        """The components with the links found now, joined to those of all found before."""
        nonlocal links
        found = compared.where("_linked").select("_a", "_b")
        roots_now = connected(links.unionByName(found), steps)
        steps.done(roots)
        links = roots_now.select(F.col("_node").alias("_a"), F.col("_root").alias("_b"))
        return roots_now

    for round_ in range(rule.rounds):
        # Compare the members of every bucket with its hub.
        hubs = stored(_hubs(buckets, rule), "hubs")
        pairs = _rooted(buckets.join(hubs, "_key").where("_doc != _b"), roots, "_doc", "_ca")
        pairs = _rooted(pairs, roots, "_b", "_cb").where("_ca != _cb")
        pairs = stored(pairs.select(F.col("_doc").alias("_a"), "_b").distinct(), "hub-pairs")
        compared = stored(_compared(_likely(pairs, sketches, rule), texts, rule, False), "compared")
        roots = link(compared)
        left = stored(_open(buckets, roots), "open-buckets")
        # Buckets with few pairs across components are paired, less what was compared already.
        few = F.col("_pairs") <= F.greatest(F.lit(rule.paired), rule.paired_each * F.col("_members"))
        last = round_ == rule.rounds - 1
        seen = pairs.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b"))
        rest = _across(left if last else left.where(few), sketches, rule).join(seen, ["_a", "_b"], "left_anti")
        rest = stored(_likely(rest, sketches, rule), "rest-pairs")
        if not rest.isEmpty():
            again = stored(_compared(rest, texts, rule, False), "compared")
            roots = link(again)
            steps.done(again)
        steps.done(pairs, compared, rest, sweep=spark)
        wide = left.where(~few)
        if last or wide.isEmpty():
            break
        # The others give way to narrower ones by the differences of their members from the hub.
        apart = wide.join(hubs.select("_key", "_b"), "_key").where("_doc != _b")
        apart = apart.select(F.col("_doc").alias("_a"), "_b").distinct()
        apart = stored(_compared(apart, texts, rule, True), "apart")
        narrower = stored(_narrower(apart.where("size(_delta) > 0"), rule, steps), "buckets")
        steps.done(buckets, hubs, left, apart, sweep=spark)
        buckets = narrower

    of = copies.select("_doc", "_high", "_low", "_class").distinct()
    found = ids.join(of, ["_doc", "_high", "_low"], "left")
    found = found.withColumn("_class", F.coalesce("_class", "_doc"))
    found = _rooted(found, roots, "_class", "_component")
    return found.select(
        F.col("_doc").alias("doc_id"),
        F.col("_size").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        F.col("_class").alias("class_id"),
    )
