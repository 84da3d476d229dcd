"""Operator 9: homomorphic multiset hash of a text's paragraphs, in DataFrame functions only.

Every paragraph (a line; long ones are parted after their sentences) is hashed to a wide vector,
and the vectors are summed modulo a power of two. The order of paragraphs plays no part, and a
paragraph can be put in or taken out of a fingerprint by adding or subtracting its vector.

Two lanes share a 64-bit number, each with bits to spare, so that one masked addition adds both
modulo 2**30. Lane entries are below 2**12 around a known mean; the centred sums are therefore a
random projection of the multiset, and the cosine of two fingerprints estimates which share of
their paragraphs is common.

Defined results: a null or empty text has no paragraphs, and all such fingerprints are equal
(likeness 1); against any other text their likeness is 0. Equal texts have equal fingerprints.
Repeated paragraphs count as often as they stand there. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apptlake.llm.common import fenced, stored, text_of

#: Numbers of two lanes each.
PAIRS = 64
LANE_MASK = (1 << 30) - 1
PAIR_MASK = LANE_MASK | LANE_MASK << 32
ENTRY_MASK = 0xFFF | 0xFFF << 32
MEAN = 0xFFF / 2

#: Where a text is parted: line ends, and blanks after the end of a sentence.
PARTS = "\\n|(?<=[.!?]) "


def paragraphs(text: Column) -> Column:
    """Paragraphs of a text, without empty ones."""
    return F.filter(F.split(text, PARTS, -1), lambda x: x != "")


def paragraph_hashes(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda x: F.xxhash64(x))


def vector(hashes: Column) -> Column:
    """The sum of the vectors of all paragraphs. ``hashes`` has to be a column, not an expression."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(PAIRS - 1)),
        lambda lane: F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda total, h: (total + F.xxhash64(h, lane).bitwiseAND(F.lit(ENTRY_MASK))).bitwiseAND(
                F.lit(PAIR_MASK)
            ),
        ),
    )


def with_paragraph(vector: Column, paragraph: Column) -> Column:
    """A vector after one paragraph is put in."""
    h = F.xxhash64(paragraph)
    return F.transform(
        vector,
        lambda x, lane: (x + F.xxhash64(h, lane).bitwiseAND(F.lit(ENTRY_MASK))).bitwiseAND(
            F.lit(PAIR_MASK)
        ),
    )


def without_paragraph(vector: Column, paragraph: Column) -> Column:
    """A vector after one paragraph is taken out: 2**30 is lent to each lane before subtracting."""
    h, lent = F.xxhash64(paragraph), (LANE_MASK + 1) | (LANE_MASK + 1) << 32
    return F.transform(
        vector,
        lambda x, lane: (
            x.bitwiseOR(F.lit(lent)) - F.xxhash64(h, lane).bitwiseAND(F.lit(ENTRY_MASK))
        ).bitwiseAND(F.lit(PAIR_MASK)),
    )


def as_text(vector: Column, count: Column) -> Column:
    """A fingerprint: all lanes and the number of paragraphs, in hexadecimal digits."""
    digits = F.transform(vector, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.array_join(digits, ""), F.lpad(F.lower(F.hex(count)), 8, "0"))


def centred(vector: Column, count: Column) -> Column:
    """All lanes less their expected sums."""
    low = F.transform(vector, lambda x: x.bitwiseAND(F.lit(LANE_MASK)) - count * MEAN)
    high = F.transform(vector, lambda x: F.shiftright(x, 32) - count * MEAN)
    return F.concat(low, high)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two centred vectors, at least 0."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v
    )
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(dot(a, b), size)))


def fingerprinted(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``<name>`` (text), ``_<name>_vector`` and ``_<name>_count`` for a text column."""
    hashes, vec, count = f"_{name}_hashes", f"_{name}_vector", f"_{name}_count"
    rows = rows.withColumn(hashes, paragraph_hashes(F.col(text)))
    rows = rows.withColumns(
        {vec: vector(F.col(hashes)), count: F.size(hashes).cast("long")}
    ).drop(hashes)
    return rows.withColumn(name, as_text(F.col(vec), F.col(count)))


def likeness(one: str, other: str) -> Column:
    """Likeness of two fingerprints made by ``fingerprinted``."""
    a = centred(F.col(f"_{one}_vector"), F.col(f"_{one}_count"))
    b = centred(F.col(f"_{other}_vector"), F.col(f"_{other}_count"))
    return F.when(F.col(one) == F.col(other), F.lit(1.0)).otherwise(
        F.coalesce(cosine(a, b), F.lit(0.0))
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_chars``, ``n_paragraphs`` and ``fingerprint`` of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    rows = rows.withColumn("n_chars", F.length("_text").cast("long"))
    rows = fingerprinted(rows, "_text", "fingerprint")
    return fenced(
        rows.select(
            "doc_id", "n_chars", F.col("_fingerprint_count").alias("n_paragraphs"), "fingerprint"
        )
    )


def next_ids(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The next larger id of every id; after the last comes the first.

    Ids are dealt out by ranges, and only the first id of each range meets those of the others.
    """
    ids = docs.select(F.col(id_col).alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
    ranges = stored(
        ids.repartitionByRange("doc_id").withColumn("_range", F.spark_partition_id()), "id-ranges"
    )
    # One row per range: as few as there are shuffle partitions.
    first = ranges.groupBy("_range").agg(F.min("doc_id").alias("_first"))
    in_order = Window.orderBy("_range")
    everywhere = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = first.select(
        F.col("_range"),
        F.coalesce(
            F.lead("_first").over(in_order), F.first("_first").over(everywhere)
        ).alias("_after"),
    )
    within = ranges.withColumn(
        "_next", F.lead("doc_id").over(Window.partitionBy("_range").orderBy("doc_id"))
    )
    return within.join(F.broadcast(after), "_range").select(
        "doc_id", F.coalesce("_next", "_after").alias("next_id")
    )


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness.

    The edited text has the last half of the code points replaced by as many first ones of the
    next document (all, if it has fewer). Rows that share an id have the same next document; as
    its text the smallest of a repeated id counts. Without an id there is no next document.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    ids = next_ids(rows)
    # Both sides below start from this one exchange, so texts move twice: by id, and by next id.
    # The fence keeps a filter of one side from making two exchanges of it.
    rows = fenced(rows.repartition("doc_id"))
    after = rows.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("_text").alias("_next_text"))
    rows = rows.join(ids, "doc_id", "left").join(after, "next_id", "left")
    half = F.floor(F.length("_text") / 2).cast("int")
    rows = rows.select(
        "doc_id",
        "_text",
        F.coalesce("_next_text", F.lit("")).alias("_next_text"),
        F.length("_text").cast("long").alias("n_chars"),
        half.alias("_half"),
    )
    edited = F.concat(
        F.substring("_text", F.lit(1), (F.col("n_chars") - F.col("_half")).cast("int")),
        F.substring("_next_text", F.lit(1), F.col("_half")),
    )
    rows = rows.withColumn("_edited", edited)
    rows = rows.withColumn("edited_sha256", F.sha2("_edited", 256))
    rows = fingerprinted(rows, "_text", "fingerprint")
    rows = fingerprinted(rows, "_edited", "edited_fingerprint")
    rows = fingerprinted(rows, "_next_text", "_next_fingerprint").drop("_text", "_next_text")
    return fenced(
        rows.select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
            likeness("fingerprint", "_next_fingerprint").alias("near_next"),
        )
    )
