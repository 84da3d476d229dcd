"""Operator 13: phrase collocations from Rabin-Karp fingerprints of all n-grams.

Prefix polynomials over the word values of many texts, modulo a prime, give the fingerprint of any
n-gram as a difference of two of them. Tasks sum up fingerprints of their own n-grams, and a shuffle
deals these by ranges of fingerprints, as arrays in ascending order, to tasks that merge one range at a
time. There are as many ranges as the texts need, so that none outgrows a task's memory. A phrase is no more frequent than its parts, so longer n-grams are counted only where
each pair of words in them may be frequent: a bit table of fixed size, with the frequent
fingerprints' bits set, says so in every task. A full table only saves less work; it drops nothing.

Frequent fingerprints are then verified against the text: their occurrences are grouped by the words
themselves, from a pointer to the first occurrence in each batch of texts the phrase is read out, and
phrases are summed as text. Two phrases of one fingerprint so count apart, and phrases that are not
frequent are never written out, but for those that share a bit with a frequent one.

Defined results: null and empty texts have no words; a null language is "und"; repeated rows count as
often as they stand; ids are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apptlake.llm.byte_words import EDGE, GAP, Words, split_words
from apptlake.llm.common import Scratch, slices, stored, text_of
from apptlake.llm.shingles import mixed

# What parts pieces and words, and which phrases count.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[0x20, 0x09]] = GAP
KINDS[[ord(c) for c in ".,;:!?"]] = KINDS[0x0A:0x0E] = EDGE
LONGEST = 4
LEAST_COUNT = 30
CONTAINED_PERCENT = 80
SCORE_SCALE = 2_000_000

#: Bits of the table of frequent fingerprints, 16 MB; it goes to all tasks whatever the data.
TABLE_BITS = 1 << 27
#: Distinct fingerprints a task sums up before it passes them on.
FINGERPRINTS_AT_ONCE = 1 << 20
#: Bytes of text to a range of fingerprints; of one size, two bytes give one fingerprint at most.
RANGE_BYTES = 8 << 20

PRIME = (1 << 61) - 1
_BASE = 0x1A2B3C4D5E6F7081 % PRIME
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_30, _31, _61, _1 = np.uint64(30), np.uint64(31), np.uint64(61), np.uint64(1)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**64, modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.minimum(x, x - _P)  # where x is smaller, the difference wraps round to a great number


def product(a, b) -> np.ndarray:
    """Products of numbers below the prime, modulo the prime 2**61 - 1, in halves of 31 bits."""
    a, b = np.asarray(a, dtype=np.uint64), np.asarray(b, dtype=np.uint64)
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << _1) + (middle >> _30) + ((middle & _LOW30) << _31) + a0 * b0)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers, step = np.ones(1, dtype=np.uint64), base
    while len(powers) < size:
        powers = np.concatenate((powers, product(powers, step)))
        step = step * step % PRIME
    return powers


def prefix_polynomials(values: np.ndarray) -> np.ndarray:
    """Before every place, and at the end, the sum of value times base to the power of its place."""
    size = 1 << max(10, len(values).bit_length())
    terms = product(values, _powers(_BASE, size)[: len(values)])
    high, low = np.cumsum(terms >> _31), np.cumsum(terms & _LOW31)
    sums = _reduced(product(_reduced(high), np.uint64(1 << 31)) + _reduced(low))
    return np.concatenate((np.zeros(1, dtype=np.uint64), sums))


def fingerprints(polynomials: np.ndarray, n: int, salt: np.ndarray) -> np.ndarray:
    """The fingerprint of the ``n`` values from every place on; ``salt`` of a place is added."""
    count = max(0, len(polynomials) - n)
    spans = _reduced(polynomials[n:] + (_P - polynomials[:count]))
    inverse = _powers(pow(_BASE, -1, PRIME), 1 << max(10, (len(polynomials) - 1).bit_length()))
    return _reduced(product(spans, inverse[:count]) + salt[:count])


def values_of(words: pa.Array) -> np.ndarray:
    """A number below the prime for each word: its bytes by eights, mixed with their place and added up.
    Words that share a number only cost work: phrases are told apart by their text later."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    starts, lengths = edges[:-1], np.diff(edges)
    data = np.frombuffer(bytes(data) + bytes(8), np.uint8)
    eights = (lengths + 7) // 8
    first = np.cumsum(eights) - eights
    place = np.arange(int(eights.sum())) - np.repeat(first, eights)
    at = np.repeat(starts, eights) + 8 * place
    read = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[at]
    # Of the last eight of a word, the bytes that are its own.
    spare = np.zeros(len(at), np.uint64)
    spare[first + eights - 1] = 8 * (8 * eights - lengths)
    read = (read << spare) ^ mixed(place.astype(np.uint64), 31)
    return _reduced(mixed(np.add.reduceat(mixed(read, 32), first) + lengths.astype(np.uint64), 33))


class Grams:
    """The n-grams of some texts: fingerprints by their first word, and where they lie in a piece."""

    def __init__(self, texts: list[bytes], langs: pa.Array) -> None:
        self.words: Words = split_words(texts, KINDS)
        self.polynomials = prefix_polynomials(values_of(self.words.values))
        langs = langs.dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang_of = langs.indices.to_numpy()[self.words.text_of]
        names = pa.array([b"language " + x.encode() for x in self.langs], pa.binary())
        salts = values_of(names)
        self.salt = salts[self.lang_of] if len(self.lang_of) else np.zeros(0, np.uint64)

    @cached_property
    def codes(self) -> np.ndarray:
        """A number for each word, the same for equal words."""
        return self.words.values.dictionary_encode().indices.to_numpy()

    def at(self, n: int) -> np.ndarray:
        """First words of the n-grams."""
        piece = self.words.piece_of
        return np.flatnonzero(piece[n - 1 :] == piece[: max(0, len(piece) - n + 1)])

    def prints(self, n: int) -> np.ndarray:
        """Fingerprints from every word on, across pieces too."""
        return fingerprints(self.polynomials, n, self.salt).astype(np.int64)

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        """The words of some n-grams as text, with spaces between."""
        parts = [self.words.values.take(pa.array(first + k)).cast(pa.string()) for k in range(n)]
        return pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]


def may_hold(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which fingerprints have their bit set."""
    bit = prints & (len(table) * 64 - 1)
    return (table[bit >> 6] >> (bit & 63).astype(np.uint64)) & _1 == 1


def in_frequent_pairs(grams: Grams, n: int, table: np.ndarray) -> np.ndarray:
    """First words of the n-grams of which every pair of words may be frequent."""
    pair = np.zeros(len(grams.words) + n, dtype=bool)
    held = may_hold(table, grams.prints(2))
    pair[: len(held)] = held
    first = grams.at(n)
    for k in range(n - 1):
        first = first[pair[first + k]]
    return first


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for batch in batches:
        for part in slices(batch, "_text"):
            yield Grams([t.encode() for t in part.column("_text").to_pylist()], part.column("_lang"))


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and the sum of the counts of each."""
    order = np.argsort(values, kind="stable")  # runs in order are merged
    values = values[order]
    first = _firsts(values)
    return values[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _firsts(values: np.ndarray) -> np.ndarray:
    """Places where sorted values differ from the one before."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))


def _range_of(prints: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges below the prime a fingerprint lies in."""
    return ((prints >> 30) * ranges >> 31).astype(np.int32)


def _counted(rows: DataFrame, sizes: tuple[int, ...], ranges: int, table=None) -> DataFrame:
    """``_print`` and ``_count`` of frequent n-grams of some sizes, by fingerprint, with ``_size``.
    With a table, only n-grams are looked at whose pairs of words it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: ([], []) for n in sizes}

        def passed_on(n):
            values, counts = (np.concatenate(x) for x in held[n])
            held[n] = ([], [])
            values, counts = _summed(values, counts)
            for k in range(0, len(values), 1 << 16):
                part, count = values[k : k + (1 << 16)], counts[k : k + (1 << 16)]
                of = _range_of(part, ranges)
                first = _firsts(of)
                ends = pa.array(np.append(first, len(of)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(of[first]),
                        pa.array(np.full(len(first), n, dtype=np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(part)),
                        pa.ListArray.from_arrays(ends, pa.array(count)),
                    ],
                    names=["_range", "_size", "_prints", "_counts"],
                )

        for grams in _batches(batches):
            for n in sizes:
                first = grams.at(n) if table is None else in_frequent_pairs(grams, n, table.value)
                prints = np.sort(grams.prints(n)[first])
                at = _firsts(prints)
                held[n][0].append(prints[at])
                held[n][1].append(np.diff(at, append=len(prints)))
                if sum(map(len, held[n][0])) >= FINGERPRINTS_AT_ONCE:
                    yield from passed_on(n)
        for n in sizes:
            if held[n][0]:
                yield from passed_on(n)

    def merged(key: tuple, runs: pa.Table) -> pa.Table:
        values, counts = (
            np.concatenate([c.flatten().to_numpy() for c in runs.column(x).chunks]) for x in ("_prints", "_counts")
        )
        values, counts = _summed(values, counts)
        often = counts >= LEAST_COUNT
        size = np.full(int(often.sum()), key[1].as_py(), dtype=np.int32)
        return pa.table({"_print": values[often], "_size": size, "_count": counts[often]})

    runs = rows.mapInArrow(run, "_range int, _size int, _prints array<bigint>, _counts array<bigint>")
    return runs.groupBy("_range", "_size").applyInArrow(merged, "_print bigint, _size int, _count bigint")


def bit_table(prints: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """A table with one bit set for each ``_print``. Its size is fixed, so is what reaches the
    driver: at most ``bits`` / 64 numbers, however many fingerprints there are."""
    bit = F.col("_print").bitwiseAND(F.lit(bits - 1))
    words = (
        prints.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(_print & 63 AS int))").alias("word"))
        .groupBy("at")
        .agg(F.bit_or("word").alias("word"))
        .toArrow()
    )
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[words.column("at").to_numpy()] = words.column("word").to_numpy().astype(np.int64).view(np.uint64)
    return table


def _verified(rows: DataFrame, tables: dict) -> DataFrame:
    """``lang``, ``phrase``, ``size`` and ``a`` of frequent phrases, counted by their text, and the
    number of all words of a language as a phrase of size 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _batches(batches):
            langs = pa.array(grams.langs, pa.string())
            if len(grams.langs):
                total = np.bincount(grams.lang_of, minlength=len(grams.langs))
                yield _phrase_rows(langs, pa.array([""] * len(grams.langs), pa.string()), 0, total)
            for n in range(1, LONGEST + 1):
                first = grams.at(n) if n < 3 else in_frequent_pairs(grams, n, tables[2].value)
                first = first[may_hold(tables[n].value, grams.prints(n)[first])]
                # Occurrences alike in language and all words, whatever their fingerprints.
                keys = [grams.lang_of[first], *(grams.codes[first + k] for k in range(n))]
                pointer, count = _grouped(keys, first)
                of = langs.take(pa.array(grams.lang_of[pointer]))
                for k in range(0, len(pointer), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield _phrase_rows(of[part], grams.phrases(pointer[part], n), n, count[part])

    counted = rows.mapInArrow(run, "lang string, phrase string, size int, a bigint")
    return (
        counted.groupBy("lang", "phrase", "size")
        .agg(F.sum("a").alias("a"))
        .where((F.col("a") >= LEAST_COUNT) | (F.col("size") == 0))
    )


def _grouped(keys: list[np.ndarray], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct row of the keys, and how many rows are alike."""
    ids = np.zeros(len(places), dtype=np.int64)
    for key in keys:
        # Numbers of distinct rows so far are below the rows' count, so this cannot overflow.
        ids = np.unique(ids * (int(key.max(initial=0)) + 1) + key, return_inverse=True)[1]
    _, one, count = np.unique(ids, return_index=True, return_counts=True)
    return places[one], count


def _phrase_rows(langs: pa.Array, phrases: pa.Array, size: int, counts: np.ndarray) -> pa.RecordBatch:
    sizes = pa.array(np.full(len(counts), size, dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [langs, phrases, sizes, pa.array(counts.astype(np.int64))], names=["lang", "phrase", "size", "a"]
    )


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``phrase``, ``size`` (words) and ``a`` (occurrences) of all phrases of up to four
    words that are frequent, and of size 0 the number of all words of each language."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("_lang"), text_of(text_col).alias("_text"))
    send = rows.sparkSession.sparkContext.broadcast
    n_bytes = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    ranges = n_bytes // RANGE_BYTES + 1
    with Scratch() as steps:
        short = steps.stored(_counted(rows, (1, 2), ranges), "short-prints")
        tables = {n: send(bit_table(short.where(F.col("_size") == n))) for n in (1, 2)}
        long = steps.stored(_counted(rows, (3, 4), ranges, tables[2]), "long-prints")
        tables |= {n: send(bit_table(long.where(F.col("_size") == n))) for n in (3, 4)}
        counts = stored(_verified(rows, tables), "phrase-counts")
    for table in tables.values():
        table.unpersist()
    return counts


def _part(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 2_000
) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences),
    ``l`` and ``r`` (those of the two parts at its lowest-scoring cut), ``n`` (all words) and
    ``score``. A phrase inside a longer one that stands for most of its occurrences is left out.
    """
    counts = phrase_counts(docs, text_col, lang_col)
    phrases = counts.where("size > 0").drop("size")
    longer = counts.where("size > 1").withColumn("_words", F.split("phrase", " "))

    spots = F.expr(
        """flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1),
               s -> array_join(slice(_words, s, k), ' '))))"""
    )
    inner = (
        longer.where("size > 2")
        .select("lang", F.explode(F.array_distinct(spots)).alias("phrase"), F.col("a").alias("_above"))
        .groupBy("lang", "phrase")
        .agg(F.max("_above").alias("_above"))
    )
    cuts = longer.select(
        "lang", "phrase", "a", "size", "_words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("_k")
    ).select(
        "lang", "phrase", "a", "_k",
        _part(F.col("_words"), F.lit(1), F.col("_k")).alias("_first"),
        _part(F.col("_words"), F.col("_k") + 1, F.col("size") - F.col("_k")).alias("_rest"),
    )
    first = phrases.select("lang", F.col("phrase").alias("_first"), F.col("a").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("_rest"), F.col("a").alias("r"))
    # Exact: products have up to 85 bits, within the 38 digits of a decimal, and div takes whole parts.
    score = F.expr(f"cast({SCORE_SCALE} AS decimal(7,0)) * cast(a AS decimal(19,0)) div (cast(l AS decimal(19,0)) + r)")
    scored = cuts.join(first, ["lang", "_first"]).join(rest, ["lang", "_rest"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "_k", "l", "r")).alias("_cut"))
    covered = F.expr(f"100 * cast(_above AS decimal(19,0)) >= {CONTAINED_PERCENT} * cast(a AS decimal(19,0))")
    kept = lowest.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))

    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        kept.select("lang", "phrase", "a", F.col("_cut")["l"].alias("l"), F.col("_cut")["r"].alias("r"), F.col("_cut")["score"].alias("score"))
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= top)
    )
    totals = counts.where("size = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
