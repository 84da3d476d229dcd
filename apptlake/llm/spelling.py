"""Operator 12: spelling variants grouped by dense prefix-suffix tiling.

Words that are near one another differ by one inserted, deleted or replaced code point: the common
prefix and the common suffix together reach the longer length minus one. Words of a tile are laid
out as two padded code-point matrices, one aligned left and one right, and compared by blocks of
pairs, which gives both lengths for many pairs at once.

Which words share a tile: the places of a word of ``l`` code points are cut in three stretches. One
edit leaves all but one stretch as they were, so two near words, the shorter of ``l``, agree in all
that comes before some stretch and all that comes after it. A word is dealt by the hash of these
two parts for every stretch, once with its own length as ``l`` and once as the longer of a pair. A
pair that agrees outside several stretches is taken in the tile of the first.

A tile of more than ``tile_rows`` words is cut into blocks by a hash of the word, and every pair of
blocks becomes a tile of its own, so no task holds more than two blocks.

Defined results: null and empty texts have no runs; a null id counts as an empty one in the hash
that deletes code points; repeated rows count as often as they stand; ties for the form go to the
smallest word in code-point order; words of any length are compared in whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import Scratch, stored, text_of

# The runs of letters, the share of runs that lose a code point, and which words count.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DELETED_SHARE = 31
LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10

STRETCHES = 3
TILE_ROWS = 1_024
#: Cells of a matrix that pairs are compared in, and distinct words a task sums up at a time.
CELLS = 1 << 22
WORDS_AT_ONCE = 1 << 18


def words_in(text: str, doc_id) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts, one code point deleted from some."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.translate(LOWER))).items():
        h = zlib.crc32(run.encode(), head)
        if h % DELETED_SHARE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(counts: Counter) -> pa.RecordBatch:
            names = pa.array(list(counts), pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                for word, n in words_in(text, doc_id):
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= WORDS_AT_ONCE:
                    yield summed(counts)
                    counts = Counter()
        yield summed(counts)

    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    words = rows.mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def tiles(words: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Words with the tiles they are of: ``_band`` (the shorter length of the tile's pairs),
    ``_stretch``, ``_hash`` of what stands outside it, and the blocks ``_one`` <= ``_two`` of a tile
    that was cut, with the word's own ``_block``."""
    length = F.length("word")
    bands = F.explode(F.array(length, length - 1)).alias("_band")
    dealt = words.select("word", "n", bands).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(STRETCHES - 1))).alias("_stretch")
    )
    edge = lambda k: F.floor(F.col("_band") * k / STRETCHES).cast("int")
    before = F.expr("left(word, _before)")
    after = F.expr("right(word, _after)")
    dealt = (
        dealt.withColumn("_before", edge(F.col("_stretch")))
        .withColumn("_after", F.col("_band") - edge(F.col("_stretch") + 1))
        .withColumn("_hash", F.xxhash64("_band", "_stretch", before, after))
        .drop("_before", "_after")
    )
    crowded = (
        dealt.groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_count"))
        .where(F.col("_count") > tile_rows)
        .select("_hash", F.ceil(F.col("_count") * 2 / tile_rows).cast("int").alias("_blocks"))
    )
    blocks = F.coalesce("_blocks", F.lit(1))
    cut = dealt.join(crowded, "_hash", "left").withColumn(
        "_block", F.pmod(F.xxhash64("word", F.lit(1)), blocks).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")
    return cut.select("*", other).select(
        "word", "n", "_band", "_stretch", "_hash", "_block",
        F.least("_block", "_other").alias("_one"), F.greatest("_block", "_other").alias("_two"),
    )


TILE = ("_band", "_stretch", "_hash", "_one", "_two")


def _matrices(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the code points of every word padded with 0: from the left, and from the right
    backwards. All code points of runs are below 256, so Latin-1 gives one byte for each."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    width = int(lengths.max(initial=0)) + 1
    points = np.frombuffer(b"".join(words), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), dtype=np.uint8)
    right = np.zeros((len(words), width), dtype=np.uint8)
    left[row, at] = points
    right[row, np.repeat(lengths, lengths) - 1 - at] = points
    return lengths, left, right


def _block_pairs(sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within groups of rows in a row, at most so many at a time."""
    end = np.repeat(np.cumsum(sizes), sizes)
    row = np.arange(len(end))
    count = end - row - 1
    sums, start = np.cumsum(count), 0
    while start < len(row):
        base = sums[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sums, base + most, side="right")))
        one = np.repeat(row[start:stop], count[start:stop])
        offset = np.arange(len(one)) - np.repeat(sums[start:stop] - count[start:stop] - base, count[start:stop])
        yield one, one + 1 + offset
        start = stop


def near_in_tiles(words: list[bytes], sizes, bands, stretches, blocks, cut) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words, each pair once over all tiles. ``sizes`` are the rows of each tile; the
    others say for each row what its tile is, and ``cut`` whether that has two different blocks."""
    lengths, left, right = _matrices(words)
    width = left.shape[1]
    found_one, found_two = [], []
    for one, two in _block_pairs(np.asarray(sizes), max(1, CELLS // width)):
        band, stretch = bands[one], stretches[one]
        fits = np.minimum(lengths[one], lengths[two]) == band
        fits &= ~cut[one] | (blocks[one] != blocks[two])
        one, two, band, stretch = one[fits], two[fits], band[fits], stretch[fits]
        # Both have a 0 behind them, so words that differ do so within the width.
        prefix = np.argmin(left[one] == left[two], axis=1)
        suffix = np.argmin(right[one] == right[two], axis=1)
        near = prefix + suffix >= np.maximum(lengths[one], lengths[two]) - 1
        before, end = band * stretch // STRETCHES, band * (stretch + 1) // STRETCHES
        near &= (prefix >= before) & (suffix >= band - end)
        near &= (stretch == 0) | (suffix < band - before)
        found_one.append(one[near])
        found_two.append(two[near])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(found_one or none), np.concatenate(found_two or none)


def near_pairs(words: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every word with every near one: ``word``, ``near``, ``near_n``; each pair both ways, once."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(c).to_numpy() for c in TILE]
        changes = np.zeros(len(table), dtype=bool)
        changes[0] = True
        for key in keys:
            changes[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(changes)
        names = table.column("word").combine_chunks()
        raw = [w.encode("latin-1") for w in names.to_pylist()]
        one, two = near_in_tiles(
            raw, np.diff([*starts, len(table)]), keys[0].astype(np.int64), keys[1].astype(np.int64),
            table.column("_block").to_numpy(), keys[3] != keys[4],
        )
        n = table.column("n").combine_chunks()
        near, this = pa.array(np.concatenate((two, one))), pa.array(np.concatenate((one, two)))
        return pa.RecordBatch.from_arrays([names.take(this), names.take(near), n.take(near)], names=["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            # The last tile may go on in the next batch; all before it is whole.
            last = np.ones(len(table), dtype=bool)
            for c in TILE:
                values = table.column(c).to_numpy()
                last &= values == values[-1]
            start = int(np.argmax(last)) if len(table) else 0
            held = table.slice(start).combine_chunks().to_batches() if start else held
            for part in _pieces(table.slice(0, start)):
                yield compared(part)
        for part in _pieces(pa.Table.from_batches(held)) if held else ():
            yield compared(part)

    rows = tiles(words, tile_rows)
    dealt = rows.repartition(*TILE).sortWithinPartitions(*TILE)
    return dealt.mapInArrow(run, "word string, near string, near_n bigint")


def _pieces(table: pa.Table) -> Iterator[pa.Table]:
    """Whole tiles, parted where the longest word's matrix would outgrow a few times ``CELLS``."""
    if not len(table):
        return
    band = table.column("_band").to_numpy().astype(np.int64)
    changes = np.zeros(len(table), dtype=bool)
    for c in TILE:
        values = table.column(c).to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    starts = np.concatenate(([0], np.flatnonzero(changes)))
    ends = np.concatenate((starts[1:], [len(table)]))
    begin, widest = 0, 0
    for k, start in enumerate(starts):
        wider = max(widest, int(band[start]) + 2)
        if start > begin and (ends[k] - begin) * wider > 4 * CELLS:
            yield table.slice(begin, start - begin)
            begin, wider = start, int(band[start]) + 2
        widest = wider
    yield table.slice(begin)


def _roots(forms: DataFrame, most: int, steps: Scratch) -> DataFrame:
    """``word`` and ``root``: the last of the forms that follow on a word. Each form is ``RATIO``
    times as frequent as the word, which bounds how many follow; every round doubles the reach."""
    steps_at_most, reach = 1, 1
    while RATIO**steps_at_most <= most:
        steps_at_most += 1
    roots = steps.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while reach < steps_at_most:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        further = roots.join(ahead, "root", "left")
        roots = steps.stored(further.select("word", F.coalesce("_further", "root").alias("root")), "roots")
        reach *= 2
    return roots


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Every word with the form it is a variant of: ``word``, ``form``, ``root``, ``n``, ``n_near``
    and ``form_n``. The form is the most frequent near word if it is ten times as frequent."""
    with Scratch() as steps:
        words = steps.stored(vocabulary(docs, id_col, text_col), "words")
        best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
        near = near_pairs(words, tile_rows).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
        is_form = -F.col("_best")["n"] >= RATIO * F.col("n")
        joined = steps.stored(
            words.join(near, "word", "left").select(
                "word",
                "n",
                F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(is_form, F.col("_best")["word"]).alias("form"),
                F.when(is_form, -F.col("_best")["n"]).alias("form_n"),
            ),
            "forms",
        )
        most = joined.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
        roots = _roots(joined.where("form IS NOT NULL"), most, steps)
        result = joined.join(roots, "word", "left")
        return stored(
            result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants"
        )
