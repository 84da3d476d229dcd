"""Operator 4: substring dedup by content-defined chunks.

A gear hash rolls over the bytes of every text; where some of its bits are zero, a chunk ends.
Ends depend on the bytes before them alone, so an insertion moves only the chunks it touches.
Chunks are deduplicated by a 128-bit digest: of equal chunks the first stays (by id, then place),
and a run of later copies in a row is cut out if it is long enough. Shorter repeats, such as
common phrases and single short lines, are left alone.

Ends lie after white space, so cuts fall between words. Where no white space stood for a while, as
in Chinese, Japanese or Thai, ends lie between characters, about as many bytes apart. A chunk never
exceeds a maximum; an end forced by that is the place of the least hash, so that it does not move
with what stands before.

Defined results: null texts are empty, and empty texts have no chunks and stay as they are. Rows
alike in id and text are one document, and come back alike; rows with one id and different texts
are documents of their own; those without an id come first. Columns other than id and text are
ignored, or carried along as they are.

At scale, chunks are shuffled twice (counted with partial sums, then joined with the repeated
digests, where adaptive execution splits the hot ones) and texts once; what is carried is small
numbers, never text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apptlake.llm.common import fenced, id_of, keyed, kind_of, slices, stored

_GEAR_SEED = 20_011
#: Bytes that bear on a chunk's end.
WINDOW = 32


@dataclass(frozen=True)
class Chunking:
    """Chunk ends: one in 2**word_bits blanks, one in 2**char_bits characters, one in 2**bare_bits of
    those with no blank in the ``WINDOW`` bytes before; sizes in bytes.

    A run is cut out from ``run_chars`` characters on.
    """

    word_bits: int = 2
    char_bits: int = 10
    least: int = 20
    most: int = 4096
    run_chars: int = 100
    bare_bits: int = 4


def gear_table() -> np.ndarray:
    """A random number for each byte; none for zero, which parts texts in the buffer."""
    table = np.random.default_rng(_GEAR_SEED).integers(1, 1 << 32, 256, dtype=np.uint32)
    table[0] = 0
    return table


_GEAR = gear_table()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum over the last 32 of their numbers, shifted by their age.

    Windows are doubled: what two halves give is added, the older one shifted by the half's length.
    """
    total = _GEAR[data]
    for half in (1, 2, 4, 8, 16):
        older = total[:-half] << np.uint32(half)
        total = total.copy()
        total[half:] += older
    return total


def chunk_ends(texts: list[bytes], how: Chunking = Chunking()) -> list[list[int]]:
    """Ends of the chunks of every text, the last one being its length; none for empty ones."""
    gap = bytes(WINDOW)
    data = np.frombuffer(gap.join([*texts, b""]), dtype=np.uint8)
    rolled = rolling_hash(data)
    bits = rolled >> np.uint32(31 - max(how.char_bits, how.bare_bits))
    white = (data == 32) | ((data >= 9) & (data <= 13))
    starts_char = np.concatenate(((data[1:] & 0xC0) != 0x80, [True]))
    ends = white & (bits & np.uint32((1 << how.word_bits) - 1) == 0)
    ends |= starts_char & (bits & np.uint32((1 << how.char_bits) - 1) == 0)
    # The last blank up to every byte; gaps between texts are wide enough to part them.
    blank = np.maximum.accumulate(np.where(white | (data == 0), np.arange(len(data)), -1))
    bare = np.arange(len(data)) - blank >= WINDOW
    ends |= bare & starts_char & (bits & np.uint32((1 << how.bare_bits) - 1) == 0)
    places = np.flatnonzero(ends) + 1

    def forced(base: int, last: int) -> int:
        """The place of the least hash, the last of equal ones, in reach of an end."""
        near = slice(base + last + min(how.least, how.most // 2) - 1, base + last + how.most)
        values = np.where(starts_char[near], rolled[near].astype(np.int64), 1 << 32)[::-1]
        return last + how.most - int(np.argmin(values))

    result, base = [], 0
    for text in texts:
        low, high = np.searchsorted(places, (base + 1, base + len(text)))
        found, last = [], 0
        for end in (places[low:high] - base).tolist():
            while end - last > how.most:
                last = forced(base, last)
                found.append(last)
            if end - last >= how.least:
                found.append(end)
                last = end
        while len(text) - last > how.most:
            last = forced(base, last)
            found.append(last)
        if len(text) > last:
            found.append(len(text))
        result.append(found)
        base += len(text) + WINDOW
    return result


def chunks(rows: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """Every chunk of the rows' ``_text``: ``_key``, ``_start``, ``_end`` (in characters), and its
    digest in two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [t.encode() for t in part.column("_text").to_pylist()]
                digests, begins, closes, counts = [], [], [], []
                for text, own in zip(texts, chunk_ends(texts, how), strict=True):
                    last = 0
                    for end in own:
                        digests.append(xxhash.xxh3_128_digest(text[last:end]))
                        last = end
                    ends = np.array(own, dtype=np.int64)
                    if len(text) and not text.isascii():
                        first = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
                        ends = np.cumsum(first)[ends - 1]
                    begins.append(np.concatenate(([0], ends[:-1])) if len(ends) else ends)
                    closes.append(ends)
                    counts.append(len(ends))
                halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                of = np.repeat(np.arange(len(texts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_key").take(pa.array(of, pa.int64())),
                        pa.array(np.concatenate(begins), pa.int32()),
                        pa.array(np.concatenate(closes), pa.int32()),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                    ],
                    names=["_key", "_start", "_end", "_high", "_low"],
                )

    return rows.select("_key", "_text").mapInArrow(
        run, f"_key {kind_of(rows)}, _start int, _end int, _high bigint, _low bigint"
    )


def repeated_spans(pieces: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """``_key`` and ``_spans``: runs of chunks in a row of which each has an earlier copy."""
    firsts = (
        pieces.groupBy("_high", "_low")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(F.struct("_key", "_start")).alias("_first"))
        .where("_copies > 1")
        .select("_high", "_low", "_first")
    )
    # Stored, so that the join has an exchange on either side and may split a hot digest.
    firsts = stored(firsts, "repeated-digests")
    later = (
        pieces.join(firsts, ["_high", "_low"])
        .where(~F.struct("_key", "_start").eqNullSafe(F.col("_first")))
        .select("_key", "_start", "_end")
    )
    # In order, a run breaks where a chunk does not start at the end of the one before.
    in_order = Window.partitionBy("_key").orderBy("_start", "_end")
    breaks = F.coalesce((F.lag("_end").over(in_order) != F.col("_start")).cast("int"), F.lit(1))
    runs = (
        later.distinct()
        .withColumn("_break", breaks)
        .withColumn("_run", F.sum("_break").over(in_order))
        .groupBy("_key", "_run")
        .agg(F.min("_start").alias("start"), F.max("_end").alias("end"))
        .where(F.col("end") - F.col("start") >= how.run_chars)
    )
    return runs.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    how: Chunking = Chunking(),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cut later copies out of all texts.

    Returns ``doc_id``, ``text`` (what is left), ``spans`` (what was cut, in characters of the
    text as it was), ``n_removed`` (characters) and the columns to ``carry`` along, which must not
    have one of these names. A text of which nothing is cut comes back unchanged.
    """
    rows = keyed(docs, id_col, text_col, carry)
    spans = repeated_spans(chunks(rows, how), how)
    rows = rows.join(spans, "_key", "left")
    # What is left lies between the end of one span and the start of the next.
    edges = F.concat(
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), F.col("_spans")
    )
    rows = rows.withColumn("_edges", edges)
    left = F.transform(
        "_edges",
        lambda x, i: F.substring(
            "_text",
            x["end"] + 1,
            F.coalesce(F.get("_edges", i + 1)["start"], F.length("_text")) - x["end"],
        ),
    )
    removed = F.aggregate("_spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return fenced(
        rows.select(
            id_of(rows).alias("doc_id"),
            F.when(F.col("_spans").isNull(), F.col("_text"))
            .otherwise(F.array_join(left, ""))
            .alias("text"),
            F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            F.coalesce(removed, F.lit(0)).alias("n_removed"),
            *[F.col("_carried")[c].alias(c) for c in carry],
        )
    )
