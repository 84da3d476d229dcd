"""Operator 5: repeated passages by sparse suffix arrays.

Of every text only the suffixes at content-selected places are kept: the word that starts the least
of a window's k-word hashes (a minimiser). Equal passages select the same places, so a passage of at
least ``passage`` words has one of them in its first ``window`` words. What stands right and left of
the places is sorted, and of each place the greatest match with any earlier place is taken on either
side.

A suffix is carried as hashes: one of its first words, as many as a match needs at least, then one
for each further word. A second row has the same head and one hash for each word to its left, nearest
first. In their order equal beginnings lie side by side. Both sides reach far enough to meet the next
selected place, so that the matches of one passage overlap and their union is the passage.

In that order matches get shorter with distance, so the longest one with an earlier place (by id, then
position) is that with the nearest earlier place before or after a row; a stack finds both in one pass.
Rows equal to the one before them are done at once. One place of every passage stays.

Sorting is by ranges over many tasks; a passage that a third of all rows hold is spread over ranges
too, since id and position take part in the order. What lies beyond a range's border matters only to
rows with no earlier place between them and the border, and these alone are what rows beyond it look
for: they go into a next round, with fewer ranges. Ranges get longer where rows do not get fewer.

Defined results: null and empty texts, and those with fewer words than a match needs, have no
repeats. Rows alike in id and text are one document and come back alike. Columns other than id and
text are ignored. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apptlake.llm.common import Scratch, id_of, keyed, kind_of, slices, stored
from apptlake.llm.shingles import mixed, word_hashes


@dataclass(frozen=True)
class Sparse:
    """Words of a passage that is sure to be found, of a window, and of the hash that selects."""

    passage: int = 50
    window: int = 16
    kgram: int = 8
    #: Rows to a range when suffixes are sorted.
    range_rows: int = 50_000

    @property
    def head(self) -> int:
        """Words that a match has to the right of its place at least."""
        return self.passage - self.window + 1

    @property
    def tail(self) -> int:
        """Further words carried to the right: past the last selected place of any passage."""
        return self.window


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the (rightmost) least value of each window, from windows half as long."""
    places, reach = np.arange(len(values)), 1
    while reach < width and len(places):
        step = min(reach, width - reach)
        left, right = places[: max(0, len(places) - step)], places[step:]
        places = np.where(values[right] <= values[left], right, left)
        reach += step
    return places


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the (rightmost) least value of every window."""
    return np.unique(_least(values, width))


def _polynomial(words: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of every run of so many words."""
    total = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64), salt) | np.uint64(1)
    for k in range(width):
        total += words[k : k + len(total)] * factors[k]
    return mixed(total, salt)


def selected(words: np.ndarray, how: Sparse) -> tuple[np.ndarray, np.ndarray]:
    """Selected places of a text that have a whole head to their right, and the heads' hashes."""
    return selected_of_all(words, np.array([len(words)]), how)


def selected_of_all(words: np.ndarray, counts: np.ndarray, how: Sparse) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts in a row, which have so many words each; places are counted from the first text's
    beginning. A window or head that reaches into the next text is none."""
    ends = np.repeat(np.cumsum(counts), counts)
    least = _least(_polynomial(words, how.kgram, 21), how.window)
    whole = np.arange(len(least)) + (how.window + how.kgram - 1) <= ends[: len(least)]
    places = np.unique(least[whole])
    places = places[places + how.head <= ends[places]]
    return places, _polynomial(words, how.head, 22)[places]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and how many words each text has."""
    hashes, counts = word_hashes([t.encode() for t in texts])
    return hashes[0], counts


def _heads(rows: DataFrame, how: Sparse) -> DataFrame:
    """``_key``, position and head hash of every selected suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                words, counts = _words(part.column("_text").to_pylist())
                places, heads = selected_of_all(words, counts, how)
                of = np.repeat(np.arange(len(counts)), counts)[places]
                places = places - (np.cumsum(counts) - counts)[of]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_key").take(pa.array(of, pa.int64())),
                        pa.array(places.astype(np.int32)),
                        pa.array(heads.view(np.int64)),
                    ],
                    names=["_key", "_at", "_head"],
                )

    return rows.select("_key", "_text").mapInArrow(
        run, f"_key {kind_of(rows)}, _at int, _head bigint"
    )


#: Bytes before the words of a ``_side``.
_FRONT = 9


def _sides(
    words: np.ndarray, heads: np.ndarray, counts: np.ndarray, of: np.ndarray, at: np.ndarray, how: Sparse
) -> pa.Array:
    """The right and the left ``_side`` of each place ``at`` in text ``of``, one after the other."""
    ends = np.cumsum(counts)
    place = (ends - counts)[of] + at
    right, left = place + how.head, place - 1
    widest = max(how.tail, how.window)
    rows = np.zeros((len(at), 2, _FRONT + 4 * widest), dtype=np.uint8)
    rows[:, 1, 0] = 1
    # Big-endian bytes, so that the order of bytes is an order of suffixes.
    rows[:, :, 1:_FRONT] = heads[place].astype(">u8").view(np.uint8).reshape(-1, 1, 8)
    for side, (first, step, reach) in enumerate(((right, 1, how.tail), (left, -1, how.window))):
        near = first[:, None] + step * np.arange(reach)
        near = words[np.clip(near, 0, max(0, len(words) - 1))] >> np.uint64(32)
        rows[:, side, _FRONT : _FRONT + 4 * reach] = near.astype(">u4").view(np.uint8)
    n = np.stack((np.minimum(how.tail, ends[of] - right), np.minimum(how.window, at)), axis=1)
    held = np.arange(_FRONT + 4 * widest) < _FRONT + 4 * n[:, :, None]
    offsets = np.concatenate(([0], np.cumsum(_FRONT + 4 * n.ravel()))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), 2 * len(at), [None, pa.py_buffer(offsets), pa.py_buffer(rows[held])])


def _suffixes(rows: DataFrame, how: Sparse) -> DataFrame:
    """``_key``, ``_at`` and ``_side`` of the suffixes listed in ``_places``, two rows for each: a byte
    (0 for right, 1 for left), the hash of the head, and the words on that side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                words, counts = _words(part.column("_text").to_pylist())
                heads = _polynomial(words, how.head, 22)
                listed = part.column("_places")
                of = np.repeat(np.arange(len(counts)), listed.value_lengths().to_numpy())
                at = listed.flatten().to_numpy()
                # So many at a time, since of one long text there may be a great many.
                for k in range(0, len(at), 1 << 16):
                    some, there = of[k : k + (1 << 16)], at[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("_key").take(pa.array(np.repeat(some, 2), pa.int64())),
                            pa.array(np.repeat(there, 2), pa.int32()),
                            _sides(words, heads, counts, some, there, how),
                        ],
                        names=["_key", "_at", "_side"],
                    )

    return rows.select("_key", "_text", "_places").mapInArrow(
        run, f"_key {kind_of(rows)}, _at int, _side binary"
    )



def _common(a: bytes, b: bytes) -> int:
    """Words of four bytes that two sides have in common, -1 where their heads differ."""
    if a[:_FRONT] != b[:_FRONT]:
        return -1
    n = min(len(a), len(b))
    differs = int.from_bytes(a[_FRONT:n]) ^ int.from_bytes(b[_FRONT:n])
    return (n - _FRONT - (differs.bit_length() + 7) // 8) // 4


def _matches(ordered: DataFrame) -> DataFrame:
    """Of each sorted row the longest match with an earlier place in its range.

    Returns ``_match`` (words beyond the head, -1 if there is none) and ``_left``, and the ``_side`` of
    the rows that go into the next round, of which nothing earlier lies between them and a border.
    """
    key_kind = kind_of(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows that wait for an earlier one: key, place, side, order, match, words in common with the
        # one below (the lowest: with the first row of the range), whether it stays.
        stack: list[list] = []
        before: bytes | None = None
        last: tuple | None = None
        schema = None

        def emit(rows: list[list]) -> pa.RecordBatch:
            rows = [r for r in rows if r[4] >= 0 or r[6]]
            arrays = [
                pa.array([r[0] for r in rows], schema.field("_key").type),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] if r[6] else None for r in rows], pa.binary()),
                pa.array([r[4] for r in rows], pa.int32()),
                pa.array([r[2][0] == 1 for r in rows], pa.bool_()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["_key", "_at", "_side", "_match", "_left"])

        for batch in batches:
            schema, done = batch.schema, []
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for key, at, side in zip(*columns, strict=True):
                order = _order((key, at))
                if side == before:
                    if order != last:  # else the same row of a repeated document
                        done.append([key, at, side, order, (len(side) - _FRONT) // 4, 0, False])
                        last = order
                    continue
                common = _common(before, side) if before is not None else len(side)
                before, last = side, order
                if common < 0:
                    done += stack
                    stack.clear()
                while stack and stack[-1][3] > order:
                    late = stack.pop()
                    late[4] = max(late[4], common)
                    common = min(common, late[5])
                    done.append(late)
                stays = not stack and common >= 0
                stack.append([key, at, side, order, common if stack else -1, common, stays])
            if done:
                yield emit(done)
        if stack:
            for row in stack:
                row[6] = True
            yield emit(stack)

    return ordered.mapInArrow(
        run, f"_key {key_kind}, _at int, _side binary, _match int, _left boolean"
    )


def _order(row: tuple) -> tuple:
    key = row[0]
    if isinstance(key, dict):  # an id and a hash; rows without an id come first
        return (key["doc_id"] is not None, key["doc_id"] or 0, key["_hash"], row[1])
    return (True, key, 0, row[1])


def repeated_passages(
    docs: DataFrame, how: Sparse = Sparse(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages that stand at an earlier place as well, in this or another document.

    Returns a row for each document that has some: ``doc_id``, ``spans`` (starts and ends in words)
    and ``n_words``, the words in them. Every passage of ``how.passage`` words or more is found.
    """
    with Scratch() as steps:
        return stored(_passages(docs, how, id_col, text_col, steps), "passages")


def _passages(docs: DataFrame, how: Sparse, id_col: str, text_col: str, steps: Scratch) -> DataFrame:
    stored = steps.stored
    rows = keyed(docs, id_col, text_col)
    # Heads that occur once match nothing; counted with partial sums before the shuffle.
    heads = _heads(rows, how)
    twice = heads.groupBy("_head").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_head")
    # Stored, so that the join has an exchange on either side and may split a hot head.
    twice = stored(twice, "repeated-heads")
    places = heads.join(twice, "_head").groupBy("_key").agg(
        F.array_distinct(F.collect_list("_at")).alias("_places")
    )
    places = stored(places, "places")
    n = places.agg(F.sum(F.size("_places"))).first()[0] or 0
    rest = _suffixes(rows.join(places, "_key"), how)
    n *= 2
    found: list[DataFrame] = []
    order, length = ["_side", "_key", "_at"], how.range_rows
    while n > 1:
        ranges = -(-n // length)
        ordered = rest.repartitionByRange(ranges, *order) if ranges > 1 else rest.repartition(1)
        seen = stored(_matches(ordered.sortWithinPartitions(*order)), "matches")
        found.append(seen.where("_match >= 0").select("_key", "_at", "_match", "_left"))
        if ranges == 1:
            break
        rest = seen.where("_side IS NOT NULL").select("_key", "_at", "_side")
        many, n = n, rest.count()
        if 4 * n > 3 * many:
            length *= 2
    spans = found[0] if found else rest.selectExpr("_key", "_at", "0 AS _match", "true AS _left").limit(0)
    for more in found[1:]:
        spans = spans.unionByName(more)
    # Overlapping matches of a document become one span.
    reach = F.when(F.col("_left"), 0).otherwise(F.col("_match"))
    found = spans.select(
        "_key",
        (F.col("_at") - F.col("_match") + reach).alias("start"),
        (F.col("_at") + F.lit(how.head) + reach).alias("end"),
    )
    in_order = Window.partitionBy("_key").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        found.distinct()
        .withColumn("_new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
        .withColumn("_span", F.sum("_new").over(in_order))
        .groupBy("_key", "_span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    spans = spans.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.sum(F.col("end") - F.col("start")).alias("n_words"),
    )
    return spans.select(id_of(spans).alias("doc_id"), "spans", "n_words")
