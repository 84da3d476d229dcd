"""Operator 11: benchmark decontamination by suffix arrays of the training text.

Documents are cut into shards, a few megabytes of texts each. A shard's words become numbers of the
benchmark's vocabulary (words compare as bytes, not by hashes), its suffixes are sorted by prefix
doubling, and every suffix of every benchmark item is searched in that array, one word deeper at a
time, by bisection of the range left so far. Where a range is left after as many words as a window
has, all its places hold the window; where one is left longest, its places hold the longest
verbatim match. Stretches in which no ten words in a row stand in pairs as in the benchmark cannot
hold a window, and are not sorted.

The benchmark is taken in blocks of ``block_bytes``: a block is sent to all tasks, and documents are
read once for each block. One block, the usual case, needs no shuffle.

Defined results: null and empty texts, and items without words, meet nothing; an item of fewer words
than a window is one window; rows of the benchmark with one ``item_id`` are one item, and those
without an id are the item "" (as are items of that name). Every row of documents gets a row, with
or without an id, repeated or not. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.byte_words import GAP, split_words
from apptlake.llm.common import slices, stored, text_of

WINDOW = 10
BLOCK_BYTES = 8 << 20

# Fixed value: bytes of words are digits, letters and all of multi-byte characters.
KINDS = np.full(256, GAP, dtype=np.uint8)
KINDS[0x30:0x3A] = KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = KINDS[0x80:] = 0

FOUND = """n_words bigint, spans array<struct<start:int,end:int>>, items array<string>,
    longest int, longest_at int, longest_item string, longest_item_at int"""


@dataclass(frozen=True)
class Block:
    """Benchmark items as one row of word numbers, 0 after each item."""

    names: list[str]
    vocabulary: pa.Array
    numbers: np.ndarray
    item_of: np.ndarray
    need: np.ndarray
    pairs: np.ndarray
    shortest: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        """Every suffix: the place of its first word."""
        return np.flatnonzero(self.numbers)


def block_of(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Block:
    """Number the words of some items, and note what a window needs: ``need`` words from a suffix's
    start (0 where a suffix has no window), adjacent ``pairs``, and for each word the length of the
    ``shortest`` item it begins that is below a window."""
    names = [name or "" for name, _ in rows]
    words = split_words([(text or "").encode() for _, text in rows], KINDS)
    coded = words.values.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64) + 1
    counts = np.bincount(words.text_of, minlength=len(rows))
    numbers = np.zeros(len(codes) + len(rows) + 1, dtype=np.int64)
    places = np.arange(len(codes)) + words.text_of
    numbers[places] = codes
    item_of = np.zeros(len(numbers), dtype=np.int64)
    item_of[places] = words.text_of
    ends = np.cumsum(counts) + np.arange(len(rows))
    need = np.zeros(len(numbers), dtype=np.int64)
    need[places] = np.where(ends[words.text_of] - places >= window, window, 0)
    shortest = np.full(len(coded.dictionary) + 1, np.iinfo(np.int64).max)
    short = np.flatnonzero((counts > 0) & (counts < window))
    first = ends[short] - counts[short]
    need[first] = counts[short]
    np.minimum.at(shortest, numbers[first], counts[short])
    inner = (numbers[:-1] > 0) & (numbers[1:] > 0)
    pairs = np.unique(numbers[:-1][inner] << 32 | numbers[1:][inner])
    return Block(names, coded.dictionary, numbers, item_of, need, pairs, shortest)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` other than 0, ordered by at least the next ``depth`` numbers up to a 0."""
    places, rank, step = np.flatnonzero(text), text.astype(np.int64), 1
    while len(places):
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:]
        key = (rank * (int(rank.max()) + 1) + ahead)[places]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([1], 1 + np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.zeros_like(rank)
        rank[places[order]] = new
        step *= 2
        if step >= depth or step >= len(text) or new[-1] == len(places):
            return places[order]
    return places


def bisected(values, low: np.ndarray, high: np.ndarray, sought: np.ndarray, after: bool) -> np.ndarray:
    """In each range [low, high) of ascending ``values(at)`` the first place that is not below (or,
    ``after``, that is above) what is sought there."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        found = values(middle)
        less = found <= sought[open_] if after else found < sought[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    return low


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of every range, and the range it is of."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


class Shard:
    """Suffix array of some texts, as far as they can share a window with a block."""

    def __init__(self, texts: list[bytes], block: Block, window: int = WINDOW) -> None:
        words = split_words(texts, KINDS)
        self.n_words = np.bincount(words.text_of, minlength=len(texts))
        self.first = np.cumsum(self.n_words) - self.n_words
        self.text_of = words.text_of
        codes = pc.fill_null(pc.index_in(words.values, value_set=block.vocabulary), -1)
        numbers = codes.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        linked = np.zeros(len(numbers), dtype=bool)
        if len(numbers) > 1 and len(block.pairs):
            known = (numbers[:-1] > 0) & (numbers[1:] > 0) & (words.text_of[:-1] == words.text_of[1:])
            key = (numbers[:-1] << 32 | numbers[1:])[known]
            at = np.minimum(np.searchsorted(block.pairs, key), len(block.pairs) - 1)
            linked[:-1][known] = block.pairs[at] == key
        begins = np.concatenate(([True], ~linked[:-1])) if len(numbers) else linked
        run_of = np.cumsum(begins) - 1
        lengths = np.bincount(run_of) if len(numbers) else np.zeros(0, dtype=np.int64)
        left = (np.cumsum(lengths) if len(lengths) else lengths)[run_of] - np.arange(len(numbers))
        may = left >= np.minimum(block.shortest[numbers], window)
        may &= numbers > 0
        kept = np.zeros(len(lengths), dtype=bool)
        kept[run_of[may]] = True
        chosen = np.flatnonzero(kept[run_of]) if len(numbers) else run_of
        # Runs in a row, a 0 after each.
        place = np.arange(len(chosen)) + (np.cumsum(begins[chosen]) - 1 if len(chosen) else 0)
        size = int(place[-1]) + 2 if len(place) else 1
        self.numbers = np.zeros(size + 1, dtype=np.int64)
        self.numbers[place] = numbers[chosen]
        self.word_at = np.zeros(size + 1, dtype=np.int64)
        self.word_at[place] = chosen
        longest_item = int(np.bincount(block.item_of[block.numbers > 0]).max(initial=0))
        depth = min(int(lengths[kept].max(initial=0)), longest_item)
        self.suffixes = suffix_array(self.numbers, depth)

    def search(self, block: Block) -> tuple[list, np.ndarray, np.ndarray]:
        """Search every suffix of the block. Returns, for every depth at which windows end, the
        suffixes with their ranges, and for every place of the array its longest match (0 if below
        a window) with the suffix that has it."""
        suffix = block.starts
        low = np.zeros(len(suffix), dtype=np.int64)
        high = np.full(len(suffix), len(self.suffixes))
        best = np.zeros(len(self.suffixes), dtype=np.int64)
        witness = np.zeros(len(self.suffixes), dtype=np.int64)
        windows, depth = [], 0
        while len(suffix):
            sought = block.numbers[suffix + depth]
            going = (sought > 0) & (low < high)
            suffix, low, high, sought = suffix[going], low[going], high[going], sought[going]

            def word(at, depth=depth):
                return self.numbers[self.suffixes[at] + depth]

            low, high = bisected(word, low, high, sought, False), bisected(word, low, high, sought, True)
            depth += 1
            left = low < high
            suffix, low, high = suffix[left], low[left], high[left]
            need = block.need[suffix]
            if (ends := need == depth).any():
                windows.append((depth, suffix[ends], low[ends], high[ends]))
            if len(matched := np.flatnonzero((need > 0) & (need <= depth))):
                # Equal starts of suffixes have one range; it is told by its lower end.
                _, one = np.unique(low[matched], return_index=True)
                one = matched[one]
                at, of = _expanded(low[one], high[one])
                best[at], witness[at] = depth, suffix[one][of]
        return windows, best, witness


def _spans(shard: Shard, windows: list) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words (of all texts in a row) that windows cover."""
    edge = np.zeros(len(shard.text_of) + 1, dtype=np.int64)
    for depth, _, low, high in windows:
        low, one = np.unique(low, return_index=True)
        at, _ = _expanded(low, high[one])
        word = np.unique(shard.word_at[shard.suffixes[at]])
        np.add.at(edge, word, 1)
        np.add.at(edge, word + depth, -1)
    hit = np.cumsum(edge[:-1]) > 0
    parted = np.concatenate(([True], shard.text_of[1:] != shard.text_of[:-1]))[: len(hit)]
    before = np.concatenate(([False], hit[:-1]))[: len(hit)]
    after = np.concatenate((hit[1:], [False]))[: len(hit)]
    last = np.concatenate((parted[1:], [True]))[: len(hit)]
    return np.flatnonzero(hit & (~before | parted)), np.flatnonzero(hit & (~after | last)) + 1


def _pairs(shard: Shard, block: Block, windows: list, most: int = 1 << 22) -> np.ndarray:
    """Every text with every item of which it holds a window, as ``text * items + item``."""
    found = np.zeros(0, dtype=np.int64)
    for _, suffix, low, high in windows:
        ranges, range_of = np.unique(low, return_inverse=True)
        one = np.unique(range_of, return_index=True)[1]
        at, of = _expanded(ranges, high[one])
        texts = np.unique(of * len(shard.n_words) + shard.text_of[shard.word_at[shard.suffixes[at]]])
        items = np.unique(range_of * len(block.names) + block.item_of[suffix])
        first = np.searchsorted(items, np.arange(len(ranges) + 1) * len(block.names))
        # Each text of a range with each item of the range, some millions at a time.
        text, of = texts % len(shard.n_words), texts // len(shard.n_words)
        sums = np.cumsum(first[of + 1] - first[of])
        start = 0
        while start < len(text):
            base = sums[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sums, base + most, side="right")))
            which, place = _expanded(first[of[start:end]], first[of[start:end] + 1])
            pairs = text[start:end][place] * len(block.names) + items[which] % len(block.names)
            found = np.union1d(found, pairs)
            start = end
    return found


def searched(texts: list[bytes], block: Block, window: int = WINDOW) -> list[pa.Array]:
    """The columns of ``FOUND`` for every text."""
    shard = Shard(texts, block, window)
    windows, best, witness = shard.search(block)
    n = len(texts)

    starts, ends = _spans(shard, windows)
    of = shard.text_of[starts]
    spans = pa.StructArray.from_arrays(
        [pa.array(starts - shard.first[of], pa.int32()), pa.array(ends - shard.first[of], pa.int32())],
        names=["start", "end"],
    )
    offsets = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), spans)

    pairs = _pairs(shard, block, windows)
    text, item = pairs // max(1, len(block.names)), pairs % max(1, len(block.names))
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    names = pa.array(block.names, pa.string()).take(pa.array(item))
    items = pa.ListArray.from_arrays(pa.array(offsets), names)

    # Of a text's longest matches the first, by its words and then by the benchmark's.
    at = np.flatnonzero(best)
    word = shard.word_at[shard.suffixes[at]]
    order = np.lexsort((word, -best[at], shard.text_of[word]))
    at, word = at[order], word[order]
    found, one = np.unique(shard.text_of[word], return_index=True)
    match = np.full((n, 3), -1)
    match[found] = np.stack((best[at[one]], word[one] - shard.first[found], witness[at[one]]), axis=1)
    none = match[:, 0] < 0
    item_of = block.item_of[np.maximum(match[:, 2], 0)]
    begins = np.searchsorted(block.item_of[block.starts], np.arange(max(1, len(block.names))))
    item_at = match[:, 2] - (block.starts[begins[item_of]] if len(block.starts) else 0)
    which = pa.array(block.names or [""], pa.string()).take(pa.array(item_of))
    return [
        pa.array(shard.n_words, pa.int64()),
        spans,
        items,
        pa.array(match[:, 0], pa.int32(), mask=none),
        pa.array(match[:, 1], pa.int32(), mask=none),
        pc.if_else(pa.array(none), pa.scalar(None, pa.string()), which),
        pa.array(item_at, pa.int32(), mask=none),
    ]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
    """The benchmark's items in blocks of about so many bytes, one at a time."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("_item"), text_of(text_col).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    which = F.pmod(F.xxhash64("_item", "_text"), F.lit(count))
    for k in range(count):
        part = rows.where(which == k) if count > 1 else rows
        yield block_of(sorted((r[0] or "", r[1]) for r in part.collect()), window)


def _found(rows: DataFrame, block: Block, window: int) -> DataFrame:
    """``rows`` without their ``_text``, with the columns of ``FOUND``."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    kept = [c for c in rows.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [t.encode() for t in part.column("_text").to_pylist()]
                found = searched(texts, sent.value, window)
                names = [*kept, "n_words", "spans", "items", "longest", "longest_at", "longest_item", "longest_item_at"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *found], names=names)

    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{ddl}, {FOUND}")


def _merged(parts: list[DataFrame]) -> DataFrame:
    """The rows of several blocks, one for each text that any of them met."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    longest = F.struct("longest", -F.col("longest_at"), "longest_item", "longest_item_at", "longest_at")
    met = both.distinct().groupBy("_key").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.max(longest).alias("_longest"),
    )
    return met.select(
        "_key",
        _joined(F.col("spans")).alias("spans"),
        "items",
        *[F.col("_longest")[c].alias(c) for c in ("longest", "longest_at", "longest_item", "longest_item_at")],
    )


def _joined(spans):
    """Spans in order with those that overlap made one."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    last = lambda done: F.element_at(done, -1)

    def add(done, span):
        widened = F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], span["end"]).alias("end"))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(widened))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, empty, add)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What each document has of the benchmark: ``doc_id``, ``n_words``, ``spans`` (words of the
    document that windows cover, from ``start`` to before ``end``), ``n_hit`` (how many words these
    are), ``items`` (ids of the items with a window in it, sorted), the ``longest`` verbatim match in
    words, where it starts (``longest_at``), in which item and at which word there, ``contaminated``,
    and the columns to ``carry`` along, which must not have one of these names.
    """
    also = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), also.alias("_carried"))
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_bytes)
    block, more = next(blocks), next(blocks, None)
    if more is None:
        found = _found(rows, block, window)
    else:
        # Rows alike in text have the same matches, so those are kept by a digest of the text.
        digest = F.md5(F.col("_text").cast("binary"))
        texts = rows.select(digest.alias("_key"), "_text")
        n_words, parts = None, []
        while block is not None:
            part = _found(texts, block, window)
            if n_words is None:
                n_words = stored(part.select("_key", "n_words").distinct(), "word-counts")
            parts.append(stored(part.where(F.size("items") > 0).drop("n_words"), "benchmark-block"))
            block, more = more, next(blocks, None) if more is not None else None
        keys = rows.select("_id", digest.alias("_key"), "_carried")
        found = keys.join(n_words, "_key").join(_merged(parts), "_key", "left")
    items = F.coalesce(F.array_sort(F.array_distinct("items")), F.array().cast("array<string>"))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        spans.alias("spans"),
        n_hit.alias("n_hit"),
        items.alias("items"),
        F.coalesce("longest", F.lit(0)).alias("longest"),
        "longest_at",
        "longest_item",
        "longest_item_at",
        (n_hit > 0).alias("contaminated"),
        *[F.col("_carried")[c].alias(c) for c in carry],
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    ids, texts = how.get("id_col", "doc_id"), how.get("text_col", "text")
    rows = docs.select(F.struct("*").alias("_row"), ids, texts)
    return contamination(rows, benchmark, carry=["_row"], **how).where("NOT contaminated").select("_row.*")
