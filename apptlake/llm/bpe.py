"""Operator 6: byte-pair encoding by an index of pair occurrences, and decoding.

Each task gathers the distinct words of its texts, maps every adjacent pair of symbols to all its
positions in them, and applies the active ranks in ascending order: all occurrences of a pair are
merged at once, and only the lists of the pairs beside them change. Ids are those of the public
tokenizer whose file is read (lower case, white space dropped, word ends marked).

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows are
encoded each; texts of any length are encoded whole; columns other than id and text are ignored.
Texts stay in the tasks that read them; the merge table, as large as the vocabulary file, is all
that is broadcast.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.llm.common import slices, text_of

#: White space of the tokenizer's pattern: Unicode's property, which Python's \s exceeds.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The tokenizer's word pattern (fixed value).
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+")

#: Distinct words a task remembers with their ids before it starts afresh; results don't depend on it.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b], extra = chr(extra), extra + 1
    return [symbols[b] for b in range(256)]


class MergeTable:
    """Merges of a vocabulary file as sorted arrays, and its tokens by id."""

    def __init__(self, file_text: str):
        self.file_text = file_text
        spec = json.loads(file_text)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.empty(self.size, dtype=object)
        for token, k in [*vocab.items(), *self.special.items()]:
            self.tokens[k] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.inner = np.array([vocab[s] for s in byte_symbols()], dtype=np.int32)
        self.last = np.array([vocab[s + end] for s in byte_symbols()], dtype=np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; -1 if it has none."""
        wanted = left.astype(np.int64) * self.size + right
        wanted[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.rank_of[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        raw = "\0".join(words).encode("utf-8", "surrogatepass") + b"\0"
        data = np.frombuffer(raw, dtype=np.uint8)
        lengths = np.array([len(w.encode("utf-8", "surrogatepass")) for w in words])
        ends = np.cumsum(lengths + 1) - 1  # the mark after each word; a zero may also be text
        symbols = self.inner[data]
        symbols[ends[lengths > 0] - 1] = self.last[data[ends[lengths > 0] - 1]]
        symbols[ends] = -1
        self._merge(symbols)
        words_of = np.repeat(np.arange(len(words)), lengths + 1)
        live = symbols >= 0
        return symbols[live], np.bincount(words_of[live], minlength=len(words))

    def _merge(self, symbols: np.ndarray) -> None:
        """Merge in place. Slots that a merge empties become -2; -1 marks the ends of words."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def put(ranks: np.ndarray, at: np.ndarray) -> None:
            real = ranks >= 0
            ranks, at = ranks[real], at[real]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                rank = int(ranks[a])
                if rank in places:
                    places[rank].append(at[a:b])
                else:
                    places[rank] = [at[a:b]]
                    heapq.heappush(active, rank)

        put(self.ranks(symbols[:-1], symbols[1:]), np.arange(n - 1))
        while active:
            rank = heapq.heappop(active)
            listed = places.pop(rank)
            at = listed[0] if len(listed) == 1 else np.concatenate(listed)
            left, right = self.left[rank], self.right[rank]
            # A listed place may have changed since; every place once, in order.
            at = at[symbols[at] == left]
            at = np.unique(at[symbols[after[at]] == right])
            if left == right and len(at) > 1:  # of overlapping pairs, every other one from the left
                chained = after[at[:-1]] == at[1:]
                first = np.concatenate(([True], ~chained))
                run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            follow = after[gone]
            symbols[at], symbols[gone] = self.made[rank], -2
            after[at], before[follow] = follow, at
            beside = before[at]
            put(
                np.concatenate(
                    (
                        np.where(beside >= 0, self.ranks(symbols[beside], symbols[at]), -1),
                        self.ranks(symbols[at], symbols[follow]),
                    )
                ),
                np.concatenate((beside, at)),
            )

    def decode(self, ids: np.ndarray) -> str:
        """Tokens parted by blanks, as the tokenizer does when its file names no decoder."""
        return " ".join(self.tokens[ids].tolist())


class Words(dict):
    """A number for every word, in the order of arrival."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """Encodes texts; remembers the ids of words that it has met, up to a bound."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.marks = re.compile("(" + "|".join(map(re.escape, table.special)) + ")")
        self.library = tokenizers.Tokenizer.from_str(table.file_text)
        self.byte_of = {symbol: b for b, symbol in enumerate(byte_symbols())}
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.ids, self.starts = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens are pieces of their own, marked by a leading zero."""
        found: list[str] = []
        for k, part in enumerate(self.marks.split(text) if self.table.special else [text]):
            if k % 2:
                found.append("\0" + part)
                continue
            if not part.isascii():
                if any(unicodedata.category(c) == "Cn" for c in set(part)):
                    found += self.library_pieces(part)
                    continue
                # The tokenizer lowers each character by itself; Python would mind a final sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            found += _WORD.findall(part.lower())
        return found

    def library_pieces(self, text: str) -> list[str]:
        """Words as the tokenizers library parts them: for characters that Python's Unicode tables
        don't know yet, which it may take for letters."""
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, part)).decode() for part, _ in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > REMEMBERED:
            self.forget()
        number = self.words.__getitem__
        coded = [np.array(list(map(number, self.pieces(t))), dtype=np.int64) for t in texts]
        self._learn()
        every = np.concatenate([*coded, np.empty(0, dtype=np.int64)])
        sizes = np.diff(self.starts)[every]
        ends = np.cumsum(sizes)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.starts[every] - (ends - sizes), sizes
        )
        ids = self.ids[where].astype("<u4")
        per_text = np.concatenate(([0], ends))[np.cumsum([0, *map(len, coded)])]
        return [ids[a:b] for a, b in zip(per_text[:-1], per_text[1:], strict=True)]

    def _learn(self) -> None:
        fresh, self.words.fresh = self.words.fresh, []
        if not fresh:
            return
        special = self.table.special
        marked = [k for k, w in enumerate(fresh) if w[0] == "\0" and w[1:] in special]
        ids, counts = self.table.encode_words(
            ["" if k in set(marked) else w for k, w in enumerate(fresh)] if marked else fresh
        )
        starts = np.concatenate(([0], np.cumsum(counts)))
        for shift, k in enumerate(marked):
            at = starts[k] + shift
            ids = np.insert(ids, at, special[fresh[k][1:]])
            counts[k] = 1
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(counts)))
        self.ids = np.concatenate((self.ids, ids))


def round_trip(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns the id as ``doc_id``, ``ids`` (little-endian unsigned 32-bit integers in a row) and
    ``decoded``. ``tokenizer_file`` is read by the driver.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        table = docs.sparkSession.sparkContext.broadcast(MergeTable(file.read()))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(table.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                ids = encoder.encode(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array([table.value.decode(x) for x in ids], pa.string()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
