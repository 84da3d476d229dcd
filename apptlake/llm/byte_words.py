"""Words of many texts at once, as Arrow values cut out of their UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Kinds of bytes: part of a word, between words, or between words that no phrase spans.
INSIDE, GAP, EDGE = 0, 1, 2


def lowered() -> np.ndarray:
    """What each byte is read as: A-Z as a-z, others as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@dataclass(frozen=True)
class Words:
    """All words of the texts in a row: their bytes, the text each is of, and its piece, a stretch
    of a text without an edge."""

    values: pa.Array
    text_of: np.ndarray
    piece_of: np.ndarray

    def __len__(self) -> int:
        return len(self.values)


def split_words(texts: list[bytes], kinds: np.ndarray) -> Words:
    """Words of all texts, A-Z lowered; ``kinds`` says what each byte is, a line feed no word's."""
    joined = b"\n".join([b"", *texts, b""])
    kind = np.frombuffer(joined.translate(kinds.tobytes()), dtype=np.uint8)
    inside = kind == INSIDE
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    outside = np.flatnonzero(kinds != INSIDE).astype(np.uint8).tobytes()
    kept = joined.translate(lowered().tobytes(), outside)
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    edges = np.cumsum([1, *(len(t) + 1 for t in texts)])
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, edges)))
    # Texts are parted by a line feed, so pieces of different texts differ where that is an edge.
    before = np.searchsorted(starts, np.flatnonzero(kind == EDGE))
    piece_of = np.repeat(np.arange(len(before) + 1), np.diff(before, prepend=0, append=len(starts)))
    return Words(values, text_of, piece_of)
