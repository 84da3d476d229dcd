"""Word shingles of whole texts as 64-bit numbers, worked out for many texts at once."""

from __future__ import annotations

import hashlib
import re
from itertools import pairwise

import numpy as np
import pyarrow as pa

from apptlake.llm.byte_words import GAP, split_words

#: Words of a text (fixed value of the contract), after A-Z are lowered.
WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

#: Bytes between words; A-Z are lowered as words are split.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = GAP


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of a well-known generator)."""
    x = x + np.uint64((0xD1B54A32D192ED03 * (salt + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cut(words: pa.Array) -> list[bytes]:
    """Words as Python bytes, cut out of their buffer: several times as fast as to_pylist()."""
    if not len(words):
        return []
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    data = bytes(data)
    return [data[start:end] for start, end in pairwise(edges)]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes for every word of all texts in a row, as two rows, and how many words
    each text has. They are halves of a cryptographic hash, so no words are known to share one."""
    words = split_words(texts, KINDS)
    coded = words.values.dictionary_encode()
    digests = b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in _cut(coded.dictionary))
    hashes = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    return hashes.T[:, coded.indices.to_numpy()], np.bincount(words.text_of, minlength=len(texts))


def _sets(words: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    spans = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64))
    for k in range(width):
        spans += words[k : k + len(spans)] * (factors[k] | np.uint64(1))
    spans = mixed(spans)
    found, at = [], 0
    for n in counts.tolist():
        if n >= width:
            found.append(np.unique(spans[at : at + n - width + 1]))
        elif n:
            whole = (words[at : at + n] * (factors[:n] | np.uint64(1))).sum(dtype=np.uint64)
            found.append(mixed(np.array([whole + np.uint64(n)]), 7))
        else:
            found.append(np.empty(0, dtype=np.uint64))
        at += n
    return found


def shingle_sets(texts: list[bytes], width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct shingles of each text as sorted 64-bit numbers, twice, by independent hashes. Texts
    with fewer words than the width have their whole sequence as one; those without words none."""
    hashes, counts = word_hashes(texts)
    return _sets(hashes[0], counts, width), _sets(hashes[1], counts, width)


def exact_shingles(text: str, width: int) -> frozenset[str]:
    """The same sets as the shingles themselves, for exact comparison."""
    words = WORD.findall(text.translate(_LOWER))
    if len(words) < width:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(map(" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
