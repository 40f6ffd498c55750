"""Words of texts as 64-bit numbers, a batch of documents at a time.

A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` yields.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a Python worker handles at a time.
CHUNK_BYTES = 2 << 20
#: Words that a worker keeps the hash of.
CACHED_WORDS = 400_000


class WordHashes(dict):
    """Word to xxHash64, remembered for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts have about ``limit`` bytes (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for a, b in zip(starts, [*starts[1:], len(part)], strict=True):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in batch[column].cast(pa.binary()).to_pylist()]


def hashed_words(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after another, and the number of words of each text."""
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(counts.sum()))
    return flat, counts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
