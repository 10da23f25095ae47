"""Words, word hashes and batches: helpers of the operators on texts.

Texts reach Python as UTF-8 bytes (a binary cast of the column), so nothing is
decoded: ``bytes.lower`` folds A-Z alone and ``bytes.split`` cuts at exactly
the characters U+0020 and U+0009 to U+000D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Distinct words that a task remembers the hash of; a full memory is emptied.
MEMORY = 150_000

#: Odd multiplier that chains word hashes into sequence hashes.
CHAIN = np.uint64(0x9E3779B97F4A7C15)

_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, computed once for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def space_words(text: bytes | None) -> list[bytes]:
    """Maximal runs without white space, unchanged; null has none."""
    return text.split() if text else []


def lower_words(text: bytes | None) -> list[bytes]:
    """The same with A-Z folded to a-z."""
    return text.lower().split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits of ASCII and of anything beyond it, A-Z folded."""
    return text.lower().translate(_PLAIN).split() if text else []


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words; none if there are fewer."""
    k = len(hashes) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * CHAIN + hashes[j : j + k]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def small_batches(batches: Iterator[pa.RecordBatch], column: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that ``column`` holds about ``budget`` bytes in each; a longer row stays whole."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + budget, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    # workers are used again: what a task has freed should not stay with them
    pa.default_memory_pool().release_unused()
