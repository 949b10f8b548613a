"""Words and word shingles as 64-bit hashes, worked on per Arrow batch inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z in lower case."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def slices(texts, chars: int = 1_000_000) -> Iterator[slice]:
    """Consecutive runs of texts of about `chars` characters, so that work on one is bounded."""
    start = size = 0
    for at, text in enumerate(texts):
        size += 0 if text is None else len(text)
        if size >= chars:
            yield slice(start, at + 1)
            start, size = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class WordHasher:
    """Hashes of words. A table of those seen before takes longer than the hash."""

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def positional_shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The shingle starting at each word; a shorter text is one shingle, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    length = min(size, n)
    total = np.full(n - length + 1, length, np.uint64)
    for k in range(length):
        total += mixed(hashes[k : n - length + 1 + k] + np.uint64(k)) * np.uint64(
            MULTIPLIERS[k % len(MULTIPLIERS)]
        )
    return mixed(total)
