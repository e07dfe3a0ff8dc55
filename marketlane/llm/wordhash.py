"""64-bit hashes of words and word sequences for a batch of texts at once (numpy inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes of text that are hashed together; a longer text forms a batch of its own.
BATCH_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ORDER = _rng.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)

SPACE = np.arange(256, dtype=np.uint8)
SPACE[65:91] += 32
SPACE[list(b" \t\n\x0b\x0c\r")] = 0
SPACE[0] = 1  # a NUL is part of a word
# Letters, digits and bytes above ASCII make words; all else parts them.
ALNUM = np.where(np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]), SPACE, 0).astype(np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def batches(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about BATCH_BYTES with the place of their first."""
    start, size, held = 0, 0, []
    for i, t in enumerate(texts):
        held.append(t or b"")
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def words(texts: list[bytes], table: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after the other, and the bounds of each text's words in them."""
    data = table[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = data != 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, first)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    length = ends - starts
    at = np.cumsum(length) - length
    place = np.arange(at[-1] + length[-1]) - np.repeat(at, length)
    power = np.cumprod(np.full(length.max(), _STEP, np.uint64))
    return mix(np.add.reduceat(_BYTE[data[inside]] * power[place], at) + length.astype(np.uint64)), bounds


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; runs may cross texts, the caller leaves those out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    last = len(hashes) - n + 1
    total = hashes[:last] * _ORDER[0]
    for k in range(1, n):
        total += hashes[k : last + k] * _ORDER[k]
    return mix(total + np.uint64(n))


def shingle_sets(texts: list[bytes | None], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's runs of n words; of the whole where it has fewer."""
    for _, held in batches(texts):
        h, bounds = words(held)
        all_grams = grams(h, n)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= n:
                yield np.unique(all_grams[a : b - n + 1])
            elif b > a:
                yield grams(h[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)
