"""A cuckoo filter over 128-bit digests that grows by chaining and supports deletion.

Tables have buckets of four 16-bit fingerprints (0: free). A digest's
fingerprint, first bucket and the exclusive-or that leads to its second bucket
come from its bytes. When a table cannot take a fingerprint, a table of twice
the size is chained. No digest that was inserted and not removed is ever missed:
a fingerprint is taken out only where a single table has it, which then is the
digest's own; else it stays, and ``left`` counts it as one that answers yes to
a digest that is gone.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
FIRST_BUCKETS = 64
MOST_MOVES = 200


def _places(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and the two buckets of each digest (rows of two uint64)."""
    mark = (digests[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1
    one = (digests[:, 1] & np.uint64(buckets - 1)).astype(np.int64)
    return mark, one, one ^ _leap(mark, buckets)


def _leap(mark, buckets: int):
    return (np.asarray(mark).astype(np.int64) * 0x5BD1E995 >> 3) & (buckets - 1)


def as_digests(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2)


class Filter:
    def __init__(self, blob: bytes | None = None) -> None:
        self.tables: list[np.ndarray] = []
        self.left = 0
        at = 0
        while blob and at < len(blob):
            buckets = int.from_bytes(blob[at : at + 8], "little")
            size = buckets * SLOTS * 2
            self.tables.append(np.frombuffer(blob, np.uint16, buckets * SLOTS, at + 8).reshape(-1, SLOTS).copy())
            at += 8 + size

    def to_bytes(self) -> bytes:
        return b"".join(len(t).to_bytes(8, "little") + t.tobytes() for t in self.tables)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        found = np.zeros(len(digests), bool)
        for t in self.tables:
            mark, one, two = _places(digests, len(t))
            found |= ((t[one] == mark[:, None]) | (t[two] == mark[:, None])).any(axis=1)
        return found

    def _put(self, table: np.ndarray, digest: np.ndarray) -> bool:
        """Place one digest, moving others along; undone where no way is found."""
        mark, one, two = (int(v[0]) for v in _places(digest, len(table)))
        for at in (one, two):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        at, moves = one, []
        for k in range(MOST_MOVES):
            slot = k % SLOTS
            moves.append((at, slot, int(table[at, slot])))
            mark, table[at, slot] = int(table[at, slot]), mark
            at ^= int(_leap(mark, len(table)))
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        for at, slot, old in reversed(moves):
            table[at, slot] = old
        return False

    def insert(self, digests: np.ndarray) -> None:
        for k in range(len(digests)):
            if not self.tables or not self._put(self.tables[-1], digests[k : k + 1]):
                self.tables.append(np.zeros((len(self.tables[-1]) * 2 if self.tables else FIRST_BUCKETS, SLOTS), np.uint16))
                self._put(self.tables[-1], digests[k : k + 1])

    def remove(self, digests: np.ndarray) -> None:
        """Take out digests that were inserted before."""
        for k in range(len(digests)):
            found = []
            for t in self.tables:
                mark, one, two = (int(v[0]) for v in _places(digests[k : k + 1], len(t)))
                at = next(((b, int(s)) for b in (one, two) for s in np.flatnonzero(t[b] == mark)), None)
                if at:
                    found.append((t, at))
            if len(found) == 1:
                found[0][0][found[0][1]] = 0
            else:
                self.left += 1
