"""A minimal perfect hash of distinct 64-bit keys, built level by level.

At each level the keys that are left are dealt to twice as many places; a key that is alone in its
place keeps it, the others go on. The slot of a key is the number of taken places before its own.
A key that is not in the table may get any slot or none, so callers store what they put in and
compare.
"""

from __future__ import annotations

import numpy as np

from skyledger.llm.words import _keys, mix

SPREAD = 2
LEVEL_KEYS = _keys(21, 64)


def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        hashed = mix(keys + LEVEL_KEYS[level])
    return ((hashed >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for the n keys it was built from."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.taken = levels
        self.before, self.size = [], 0
        for taken in levels:
            upto = np.cumsum(taken, dtype=np.int64)
            self.before.append(upto + (self.size - 1))
            self.size += int(upto[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.astype(np.uint64)
        while len(left):
            if len(levels) == len(LEVEL_KEYS):
                raise ValueError("the keys are not distinct")
            places = SPREAD * len(left) + 1
            at = _place(left, len(levels), places)
            counts = np.bincount(at, minlength=places)
            levels.append(counts == 1)
            left = left[counts[at] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some, not all, keys that are not in the table."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, taken in enumerate(self.taken):
            at = _place(keys[left], level, len(taken))
            own = taken[at]
            out[left[own]] = self.before[level][at[own]]
            left = left[~own]
        return out

    def parts(self) -> list[np.ndarray]:
        """What ``from_parts`` needs: the number of places of each level and their bits."""
        sizes = np.array([len(taken) for taken in self.taken], dtype="<i8")
        return [sizes, np.packbits(np.concatenate([*self.taken, np.zeros(0, bool)]))]

    @classmethod
    def from_parts(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        each = np.frombuffer(sizes, dtype="<i8")
        flags = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(each.sum())).view(bool)
        return cls(np.split(flags, np.cumsum(each)[:-1]) if len(each) else [])
